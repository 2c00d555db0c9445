"""The operators against brute force, on odd rows and small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from ordermill.llm import (
    decontamination, induced, language, pii, simhash, substring, suffixarray, suffixtree, topk,
    toxicity,
)
from tests.llm.util import documents, left_behind

ODD = [None, "", " ", "a", "same words here", "same words here", "x " * 30_000, "é ß 漢字 😀 \x00 end"]
IDS = [3, 4, 5, None, 7, 7, 8, 9]
CLASH = ["*", "1 AS fp", "2 AS score", "3 AS k", "4 AS t", "5 AS spans", "6 AS kind", "7 AS root"]


def words(n, seed, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


# Repeated lines


def test_repeated_units_go_but_the_first(spark):
    line = "This sentence is long enough to be compared with others of its kind."
    texts = [f"First own line of the first text, nothing more.\n{line}\nEnd.",
             f"Other. {line.upper()} And a tail that is only here, for certain.", None, "", line]
    rows = {r.doc_id: r for r in substring.remove_repeats(
        documents(spark, texts).selectExpr(*CLASH)).collect()}
    assert [rows[i].n_spans for i in range(5)] == [0, 1, 0, 0, 1]
    assert rows[0].text == texts[0] and rows[4].text == ""
    span = rows[1].removed[0]
    assert texts[1][span.start : span.end].strip() == line.upper()
    assert span.kept_doc_id == 0 and texts[0][span.kept_start :].startswith(line)
    assert rows[1].text == texts[1][: span.start] + texts[1][span.end :]


def test_short_repeated_units_go(spark):
    texts = ["Short line\n\nOwn one. Yes.", "short  LINE\n\nOwn two. Yes. Own three.\n", "Yes."]
    rows = {r.doc_id: r for r in substring.remove_repeats(documents(spark, texts)).collect()}
    assert [rows[i].text for i in range(3)] == [texts[0], "\nOwn two. Own three.\n", ""]


def test_substring_on_odd_and_empty_tables(spark):
    docs = documents(spark, ODD, doc_id=IDS)
    assert substring.remove_repeats(docs).count() == len(ODD)
    assert substring.remove_repeats(docs.limit(0)).count() == 0


# SimHash


def brute_fingerprint(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or (
        [" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    known = list(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in known}


@pytest.mark.parametrize("max_bucket", [1, 64])
def test_links_of_fingerprints(spark, max_bucket):
    pick = random.Random(max_bucket)
    prints = {0, 1, 2**63}
    for _ in range(30):
        f = pick.getrandbits(64)
        for _ in range(12):
            prints.add(f)
            f ^= 1 << pick.randrange(64)
            f ^= pick.choice([0, 1 << pick.randrange(64)])
    table = spark.createDataFrame([(f - (f >> 63 << 64),) for f in prints], "fp long")
    got = collections.defaultdict(set)
    for r in simhash.components(simhash.links(table, max_bucket=max_bucket), "test").collect():
        got[r.root].add(r.node % 2**64)
    expected = collections.defaultdict(set)
    for f, r in brute_components(prints).items():
        expected[r].add(f)
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(v) for v in expected.values() if len(v) > 1)


def test_near_duplicates_of_texts(spark):
    base = words(200, 1)
    texts = ODD + [" ".join(base), " ".join(base[:-1] + ["other"]), " ".join(words(200, 2))]
    ids = IDS + [20, 21, 22]
    docs = documents(spark, texts, doc_id=ids).selectExpr(*CLASH)
    prints = [brute_fingerprint(t) for t in texts]
    roots = brute_components(prints)
    least = {}
    for i, f in zip(ids, prints):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((repr(r.doc_id), r.fp % 2**64, r.component_id) for r in rows) == sorted(
        (repr(i), f, least.get(roots[f])) for i, f in zip(ids, prints))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# Suffix arrays


@pytest.mark.parametrize("seed", range(60))
def test_repeated_starts(seed):
    pick = random.Random(seed)
    length = pick.choice([8, 9, 20])
    signs = bytes(range(pick.choice([1, 2, 26])))
    texts = [bytes(pick.choices(signs, k=pick.randrange(length, length + 40))) for _ in range(8)]
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for text, found in zip(texts, induced.repeated_starts(texts, length)):
        assert [count[text[i : i + length]] > 1 for i in range(len(text) - length + 1)] == found.tolist()


@pytest.mark.parametrize("anchor_bytes", [0, 1 << 20])
def test_long_repeats_go(spark, anchor_bytes):
    pick = random.Random(5)
    block = "".join(pick.choices("abcdé ", k=400))
    texts = ["".join(pick.choices("abcd", k=pick.randrange(300))) for _ in range(20)]
    texts += [t + block[: pick.randrange(400)] + t for t in texts] + ["z" * 700, "", None, block, block]
    length = 40
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    rows = {r.doc_id: r for r in suffixarray.remove_repeats(
        documents(spark, texts).selectExpr(*CLASH), length, 8, 4096, anchor_bytes).collect()}
    for i, text in enumerate(data):
        covered = bytearray(len(text))
        for s in range(len(text) - length + 1):
            if count[text[s : s + length]] > 1:
                covered[s : s + length] = b"\1" * length
        assert rows[i].n_removed == sum(covered)
        assert rows[i].n_spans == len(re.findall(b"\1+", bytes(covered)))
        assert bytes(rows[i].kept) == bytes(b for b, c in zip(text, covered) if not c)


def test_suffix_arrays_on_empty_table(spark):
    assert suffixarray.remove_repeats(documents(spark, ["a"]).limit(0)).count() == 0


# Language-model scores


def test_scores_against_counts(spark):
    texts = [" ".join(words(80, i, 60)) for i in range(40)] + [None, "", "New words ONLY", "NEW words"]
    docs = documents(spark, texts).selectExpr(*CLASH)
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\n"] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total = sum(count.values())
    for r in suffixtree.score(docs).collect():
        ws = tokens[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(base) and r.score < 0


def brute_scores(lists, held, max_words):
    """{context: (state, {next: n})} and scores of lists of known words, by the definition."""
    count = collections.Counter(w for ws, h in zip(lists, held) if not h for w in ws)
    total = sum(count.values()) + len(count) + 1
    states, tracked = {}, set()

    def probability(context, word, longest):
        p = (count[word] + 1) / total
        for size in range(1, min(longest, len(context)) + 1):
            after = states.get(tuple(context[-size:]))
            if after is None:
                break
            n, t = sum(after.values()), len(after)
            single = sum(x == 1 for x in after.values())
            p = ((after[word] if after[word] > 1 else 0) + (t + single) * p) / (n + t)
        return p

    for size in range(1, max_words + 1):
        seen = collections.defaultdict(collections.Counter)
        for ws, h in zip(lists, held):
            for i in range(size, len(ws) if not h else 0):
                context = tuple(ws[i - size : i])
                if size == 1 or context[1:] in states:
                    seen[context][ws[i]] += 1
        # Looked at: seen twice or more, as is the context without its last word, for any length.
        seen = {c: after for c, after in seen.items()
                if sum(after.values()) > 1 and (size == 1 or c in tracked)}
        tracked = {(*c, w) for c, after in seen.items() for w, n in after.items() if n > 1}
        found = {}
        for context, after in seen.items():
            of, t, gain = sum(after.values()), len(after), 0.0
            for w, n in after.items():
                steps = round(-math.log(probability(context[1:], w, size - 1)) * suffixtree.STEPS)
                p = math.exp(-steps / suffixtree.STEPS)
                gain += n * math.log(((n - 1) / p + t) / (of - 1 + t))
            if gain > 0:
                found[context] = after
        states |= found
    return states, [
        sum(math.log10(probability(ws[max(i - max_words, 0) : i], w, max_words)) for i, w in enumerate(ws))
        for ws in lists]


@pytest.mark.parametrize("hot, max_words", [(1 << 21, 1), (1 << 21, 3), (20, 3)])
def test_scores_against_all_contexts(spark, monkeypatch, hot, max_words):
    """Frequent contexts count, longer ones too; several chunks and hot contexts change nothing."""
    pick = random.Random(11)
    follow = {w: pick.sample(range(30), 2) for w in [(a, b) for a in range(30) for b in range(30)]}
    texts = []
    for _ in range(70):
        ws = [pick.randrange(30), pick.randrange(30)]
        while len(ws) < 90:
            ws.append(pick.choice(follow[ws[-2], ws[-1]]) if pick.random() < 0.8 else pick.randrange(30))
        texts.append(" ".join(f"w{w}" for w in ws))
    lists = [t.split() + ["\n"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    monkeypatch.setattr(suffixtree, "BUCKET_TOKENS", 1500)
    states, expected = brute_scores(lists, held, max_words)
    assert any(sum(after.values()) > 64 for after in states.values())
    assert {len(c) for c in states} == set(range(1, max_words + 1))
    rows = {r.doc_id: r for r in suffixtree.score(documents(spark, texts), max_words=max_words, hot=hot).collect()}
    for i, score in enumerate(expected):
        assert rows[i].score == pytest.approx(score, abs=1e-6)
    for context in [*states][:50]:  # What follows a context shares one at most.
        n, t = sum(states[context].values()), len(states[context])
        listed = sum(x for x in states[context].values() if x > 1)
        assert listed / (n + t) < 1
    test = [i for i, h in enumerate(held) if h]
    assert sum(rows[i].score for i in test) > sum(rows[i].base_score for i in test)


def test_scores_of_odd_and_empty_tables(spark):
    docs = documents(spark, ODD, doc_id=IDS)
    assert suffixtree.score(docs).filter("score < 0").count() == len(ODD)
    assert suffixtree.score(docs.limit(0)).count() == 0


def test_pairs_sort_as_whole_numbers():
    """Numbers that leave no room for their places sort as well."""
    pick = np.random.default_rng(1)
    for size, most in ((0, 5), (1, 1), (1000, 30), (5000, 2**31 - 1)):
        high, low = (pick.integers(0, most, size).astype(np.int32) for _ in range(2))
        whole = high.astype(np.int64) << 32 | low
        order = np.argsort(whole, kind="stable")
        pairs, places = suffixtree._sorted_pairs(high, low)
        assert np.array_equal(pairs, whole[order]) and np.array_equal(places, order)


def test_language_model_leaves_no_shuffles(spark, conf):
    """Before the scores are asked for, only the tables they are made from are on disk."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")  # No shuffle is given up half-way.
    docs = documents(spark, [" ".join(words(60, i, 50)) for i in range(30)])
    files, tables, scores = left_behind(spark, lambda: suffixtree.score(docs))
    assert not files
    assert tables == ["lm-counts", "lm-numbered", "lm-states-1", "lm-states-2"]
    assert scores.count() == scores.count() == 30


# Top-k


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "STEP_QUERIES", 3)
    pick = np.random.default_rng(3)
    vectors = pick.integers(-9, 9, (300, 6)).astype(float)  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6)]
    rows += [(902, [float("nan")] * 6), (903, [float("inf")] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ready = topk.quantised(table, scale=1)
    got = topk.top_k(ready, ready.filter("vec_id % 10 = 0"), 5, block_rows=64, group_queries=8)
    expected = set()
    for q in range(0, 300, 10):
        scores = vectors @ vectors[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:5]
        expected |= {(q, n + 1, i, int(scores[i])) for n, i in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expected
    assert topk.top_k(ready.limit(0), ready.limit(0)).count() == 0
    assert topk.top_k(ready.filter("vec_id < 2"), ready.filter("vec_id < 2")).count() == 2


# Personal data


def brute_spans(text):
    def luhn(digits):
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in plain.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            right = (
                kind == "email"
                or kind == "ip" and all(int(p) < 256 for p in m.group().split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15)
            if right:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans(spark):
    pick = random.Random(11)
    signs = ["1", "4", "2555", "0", ".", "@", "a", "b-", "+", " ", "(", ")", "%", "é😀", "\n", "4111 1111 1111 1111", "10.0.0.1",
             "x.y@z.com", "+44 20 7946 0958"]
    texts = ["".join(pick.choices(signs, k=pick.randrange(40))) for _ in range(400)]
    texts += ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "1" * 5000, "a." * 3000 + "@b.c", None, ""]
    rows = {r.doc_id: r for r in pii.find(documents(spark, texts).selectExpr(*CLASH)).collect()}
    for i, text in enumerate(texts):
        expected = brute_spans(text or "")
        assert rows[i].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert set(expected) <= set(rows[i].spans.split(",")) | {""}
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [
            sum(s.startswith(k) for s in expected) for k in pii.KINDS]


def test_redaction(spark):
    docs = documents(spark, ["write to x@y.com, or 10.0.0.1!", "clean text", None, "é x@y.com"])
    rows = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert rows[0].text == "write to <EMAIL>, or <IP>!" and rows[0].n_chars == len(rows[0].text)
    assert [rows[i].text for i in (1, 2, 3)] == ["clean text", None, "é <EMAIL>"]
    assert pii.find(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0


def test_spans_of_a_chain_are_taken_by_score(spark):
    """Spans at both ends of a chain stay where the one that joins them does not."""
    pick = random.Random(4)
    rows = [(1, 1, "card", 0, 19, 0.9), (1, 1, "phone", 10, 30, 0.5), (1, 1, "card", 20, 39, 0.8)]
    rows += [(2, t, pick.choice(pii.KINDS), a, a + pick.randrange(1, 12), pick.random())
             for t in range(20) for a in pick.choices(range(60), k=15)]
    found = pii.apart(spark.createDataFrame(
        rows, "k long, t long, kind string, start long, end long, score double"))
    expected = set()
    for k, t, kind, start, end, _ in sorted(rows, key=lambda r: (-r[5], r[3], r[4], r[2])):
        if not any(x[:2] == (k, t) and x[3] < end and start < x[4] for x in expected):
            expected.add((k, t, kind, start, end))
    assert {(1, 1, "card", 0, 19), (1, 1, "card", 20, 39)} < expected
    assert sorted(tuple(r) for r in found.select("k", "t", "kind", "start", "end").collect()) == sorted(expected)


# Toxicity, language, benchmark


def test_toxicity_learns_words_and_leaves_others(spark):
    texts = [" ".join(words(40, i)) + (" vile nasty" if i % 5 == 0 else "") for i in range(600)]
    docs = documents(spark, texts + [None, ""]).selectExpr(*CLASH)
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(600)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 602
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.doc_id % 5 == 0 and r.doc_id < 600) and 0 <= r.score <= 1
    assert toxicity.clean(docs, labels).count() == 602 - 120
    assert toxicity.score(docs, labels.limit(0)).filter("predicted = 0").count() == 602
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_languages(spark):
    pick = random.Random(4)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "zu"]}
    langs = [pick.choice(["aa", "bb"]) for _ in range(300)]
    texts = [" ".join("".join(pick.choices(syllables[g], k=3)) for _ in range(30)) for g in langs]
    docs = documents(spark, texts + [None, "123 !?", "ungzu"], lang=langs + [None, "aa", None])
    rows = {r.doc_id: r for r in language.identify(docs.selectExpr(*CLASH)).collect()}
    assert all(rows[i].lang_pred == g for i, g in enumerate(langs))
    assert rows[300].lang_pred == rows[301].lang_pred == "und" and rows[302].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language.identify(docs.limit(0)).count() == 0


def test_benchmark_passages(spark):
    item = "Rare " + " ".join(words(12, 100, 5000)) + ". The answer is " + " ".join(words(5, 101, 5000)) + "."
    other = " ".join(words(30, 102, 5000))
    changed = item.split()
    changed[3] = "different"
    texts = [" ".join(words(100, i)) for i in range(30)]
    texts[3] += " " + item.upper() + " " + texts[4]
    texts[5] += " " + " ".join(changed)
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, "")], "item_id long, text string")
    docs = documents(spark, texts + ODD, doc_id=[*range(30), *(100 + i for i in range(8))])
    found = decontamination.contaminated(docs.selectExpr(*CLASH), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(3, 1), (5, 1)}
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("n", [20, 400])
def test_short_items_among_rare_words(spark, n):
    """Items of 15 words are found anywhere in texts of words seen once."""
    items = [" ".join(words(15, 200 + i, 40)) for i in range(4)]
    texts = [" ".join(words(60, i, 40)) for i in range(n)]
    for i in range(4):
        own = [f"own{n}x{i}x{j}" for j in range(60)]
        texts.append(" ".join(own[: 13 + 5 * i]) + " " + items[i] + " " + " ".join(own[13 + 5 * i :]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontamination.contaminated(documents(spark, texts), bench)
    assert {(n + i, i) for i in range(4)} <= {(r.doc_id, r.item_id) for r in found.collect()}


@pytest.mark.parametrize("rows, width, most, k", [
    (4000, 4, 300, 10), (3000, 2, 3, 10), (700, 5, 9, 500), (900, 3, 2**33, 10), (40, 0, 1, 5)])
def test_topk_bounds_never_lose_a_row(rows, width, most, k):
    """A block's kept rows hold the k best by brute force, ties in row order."""
    rng = np.random.default_rng(rows)
    matrix = rng.integers(-most, most + 1, (rows, width))
    queries = rng.integers(-9, 10, (20, width))
    found = {i: (kept, score) for i, kept, score in topk.Lists(matrix).top(queries, k)}
    assert sorted(found) == list(range(20))
    for i, (kept, score) in found.items():
        full = matrix @ queries[i]
        assert (score == full[kept]).all()
        best = topk._best(score, k)
        assert (kept[best] == np.lexsort((np.arange(rows), -full))[:k]).all()


def test_topk_of_empty_vectors_scores_zero(spark):
    table = spark.createDataFrame(
        [(1, []), (2, []), (3, [1.0]), (4, None)], "vec_id long, embedding array<float>")
    ready = topk.quantised(table)
    got = topk.top_k(ready, ready.filter("vec_id = 1"), 5).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 0)]

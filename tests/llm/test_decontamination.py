"""Benchmark items in documents, against all windows times all items."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import decontamination as dc
from tests.llm.util import documents

ITEMS = "item_id long, text string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            row[j], left = (left + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def brute(texts, items, width=24, stride=12):
    """{(document, item): greatest cosine} by exact TF-IDF vectors of all windows."""
    split = [dc.words_of(t or "") for t in texts]
    seen = Counter(w for words in split for w in set(words))

    def vector(words):
        counts = Counter(words)
        v = {w: n * (math.log((1 + len(texts)) / (1 + seen[w])) + 1) for w, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / norm for w, x in v.items()}

    found = {}
    shortest = min(len(dc.words_of(t)) for t in items.values())
    for doc, words in enumerate(split):
        for w, step in [(w, max(1, w * stride // width)) for w in dc._widths(width, shortest)]:
            for s in range(0, max(len(words) - w + step, 1), step):
                passage = vector(words[s : s + w])
                for item, text in items.items():
                    own = dc.words_of(text)
                    cosine = sum(x * passage.get(v, 0) for v, x in vector(own).items())
                    if cosine < dc.MIN_COSINE:
                        continue
                    region = words[max(s - len(own), 0) : s + w + len(own)]
                    covered = lcs(own, region) / len(own)
                    sentences = [dc.words_of(x) for x in dc._SENTENCE.split(text) if dc.words_of(x)]
                    answer = sentences[-1] if len(sentences) > 1 else own[len(own) * 2 // 3 :]
                    if covered >= dc.COVERED or (
                        covered >= dc.PARTLY and lcs(answer, region) / len(answer) >= dc.ANSWERED
                    ):
                        found[doc, item] = max(found.get((doc, item), 0), cosine)
    return found


def corpus(seed, n=40, n_items=12):
    """Texts over few words, so that items are nearly covered by chance; some planted."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    shares = [1 / (i + 1) for i in range(60)]

    def prose(k):
        return pick.choices(vocabulary, shares, k=k)

    items = {i: prose(pick.randrange(8, 30)) for i in range(n_items)}
    texts = []
    for d in range(n):
        words = prose(pick.randrange(1, 150))
        if d % 2:
            item = [w for w in items[d % n_items] if pick.random() < pick.choice([0.6, 0.8, 1.0])]
            at = pick.randrange(len(words) + 1)
            words[at:at] = item
        texts.append(" ".join(words))
    return texts, {i: " ".join(w[:-3]) + ". " + " ".join(w[-3:]) + "." for i, w in items.items()}


def test_all_windows_times_all_items(spark):
    for seed in (1, 2):
        texts, items = corpus(seed)
        want = brute(texts, items)
        got = {
            (r.doc_id, r.item_id): r.cosine
            for r in dc.contaminated(
                documents(spark, texts), spark.createDataFrame(list(items.items()), ITEMS)).collect()}
        assert len(want) > 15
        # Cosines right at the limit may fall on either side of it in single precision.
        edge = {k for k, c in want.items() if c < dc.MIN_COSINE + 1e-3}
        assert set(want) - edge <= set(got)
        assert all(k in want or c < dc.MIN_COSINE + 1e-3 for k, c in got.items())


def test_places_lose_no_covered_window():
    pick = random.Random(5)
    for _ in range(150):
        terms = pick.choice([6, 30])
        idf = np.array([1 + pick.random() for _ in range(terms)])
        items = [dc.Item(i, [pick.randrange(terms) for _ in range(pick.randrange(1, 14))], [])
                 for i in range(pick.randrange(1, 5))]
        numbers = np.array([pick.randrange(-1, terms) for _ in range(pick.randrange(0, 60))], np.int32)
        widths = [(8, 4), (4, 2)]
        kept = set(dc.Places(items, idf).windows(numbers, widths))
        for width, stride in widths:
            for s in range(0, max(len(numbers) - width + stride, 1), stride):
                best = max(
                    lcs(i.words, numbers[max(s - len(i.words), 0) : s + width + len(i.words)].tolist())
                    / len(i.words) for i in items)
                assert best < dc.PARTLY or (s, width) in kept


def test_places_count_many_pairs_together(monkeypatch):
    """Windows and items are counted at once, in as many parts as it takes."""
    pick = random.Random(6)
    items = [dc.Item(i, [pick.randrange(40) for _ in range(pick.randrange(3, 14))], []) for i in range(6)]
    places = dc.Places(items, np.array([1 + pick.random() for _ in range(40)]))
    numbers = np.array([pick.randrange(-1, 40) for _ in range(300)], np.int32)
    found = places.windows(numbers, [(8, 4), (4, 2)])
    assert found == sorted(set(found), key=lambda f: (-f[1], f[0])) and {w for _, w in found} == {8, 4}
    for start, width in found:
        regions = [
            (Counter(i.words), Counter(
                numbers[max(start - len(i.words), 0) : start + width + len(i.words)].tolist())) for i in items]
        assert any((own & near).total() >= dc.PARTLY * own.total() - 1e-3 for own, near in regions)
    monkeypatch.setattr(dc, "PAIRS", 2)
    assert places.windows(numbers, [(8, 4), (4, 2)]) == found


def test_repeated_items_and_small_blocks(spark):
    texts, items = corpus(3, n=20, n_items=7)
    docs = documents(spark, texts)
    plain = spark.createDataFrame(list(items.items()), ITEMS)
    copies = spark.createDataFrame(
        [(100 + i, items[0]) for i in range(30)] + [(None, items[0]), (7, None), (8, ""), (9, "?!")], ITEMS)
    whole = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, plain).collect()}
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(
        docs, plain.unionByName(copies), block_items=2).collect()}
    hit = {d for d, i in whole if i == 0}
    assert {(d, i) for d, i in found if i is not None and i < 100} == whole
    assert {(d, i) for d, i in found if i is None or i >= 100} == {
        (d, i) for d in hit for i in [None, *range(100, 130)]}


def test_no_items_and_no_documents(spark):
    docs = documents(spark, ["a b c", None])
    none = spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "a b c")], ITEMS)
    assert dc.contaminated(docs, none).collect() == []
    assert dc.contaminated(docs.limit(0), one).collect() == []
    assert [r.doc_id for r in dc.contaminated(docs, one).collect()] == [0]
    clash = documents(spark, ["a b c", "z"]).selectExpr("*", "1 AS __k", "2 AS __t", "3 AS word")
    kept = dc.clean(clash.drop("__k", "__t"), one)
    assert [r.doc_id for r in kept.collect()] == [1]


def test_words_are_those_of_the_pattern():
    texts = [chr(c) for c in range(0x3000)] + ["a" + chr(c) + "B_c" for c in range(0x250)]
    texts += ["É ß_x 漢字 😀 e\u0301 \ud800 ١٢ ²", "Ünder_Score\tx\x1cy\x85z", "İI ŉ", "x\u3000y\xa0z", ""]
    for text in texts:
        assert dc.words_of(text) == re.findall(r"[^\W_]+", text.lower())


def test_words_are_split_without_the_pattern(monkeypatch):
    """Only texts with other signs than letters and digits outside ASCII need it."""
    monkeypatch.setattr(dc, "_WORD", None)
    assert dc.words_of("One, two_THREE 4.") == ["one", "two", "three", "4"]
    assert dc.words_of("Één, zwölf_漢字") == ["één", "zwölf", "漢字"]


def test_all_passages_are_weighed_and_none_is_left_out(spark, monkeypatch):
    """Also those far from any item: all go into the decomposition, with their norms."""
    monkeypatch.setattr(dc, "STRETCH", 24)
    monkeypatch.setattr(dc, "PACKED", 50)
    pick = random.Random(8)
    known = [f"w{i}" for i in range(9)]
    texts = [
        pick.choices(known + [f"x{i}" for i in range(40)], k=k) for k in [1, 2, 7, 24, 25, 90, 131]
    ] + [["far", "from", "any", "item"] * 9, []]
    idf = np.array([1 + pick.random() for _ in known])
    often = {dc._digest(f"x{i}"): 1.5 for i in range(20)}
    widths, number = [(8, 4), (4, 2)], {w: i for i, w in enumerate(known)}
    weights = {**dict(zip(known, idf)), **{f"x{i}": 1.5 for i in range(20)}}

    class Shared:
        value = often

    docs = documents(spark, [" ".join(t) for t in texts]).selectExpr("doc_id", "doc_id AS text_hash", "text")
    table = dc._passages(docs, number, idf, Shared, 2.0, widths, 5)
    wanted, dense = {}, []
    for doc, words in enumerate(texts):
        for w, step in widths:
            for s in range(0, max(len(words) - w + step, 1) if words else 0, step):
                counts = Counter(words[s : s + w])
                row = {v: n * weights.get(v, 2.0) for v, n in counts.items()}
                wanted.setdefault((doc, w), []).append(sum(x * x for x in row.values()))
                dense.append([row.get(v, 0) / math.sqrt(wanted[doc, w][-1]) for v in known])
    found, total = {}, 0
    for r in table.orderBy("doc_id", F.expr("monotonically_increasing_id()")).collect():
        squares = np.frombuffer(r.squares, "<f8").tolist()
        for (w, _), n in zip(widths, r.counts):
            found.setdefault((r.doc_id, w), []).extend(squares[:n])
            squares, total = squares[n:], total + n
    assert {k for k, v in found.items() if v} == set(wanted) and total == len(dense)
    assert all(np.allclose(sorted(found[k]), sorted(wanted[k])) for k in wanted)
    dense = np.array(dense)
    x = np.random.default_rng(1).standard_normal((len(known), 3))
    batch = table.toArrow().combine_chunks().to_batches()[0]
    for side, summed in ((4096, 1 << 20), (4, 3)):
        monkeypatch.setattr(dc, "SIDE", side)
        monkeypatch.setattr(dc, "SUMMED", summed)
        for most in (1, 60, 10**6):
            products = dc._Products(x, idf, widths)
            for packed in dc._packed(batch, widths, most):
                products.add(packed)
            products.flush()
            assert np.allclose(products.total, dense.T @ (dense @ x), rtol=1e-4, atol=1e-4)
    # The space is that of all passages and of the items, not of passages near items only.
    items = [np.array([0, 1, 2]), np.array([3, 4])]
    latent = dc._latent(table, items, idf, widths, 6, 8)
    rows = np.zeros((2, len(known)))
    for i, words in enumerate(items):
        rows[i, words] = idf[words] / np.linalg.norm(idf[words])
    right = np.linalg.svd(np.vstack([dense, math.sqrt(len(dense)) * rows]))[2][:3].T
    assert np.allclose(np.linalg.svd(latent.T @ right)[1], 1, atol=1e-3)


def test_cosines_are_those_of_the_plain_vectors(spark):
    """Not those of the latent space, which are a little off."""
    texts, items = corpus(4)
    want = brute(texts, items)
    got = {
        (r.doc_id, r.item_id): r.cosine
        for r in dc.contaminated(
            documents(spark, texts), spark.createDataFrame(list(items.items()), ITEMS)).collect()}
    assert set(got) == {k for k in want} and all(abs(got[k] - c) < 1e-9 for k, c in want.items())


def test_items_much_longer_than_a_passage(spark):
    words = [f"v{i}" for i in range(700)]
    texts = ["a b " * 30 + " ".join(words) + " c d" * 40, " ".join(words[:350]), "a b c d " * 20]
    one = spark.createDataFrame([(1, " ".join(words)), (2, "a b c x y z")], ITEMS)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(documents(spark, texts), one).collect()} == {(0, 1)}


def test_items_outside_the_latent_space_are_not_lost(spark, monkeypatch):
    texts, items = corpus(5)
    monkeypatch.setattr(dc, "_latent", lambda passages, items, idf, *_: np.eye(len(idf))[:, :1])
    want = brute(texts, items)
    got = {
        (r.doc_id, r.item_id) for r in dc.contaminated(
            documents(spark, texts), spark.createDataFrame(list(items.items()), ITEMS)).collect()}
    assert len(want) > 15 and got == set(want)

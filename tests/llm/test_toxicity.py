"""The block-max search, its votes and their calibration against brute force."""

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from ordermill.llm import toxicity
from tests.llm.util import documents, left_behind

ODD = [None, "", " ", "a", "same words here", "same words here", "x " * 30_000, "é ß 漢字 😀 \x00 end"]


def words(n, seed, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def examples(vectors, size, neighbours, seed=5):
    pick = np.random.default_rng(seed)
    terms = np.concatenate([v[0] for v in vectors]).astype(np.int32)
    counts = np.concatenate([v[1] for v in vectors]).astype(np.int32)
    return toxicity.Examples(
        np.arange(size), pick.random(size) + 1, pick.random((3, size)).astype(np.float32),
        np.array([len(v[0]) for v in vectors]), terms, counts,
        pick.integers(0, 2, len(vectors)).astype(float), np.arange(len(vectors)), neighbours)


@pytest.mark.parametrize("topics, neighbours", [(1, 15), (8, 15), (8, 100), (8, 2000)])
def test_search_equals_all_cosines(topics, neighbours):
    """Frequent and rare words, ties by repeated vectors; blocks of other topics are skipped."""
    pick = np.random.default_rng(2)
    vectors = []
    for i in range(1500):
        low = 300 * (i % topics)
        some = np.unique(np.concatenate([low + pick.integers(0, 20, 12), low + pick.integers(0, 300, 8)]))
        vectors.append((some, pick.integers(1, 4, len(some))))
    vectors += vectors[:200]
    index = toxicity.Index(examples(vectors, 300 * topics, neighbours))
    dense = np.zeros((len(vectors), 300 * topics))
    for i in range(len(vectors)):
        t, w = index.own(i)
        dense[i, t] = w
    assert np.allclose((dense**2).sum(axis=1), 1)
    own = list(range(0, 1700, 17))
    for without in (None, own):
        found = index.search([index.own(i) for i in own], without)
        for i, (at, cosines, telling) in zip(own, found):
            exact = np.round(dense @ dense[i], 12)
            order = [e for e in np.lexsort((np.arange(len(exact)), -exact)).tolist()
                     if exact[e] > 0 and (without is None or e != i)][:neighbours]
            assert at.tolist() == order and np.allclose(cosines, exact[order])
            told = index.of.told[0 if without is None else 1 if index.of.share[i] > 0 else 2]
            assert np.allclose(telling, (dense[order] * dense[i]) @ told)
    assert index.visited <= index.offered
    if topics == 8 and neighbours == 15:
        assert index.visited < index.offered / 4


@pytest.mark.parametrize("whole", [0, 10**9])
def test_parts_of_lists_and_whole_lists(whole, monkeypatch):
    """Words with a column, frequent and rare ones; frequent lists are read by block or whole."""
    monkeypatch.setattr(toxicity, "WHOLE", whole)
    pick = np.random.default_rng(4)
    vectors = []
    for _ in range(1500):
        some = np.unique((pick.random(40) ** 3 * 3000).astype(int))
        vectors.append((some, pick.integers(1, 5, len(some))))
    index = toxicity.Index(examples(vectors, 3000, 20))
    used = {t for v in vectors for t in v[0].tolist()}
    assert 0 < index.dense.shape[1] < index.dense.shape[1] + len(index.peaks) < len(used)
    dense = np.zeros((len(vectors), 3000))
    for i in range(len(vectors)):
        t, w = index.own(i)
        dense[i, t] = w
    own = list(range(0, 1500, 25))
    for i, (at, cosines, _) in zip(own, index.search([index.own(i) for i in own], own)):
        exact = np.round(dense @ dense[i], 12)
        exact[i] = 0
        order = np.lexsort((np.arange(len(exact)), -exact))[:20]
        assert at.tolist() == order.tolist() and np.allclose(cosines, exact[order])


def test_memory_of_searching():
    """Many queries at once take little memory beside the index."""
    pick = np.random.default_rng(3)
    vectors = []
    for _ in range(4000):
        some = np.unique((pick.random(150) ** 2 * 6000).astype(int))
        vectors.append((some, pick.integers(1, 4, len(some))))
    of = examples(vectors, 6000, 15)
    tracemalloc.start()
    index = toxicity.Index(of)
    size = tracemalloc.get_traced_memory()[0]
    queries = [index.own(i) for i in range(64)]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    index.search(queries)
    searched = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert searched < size / 2, (size, searched)


def test_index_without_examples_or_words():
    empty = toxicity.Examples(
        np.zeros(0, int), np.zeros(0), np.zeros((3, 0), np.float32), np.zeros(0, int),
        np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, int))
    assert len(empty.open().search([(np.zeros(0, int), np.zeros(0))])[0][0]) == 0
    index = toxicity.Index(examples([(np.array([1]), np.array([1]))], 3, 15))
    assert [len(f[0]) for f in index.search([(np.zeros(0, int), np.zeros(0)), index.own(0)])] == [0, 1]


def brute(texts, labels, ids):
    """Scores by the definition, over all pairs of texts and examples."""
    counts = [collections.Counter(toxicity.words_of((t or "").encode())) for t in texts]
    df = collections.Counter(w for c in counts for w in c)
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}
    vectors = []
    for c in counts:
        v = {w: (1 + math.log(n)) * idf[w] for w, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: x / size for w, x in v.items()})
    chosen = {}
    for i, y in sorted(labels.items()):
        if zlib.crc32(str(i).encode()) % 3 != 1:
            at = ids.index(i)
            chosen.setdefault(texts[at] or "", [at, []])[1].append(y)
    chosen = [(vectors[at], sum(ys) / len(ys)) for at, ys in chosen.values()]

    def told(w, without):
        n, seen = [0, 0], [0, 0]
        for e, (v, share) in enumerate(chosen):
            if e != without:
                n[share > 0] += 1
                seen[share > 0] += w in v
        if not all(n):
            return 0.0
        cells = [(s, sum(seen) * m / sum(n)) for s, m in zip(seen, n)]
        cells += [(m - s, (sum(n) - sum(seen)) * m / sum(n)) for s, m in zip(seen, n)]
        return max(2 * sum(s * math.log(s / e) for s, e in cells if s), 0.0)

    def vote(own, without=-1):
        g = {w: told(w, without) for w in own}
        near = []
        for e, (v, share) in enumerate(chosen):
            cosine = sum(x * v.get(w, 0) for w, x in own.items())
            if cosine > 0 and e != without:
                near.append((-round(cosine, 12), e, share, sum(x * v.get(w, 0) * g[w] for w, x in own.items())))
        near = sorted(near)[: toxicity.NEIGHBOURS]
        weights = [(toxicity.PLAIN + t) / (1.05 + c) for c, _, _, t in near]
        best = [-c for c, *_ in near[:3]]
        return (sum(w * n[2] for w, n in zip(weights, near)) / sum(weights) if near else -1.0), best

    share = np.array([s for _, s in chosen])
    fit = toxicity.calibrated(
        np.array([vote(v, e)[0] for e, (v, _) in enumerate(chosen)]), np.ones(len(chosen)), share)
    found = [vote(v) for v in vectors]
    return [fit(v) for v, _ in found], [best for _, best in found]


def test_scores_equal_brute_force(spark):
    """Neighbours, votes, calibration; odd rows, copies, words that no example has."""
    texts = [" ".join(words(30, i)) + (" vile nasty" if i % 4 == 0 else "") for i in range(150)]
    texts += ["vile"] * 3 + [" ".join(words(3000, 99, 2000)) + " vile"] + ODD
    labels = {i: int(i % 4 == 0) for i in range(150)} | {150: 1, 151: 1, 152: 0, 155: 0}
    docs = documents(spark, texts).selectExpr("*", "1 AS score", "2 AS terms", "3 AS n", "4 AS toxic")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.score(docs, given).collect()}
    scores, best = brute(texts, labels, list(range(len(texts))))
    assert len(rows) == len(texts)
    for i, (score, cosines) in enumerate(zip(scores, best)):
        assert [e.cosine for e in rows[i].evidence] == pytest.approx(cosines)
        assert rows[i].score == pytest.approx(score, abs=1e-5)
    mean = [np.mean([rows[i].score for i in range(150) if (i % 4 == 0) == bad]) for bad in (True, False)]
    assert mean[0] > mean[1] + 0.5


def test_null_ids_and_repeated_rows(spark):
    texts = [" ".join(words(30, i)) + (" vile nasty" if i % 4 == 0 else "") for i in range(80)] + ODD + ODD[3:5]
    ids = [*range(80), 80, 80, 81, None, None, 82, 83, None, None, None]
    docs = documents(spark, texts, doc_id=ids)
    given = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(80)] + [(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    rows = toxicity.score(docs, given).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, ids))
    kept = toxicity.clean(docs, given)
    assert kept.columns == docs.columns
    assert kept.count() == len(texts) - sum(r.predicted for r in rows)


def test_no_shuffles_are_left(spark, conf):
    """Before the scores are asked for, shuffles are gone and the caller's setting is back."""
    conf("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")  # No shuffle is given up half-way.
    docs = documents(spark, [" ".join(words(30, i)) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 2)], "doc_id long, toxic int")
    files, _, scores = left_behind(spark, lambda: toxicity.score(docs, labels))
    assert not files
    assert scores.count() == scores.count() == 60
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

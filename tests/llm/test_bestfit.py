import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermill.llm import bestfit
from ordermill.llm.common import vocabulary
from tests.llm.util import documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def public():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def one_by_one(histogram, capacity):
    """Best-two-fit on single documents, by trying all pairs."""
    left = sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True)
    bins = []
    while left:
        gap, held, rest = capacity, [], []
        for s in left:
            if s <= gap:
                gap -= s
                held.append(s)
            else:
                rest.append(s)
        left = rest
        if gap and len(held) > 1:
            least, number = min(held), collections.Counter(left)
            pairs = [
                (x + y, x, y) for x in number for y in number
                if y <= x and least < x + y <= gap + least and (x != y or number[x] > 1)]
            if pairs:
                _, x, y = max(pairs)
                held.remove(least)
                held += [x, y]
                left.remove(x)
                left.remove(y)
                left = sorted([*left, least], reverse=True)
        bins.append(sorted(held, reverse=True))
    return bins


def test_plan_is_that_of_single_documents():
    pick = random.Random(3)
    for _ in range(400):
        capacity = pick.choice([5, 10, 16, 30, 64])
        lengths = pick.sample(range(1, capacity + 1), pick.randrange(1, min(capacity, 9)))
        histogram = {s: pick.choice([1, 2, 3, 10, 40]) for s in lengths}
        planned = [
            [s for s in sorted(b.parts, reverse=True) for _ in range(b.parts[s])]
            for b in bestfit.plan(histogram, capacity) for _ in range(b.times)]
        assert planned == one_by_one(histogram, capacity)


def test_a_pair_replaces_the_shortest():
    assert [b.parts for b in bestfit.plan({6: 1, 3: 1, 2: 2}, 10)] == [{6: 1, 2: 2}, {3: 1}]
    assert bestfit.plan({}, 10) == []


def test_plan_is_small_and_tight_for_any_number():
    pick = random.Random(4)
    histogram = {s: pick.randrange(10**9) for s in range(1, 1025)}
    bins = bestfit.plan(histogram)
    used = collections.Counter()
    for b in bins:
        assert sum(s * n for s, n in b.parts.items()) <= 1024
        used.update({s: n * b.times for s, n in b.parts.items()})
    assert used == collections.Counter(histogram) and len(bins) < 5 * 1024
    tokens = sum(s * n for s, n in histogram.items())
    assert sum(b.times for b in bins) < 1.02 * tokens / 1024


def check(rows, texts, public, sequence=1024):
    places, pieces = {}, collections.defaultdict(list)
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = public(text or "") + [2]
        short = len(ids) % sequence or sequence
        at = 0
        for n, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.length) == (n, at, sequence if n else min(short, len(ids)))
            part = np.array(ids[at : at + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= sequence
    return sorted(sorted((n for _, n in spans), reverse=True) for spans in places.values())


def test_whole_table(spark, public):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = bestfit.pack(docs, *vocabulary()).collect()
    filled = check(rows, {r.doc_id: r.text for r in docs.collect()}, public)
    histogram = collections.Counter(r.length for r in rows)
    assert filled == sorted(one_by_one(histogram, 1024))


def test_odd_rows(spark, public):
    texts = [None, "", "a", "word " * 9000, "  ", "same", "same", "x" * 700]
    rows = bestfit.pack(
        documents(spark, texts).selectExpr(
            "*", "1 AS length", "2 AS ids", "3 AS nth", "4 AS chunk", "5 AS rank", "6 AS sequence_id"),
        *vocabulary(), sequence=64, with_ids=True).collect()
    check(rows, dict(enumerate(texts)), public, 64)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = documents(spark, ["a b", "a b", "c", None], doc_id=[7, 7, None, None])
    rows = bestfit.pack(docs, *vocabulary()).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["7", "7", "None", "None"]
    assert sorted(r.offset for r in rows) == [0, 3, 6, 8]
    assert bestfit.pack(docs.limit(0), *vocabulary()).collect() == []


def test_few_files_with_many_partitions(spark, conf, tmp_path, monkeypatch):
    """Small pieces from many shuffle partitions: neither tables nor the result fall apart."""
    conf("spark.sql.shuffle.partitions", "97")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = []
    whole = bestfit.settle
    monkeypatch.setattr(bestfit, "settle", lambda df, label: written.append(whole(df, label)) or written[-1])
    texts = ["word " * (i % 40) for i in range(300)]
    found = bestfit.pack(documents(spark, texts), *vocabulary(), sequence=64)
    assert sum(len(t.inputFiles()) for t in written) < 20
    found.write.parquet(f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("part-*"))) < 20
    assert spark.read.parquet(f"{tmp_path}/out").select("doc_id").distinct().count() == len(texts)

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ordermill.llm import packing
from ordermill.llm.common import vocabulary
from tests.llm.util import documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def public():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def _texts(n):
    random.seed(n)
    signs = " \n\t ab'sé1 2!. 　\u0085x  \r\x0b😀ß<|endoftext|>漢字"
    return ["".join(random.choice(signs) for _ in range(random.randrange(60))) for _ in range(n)]


def test_ids_are_those_of_the_library(public):
    texts = _texts(3000) + ["", " ", "  a", "a  ", "x" * 5000, " y" * 3000]
    texts += pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist()
    ids, ends = packing.Encoder(*vocabulary()).encode([t.encode() for t in texts])
    at = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[at:end].tolist() == public(text)
        at = end


def check(rows, texts, public, sequence=1024):
    """Pieces cover every document once and fill the sequences without gaps."""
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = public(text or "") + [0]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            part = np.array(ids[at : at + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    assert sorted(places) == list(range(len(places)))
    for sequence_id, spans in places.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == sequence or sequence_id == len(places) - 1 and at <= sequence


def test_whole_table(spark, public):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(packing.pack(docs, *vocabulary()).collect(), texts, public)


def test_odd_rows(spark, public):
    texts = [None, "", "a", "word " * 9000, "  ", "same", "same"]
    docs = documents(spark, texts, source=[None, "a", "a", "b", "b", None, "c"])
    rows = packing.pack(docs, *vocabulary(), sequence=64, window_sequences=2).collect()
    check(rows, dict(enumerate(texts)), public, 64)


def test_clashing_columns_empty_table_and_no_source(spark):
    docs = documents(spark, ["a b", "c"]).selectExpr("*", "1 AS length", "2 AS ids", "3 AS queue")
    packed = packing.pack(docs, *vocabulary())
    assert packed.count() == 2
    assert packing.pack(docs.limit(0), *vocabulary()).collect() == []
    assert packing.pack(docs.drop("source"), *vocabulary()).count() == 2


def test_windows_hold_the_shares(spark):
    random.seed(5)
    texts = [" ".join(random.choice("abcdefg") for _ in range(200)) for _ in range(300)]
    sources = ["x" if i % 3 else "y" for i in range(300)]
    docs = documents(spark, texts, source=sources)
    window = 64 * 4
    rows = packing.pack(docs, *vocabulary(), sequence=64, window_sequences=4).collect()
    share = sum(len(t.split()) + 1 for t, s in zip(texts, sources) if s == "y")
    total = sum(r.length for r in rows)
    for n in range(total // window):
        of = sum(r.length for r in rows if r.sequence_id // 4 <= n and r.source == "y")
        assert abs(of - (n + 1) * window * share / total) < 2

    rows = packing.pack(
        docs, *vocabulary(), weights={"x": 1, "y": 3}, sequence=64, window_sequences=4).collect()
    for n in range(int(share / 0.75) // window - 1):
        of = sum(r.length for r in rows if r.sequence_id // 4 <= n and r.source == "y")
        assert abs(of - (n + 1) * window * 0.75) < 2


def test_rare_sources_share_a_queue(spark, public):
    texts = ["one two three"] * 40
    docs = documents(spark, texts, source=[f"s{i}" for i in range(40)])
    rows = packing.pack(docs, *vocabulary(), sequence=16, window_sequences=1, max_queues=3).collect()
    check(rows, dict(enumerate(texts)), public, 16)


def test_rare_sources_take_turns(spark, monkeypatch):
    """In the shared queue every source is within a document of its share, at every sequence's end."""
    monkeypatch.setattr(packing, "RANGE_TOKENS", 300)
    texts = [" word" * (1 + (i * 7) % 9) for i in range(900)]
    sources = [f"s{i // 20:02d}" for i in range(600)] + ["large"] * 300
    docs = documents(spark, texts, source=sources)
    rows = packing.pack(docs, *vocabulary(), max_queues=10, sequence=64, window_sequences=1).collect()
    total, done = {}, {}
    for r in rows:
        total[r.source] = total.get(r.source, 0) + r.length
    assert len(total) == 31 and total["large"] * 10 > sum(total.values())
    rare = sum(n for s, n in total.items() if s != "large")
    last = max(r.sequence_id for r in rows)
    for sequence in range(last + 1):
        for r in rows:
            if r.sequence_id == sequence:
                done[r.source] = done.get(r.source, 0) + r.length
        given = sum(n for s, n in done.items() if s != "large") / rare
        for s in total.keys() - {"large"}:
            assert abs(done.get(s, 0) - given * total[s]) <= 14, (sequence, s)


def test_cuts_never_fall_back():
    mix = packing.Mixture([5, 100_000, 33_333, 70], None, 256)
    cuts = mix.cuts(np.arange(0, 530))
    assert (np.diff(cuts, axis=0) >= 0).all()
    assert cuts.sum(axis=1).tolist() == [min(n * 256, mix.all) for n in range(530)]

"""Exact removal of long byte strings that occur more than once.

Every window of ``length`` bytes is assigned to an anchor: the rightmost of its
short byte grams with the smallest hash. Equal windows have equal anchors at
equal places, so only windows of anchors that occur again can repeat. The
windows of one anchor occurrence are neighbours and form a stretch.

* A stretch whose whole text occurs again repeats as a whole; that is an
  aggregate over digests, whatever the number of copies.
* Of the other stretches of a repeated anchor, one of each text goes to a shard
  of the anchor. A suffix array, built by induced sorting, with its permuted
  common prefixes finds the windows they share byte by byte (``induced``).
* An anchor with more different stretches than a shard may hold has its windows
  counted by digest instead, one row per window.

Texts travel only to cut out those stretches and to be cut at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, slices, utf8
from ordermill.llm.induced import repeated_starts
from ordermill.sources.shared import settle

LENGTH = 200
GRAM = 32
#: Bytes of stretches per shard, and per anchor before its windows are digested.
SHARD_BYTES = 1 << 20
ANCHOR_BYTES = 8 << 20
#: Bytes hashed at a time; places within fit in 24 bits.
BLOCK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2 ** 64."""
    base = np.full(n, _BASE, dtype=np.uint64)
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed rolling hash of every ``gram`` bytes."""
    n = len(data)
    size = 1 << max(n, BLOCK_BYTES).bit_length()
    up, down = _powers(size)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(data * up[:n], dtype=np.uint64, out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _stretches(
    data: np.ndarray, ends: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor's place after it, anchor hash) of each stretch.

    ``data`` holds several texts, which end at ``ends``; no window crosses an end.
    """
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
    h = _gram_hashes(data, gram)
    key = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64))
    width, reach = 1, length - gram + 1
    while width * 2 <= reach:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = reach - width
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    place = (_PLACE - (key & _PLACE)).astype(np.int64)
    # Windows that cross an end belong to no text.
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    new = np.ones(n, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    new[starts[starts < n]] = True
    first = np.flatnonzero(new & inside)
    last = np.zeros(n, dtype=bool)
    last[:-1] = new[1:] | ~inside[1:]
    last[-1] = True
    last = np.flatnonzero(last & inside)
    return first, last - first + 1, place[first] - first, h[place[first]]


def stretches(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k, t, a, d, s, w, r): the stretches of all texts.

    ``k`` and ``t`` are the row's id and text hash, ``a`` the anchor, ``d`` a
    digest of the stretch and the anchor's place ``r`` in it, ``s`` its first
    window's byte, ``w`` the number of its windows.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "text", BLOCK_BYTES):
            texts = utf8(batch.column("text"))
            ids, hashes = (batch.column(c).to_numpy() for c in ("k", "t"))
            # A very long text is taken in parts that share length - 1 bytes.
            pieces = [
                (row, at, text[at : at + BLOCK_BYTES + length - 1])
                for row, text in enumerate(texts)
                for at in range(0, max(len(text) - length + 1, 1), BLOCK_BYTES)
            ]
            joined = b"".join(p for _, _, p in pieces)
            ends = np.cumsum([len(p) for _, _, p in pieces])
            for group in _groups(ends, 4 * BLOCK_BYTES):
                low = ends[group[0] - 1] if group[0] else 0
                own = ends[group] - low
                part = joined[low : ends[group[-1]]]
                first, windows, place, anchor = _stretches(
                    np.frombuffer(part, dtype=np.uint8), own, length, gram)
                if not len(first):
                    continue
                view = memoryview(part)
                digest = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[s : s + w + length - 1], seed=r)
                     for s, w, r in zip(first.tolist(), windows.tolist(), place.tolist())),
                    dtype=np.uint64, count=len(first))
                piece = group[0] + np.searchsorted(own, first, side="right")
                row = np.array([p[0] for p in pieces])[piece]
                offset = np.array([p[1] for p in pieces])[piece]
                start = first + low - np.concatenate([[0], ends])[piece] + offset
                yield pa.record_batch(
                    [ids[row], hashes[row], anchor.view(np.int64), digest.view(np.int64),
                     start.astype(np.int64), windows.astype(np.int32), place.astype(np.int32)],
                    names=["k", "t", "a", "d", "s", "w", "r"])

    return _rows(docs).select("k", "t", "text").mapInArrow(
        batches, "k long, t long, a long, d long, s long, w int, r int")


def _groups(ends: np.ndarray, most: int) -> list[np.ndarray]:
    """Consecutive numbers of pieces, about ``most`` bytes in each group."""
    cuts = np.flatnonzero(np.diff(ends // most)) + 1
    return np.split(np.arange(len(ends)), cuts)


def _rows(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumns(
        {"k": F.coalesce("doc_id", F.lit(MIN_LONG)), "t": F.xxhash64("text")})


def _shared_windows(length: int):
    """Windows that stretches of one shard share, as spans of single stretches."""

    def of(rows: pa.Table) -> pa.Table:
        # A row may come twice, from rows equal in id and text.
        distinct: dict[tuple[int, int], dict] = {}
        for row in rows.to_pylist():
            distinct.setdefault((row["a"], row["d"]), row)
        ordered = list(distinct.values())
        k, t, s, e = [], [], [], []
        for row, again in zip(ordered, repeated_starts([r["text"] for r in ordered], length)):
            if row["n"] > 1 or not again.any():
                continue
            edges = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
                k.append(row["k"])
                t.append(row["t"])
                s.append(row["s"] + int(a))
                e.append(row["s"] + int(b))
        return pa.table({"k": pa.array(k, pa.int64()), "t": pa.array(t, pa.int64()),
                         "s": pa.array(s, pa.int64()), "e": pa.array(e, pa.int64())})

    return of


def _window_digests(length: int):
    """Every window of the stretches, by digest."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "text", 1 << 20):
            out = []
            for row in batch.to_pylist():
                view = memoryview(row["text"])
                for i in range(len(view) - length + 1):
                    out.append((row["k"], row["t"], row["n"], row["s"] + i,
                                xxhash.xxh3_128_digest(view[i : i + length])))
            k, t, n, s, d = zip(*out)
            yield pa.record_batch(
                [pa.array(k, pa.int64()), pa.array(t, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(s, pa.int64()), pa.array(d, pa.binary())],
                names=["k", "t", "n", "s", "w"])

    return of


def repeated_windows(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """(k, t, s, e): runs of windows, first and last + 1, that occur elsewhere."""
    all_ = settle(stretches(docs, length, gram), "suffix-stretches")
    anchors = all_.groupBy("a").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    again = anchors.filter("n > 1").select("a", (F.col("low") != F.col("high")).alias("mixed"))
    found = settle(all_.join(again, "a"), "suffix-repeated")
    place = F.struct("k", "t", "s", "w", "r")
    kinds = settle(
        found.filter("mixed").groupBy("a", "d").agg(
            F.count(F.lit(1)).alias("n"), F.min(place).alias("p")),
        "suffix-kinds")
    whole = found.filter("NOT mixed").select("k", "t", "s", "w").union(
        found.filter("mixed").join(kinds.filter("n > 1").select("a", "d"), ["a", "d"])
        .select("k", "t", "s", "w"))
    runs = whole.select("k", "t", "s", (F.col("s") + F.col("w")).alias("e"))

    # Only anchors with a stretch that occurs once leave anything to find.
    sizes = kinds.groupBy("a").agg(
        F.min("n").alias("least"), F.sum(F.col("p.w") + F.lit(length - 1)).alias("bytes")
    ).filter("least = 1").select("a", "bytes")
    open_ = settle(kinds.join(sizes, "a"), "suffix-open")
    total = open_.agg(F.sum(F.col("p.w") + F.lit(length - 1))).first()[0] or 0
    shards = int(total // shard_bytes + 1)
    wanted = open_.groupBy(F.col("p.k").alias("k"), F.col("p.t").alias("t")).agg(
        F.collect_set(F.struct("a", "d", "n", "p.s", "p.w", "bytes")).alias("cuts"))
    cut = F.explode("cuts").alias("c")
    body = F.encode("text", "UTF-8")
    texts = _rows(docs).join(wanted, ["k", "t"]).select("k", "t", body.alias("body"), cut).select(
        "k", "t", "c.a", "c.d", "c.n", "c.s", "c.bytes",
        F.substring("body", F.col("c.s").cast("int") + 1, F.col("c.w") + length - 1).alias("text"))
    texts = settle(texts, "suffix-texts")
    few = texts.filter(F.col("bytes") <= anchor_bytes)
    shared = few.groupBy(F.pmod(F.hash("a"), F.lit(shards)).alias("shard")).applyInArrow(
        _shared_windows(length), "k long, t long, s long, e long")
    many = texts.filter(F.col("bytes") > anchor_bytes).dropDuplicates(["a", "d"])
    windows = settle(many.select("k", "t", "n", "s", "text").mapInArrow(
        _window_digests(length), "k long, t long, n long, s long, w binary"), "suffix-windows")
    counted = windows.groupBy("w").agg(F.sum("n").alias("m")).filter("m > 1").select("w")
    single = windows.filter("n = 1").join(counted, "w").select(
        "k", "t", "s", (F.col("s") + 1).alias("e"))
    return runs.union(shared).union(single)


def _cut(text: bytes, runs: list[dict], length: int) -> tuple[int, int, bytes, list[dict]]:
    """(bytes removed, spans, what is left, the spans) for runs of windows."""
    spans: list[list[int]] = []
    for run in sorted(runs, key=lambda r: r["s"]):
        end = run["e"] + length - 1
        if spans and run["s"] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([run["s"], end])
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    removed = sum(b - a for a, b in spans)
    return removed, len(spans), b"".join(kept), [{"start": a, "end": b} for a, b in spans]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    Each byte of the text (UTF-8, null as empty) that is covered by a string of
    ``length`` bytes that also starts anywhere else goes; ``spans`` are the
    maximal runs of such bytes (end exclusive) and ``kept`` the bytes between
    them, which need not be whole characters. Of repeated rows both lose their
    long strings; null ids are ids like any other. Runs jobs: stretches and what
    repeats of them are written to the shared folder.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be positive and at most length")
    runs = repeated_windows(docs, length, gram, shard_bytes, anchor_bytes)
    by_text = settle(
        runs.groupBy("k", "t").agg(F.collect_set(F.struct("s", "e")).alias("runs")), "suffix-runs")
    joined = _rows(docs).join(by_text, ["k", "t"], "left").select("doc_id", "text", "runs")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "text", 8 << 20):
            texts = utf8(batch.column("text"))
            done = [_cut(t, r or [], length) for t, r in zip(texts, batch.column("runs").to_pylist())]
            removed, spans, kept, where = zip(*done)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(where, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.mapInArrow(
        batches,
        "doc_id long, n_bytes long, n_removed long, n_spans long, "
        "spans array<struct<start:long,end:long>>, kept binary")

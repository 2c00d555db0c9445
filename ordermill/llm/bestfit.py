"""Best-two-fit packing of documents into fixed-length sequences.

Bins are filled one after the other: greedily, always the longest document that
still fits; then, where a gap is left and the bin holds more than one document,
its shortest one is taken out again if two unpacked documents fill the widened
gap more tightly. The fullest such pair goes in, and the shortest document is
unpacked again.

What is done next depends only on how many documents of each length are still
unpacked. So the packing is planned on the histogram of lengths, which has at
most ``sequence`` entries whatever the number of documents: bins that come out
alike are planned once with their number. Each document then finds its bin by
its length and its rank among the documents of that length, without being
compared with any other document. No length, however frequent, meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ordermill.llm.common import slices, utf8
from ordermill.llm.packing import BATCH_BYTES, encoder
from ordermill.sources.shared import settle

SEQUENCE = 1024
END_ID = 2


class Bins(NamedTuple):
    """``times`` bins in a row, each with ``parts``: length -> documents of that length."""

    times: int
    parts: dict[int, int]


class Unpacked:
    """How many documents of each length are left, and the longest that fits a gap."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        self.fits = np.zeros(len(counts), dtype=np.int64)
        self._renew(0)

    def _renew(self, start: int) -> None:
        here = np.arange(start, len(self.counts))
        known = np.where(self.counts[start:] > 0, here, 0)
        if start:
            known[0] = max(known[0], self.fits[start - 1])
        self.fits[start:] = np.maximum.accumulate(known)

    def add(self, length: int, n: int) -> None:
        had = self.counts[length] > 0
        self.counts[length] += n
        if had != (self.counts[length] > 0):
            self._renew(length)

    def tightest_pair(self, gap: int) -> tuple[int, int]:
        """The two unpacked lengths with the largest sum up to ``gap``, the longer
        first and as long as possible; (0, 0) if no two fit.
        """
        longer = np.flatnonzero(self.counts[: max(gap, 1)])
        if not len(longer):
            return 0, 0
        shorter = self.fits[np.minimum(longer, gap - longer)]
        alone = (shorter == longer) & (self.counts[longer] < 2)
        shorter = np.where(alone, self.fits[longer - 1], shorter)
        total = np.where(shorter > 0, longer + shorter, 0)
        best = len(total) - 1 - int(np.argmax(total[::-1]))
        return (int(longer[best]), int(shorter[best])) if total[best] else (0, 0)


def _one_bin(left: Unpacked, capacity: int) -> tuple[dict[int, int], dict[int, int]]:
    """(the bin's documents, all documents touched), taken out of ``left``."""
    parts: dict[int, int] = {}
    gap = capacity
    while gap and (length := int(left.fits[gap])):
        n = min(int(left.counts[length]), gap // length)
        left.add(length, -n)
        parts[length] = n
        gap -= n * length
    touched = dict(parts)
    if gap and sum(parts.values()) > 1:
        least = min(parts)
        pair = left.tightest_pair(gap + least)
        if sum(pair) > least:
            left.add(least, 1)
            parts[least] -= 1
            for length in pair:
                left.add(length, -1)
                parts[length] = parts.get(length, 0) + 1
                touched[length] = touched.get(length, 0) + 1
    return {length: n for length, n in parts.items() if n}, touched


def plan(histogram: dict[int, int], capacity: int = SEQUENCE) -> list[Bins]:
    """Bins that pack ``histogram`` (length -> number of documents), alike ones together.

    A bin is repeated while every length it touched is still there in the
    numbers the bin's choices saw, so all repetitions are what filling bin after
    bin would give. Each group of bins uses up a length but for a few documents:
    the plan has a few entries a length, whatever the numbers.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    left = Unpacked(counts)
    bins = []
    while left.fits[capacity]:
        parts, touched = _one_bin(left, capacity)
        # Before a further equal bin each length needs as many documents as the
        # bin touched, and one more, so that none seems used up.
        spare = [
            (int(left.counts[s]) - n - 1) // parts[s] if s in parts else int(left.counts[s] > n) << 62
            for s, n in touched.items()
        ]
        more = max(min(spare), 0)
        for length, n in parts.items():
            left.add(length, -n * more)
        bins.append(Bins(1 + more, parts))
    return bins


class Places:
    """Bin and offset by length and rank, from a plan."""

    def __init__(self, bins: list[Bins]) -> None:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        first = 0
        for times, parts in bins:
            offset = 0
            for length in sorted(parts, reverse=True):
                n = parts[length]
                rank = used.get(length, 0)
                rows.setdefault(length, []).append((rank, n, first, offset))
                used[length] = rank + n * times
                offset += n * length
            first += times
        self.bins = first
        self._rows = {length: np.array(r, dtype=np.int64) for length, r in rows.items()}

    def of(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bins, offsets) of the documents of one length with these ranks."""
        rows = self._rows[length]
        rank, n, first, offset = rows[np.searchsorted(rows[:, 0], ranks, side="right") - 1].T
        nth = ranks - rank
        return first + nth // n, offset + nth % n * length


def _cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be short."""
    ends = range(n % most or most, n + 1, most)
    return [(max(end - most, 0), min(end, most)) for end in ends]


def pieces(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, chunk, nth): the documents' pieces.

    ``chunk`` is the input partition, ``nth`` counts the pieces of the same
    length before this one in the chunk. Null texts are empty; every text gets
    ``end_id``. ``with_ids`` adds the ids themselves.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary, pattern)
        chunk = TaskContext.get().partitionId()
        so_far = np.zeros(sequence + 1, dtype=np.int64)
        for batch in slices(parts, "text", BATCH_BYTES):
            ids, ends = bpe.encode(utf8(batch.column("text")))
            ids = ids.astype("<u4")
            last = np.array([end_id], dtype="<u4")
            found, kept, at = [], [], 0
            for row, end in enumerate(ends.tolist()):
                tokens = np.concatenate([ids[at:end], last])
                for piece, (start, length) in enumerate(_cut(len(tokens), sequence)):
                    part = tokens[start : start + length]
                    found.append((row, piece, start, length, zlib.crc32(part), so_far[length]))
                    so_far[length] += 1
                    if with_ids:
                        kept.append(part.astype(np.int32))
                at = end
            row, piece, start, length, check, nth = np.array(found, dtype=np.int64).T
            columns = [
                batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array(check),
                pa.array(np.full(len(row), chunk, dtype=np.int32)), pa.array(nth),
            ] + ([pa.array(kept, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.record_batch(columns, names=names)

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, chunk int, nth long"
              + (", ids array<int>" if with_ids else ""))
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.mapInArrow(batches, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents of more than ``sequence`` tokens are cut into pieces of that many,
    the first of which may be shorter; all others stay whole. ``start`` counts
    the document's ids before the piece, ``ids_crc32`` covers its ids as
    little-endian unsigned 32-bit values, ``ids`` (``with_ids``) are the ids.
    Every row is packed, repeated rows and null ids too; a null or empty text is
    its ``end_id`` alone; an empty table has no pieces. Other columns are not
    looked at, whatever their names.

    Runs jobs: the pieces are written to the shared folder; the numbers of
    pieces by length, at most ``sequence``, come to the driver.
    """
    found = settle(
        pieces(docs, vocabulary, pattern, sequence, end_id, with_ids), "bestfit-pieces")
    # Counted anew where it is needed: as a table it would be one small file per shuffle partition.
    counts = found.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {
        r["length"]: r["n"]
        for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    places = Places(plan(histogram, sequence))

    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select("chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = found.join(bases, ["chunk", "length"]).select(
        *[c for c in found.columns if c not in ("chunk", "nth")],
        (F.col("base") + F.col("nth")).alias("rank"))
    # As many tasks and files as the pieces' table needs, however many partitions the join has.
    ranked = ranked.coalesce(max(found.rdd.getNumPartitions(), 1))
    columns = [c for c in ranked.columns if c != "rank"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            bins, offsets = np.zeros_like(rank), np.zeros_like(rank)
            for one in np.unique(length).tolist():
                here = np.flatnonzero(length == one)
                bins[here], offsets[here] = places.of(one, rank[here])
            yield pa.record_batch(
                [*[batch.column(c) for c in columns], pa.array(bins), pa.array(offsets)],
                names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(batches, f"{schema}, sequence_id long, offset long")

"""Repeated lines: units hashed globally, the earliest kept, the rest removed.

A text is cut into lines, and lines after sentence ends, so that a passage set
into other prose is found as well. A unit is normalised (case, digits and white
space folded) and digested, however short it is; only blank units stay as they
are. A repeated line goes with its sentences. Of each digest the occurrence of
the smallest (doc_id, text, position) stays.

Only digests travel, not texts. They are counted first, with map-side combine,
so a line that a third of all texts share shrinks to one row per task; then the
occurrences of repeated digests alone are kept and ranked, again by an aggregate.
Joins go from occurrences to one row per digest, so adaptive execution can split
a hot one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, slices
from ordermill.sources.shared import settle

#: Shorter units always stay; 1 leaves out blank ones only.
MIN_CHARS = 1
#: Ends of units: line breaks, or also white space after a sentence.
LINES = r"[^\n]*\n?"
SENTENCES = r"(?:[^\n.!?]|[.!?](?![ \t\n]))*+(?:[.!?]+[ \t]*)?\n?"

_DIGITS = re.compile(r"[0-9]+")


def normalise(unit: str) -> str:
    """Case, runs of digits and white space folded."""
    return _DIGITS.sub("0", " ".join(unit.lower().split()))


def _units(text: str, pattern: re.Pattern[str], min_chars: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, 128-bit digest) of each unit that is long enough."""
    for match in pattern.finditer(text):
        start, end = match.span()
        if end - start < min_chars:
            continue
        folded = normalise(match.group())
        if len(folded) >= min_chars:
            yield start, end, xxhash.xxh3_128_intdigest(folded.encode())


def digests(docs: DataFrame, ends: str = SENTENCES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, units): the units of each text, in order.

    A unit has its start and end (code points, line break included) and 96 bits
    of the digest of its normalised form.
    """
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    unit = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("d1", pa.int64()), ("d2", pa.int32())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(ends)
        for batch in slices(parts, "text", 8 << 20):
            offsets, s, e, hi, lo = [0], [], [], [], []
            for text in batch.column("text").to_pylist():
                for start, end, digest in _units(text, pattern, min_chars):
                    s.append(start)
                    e.append(end)
                    hi.append(digest >> 64)
                    lo.append(digest & 0xFFFFFFFF)
                offsets.append(len(s))
            fields = [
                pa.array(s, pa.int32()), pa.array(e, pa.int32()),
                pa.array(np.array(hi, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(lo, dtype=np.uint32).view(np.int32)),
            ]
            values = pa.StructArray.from_arrays(fields, fields=list(unit))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"), lists],
                names=["doc_id", "text_hash", "units"])

    return rows.mapInArrow(
        batches,
        "doc_id long, text_hash long, units array<struct<s:int,e:int,d1:long,d2:int>>")


def _kept(text: str, spans: list[dict]) -> tuple[str, int]:
    at, out, gone = 0, [], 0
    for span in spans:
        out.append(text[at : span["start"]])
        gone += span["end"] - span["start"]
        at = span["end"]
    return "".join([*out, text[at:]]), gone


def remove_repeats(
    docs: DataFrame, ends: str = SENTENCES, min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row per row of ``docs``, with what is left of its text.

    ``removed`` lists the removed units in order, with their place in the
    original text (code points, end exclusive) and the place of the occurrence
    that stays. ``n_removed`` counts removed code points, ``n_spans`` removed
    units. Null texts count as empty. Rows equal in id and text count as one
    document and keep the same units; ids may be null. Runs jobs: digests and
    the occurrences of repeated ones are written to the shared folder.
    """
    cut = settle(digests(docs, ends, min_chars), "line-digests")
    counts = cut.select(F.explode("units.d1").alias("d1")).groupBy("d1").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1")
    repeated = settle(counts, "line-repeated")
    each = cut.select("doc_id", "text_hash", F.explode("units").alias("u")).select(
        "doc_id", "text_hash", "u.s", "u.e", "u.d1", "u.d2")
    found = settle(each.join(repeated, "d1"), "line-occurrences")
    place = F.struct("doc_id", "text_hash", "s", "e")
    firsts = found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    later = (
        found.join(firsts.filter("first <> last"), ["d1", "d2"])
        .filter(~F.struct("doc_id", "text_hash", "s", "e").eqNullSafe(F.col("first")))
        .select(
            F.coalesce("doc_id", F.lit(MIN_LONG)).alias("k"), "text_hash",
            F.struct(
                F.col("s").alias("start"), F.col("e").alias("end"),
                F.col("first.doc_id").alias("kept_doc_id"), F.col("first.s").alias("kept_start"),
            ).alias("span"),
        )
        .groupBy("k", "text_hash")
        .agg(F.array_sort(F.collect_set("span")).alias("removed"))
    )
    rows = id_and_text(docs).withColumns(
        {"text_hash": F.xxhash64("text"), "k": F.coalesce("doc_id", F.lit(MIN_LONG))})
    joined = rows.join(later, ["k", "text_hash"], "left").select("doc_id", "text", "removed")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "text", 8 << 20):
            texts, spans = batch.column("text").to_pylist(), batch.column("removed").to_pylist()
            done = [_kept(t, s) if s else (t, 0) for t, s in zip(texts, spans)]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([d[1] for d in done], pa.int64()),
                    pa.array([len(s) if s else 0 for s in spans], pa.int64()),
                    batch.column("removed"),
                    pa.array([d[0] for d in done], pa.string()),
                ],
                names=["doc_id", "n_chars", "n_removed", "n_spans", "removed", "text"])

    return joined.mapInArrow(
        batches,
        "doc_id long, n_chars long, n_removed long, n_spans long, "
        "removed array<struct<start:int,end:int,kept_doc_id:long,kept_start:int>>, text string")

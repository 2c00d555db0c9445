"""SimHash near-duplicates, linked through pigeonring candidates.

Two fingerprints link when at most ``max_bits`` of their 64 bits differ. The
bits are cut into ``segments`` that stand on a ring. If all differences are at
most ``max_bits``, some segment starts a chain in which every run of 1, 2, ...
segments holds at most its proportional share of them: with 3 segments and 2
bits, the first segment differs in 0 bits, the first two in at most 1, all in at
most 2. So only fingerprints that agree in a segment meet, and a pair is checked
in full only where the whole chain holds.

Fingerprints that agree in a segment may be many (a group of near copies). A
bucket above ``max_bucket`` members makes no pairs at all: each member writes
itself and its one-bit neighbours outside the segment as meeting points. Two
members share a meeting point exactly when they differ in at most 2 bits, and at
most 65 different fingerprints touch one point, so the links are found whole and
the rows stay in proportion to the members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, keyed, signed, slices, utf8
from ordermill.llm.components import components
from ordermill.sources.shared import settle

WORDS = 3
MAX_BITS = 2
SEGMENTS = 3
MAX_BUCKET = 64
SEED = 42


def _fingerprint(text: bytes, words: int) -> int:
    """Majority of the shingles' hash bits; ASCII white space parts words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row, the fingerprint as a signed long.

    Null and empty texts have fingerprint zero; a text of fewer than ``words``
    words is one shingle. Other columns are ignored.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(rows, "text", 8 << 20):
            prints = [_fingerprint(t, words) for t in utf8(batch.column("text"))]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"),
                 signed(np.array(prints, dtype=np.uint64))],
                names=["doc_id", "text_hash", "fp"])

    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(batches, "doc_id long, text_hash long, fp long")


def _ring(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment; the segments cover all 64 bits."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(shift: int, width: int) -> int:
    """Bits of a segment as a signed long."""
    return int(np.uint64(((1 << width) - 1) << shift).view(np.int64))


def _differences(i: int, run: int, ring: list[tuple[int, int]]) -> Column:
    """Differing bits of ``fa`` and ``fb`` in ``run`` segments from segment ``i`` on."""
    mask = 0
    for k in range(run):
        mask |= _mask(*ring[(i + k) % len(ring)])
    return F.bit_count(F.col("fa").bitwiseXOR(F.col("fb")).bitwiseAND(F.lit(mask)))


def _chain(i: int, max_bits: int, ring: list[tuple[int, int]]) -> Column:
    """Every run from segment ``i`` on holds at most its share of the differences."""
    viable = F.lit(True)
    for run in range(1, len(ring) + 1):
        viable &= _differences(i, run, ring) <= F.lit(run * max_bits // len(ring))
    return viable


def links(
    prints: DataFrame,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """(a, b): links that join any two distinct fingerprints of ``prints`` (fp)
    that differ in at most ``max_bits`` bits, directly or over a shared partner
    that itself links to both. ``max_bits`` is at most 2 and below ``segments``.
    """
    if not 0 <= max_bits <= 2 or max_bits >= segments:
        raise ValueError("max_bits must be 0, 1 or 2 and below segments")
    ring = _ring(segments)
    parts = [
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(*s))).alias("v"))
        for i, s in enumerate(ring)
    ]
    members = prints.select("fp", F.explode(F.array(*parts)).alias("s")).select("fp", "s.i", "s.v")
    sizes = members.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = members.join(sizes, ["i", "v"])
    cold, hot = sized.filter(F.col("n") <= max_bucket), sized.filter(F.col("n") > max_bucket)

    left = cold.select("i", "v", F.col("fp").alias("fa"))
    right = cold.select("i", "v", F.col("fp").alias("fb"))
    viable = F.lit(False)
    for i in range(segments):
        viable |= (F.col("i") == i) & _chain(i, max_bits, ring)
    pairs = left.join(right, ["i", "v"]).filter((F.col("fa") < F.col("fb")) & viable)

    # Meeting points: differences allowed on each side add up to max_bits.
    flips = [F.lit(0)]
    if max_bits:
        flips += [F.lit(_mask(b, 1)) for b in range(64)]
    points = hot.select(
        "i", "v", "fp", F.explode(F.array(*[f.cast("long") for f in flips])).alias("flip"))
    outside = F.lit(False)
    for i, s in enumerate(ring):
        outside |= (F.col("i") == i) & (F.col("flip").bitwiseAND(F.lit(_mask(*s))) == 0)
    met = (
        points.filter(outside)
        .groupBy("i", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
        .agg(F.collect_set("fp").alias("fps"))
        .filter(F.size("fps") > 1)
    )
    if max_bits == 1:  # two neighbours of a point may differ in 2 bits; the point itself is near both
        met = met.filter(F.array_contains("fps", F.col("point"))).withColumn("hub", F.col("point"))
    else:
        met = met.withColumn("hub", F.array_min("fps"))
    met = met.select(F.col("hub").alias("fa"), F.explode("fps").alias("fb")).filter("fa <> fb")
    found = pairs.select("fa", "fb").union(met)
    return found.select(F.col("fa").alias("a"), F.col("fb").alias("b"))


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) for every row of ``docs``.

    Rows belong together when their fingerprints link, directly or in a chain;
    ``component_id`` is the smallest doc_id of the component. Equal fingerprints
    count once in the search. Repeated rows and repeated ids are kept; a
    component whose ids are all null has a null ``component_id``; ``root``, its
    smallest fingerprint, tells it apart all the same. Runs jobs: the
    fingerprints and the links are written to the shared folder.
    """
    rows = settle(fingerprints(docs, words), "simhash-rows")
    distinct = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct, max_bits, segments, max_bucket), "simhash")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(
        rooted.join(smallest, "root").select("fp", "component_id", "root"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id.

    Of rows with that id the smallest text hash stays, of repeated rows one; in
    a component whose ids are all null likewise. Columns stay as they are.
    """
    found = settle(
        near_duplicates(docs, **settings).select(
            F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "text_hash", "root"),
        "simhash-found")
    first = found.groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("f")).select("f.*")
    kept = settle(
        first.select(
            F.when(F.col("id") == 2**63 - 1, MIN_LONG).otherwise(F.col("id")).alias("__k"),
            F.col("text_hash").alias("__t")),
        "simhash-kept")
    rows = keyed(docs).join(kept, ["__k", "__t"], "left_semi")
    again = found.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.limit(1).count():
        rows = rows.dropDuplicates(["__k", "__t"])
    return rows.select(*docs.columns)

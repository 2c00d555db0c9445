"""Centroid clustering of integer vectors by bit planes and popcounts.

A vector of 64 whole numbers is packed plane by plane: bit i of all components
makes one 64-bit word, the highest plane carries the sign. Then

    x . c = sum over planes i, j of w(i) w(j) popcount(X_i and C_j)

with w(i) = 2^i, and -2^i for the sign's plane; distances are |x|^2 - 2 x.c + |c|^2,
exact in 64-bit integers. Sums of a cluster are counted by plane as well.

Vectors are packed once and written to the shared folder; every round reads the
words, adds up per batch and cluster (a third of all vectors in one cluster are a
few rows for each task), and brings clusters x 64 sums to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermill.sources.shared import settle

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
#: Components lie within +-2^26, so that squared distances fit 64 bits.
LIMIT = 1 << 26
BATCH_ROWS = 4096


def quantised(
    vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, parts): floor(scale * x) of each component x, as array<long>.

    Left out are vectors that are null or have not exactly 64 components, a null
    or non-finite one, or one of 2^26 and more in size after scaling, whose
    distances may not fit a long. Null ids and repeated rows stay.
    """
    exact = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    whole = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float(LIMIT)))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), exact.alias("x"))
        .filter((F.size("x") == WIDTH) & whole)
        .select("vec_id", F.transform("x", lambda v: F.floor(v).cast("long")).alias("parts"))
    )


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane is worth."""
    worth = np.int64(1) << np.arange(planes, dtype=np.int64)
    worth[-1] = -worth[-1]
    return worth


def packed(parts: np.ndarray, planes: int) -> np.ndarray:
    """Planes of vectors: (n, 64) whole numbers to (n, planes) words."""
    bits = (parts[:, None, :] >> np.arange(planes, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def dots(words: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of all vectors with all of ``other``, both as planes."""
    result = np.zeros((len(words), len(other)), dtype=np.int64)
    worth, other_worth = weights(words.shape[1]), weights(other.shape[1])
    for i, w in enumerate(worth.tolist()):
        for j, v in enumerate(other_worth.tolist()):
            shared = np.bitwise_count(words[:, i, None] & other[None, :, j])
            result += shared.astype(np.int64) * (w * v)
    return result


def squares(words: np.ndarray) -> np.ndarray:
    """Inner product of each vector with itself."""
    worth = weights(words.shape[1])
    result = np.zeros(len(words), dtype=np.int64)
    for i, w in enumerate(worth.tolist()):
        for j, v in enumerate(worth.tolist()):
            result += np.bitwise_count(words[:, i] & words[:, j]).astype(np.int64) * (w * v)
    return result


def sums(words: np.ndarray) -> np.ndarray:
    """The 64 components' sums over all vectors, from counts of set bits by plane."""
    counts = [
        np.unpackbits(np.ascontiguousarray(words[:, i]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        .sum(axis=0, dtype=np.int64) for i in range(words.shape[1])
    ]
    return weights(words.shape[1]) @ np.array(counts)


def nearest(
    words: np.ndarray, norms: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); ties to the smaller number."""
    size = (centroids * centroids).sum(axis=1)
    # One plane more than the widest component's bits, for the sign.
    planes = int(np.abs(centroids).max()).bit_length() + 1
    distance = norms[:, None] - 2 * dots(words, packed(centroids, planes)) + size[None, :]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(best)), best]


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in parts:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            some = batch.slice(at, BATCH_ROWS)
            data = np.frombuffer(b"".join(some.column("words").to_pylist()), dtype="<u8")
            yield some, data.reshape(some.num_rows, -1), some.column("norm").to_numpy()


def pack(vectors: DataFrame) -> DataFrame:
    """(vec_id, words, norm) of quantised vectors, the planes as one binary.

    The number of planes is that of the widest component of all (one small job).
    """
    widest = vectors.agg(F.max(F.greatest(F.array_max("parts"), -F.array_min("parts")))).first()[0]
    planes = int(widest or 0).bit_length() + 1

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                some = batch.slice(at, BATCH_ROWS)
                whole = some.column("parts").flatten().to_numpy().reshape(-1, WIDTH)
                words = packed(whole, planes)
                yield pa.record_batch(
                    [some.column("vec_id"), pa.array([row.tobytes() for row in words], pa.binary()),
                     pa.array(squares(words))],
                    names=["vec_id", "words", "norm"])

    return vectors.mapInArrow(batches, "vec_id long, words binary, norm long")


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:vec_id``, in that order.

    Equal ids go by their components; a null id counts as empty text.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.orderBy(F.sha2(key, 256), "parts").limit(clusters).collect()
    return np.array([r.parts for r in chosen], dtype=np.int64).reshape(-1, WIDTH)


def _next(words: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as the floor of the mean of the vectors nearest to it."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, planes, norms in _batches(parts):
            best, _ = nearest(planes, norms, centroids)
            seen, n = np.unique(best, return_counts=True)
            yield pa.record_batch(
                [pa.array(np.repeat(seen, WIDTH).astype(np.int32)),
                 pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(seen))),
                 pa.array(np.repeat(n, WIDTH)),
                 pa.array(np.concatenate([sums(planes[best == c]) for c in seen]))],
                names=["cluster", "component", "n", "total"])

    found = words.mapInArrow(batches, "cluster int, component int, n long, total long")
    moved = centroids.copy()
    for r in found.groupBy("cluster", "component").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    ).collect():
        moved[r.cluster, r.component] = int(r.total) // r.n
    return moved


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = 3,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of quantised vectors, and the final centroids.

    Each round gives every vector to its nearest centroid (squared distance,
    ties to the smaller number) and moves each centroid that has vectors to the
    componentwise floor of their mean. Rounds end early when no centroid moves,
    since further ones would change nothing. With fewer vectors than
    ``clusters`` there are as many centroids as vectors; an empty table gives an
    empty result.
    """
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), centroids
    words = settle(pack(vectors), "planes")
    for _ in range(rounds):
        moved = _next(words, centroids)
        if np.array_equal(moved, centroids):
            break
        centroids = moved

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, planes, norms in _batches(parts):
            best, distance = nearest(planes, norms, centroids)
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    assigned = words.mapInArrow(batches, "vec_id long, cluster int, distance long")
    return settle(assigned, "clusters"), centroids


def with_quality(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256.

    The distances' sums by cluster, one row a cluster, come to the driver.
    """
    inertia = {
        r["cluster"]: r["s"]
        for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    }
    digest = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()
    ]

    def by_cluster(values: dict[int, object], kind: str) -> Column:
        if not values:
            return F.lit(None).cast(kind)
        table = F.create_map(*[F.lit(v) for pair in values.items() for v in pair])
        return table[F.col("cluster")].cast(kind)

    return assigned.select(
        "vec_id", "cluster", "distance",
        by_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        by_cluster(dict(enumerate(digest)), "string").alias("centroid_sha256"))

import hashlib

import numpy as np
import pytest

from ordermill.llm import oracles, planes
from ordermill.llm.queries import QUERIES
from tests.compare import connect, rows_of, types_of

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, words int, norm int, cluster string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, 1, 2, "x") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors, clusters=8, rounds=10):
    """By plain whole numbers: vectors is {vec_id: components}."""
    order = sorted(vectors, key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centroids = [vectors[i] for i in order[:clusters]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        near = {i: best(v)[1] for i, v in vectors.items()}
        centroids = [
            [sum(column) // len(mine) for column in zip(*mine)]
            if (mine := [vectors[i] for i in vectors if near[i] == n]) else c
            for n, c in enumerate(centroids)]
    return {i: best(v) for i, v in vectors.items()}, centroids


def test_popcounts_give_exact_products():
    rng = np.random.default_rng(1)
    for limit in (1, 2, 600, planes.LIMIT - 1):
        x = rng.integers(-limit, limit + 1, size=(50, 64))
        y = rng.integers(-limit, limit + 1, size=(7, 64))
        x[0], x[1], y[0] = -limit, limit, -limit
        bits = int(limit).bit_length() + 1
        a, b = planes.packed(x, bits), planes.packed(y, bits)
        assert np.array_equal(planes.dots(a, b), x @ y.T)
        assert np.array_equal(planes.squares(a), (x * x).sum(axis=1))
        assert np.array_equal(planes.sums(a), x.sum(axis=0))
        near, distance = planes.nearest(a, planes.squares(a), y)
        all_distances = ((x[:, None] - y[None]) ** 2).sum(axis=2)
        assert np.array_equal(distance, all_distances.min(axis=1))
        assert np.array_equal(near, all_distances.argmin(axis=1))


def test_against_plain_arithmetic_with_ties(spark):
    rng = np.random.default_rng(2)
    parts = rng.integers(-2, 3, size=(60, 64))
    parts[20:40] = parts[:20]
    vectors = planes.quantised(table(spark, (parts / 1024).tolist()))
    assigned, centroids = planes.cluster(vectors, clusters=5, rounds=4)
    expected, ends = brute(dict(enumerate(parts.tolist())), 5, 4)
    assert {r.vec_id: (r.distance, r.cluster) for r in assigned.collect()} == expected
    assert centroids.tolist() == ends


def test_whole_table_against_sql(spark):
    db, sql = connect(FOLDER), oracles.ORACLES["op12_centroid_clustering"]
    result = QUERIES["op12_centroid_clustering"](spark, FOLDER)
    assert dict(result.dtypes) == types_of(db, sql)
    assert rows_of(result.toPandas()) == rows_of(db.execute(sql).fetchdf())


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.5] * 63, [0.5] * 65, [nan] + [0.1] * 63, [inf] + [0.1] * 63,
           [None] + [0.1] * 63, [70_000.0] + [0.1] * 63]
    kept = [[0.25] * 64, [-0.25] * 64, [65_000.0] * 64]
    rows = planes.with_quality(*planes.cluster(planes.quantised(table(spark, odd + kept)))).collect()
    assert {r.vec_id for r in rows} == {8, 9, 10}
    assert all(r.distance == 0 and r.inertia == 0 for r in rows)
    assert len({r.cluster for r in rows}) == 3
    shas = {r.vec_id: r.centroid_sha256 for r in rows}
    assert shas[9] == hashlib.sha256(",".join(["-256"] * 64).encode()).hexdigest()


def test_repeated_and_null_ids_and_empty_table(spark):
    vectors = table(spark, [[0.1] * 64, [0.1] * 64, [0.3] * 64, [0.2] * 64], ids=[5, 5, None, 5])
    quantised = planes.quantised(vectors)
    rows = planes.with_quality(*planes.cluster(quantised, clusters=2)).collect()
    assert len(rows) == 4 and {r.cluster for r in rows} <= {0, 1}
    empty = planes.with_quality(*planes.cluster(quantised.limit(0)))
    assert empty.collect() == []
    assert empty.columns == planes.with_quality(*planes.cluster(quantised)).columns


@pytest.mark.parametrize("rounds", [0, 1, 50])
def test_any_number_of_rounds(spark, rounds):
    rng = np.random.default_rng(3)
    parts = rng.integers(-9, 9, size=(40, 64))
    vectors = planes.quantised(table(spark, (parts / 1024).tolist()))
    assigned, _ = planes.cluster(vectors, clusters=3, rounds=rounds)
    expected, _ = brute(dict(enumerate(parts.tolist())), 3, rounds)
    assert {r.vec_id: (r.distance, r.cluster) for r in assigned.collect()} == expected

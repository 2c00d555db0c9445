import bisect
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window, functions as F

from ordermill.operators import dispersion as dp
from ordermill.operators import reports as rp
from ordermill.plans.inspect import plan_text

SCHEMA = "row_key long, sku string, year int, month int, promo_count long, amount double"


def orders_of(spark, pairs, sku="k"):
    rows = [(i, sku, 2022, 4, c, float(a)) for i, (c, a) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def exact(counts, p):
    ordered = sorted(counts)
    return next(c for c in ordered if bisect.bisect_right(ordered, c) / len(ordered) >= p)


def test_percentile_is_the_inverse_distribution(spark):
    profile = dp.promo_profile(orders_of(spark, [(c, 1) for c in range(1, 6)]))
    found = dp.thresholds_exact(profile).first()
    assert (found.p90_thresh_exact, found.p80_thresh_exact) == (5, 4)
    found = dp.thresholds_approx(profile).first()
    assert (found.p90_thresh, found.p80_thresh) == (5, 4)


def test_single_qualifying_order_has_no_deviation(spark):
    profile = dp.promo_profile(orders_of(spark, [(c, c * 10) for c in range(1, 6)]))
    found = dp.sku_month_std(profile).first()
    assert found.std_p90_exact == found.std_p90_approx == 0.0
    assert found.std_p80_exact == found.std_p80_approx == 5.0


def test_equal_amounts_have_no_deviation_however_large(spark):
    rows = [(0, 1)] * 8 + [(3, 123456789.37)] * 4 + [(4, 123456789.37)] * 3
    assert dp.sku_month_std_exact(dp.promo_profile(orders_of(spark, rows))).first()[3:] == (0, 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    """60 random groups of 1 to 60 orders in one table."""
    rng = random.Random(seed)
    rows = [(f"k{g}", (rng.randint(0, 6), rng.randint(1, 10_000)))
            for g in range(60) for _ in range(rng.randint(1, 60))]
    groups = defaultdict(list)
    for sku, p in rows:
        groups[sku].append(p)
    table = spark.createDataFrame(
        [(i, sku, 2022, 4, c, float(a)) for i, (sku, (c, a)) in enumerate(rows)], SCHEMA
    )
    for r in dp.sku_month_std(dp.promo_profile(table)).collect():
        for p, approx, found in ((0.9, r.std_p90_approx, r.std_p90_exact),
                                 (0.8, r.std_p80_approx, r.std_p80_exact)):
            least = exact([c for c, _ in groups[r.SKU]], p)
            kept = [a for c, a in groups[r.SKU] if c >= least]
            mean = sum(kept) / len(kept)
            expected = math.sqrt(sum((a - mean) ** 2 for a in kept) / len(kept))
            assert found == pytest.approx(expected, abs=1e-9)
            assert approx == found


def test_cume_dist_equals_the_window_function(spark):
    pairs = [(i * 7 % 11, i) for i in range(200)]
    table = orders_of(spark, pairs)
    window = Window.partitionBy(*dp.GROUP).orderBy("promo_count")
    expected = table.withColumn("cume_dist", F.cume_dist().over(window))
    key = ["row_key", "cume_dist"]
    assert sorted(map(tuple, dp.promo_cume_dist(table).select(key).collect())) == sorted(
        map(tuple, expected.select(key).collect())
    )


@pytest.mark.parametrize("accuracy", [2, 7, 50, 1000, 1_000_000, 2**31 - 1])
def test_coarse_thresholds_stay_within_their_bound(spark, accuracy):
    """The share of orders up to the threshold is p, give or take 1 / accuracy."""
    counts = [i * i * 31 % 997 for i in range(5000)]
    profile = dp.promo_profile(orders_of(spark, [(c, 1) for c in counts]))
    found = dp.thresholds_approx(profile, accuracy=accuracy).first()
    ordered = sorted(counts)
    for p, threshold in ((0.9, found.p90_thresh), (0.8, found.p80_thresh)):
        below = bisect.bisect_left(ordered, threshold) / len(ordered)
        up_to = bisect.bisect_right(ordered, threshold) / len(ordered)
        assert below - 1 / accuracy <= p <= up_to + 1 / accuracy


def test_fine_thresholds_are_exact_up_to_the_limit(spark):
    counts = [i * i * 31 % 997 for i in range(5000)]
    profile = dp.promo_profile(orders_of(spark, [(c, 1) for c in counts]))
    found = dp.thresholds_approx(profile, accuracy=50_000).first()
    assert (found.p90_thresh, found.p80_thresh) == (exact(counts, 0.9), exact(counts, 0.8))


def test_approximate_thresholds_never_copy_orders(spark):
    profile = dp.promo_profile(orders_of(spark, [(1, 1), (2, 1)]))
    assert "Generate" not in plan_text(dp.thresholds_approx(profile, accuracy=2))


def test_reports_on_no_groups(spark):
    profile = dp.promo_profile(orders_of(spark, [(1, 1)]).limit(0))
    compared = rp.threshold_compare(dp.thresholds_approx(profile), dp.thresholds_exact(profile))
    summary = rp.threshold_diff_summary(compared).first()
    assert (summary.n_groups, summary.pct_diff_p90) == (0, None)
    counts = [
        dp.qualifying_counts(profile, t, c, n) for t, c, n in (
            (dp.thresholds_approx(profile), "p90_thresh", "n_qualified_approx"),
            (dp.thresholds_exact(profile), "p90_thresh_exact", "n_qualified_exact"))]
    assert rp.qualifying_diff_summary(rp.qualifying_set_diff(*counts)).first().n_groups == 0


def test_row_form_agrees_with_the_profile(spark):
    pairs = [(i * 7 % 11, i * 37 % 101) for i in range(300)]
    table = orders_of(spark, pairs)
    profile = dp.promo_profile(table)
    kept = dp.qualifying_orders(table, dp.thresholds_exact(profile), "p80_thresh_exact")
    stds = dp.deviation(kept, "std", "n")
    row = dp.spine_left_join(dp.sku_month_spine(table), stds, "std").first()
    assert row["std"] == pytest.approx(dp.sku_month_std_exact(profile).first().std_p80_exact)


def test_spine_fills_missing_groups(spark):
    spine = dp.sku_month_spine(orders_of(spark, [(1, 1)]))
    empty = dp.deviation(orders_of(spark, [(1, 1)], "other"), "std", "n")
    assert dp.spine_left_join(spine, empty, "std").first()["std"] == 0.0


KEYS = "sku string, year int, month int"


def test_threshold_reports(spark):
    approx = spark.createDataFrame(
        [("a", 2022, 4, 5, 4), ("b", 2022, 4, 5, 4), ("c", 2022, 4, 2, 1)],
        f"{KEYS}, p90_thresh long, p80_thresh long")
    exact_ = spark.createDataFrame(
        [("a", 2022, 4, 5, 4), ("b", 2022, 4, 7, 4), ("c", 2022, 4, 1, 1)],
        f"{KEYS}, p90_thresh_exact long, p80_thresh_exact long")
    compare = rp.threshold_compare(approx, exact_)
    s = rp.threshold_diff_summary(compare).first()
    assert (s.n_groups, s.n_diff_p90, s.pct_diff_p90, s.mean_abs_diff_p90, s.max_abs_diff_p90) == (
        3, 2, 66.67, 1.0, 2.0)
    assert (s.n_diff_p80, s.pct_diff_p80, s.max_abs_diff_p80) == (0, 0.0, 0.0)
    assert [r.sku for r in rp.threshold_disagreements(compare, 1).collect()] == ["b"]


def test_qualifying_set_reports(spark):
    approx = spark.createDataFrame(
        [("a", 2022, 4, 5), ("b", 2022, 4, 1)], f"{KEYS}, n_qualified_approx long")
    exact_ = spark.createDataFrame(
        [("b", 2022, 4, 3), ("c", 2022, 4, 1), ("d", 2022, 4, 0)],
        f"{KEYS}, n_qualified_exact long")
    diff = rp.qualifying_set_diff(approx, exact_)
    assert {r.sku: r.diff_count for r in diff.collect()} == {"a": 5, "b": -2, "c": -1, "d": 0}
    assert tuple(rp.qualifying_diff_summary(diff).first()) == (4, 3, 75.0)
    assert [r.sku for r in rp.qualifying_disagreements(diff, 2).collect()] == ["a", "b"]


def test_size_reports(spark):
    table = orders_of(spark, [(1, 1)] * 5, "big").union(orders_of(spark, [(1, 1)] * 2, "small"))
    sizes = rp.sku_month_sizes(table)
    assert [(r.sku, r.n_orders) for r in rp.largest_groups(sizes, 1, 1).collect()] == [("big", 5)]
    summary = rp.group_size_summary(sizes, 2).first()
    assert summary.n_large_groups == 1
    assert summary.max_size_mb == pytest.approx(5 * 200 / 2**20)
    assert summary.partition_ratio == pytest.approx(5 * 200 / 2**20 / 128)


def test_std_diff_reports(spark):
    stds = spark.createDataFrame(
        [("a", 2022, 4, 1.0, 1.0, 1.0, 3.0), ("b", 2022, 4, 2.0, 1.0, 1.5, 1.0 + 1e-12)],
        "SKU string, year int, month int, std_p90_approx double, std_p80_approx double, "
        "std_p90_exact double, std_p80_exact double")
    diffs = rp.std_diff(stds)
    assert tuple(rp.std_diff_summary(diffs).first()) == (2, 1, 1)
    assert [r.SKU for r in rp.largest_std_diffs(diffs, 1).collect()] == ["b"]

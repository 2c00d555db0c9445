"""The plans are the ones meant for very large tables."""

from ordermill.operators import cancellation as cc
from ordermill.operators import dispersion as dp
from ordermill.plans.catalog import QUERIES
from ordermill.plans.inspect import plan_report, plan_text, run_to_nowhere, stage_ids, time_runs
from ordermill.sources.shared import settle
from ordermill.sources.star import sales

FOLDER = "/root/testdata/sf0.001"


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(QUERIES["sku_month_spine"](spark, FOLDER))
    assert "c_custkey" not in text and "p_type" not in text


def test_deviation_never_joins_order_rows(spark):
    orders = dp.prepare_sku_orders(
        settle(sales(spark, FOLDER, "order_date", "sku", "amount", "promotion_ids"), "sales"))
    report = plan_report(dp.sku_month_std_exact(dp.promo_profile(orders)))
    assert report == {"joins": [], "exchanges": 2}


def _hot_orders(spark):
    rows = spark.range(60_000).selectExpr(
        "id AS row_key",
        "concat_ws(',', if(id % 3 = 0, 'HOT', concat('P', id % 997)), concat('Q', id % 991)) AS p",
    )
    promoted = rows.selectExpr(
        "row_key", "date_add(date '2022-01-01', cast(row_key % 50 as int)) AS order_date",
        "split(p, ',') AS promo_array", "p AS promotion_ids")
    return settle(promoted, "hot")


def test_hot_promotion_is_split_beyond_the_broadcast_limit(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    orders = _hot_orders(spark)
    valid = settle(cc.valid_promotions(orders), "valid")
    counts = cc.valid_promo_count(orders, valid)
    assert counts.selectExpr("sum(valid_promotion_count)").first()[0] == 120_000
    counts.collect()
    assert "skew=true" in plan_text(counts)


def test_candidates_are_chosen_before_their_promotions_are_exploded(spark):
    report = plan_text(QUERIES["qualified_orders"](spark, FOLDER))
    explode = report.index("Generate explode")
    assert "standard" in report[explode:]


def test_hot_group_is_split_beyond_the_broadcast_limit(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    orders = settle(spark.range(60_000).selectExpr(
        "id AS row_key", "if(id % 3 = 0, 'HOT', concat('S', id % 997)) AS sku", "2022 AS year",
        "4 AS month", "id % 5 AS promo_count", "cast(id AS double) AS amount"), "hot-groups")
    thresholds = settle(dp.thresholds_exact(dp.promo_profile(orders)), "thresholds")
    joined = dp.orders_with_thresholds(orders, thresholds)
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan_text(joined)


def test_small_side_is_broadcast_by_its_size(spark):
    orders = _hot_orders(spark)
    valid = settle(cc.valid_promotions(orders), "valid")
    assert plan_report(cc.valid_promo_count(orders, valid))["joins"] == ["BroadcastHashJoin"]


def test_inspection_helpers(spark):
    table = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    assert plan_report(table)["exchanges"] == 1
    assert len(stage_ids(spark, table.collect)) >= 2
    mean, spread = time_runs(lambda: run_to_nowhere(spark.range(1)), 2)
    assert mean > 0 and spread >= 0

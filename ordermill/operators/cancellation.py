"""Cancelled share per city among cheap standard orders with enough valid promotions.

A promotion is valid when its first and last sighting lie at least two days
apart. An order qualifies when it is a standard one, has at least three valid
promotions and costs less than its state's average over merchant-fulfilled,
shipped orders.

``qualified_orders`` and the operators it builds on work order by order and
need a ``row_key``. ``city_cancellation`` gives the final table without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.functions.promos import promo_array, raw_promo_count
from ordermill.functions.text import lower_trimmed, upper_trimmed
from ordermill.sources.shared import settle

_AVG = "state_avg_merchant_shipped_amount"


def prepare_orders(sales: DataFrame) -> DataFrame:
    """Normalised orders that have a date, an amount, a city and a state."""
    key = [c for c in ("row_key",) if c in sales.columns]
    return sales.select(
        *key,
        "order_date",
        "amount",
        lower_trimmed("status").alias("status"),
        lower_trimmed("fulfilment").alias("fulfilment"),
        lower_trimmed("service_level").alias("service_level"),
        lower_trimmed("courier_status").alias("courier_status"),
        upper_trimmed("ship_city").alias("ship_city"),
        upper_trimmed("ship_state").alias("ship_state"),
        "promotion_ids",
        promo_array("promotion_ids").alias("promo_array"),
    ).filter(
        F.col("order_date").isNotNull()
        & F.col("amount").isNotNull()
        & (F.length("ship_city") > 0)
        & (F.length("ship_state") > 0)
    )


def with_row_key(orders: DataFrame) -> DataFrame:
    """Add a ``row_key`` and write the orders to the shared folder (runs a job).

    Generated ids depend on how the input was split, so they are only safe to
    join on once they are stored.
    """
    return settle(orders.withColumn("row_key", F.monotonically_increasing_id()), "keyed")


def promo_rows(orders: DataFrame) -> DataFrame:
    """One row per order and listed promotion, repeats kept.

    Same rows as exploding ``promo_array``; splitting first and trimming after
    keeps the whole chain in generated code.
    """
    key = [c for c in ("row_key",) if c in orders.columns]
    pieces = orders.select(
        *key, "order_date", F.explode(F.split("promotion_ids", ",")).alias("piece")
    )
    return pieces.select(*key, "order_date", F.trim("piece").alias("promotion_id")).filter(
        F.length("promotion_id") > 0
    )


def promo_active_span(orders: DataFrame) -> DataFrame:
    """First and last day of each promotion and the days between them."""
    return active_span(promo_rows(orders))


def active_span(rows: DataFrame) -> DataFrame:
    """``promo_active_span`` from promotion rows."""
    return (
        rows.groupBy("promotion_id")
        .agg(
            F.min("order_date").alias("first_seen_date"),
            F.max("order_date").alias("last_seen_date"),
        )
        .withColumn("active_days", F.datediff("last_seen_date", "first_seen_date"))
    )


def valid_promotions(orders: DataFrame, min_active_days: int = 2) -> DataFrame:
    """Promotions whose sightings span at least ``min_active_days``."""
    return promo_active_span(orders).filter(F.col("active_days") >= min_active_days)


def valid_promo_rows(orders: DataFrame, valid: DataFrame) -> DataFrame:
    """Order-promotion rows whose promotion is valid.

    ``valid`` has one row per promotion, so a semi join gives the inner join's
    rows; a promotion on very many orders is split at run time by AQE.
    """
    return _in_valid(promo_rows(orders), valid)


def _in_valid(rows: DataFrame, valid: DataFrame) -> DataFrame:
    return (
        rows.select("row_key", "promotion_id")
        .join(valid.select("promotion_id"), "promotion_id", "left_semi")
        .select("row_key", "promotion_id")
    )


def stored_valid_promo_rows(orders: DataFrame, min_active_days: int = 2) -> DataFrame:
    """``valid_promo_rows`` from promotion rows that are stored once and read twice.

    The rows give the valid promotions and are then joined with them. As both
    sides are read from tables, the valid ones with a selection, Spark's runtime
    Bloom filter can apply (with its default settings from 10 GB of rows and below
    10 MB of valid promotions): rows of other promotions are dropped in the scan's
    tasks, before the shuffle. A promotion list that is exploded on the way to the
    join can not be filtered so. Runs jobs: both tables are written.
    """
    rows = settle(promo_rows(orders), "promo-rows")
    valid = active_span(rows).filter(F.col("active_days") >= min_active_days)
    valid = settle(valid, "valid-promotions").filter(F.col("active_days") >= min_active_days)
    return _in_valid(rows, valid)


def valid_promo_count(orders: DataFrame, valid: DataFrame) -> DataFrame:
    """Distinct valid promotions per order; orders without any are absent.

    Repeats are dropped inside each order before the join, which saves the
    second shuffle of a distinct count.
    """
    return (
        orders.select(
            "row_key", F.explode(F.array_distinct("promo_array")).alias("promotion_id")
        )
        .join(valid.select("promotion_id"), "promotion_id", "left_semi")
        .groupBy("row_key")
        .agg(F.count(F.lit(1)).alias("valid_promotion_count"))
    )


def orders_with_promo_count(orders: DataFrame, counts: DataFrame) -> DataFrame:
    """Orders with their number of valid promotions, 0 where there is none."""
    return orders.join(counts, "row_key", "left").withColumn(
        "valid_promotion_count", F.coalesce("valid_promotion_count", F.lit(0).cast("long"))
    )


def state_avg_amount(orders: DataFrame) -> DataFrame:
    """Average amount per state over merchant-fulfilled, shipped orders."""
    return (
        orders.filter(
            (F.col("fulfilment") == "merchant") & (F.col("courier_status") == "shipped")
        )
        .groupBy("ship_state")
        .agg(F.avg("amount").alias(_AVG))
    )


def orders_with_state_avg(orders: DataFrame, averages: DataFrame) -> DataFrame:
    """Orders with their state's average, null where the state has none."""
    return orders.join(averages, "ship_state", "left")


def candidate_orders(orders: DataFrame, averages: DataFrame, min_promotions: int = 3) -> DataFrame:
    """Standard orders below their state's average that list enough promotions.

    The list may still name too few valid ones; only these orders need a look.
    """
    listed = orders.filter(
        (F.col("service_level") == "standard")
        & (raw_promo_count("promotion_ids") >= min_promotions)
    )
    return listed.join(averages, "ship_state").filter(F.col("amount") < F.col(_AVG))


def qualified_orders(
    orders: DataFrame, valid: DataFrame, averages: DataFrame, min_promotions: int = 3
) -> DataFrame:
    """Standard orders below their state's average with enough valid promotions.

    Only the promotions of candidates are exploded and shuffled.
    """
    candidates = candidate_orders(orders, averages, min_promotions)
    enough = valid_promo_count(candidates, valid).filter(
        F.col("valid_promotion_count") >= min_promotions
    )
    return candidates.join(enough, "row_key")


def cancellation_by_city(qualified: DataFrame) -> DataFrame:
    """Final table from qualified orders, one row per order."""
    totals = qualified.groupBy("ship_city", "ship_state").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("status").contains("cancelled")).alias("cancelled"),
        F.max(_AVG).alias(_AVG),
    )
    return _final_columns(totals)


def city_cancellation(
    orders: DataFrame, valid: DataFrame, averages: DataFrame, min_promotions: int = 3
) -> DataFrame:
    """Final table straight from prepared orders.

    No order is ever joined to itself. Candidates are first counted per city
    and set of promotions, which needs no row key and folds an order pattern
    that holds much of the input into one row per map task; lists that differ
    in order, blanks or repeats meet in one set. Only these groups are matched
    with the valid promotions.

    With ``valid`` and ``averages`` settled the planner knows their sizes and
    broadcasts them only where they are small.
    """
    sets = (
        candidate_orders(orders, averages, min_promotions)
        .withColumn("promotions", F.array_sort(F.array_distinct(promo_array("promotion_ids"))))
        .filter(F.size("promotions") >= min_promotions)
    )
    groups = sets.groupBy("ship_city", "ship_state", "promotions").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("status").contains("cancelled")).alias("cancelled"),
        F.max(_AVG).alias(_AVG),
    )
    # The digest stands for the set once its promotions are on separate rows.
    listed = groups.select(
        "ship_city",
        "ship_state",
        F.sha2(F.array_join("promotions", ","), 256).alias("list_key"),
        "orders",
        "cancelled",
        _AVG,
        F.explode("promotions").alias("promotion_id"),
    )
    qualified = (
        listed.join(valid.select("promotion_id"), "promotion_id", "left_semi")
        .groupBy("ship_city", "ship_state", "list_key")
        .agg(
            F.count(F.lit(1)).alias("valid_promotion_count"),
            F.max("orders").alias("orders"),
            F.max("cancelled").alias("cancelled"),
            F.max(_AVG).alias(_AVG),
        )
        .filter(F.col("valid_promotion_count") >= min_promotions)
    )
    totals = qualified.groupBy("ship_city", "ship_state").agg(
        F.sum("orders").alias("orders"),
        F.sum("cancelled").alias("cancelled"),
        F.max(_AVG).alias(_AVG),
    )
    return _final_columns(totals)


def _final_columns(totals: DataFrame) -> DataFrame:
    percentage = F.round(
        F.col("cancelled").cast("double") * 100.0 / F.col("orders").cast("double"), 4
    )
    return totals.select(
        "ship_city",
        "ship_state",
        F.col("orders").alias("qualified_standard_order_count"),
        F.col("cancelled").alias("cancelled_order_count"),
        percentage.alias("cancelled_percentage"),
        _AVG,
    )

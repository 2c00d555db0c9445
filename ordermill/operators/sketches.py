"""Percentiles of promotion counts from stored quantile sketches.

One KLL sketch per SKU and day is written once. Any longer period is answered by
merging sketches, without reading an order again: SKU-months, SKU-years, or a
SKU's whole time. A sketch holds at most a few times k values, so merging costs
the same for a SKU that has a third of all orders, and partial sketches combine
on the map side.

A sketch that has seen no more than k orders is exact. Beyond that the share of
orders at or below its percentile p lies within ``rank_error_bound(k)`` of p in
99 of 100 cases; ``rank_errors`` measures it against the exact profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.functions.promos import raw_promo_count
from ordermill.operators.dispersion import (
    ACCURACY, GROUP, PERCENTILES, approx_name, exact_name, percentile_label,
)

SKETCH_K = 200


def dated_orders(sales: DataFrame) -> DataFrame:
    """Orders with a date, a SKU and an amount: SKU, day and raw promotion count."""
    return sales.filter(
        F.col("order_date").isNotNull() & F.col("sku").isNotNull() & F.col("amount").isNotNull()
    ).select("sku", "order_date", raw_promo_count("promotion_ids").alias("promo_count"))


def daily_sketches(orders: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(sku, order_date, sketch): promotion counts of each SKU and day."""
    return orders.groupBy("sku", "order_date").agg(
        F.kll_sketch_agg_bigint("promo_count", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches merged over all days of each group of ``sku``, ``year``, ``month``."""
    dated = sketches.select(
        "sku", F.year("order_date").alias("year"), F.month("order_date").alias("month"), "sketch")
    return dated.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_name(p: float) -> str:
    return f"{percentile_label(p)}_thresh_sketch"


def thresholds_sketch(
    merged: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Percentiles of the promotion count per group, and the orders seen, from sketches."""
    keys = [c for c in merged.columns if c != "sketch"]
    return merged.select(
        *keys,
        F.kll_sketch_get_n_bigint("sketch").alias("n_orders"),
        *[
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias(sketch_name(p))
            for p in percentiles
        ],
    )


def thresholds_percentile_approx(
    orders: DataFrame, percentiles: Sequence[float] = PERCENTILES, accuracy: int = ACCURACY
) -> DataFrame:
    """Percentiles per SKU and month by Spark's own mergeable summary of order rows.

    Below ``accuracy`` orders a group's summary keeps nearly every order, so it
    is the plain form to compare with, not the one for large groups.
    """
    return orders.groupBy(*GROUP).agg(
        *[
            F.percentile_approx("promo_count", F.lit(float(p)), F.lit(accuracy)).alias(approx_name(p))
            for p in percentiles
        ]
    )


def count_profile(orders: DataFrame, *keys: str) -> DataFrame:
    """Orders by group and promotion count, from rows that carry ``order_date``."""
    dated = orders.withColumns(
        {"year": F.year("order_date"), "month": F.month("order_date")})
    return dated.groupBy(*keys, "promo_count").agg(F.count(F.lit(1)).alias("orders_at"))


def rank_error_bound(k: int) -> float:
    """Largest error of a rank for a KLL sketch, at 99 % confidence (fixed constants)."""
    return 2.296 / k**0.9723


def rank_errors(
    profile: DataFrame,
    thresholds: DataFrame,
    k: int = SKETCH_K,
    percentiles: Sequence[float] = PERCENTILES,
) -> DataFrame:
    """Per group the exact and the sketched percentiles and the sketched ones' rank errors.

    A value's ranks run from the share of orders below it to the share up to it;
    the error of percentile p is its distance from that range, and ``within``
    says whether the bound for ``k`` holds. The join is between one row per group
    and one per group and promotion count, never order rows.
    """
    keys = [c for c in thresholds.columns if c != "n_orders" and not c.endswith("_thresh_sketch")]
    upward = Window.partitionBy(*keys).orderBy("promo_count")
    shares = profile.withColumn(
        "up_to", F.sum("orders_at").over(upward) / F.sum("orders_at").over(Window.partitionBy(*keys)))
    count, up_to = F.col("promo_count"), F.col("up_to")

    def error(p: float) -> Column:
        chosen = F.col(sketch_name(p))
        below = F.coalesce(F.max(F.when(count < chosen, up_to)), F.lit(0.0))
        return F.greatest(F.lit(0.0), below - p, p - F.max(F.when(count <= chosen, up_to)))

    table = shares.join(thresholds, keys).groupBy(*keys).agg(
        F.max("n_orders").alias("n_orders"),
        *[F.min(F.when(up_to >= p, count)).alias(exact_name(p)) for p in percentiles],
        *[F.max(sketch_name(p)).alias(sketch_name(p)) for p in percentiles],
        *[error(p).alias(f"{percentile_label(p)}_rank_error") for p in percentiles],
    )
    bound = rank_error_bound(k)
    return table.withColumns(
        {
            f"{label}_within": F.col(f"{label}_rank_error") <= bound
            for label in map(percentile_label, percentiles)
        }
    )

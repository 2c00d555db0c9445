"""Comparison and sizing reports, each a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordermill.operators.dispersion import GROUP

_THRESHOLDS = ["p90_thresh", "p90_thresh_exact", "diff_p90",
               "p80_thresh", "p80_thresh_exact", "diff_p80"]


def clean_counts(sales: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows read, rows kept by each clean-up, and valid promotions, as one row."""
    has_date = F.col("order_date").isNotNull() & F.col("amount").isNotNull()
    in_city = (F.length(F.trim("ship_city")) > 0) & (F.length(F.trim("ship_state")) > 0)
    has_sku = F.col("sku").isNotNull()
    return sales.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(has_date & in_city).alias("city_rows_kept"),
        F.count_if(has_date & has_sku).alias("sku_rows_kept"),
    ).select(
        "*",
        (F.col("rows_in") - F.col("sku_rows_kept")).alias("sku_rows_dropped"),
        valid.select(F.count(F.lit(1))).scalar().alias("valid_promotions"),
    )


def threshold_compare(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Approximate minus exact thresholds per group."""
    return approx.join(exact, GROUP).withColumns(
        {
            f"diff_{p}": F.col(f"{p}_thresh").cast("double")
            - F.col(f"{p}_thresh_exact").cast("double")
            for p in ("p90", "p80")
        }
    )


def threshold_diff_summary(compare: DataFrame) -> DataFrame:
    """How many groups differ, in percent as well, and by how much."""
    def pair(p: str) -> list[Column]:
        diff = F.col(f"diff_{p}")
        differing = F.count_if(diff != 0)
        return [
            differing.alias(f"n_diff_{p}"),
            _percent(differing).alias(f"pct_diff_{p}"),
            F.avg(F.abs(diff)).alias(f"mean_abs_diff_{p}"),
            F.max(F.abs(diff)).alias(f"max_abs_diff_{p}"),
        ]

    return compare.agg(F.count(F.lit(1)).alias("n_groups"), *pair("p90"), *pair("p80"))


def threshold_disagreements(compare: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` groups, in key order, whose thresholds differ."""
    return (
        compare.filter((F.col("diff_p90") != 0) | (F.col("diff_p80") != 0))
        .select(*GROUP, *_THRESHOLDS)
        .orderBy(*GROUP)
        .limit(k)
    )


def qualifying_set_diff(approx_counts: DataFrame, exact_counts: DataFrame) -> DataFrame:
    """Qualifying orders per group by either method and their difference."""
    zero = F.lit(0).cast("long")
    return (
        approx_counts.join(exact_counts, GROUP, "full_outer")
        .withColumns(
            {
                "n_qualified_approx": F.coalesce("n_qualified_approx", zero),
                "n_qualified_exact": F.coalesce("n_qualified_exact", zero),
            }
        )
        .withColumn("diff_count", F.col("n_qualified_approx") - F.col("n_qualified_exact"))
    )


def qualifying_diff_summary(set_diff: DataFrame) -> DataFrame:
    """How many groups have a different number of qualifying orders."""
    differing = F.count_if(F.col("diff_count") != 0)
    return set_diff.agg(
        F.count(F.lit(1)).alias("n_groups"),
        differing.alias("n_diff"),
        _percent(differing).alias("pct_diff"),
    )


def qualifying_disagreements(set_diff: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` groups whose numbers of qualifying orders differ most."""
    return (
        set_diff.filter(F.col("diff_count") != 0)
        .orderBy(F.abs("diff_count").desc(), *GROUP)
        .limit(k)
    )


def sku_month_sizes(orders: DataFrame, row_bytes: int = 200) -> DataFrame:
    """Orders per group and their estimated size in MB."""
    counted = orders.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_orders"))
    return estimated_sizes(counted, row_bytes)


def estimated_sizes(counted: DataFrame, row_bytes: int = 200) -> DataFrame:
    """Groups with their ``n_orders`` and an estimated size in MB."""
    return counted.withColumn(
        "est_size_mb", F.col("n_orders") * row_bytes / F.lit(1024.0 * 1024.0))


def largest_groups(sizes: DataFrame, min_orders: int = 1000, k: int = 20) -> DataFrame:
    """The ``k`` groups with most orders among those over ``min_orders``."""
    return (
        sizes.filter(F.col("n_orders") > min_orders)
        .orderBy(F.desc("n_orders"), *GROUP)
        .limit(k)
    )


def group_size_summary(
    sizes: DataFrame, min_orders: int = 1000, partition_mb: float = 128.0
) -> DataFrame:
    """Number of large groups and the largest one against a partition's size."""
    return (
        sizes.filter(F.col("n_orders") > min_orders)
        .agg(
            F.count(F.lit(1)).alias("n_large_groups"),
            F.max("est_size_mb").alias("max_size_mb"),
        )
        .withColumn("partition_ratio", F.col("max_size_mb") / partition_mb)
    )


def std_diff(stds: DataFrame) -> DataFrame:
    """Absolute difference of approximate and exact deviations per group."""
    return stds.withColumns(
        {
            f"diff_std_{p}": F.abs(F.col(f"std_{p}_approx") - F.col(f"std_{p}_exact"))
            for p in ("p90", "p80")
        }
    )


def std_diff_summary(diffs: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """How many groups differ by more than ``tolerance``."""
    return diffs.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.col("diff_std_p90") > tolerance).alias("n_diff_std_p90"),
        F.count_if(F.col("diff_std_p80") > tolerance).alias("n_diff_std_p80"),
    )


def largest_std_diffs(diffs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` groups whose P90 deviations differ most."""
    return diffs.orderBy(F.desc("diff_std_p90"), *GROUP).limit(k)


def _percent(part: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, F.count(F.lit(1))), 2)

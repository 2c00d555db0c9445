"""Amount deviation per SKU and month over orders with many promotions.

Per group of (sku, year, month) the orders whose promotion count reaches the
group's P90 or P80 are kept and the population deviation of their amounts is
taken. A percentile here is the smallest promotion count whose cumulative
share reaches p (the inverse of the distribution function, no interpolation).

Everything is answered from one narrow table, the promotion profile: one row
per group and promotion count with the number of orders and the moments of
their amounts. It comes from a single aggregate with map-side combine, so a SKU
that holds a third of all orders shrinks to a few rows per map task, and no
order row is ever sorted within its group or joined to its threshold. The
operators that do return order rows carry ``row_key`` when the input has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.functions.promos import raw_promo_count

GROUP = ["sku", "year", "month"]
PERCENTILES = (0.9, 0.8)
ACCURACY = 1_000_000


def percentile_label(p: float) -> str:
    """``p90`` for 0.9."""
    return f"p{p * 100:g}".replace(".", "_")


def prepare_sku_orders(sales: DataFrame) -> DataFrame:
    """Orders with a date, a SKU and an amount, and their raw promotion count.

    A blank SKU is a SKU like any other; only null ones are dropped.
    """
    key = [c for c in ("row_key",) if c in sales.columns]
    return sales.filter(
        F.col("order_date").isNotNull() & F.col("sku").isNotNull() & F.col("amount").isNotNull()
    ).select(
        *key,
        "sku",
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
        raw_promo_count("promotion_ids").alias("promo_count"),
        "amount",
    )


def promo_profile(orders: DataFrame) -> DataFrame:
    """Orders and amount moments per group and promotion count, with running totals.

    ``cume_orders`` counts the group's orders with at most that many promotions
    and ``group_orders`` all of them. The running sum sorts distinct promotion
    counts, not orders.
    """
    counted = orders.groupBy(*GROUP, "promo_count").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("amount").alias("amount_mean"),
        F.var_pop("amount").alias("amount_var"),
    )
    group = Window.partitionBy(*GROUP)
    upward = group.orderBy("promo_count").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumns(
        {
            "cume_orders": F.sum("n_orders").over(upward),
            "group_orders": F.sum("n_orders").over(group),
        }
    )


def promo_cume_dist(orders: DataFrame) -> DataFrame:
    """Orders with the cumulative share of their promotion count in the group.

    Equals ``cume_dist()`` over the group, without sorting its orders: the
    share depends on the promotion count alone and is joined from the profile.
    """
    shares = promo_profile(orders).select(
        *GROUP, "promo_count", _cume_share().alias("cume_dist")
    )
    return orders.join(shares, [*GROUP, "promo_count"])


def thresholds_exact(
    profile: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Exact percentiles of the promotion count per group, from the profile."""
    return profile.groupBy(*GROUP).agg(
        *[_threshold(p).alias(exact_name(p)) for p in percentiles]
    )


def thresholds_exact_by_rows(
    shares: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Exact percentiles from order rows that carry their ``cume_dist``."""
    return shares.groupBy(*GROUP).agg(
        *[
            F.min(F.when(F.col("cume_dist") >= p, F.col("promo_count"))).alias(exact_name(p))
            for p in percentiles
        ]
    )


def thresholds_approx(
    profile: DataFrame,
    percentiles: Sequence[float] = PERCENTILES,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Approximate percentiles of the promotion count per group, from the profile.

    The smallest count whose cumulative share reaches p - 1 / ``accuracy``: the
    share at the result is within 1 / ``accuracy`` of p, the bound a sketch of
    that accuracy gives, for groups of any size by the same rule. It is not
    Spark's own sketch, which keeps nearly every row at such accuracies.
    """
    return profile.groupBy(*GROUP).agg(
        *[_threshold(p, accuracy).alias(approx_name(p)) for p in percentiles]
    )


def orders_with_thresholds(orders: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Orders with the thresholds of their group."""
    return orders.join(thresholds, GROUP)


def qualifying_orders(orders: DataFrame, thresholds: DataFrame, column: str) -> DataFrame:
    """Orders whose promotion count reaches the group's threshold in ``column``."""
    return orders_with_thresholds(orders, thresholds).filter(
        F.col("promo_count") >= F.col(column)
    )


def qualifying_counts(
    profile: DataFrame, thresholds: DataFrame, column: str, name: str
) -> DataFrame:
    """Number of orders per group that reach the threshold in ``column``."""
    return (
        profile.join(thresholds, GROUP)
        .filter(F.col("promo_count") >= F.col(column))
        .groupBy(*GROUP)
        .agg(F.sum("n_orders").alias(name))
    )


def deviation(qualifying: DataFrame, name: str, count_name: str) -> DataFrame:
    """Population deviation of the amounts per group of order rows.

    Groups with fewer than two orders get 0.
    """
    n = F.count(F.lit(1))
    std = F.when(n > 1, F.stddev_pop("amount"))
    return qualifying.groupBy(*GROUP).agg(
        n.alias(count_name), F.coalesce(std, F.lit(0.0)).alias(name)
    )


def sku_month_spine(orders: DataFrame) -> DataFrame:
    """All groups that occur."""
    return orders.select(*GROUP).distinct()


def spine_left_join(spine: DataFrame, deviations: DataFrame, *names: str) -> DataFrame:
    """Every group of the spine with its deviations, 0 where there are none."""
    joined = spine.join(deviations, GROUP, "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})


def sku_month_std_exact(
    profile: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Deviations above the exact percentiles, one row per group."""
    thresholds = {exact_name(p): _threshold(p) for p in percentiles}
    return _deviations(
        _with_thresholds(profile, thresholds),
        {exact_name(p): f"std_{percentile_label(p)}_exact" for p in percentiles},
    )


def sku_month_std_approx(
    profile: DataFrame,
    percentiles: Sequence[float] = PERCENTILES,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Deviations above the approximate percentiles, one row per group."""
    thresholds = {approx_name(p): _threshold(p, accuracy) for p in percentiles}
    return _deviations(
        _with_thresholds(profile, thresholds),
        {approx_name(p): f"std_{percentile_label(p)}_approx" for p in percentiles},
    )


def sku_month_std(
    profile: DataFrame,
    percentiles: Sequence[float] = PERCENTILES,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Final table: deviations above both kinds of percentiles."""
    thresholds = {approx_name(p): _threshold(p, accuracy) for p in percentiles}
    thresholds |= {exact_name(p): _threshold(p) for p in percentiles}
    both = _with_thresholds(profile, thresholds)
    names = {approx_name(p): f"std_{percentile_label(p)}_approx" for p in percentiles}
    names |= {exact_name(p): f"std_{percentile_label(p)}_exact" for p in percentiles}
    table = _deviations(both, names)
    return table.select(F.col("sku").alias("SKU"), "year", "month", *names.values())


def approx_name(p: float) -> str:
    return f"{percentile_label(p)}_thresh"


def exact_name(p: float) -> str:
    return f"{percentile_label(p)}_thresh_exact"


def _cume_share() -> Column:
    return F.col("cume_orders") / F.col("group_orders")


def _threshold(p: float, accuracy: int | None = None) -> Column:
    """Smallest promotion count whose share reaches p, or p - 1 / ``accuracy``."""
    least = p - 1 / accuracy if accuracy else p
    return F.min(F.when(_cume_share() >= least, F.col("promo_count")))


def _with_thresholds(profile: DataFrame, thresholds: dict[str, Column]) -> DataFrame:
    group = Window.partitionBy(*GROUP)
    return profile.withColumns({name: t.over(group) for name, t in thresholds.items()})


def _deviations(profile: DataFrame, names: dict[str, str]) -> DataFrame:
    """Merge the moments of the qualifying profile rows, per threshold column.

    The mean of the qualifying orders comes first, so the squares are taken
    about it and do not cancel.
    """
    group = Window.partitionBy(*GROUP)

    def over_qualifying(threshold: str, value: Column) -> Column:
        return F.sum(F.when(F.col("promo_count") >= F.col(threshold), value))

    n = F.col("n_orders")
    means = profile.withColumns(
        {
            f"{t}_mean": over_qualifying(t, n * F.col("amount_mean")).over(group)
            / over_qualifying(t, n).over(group)
            for t in names
        }
    )

    def std(threshold: str) -> Column:
        off = F.col("amount_mean") - F.col(f"{threshold}_mean")
        squares = over_qualifying(threshold, n * (F.col("amount_var") + off * off))
        kept = over_qualifying(threshold, n)
        return F.coalesce(F.when(kept > 1, F.sqrt(squares / kept)), F.lit(0.0))

    return means.groupBy(*GROUP).agg(*[std(t).alias(s) for t, s in names.items()])

"""The four questions as whole jobs, from CSV orders to a sorted result file.

A job that needs its orders more than once stores them first as a narrow table
in the shared folder, so the CSV text is parsed once and a lost executor costs
no second parse; the table goes when the job ends. Results are several sorted
files unless ``single_file`` asks for one, which a single task then writes.

Every job returns its row counts (read, kept, result and its own), taken while
its writes run; the input is not read again for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.operators import cancellation, dispersion, reports, rolling, variety
from ordermill.sources.counts import Counts
from ordermill.sources import orders_csv, sinks
from ordermill.sources.rejects import (
    Rules, item_rules, kept, purchase_rules, read_with_raw_lines, rejected, with_reason,
)
from ordermill.sources.shared import Scratch


def rolling_top_size(
    spark: SparkSession, source: str, target: str, single_file: bool = False,
    rejects: str | None = None,
) -> dict[str, int]:
    """Most bought size per state and rolling window, as CSV.

    ``rejects`` names a folder for the lines that are not used, with the reason.
    """
    columns = ["date", "status", "qty", "size", "ship_state"]
    counts = Counts()
    with Scratch(spark) as scratch:
        orders = _lines(spark, scratch, counts, source, columns, purchase_rules(), rejects,
                        any_date_format=True)
        purchases = counts.at("kept", rolling.shipped_purchases(orders))
        result = rolling.top_size(
            rolling.sum_windows(rolling.rolling_fanout(rolling.daily_size_qty(purchases))))
        sinks.write_csv(result, target, ["window_date", "state"], single_file, counts)
    return counts.taken()


def median_variety(
    spark: SparkSession, source: str, target: str, single_file: bool = False,
    rejects: str | None = None,
) -> dict[str, int]:
    """Median number of SKUs per style, by month and state, as CSV; ``rejects`` as above."""
    columns = ["date", "sku", "style", "size", "ship_state"]
    counts = Counts()
    with Scratch(spark) as scratch:
        orders = _lines(spark, scratch, counts, source, columns, item_rules(), rejects)
        items = counts.at("kept", variety.sized_items(orders))
        result = variety.median_of(variety.variety_per_style(items))
        sinks.write_csv(result, target, ["month", "state"], single_file, counts)
    return counts.taken()


def _lines(
    spark: SparkSession, scratch: Scratch, counts: Counts, source: str, columns: list[str],
    rules: Rules, rejects: str | None, any_date_format: bool = False,
) -> DataFrame:
    """Typed orders of a text question; lines it does not use go to ``rejects`` if given.

    With ``rejects`` the checked lines are stored, so the CSV is parsed once.
    """
    if rejects is None:
        raw = counts.at("read", orders_csv.read_orders(spark, source, columns, trim=True))
    else:
        lines = counts.at("read", read_with_raw_lines(spark, source, columns))
        checked = scratch.settle(with_reason(lines, rules), "checked-lines")
        counts.at("rejected", rejected(checked)).write.mode("overwrite").parquet(rejects)
        raw = kept(checked)
    return orders_csv.type_orders(raw, any_date_format, clamp=True)


def city_cancellation(
    spark: SparkSession, source: str, target: str, single_file: bool = False
) -> dict[str, int]:
    """Cancelled share per city, as parquet."""
    columns = ["date", "amount", "status", "fulfilment", "service_level", "courier_status",
               "ship_city", "ship_state", "promotion_ids"]
    counts = Counts()
    with Scratch(spark) as scratch:
        raw = counts.at("read", orders_csv.read_orders(spark, source, columns))
        prepared = cancellation.prepare_orders(orders_csv.type_orders(raw)).drop("promo_array")
        orders = scratch.settle(counts.at("kept", prepared), "orders")
        valid = scratch.settle(
            counts.at("valid_promotions", cancellation.valid_promotions(orders)), "valid-promotions")
        averages = scratch.settle(cancellation.state_avg_amount(orders), "state-averages")
        result = cancellation.city_cancellation(orders, valid, averages)
        sinks.write_parquet(result, target, ["ship_state", "ship_city"], single_file, counts)
    return counts.taken()


def sku_month_std(
    spark: SparkSession, source: str, target: str, single_file: bool = False,
    reports_to: str | None = None, min_orders: int = 1000,
) -> dict[str, int]:
    """Deviation per SKU and month by both kinds of percentiles, as parquet.

    ``reports_to`` names a folder for the comparison and size reports, one
    parquet table each. All come from one stored promotion profile.
    """
    columns = ["date", "sku", "amount", "promotion_ids"]
    counts = Counts()
    with Scratch(spark) as scratch:
        raw = counts.at("read", orders_csv.read_orders(spark, source, columns))
        orders = counts.at("kept", dispersion.prepare_sku_orders(orders_csv.type_orders(raw)))
        profile = scratch.settle(dispersion.promo_profile(orders), "promo-profile")
        result = dispersion.sku_month_std(profile)
        sinks.write_parquet(result, target, ["year", "month", "SKU"], single_file, counts)
        if reports_to:
            for name, report in sku_month_reports(profile, min_orders).items():
                path = f"{reports_to.rstrip('/')}/{name}"
                report.coalesce(1).write.mode("overwrite").parquet(path)
    return counts.taken()


SKU_MONTH_REPORTS = [
    "threshold_diff_summary", "threshold_disagreements", "qualifying_diff_summary",
    "qualifying_disagreements", "group_size_summary", "largest_groups", "std_diff_summary",
    "largest_std_diffs",
]


def sku_month_reports(profile: DataFrame, min_orders: int = 1000) -> dict[str, DataFrame]:
    """The reports on approximate against exact percentiles and on group sizes, by name.

    Each has one row or a top-k; group sizes are sums of the profile's orders.
    """
    approx, exact = dispersion.thresholds_approx(profile), dispersion.thresholds_exact(profile)
    compare = reports.threshold_compare(approx, exact)
    set_diff = reports.qualifying_set_diff(
        dispersion.qualifying_counts(profile, approx, "p90_thresh", "n_qualified_approx"),
        dispersion.qualifying_counts(profile, exact, "p90_thresh_exact", "n_qualified_exact"))
    sizes = reports.estimated_sizes(
        profile.groupBy(*dispersion.GROUP).agg(F.sum("n_orders").alias("n_orders")))
    diffs = reports.std_diff(dispersion.sku_month_std(profile))
    found = [
        reports.threshold_diff_summary(compare),
        reports.threshold_disagreements(compare),
        reports.qualifying_diff_summary(set_diff),
        reports.qualifying_disagreements(set_diff),
        reports.group_size_summary(sizes, min_orders),
        reports.largest_groups(sizes, min_orders),
        reports.std_diff_summary(diffs),
        reports.largest_std_diffs(diffs),
    ]
    return dict(zip(SKU_MONTH_REPORTS, found, strict=True))


JOBS: dict[str, Callable[..., dict[str, int]]] = {
    "rolling-top-size": rolling_top_size,
    "median-variety": median_variety,
    "city-cancellation": city_cancellation,
    "sku-month-std": sku_month_std,
}

"""Named queries over a folder of star-schema tables.

Each query runs one operator over the whole ``sales`` view. Doubles are rounded
to four decimals, so that engines that add in another order agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.functions import dates, promos, text
from ordermill.operators import cancellation as cc
from ordermill.operators import dispersion as dp
from ordermill.operators import reports as rp
from ordermill.operators import rolling as rl
from ordermill.operators import variety as vr
from ordermill.sources import orders_csv, shared, sinks
from ordermill.sources.star import sales

Query = Callable[[SparkSession, str], DataFrame]

# The tables hold no group of more than 1,000 orders, so the size reports use a lower limit.
MIN_ORDERS = 10
COARSE_ACCURACY = 2

QUERIES: dict[str, Query] = {}

# Header names of the sales export, by canonical column.
EXPORT_HEADER = {
    "row_key": "Order ID",
    "status": "Status",
    "fulfilment": "Fulfilment",
    "service_level": "ship-service-level",
    "courier_status": "Courier Status",
    "qty": "Qty",
    "amount": "Amount",
    "size": "Size",
    "sku": "SKU",
    "style": "Style",
    "ship_city": "ship-city",
    "ship_state": "ship-state",
    "promotion_ids": "promotion-ids",
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


# Inputs of the four questions: only the columns each one reads.


def _purchase_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder, "row_key", "order_date", "status", "qty", "size", "ship_state")


def _item_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder, "row_key", "order_date", "size", "sku", "style", "ship_state")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return cc.prepare_orders(
        sales(
            spark, folder, "row_key", "order_date", "amount", "status", "fulfilment",
            "service_level", "courier_status", "ship_city", "ship_state", "promotion_ids",
        )
    )


def _sku_orders(spark: SparkSession, folder: str) -> DataFrame:
    return dp.prepare_sku_orders(
        sales(spark, folder, "row_key", "order_date", "sku", "amount", "promotion_ids")
    )


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return dp.promo_profile(_sku_orders(spark, folder))


def _settled_profile(spark: SparkSession, folder: str) -> DataFrame:
    return shared.settle(_profile(spark, folder), "promo-profile")


# Scans, text, dates


@query
def scan_csv_normalised(spark: SparkSession, folder: str) -> DataFrame:
    """Write the sales as CSV under the export's header, then scan that CSV.

    The date column mixes patterns, which the scan has to tell apart.
    """
    table = sales(spark, folder)
    path = shared.new_path(spark, "sales-csv")
    exported = table.select(
        _four_digit_date_text().alias("Date"),
        *[F.col(c).alias(h) for c, h in EXPORT_HEADER.items()],
    )
    exported.write.option("header", True).option("escape", '"').csv(path)
    scanned = orders_csv.type_orders(
        orders_csv.read_orders(spark, path), any_date_format=True
    )
    return _rounded(scanned, "amount").withColumn("promotion_ids", F.coalesce("promotion_ids", F.lit("")))


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder, "row_key", "order_date")
    written = table.select("row_key", _any_date_text().alias("date"))
    return written.select(
        "row_key",
        "date",
        dates.parse_any_date("date").alias("any_date"),
        dates.parse_sale_date("date").alias("sale_date"),
    )


@query
def month_key(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder, "row_key", "order_date")
    return table.select("row_key", dates.month_key("order_date").alias("month"))


@query
def normalise_state(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder, "row_key", "ship_city", "ship_state")
    spelled = (
        F.when(F.col("row_key") % 5 == 0, F.lit(" ORISSA"))
        .when(F.col("row_key") % 5 == 1, F.lit("rajsthan\t"))
        .otherwise(F.concat(F.lit(" "), "ship_state", F.lit("  &   "), "ship_city"))
    )
    return table.select("row_key", text.title_state(spelled).alias("state"))


def _four_digit_date_text() -> Column:
    key, day = F.col("row_key"), F.col("order_date")
    return (
        F.when(key % 3 == 0, F.date_format(day, "M/d/yyyy"))
        .when(key % 3 == 1, F.date_format(day, "MM-dd-yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def _any_date_text() -> Column:
    """Every accepted pattern in turn, an unknown one and an impossible day."""
    key, day = F.col("row_key"), F.col("order_date")
    patterns = [
        "M/d/yy", "M-d-yy", "MM-dd-yy", "MM-dd-yyyy", "yyyy-MM-dd", "M/d/yyyy", "MM/dd/yyyy",
        "yyyy/MM/dd",
    ]
    chosen = F.when(key % 9 == 8, F.lit("02-30-22"))
    for i, pattern in enumerate(patterns):
        chosen = chosen.when(key % 9 == i, F.date_format(day, pattern))
    return chosen


# Rolling top size


@query
def filter_shipped(spark: SparkSession, folder: str) -> DataFrame:
    return rl.shipped_purchases(_purchase_sales(spark, folder))


@query
def rolling_fanout(spark: SparkSession, folder: str) -> DataFrame:
    purchases = rl.shipped_purchases(_purchase_sales(spark, folder))
    return rl.rolling_fanout(rl.daily_size_qty(purchases))


@query
def rolling_size_qty(spark: SparkSession, folder: str) -> DataFrame:
    return rl.rolling_size_qty(_purchase_sales(spark, folder))


@query
def rolling_top_size(spark: SparkSession, folder: str) -> DataFrame:
    return rl.rolling_top_size(_purchase_sales(spark, folder))


@query
def rolling_top_size_window(spark: SparkSession, folder: str) -> DataFrame:
    return rl.top_size(rl.rolling_size_qty_event_time(_purchase_sales(spark, folder)))


@query
def write_csv_result(spark: SparkSession, folder: str) -> DataFrame:
    """The rolling top sizes written as bare CSV and read back."""
    path = shared.new_path(spark, "top-size-csv")
    sinks.write_csv(rolling_top_size(spark, folder), path, ["window_date", "state"])
    schema = "window_date date, state string, most_bought_size string"
    return spark.read.option("header", True).schema(schema).csv(path)


# Median variety


@query
def filter_size_class(spark: SparkSession, folder: str) -> DataFrame:
    return vr.sized_items(_item_sales(spark, folder))


@query
def distinct_style_skus(spark: SparkSession, folder: str) -> DataFrame:
    return vr.distinct_style_skus(vr.sized_items(_item_sales(spark, folder)))


@query
def variety_per_style(spark: SparkSession, folder: str) -> DataFrame:
    return vr.variety_per_style(vr.sized_items(_item_sales(spark, folder)))


@query
def median_variety(spark: SparkSession, folder: str) -> DataFrame:
    return vr.median_variety(_item_sales(spark, folder))


# City cancellation


@query
def prepare_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).withColumn("n_promos", F.size("promo_array"))
    return _rounded(orders.drop("promo_array"), "amount")


@query
def promo_arrays(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder, "row_key", "promotion_ids")
    array = promos.promo_array(_ragged_list())
    return table.select(
        "row_key", F.size(array).alias("n_promos"), F.array_join(array, "|").alias("promos")
    )


@query
def promo_count(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(spark, folder, "row_key", "promotion_ids")
    return table.select("row_key", promos.raw_promo_count(_ragged_list()).alias("promo_count"))


def _ragged_list() -> Column:
    """Promotion lists with blanks around ids and empty pieces in every fifth row."""
    listed = F.col("promotion_ids")
    return F.when(
        F.col("row_key") % 5 == 0, F.concat(F.replace(listed, F.lit(","), F.lit(" , ")), F.lit(", ,"))
    ).otherwise(listed)


@query
def promo_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cc.promo_rows(_orders(spark, folder))


@query
def promo_active_span(spark: SparkSession, folder: str) -> DataFrame:
    return cc.promo_active_span(_orders(spark, folder))


@query
def valid_promotions(spark: SparkSession, folder: str) -> DataFrame:
    return cc.valid_promotions(_orders(spark, folder))


def _valid(orders: DataFrame) -> DataFrame:
    """Valid promotions, settled so that a hot one can be split in joins."""
    return shared.settle(cc.valid_promotions(orders), "valid-promotions")


@query
def valid_promo_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return cc.valid_promo_rows(orders, _valid(orders))


@query
def valid_promo_rows_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same from stored promotion rows, with a Bloom filter where that pays."""
    return cc.stored_valid_promo_rows(_orders(spark, folder))


@query
def valid_promo_count(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return cc.valid_promo_count(orders, _valid(orders))


@query
def orders_with_promo_count(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    counts = cc.valid_promo_count(orders, _valid(orders))
    return cc.orders_with_promo_count(orders, counts).select(
        "row_key", "ship_city", "ship_state", "valid_promotion_count"
    )


@query
def state_avg_amount(spark: SparkSession, folder: str) -> DataFrame:
    averages = cc.state_avg_amount(_orders(spark, folder))
    return _rounded(averages, "state_avg_merchant_shipped_amount")


def _averages(orders: DataFrame) -> DataFrame:
    """State averages, settled so that the planner knows their size."""
    return shared.settle(cc.state_avg_amount(orders), "state-averages")


@query
def orders_with_state_avg(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    joined = cc.orders_with_state_avg(orders, _averages(orders)).select(
        "row_key", "ship_state", "amount", "state_avg_merchant_shipped_amount"
    )
    return _rounded(joined, "amount", "state_avg_merchant_shipped_amount")


def _qualified(orders: DataFrame) -> DataFrame:
    return cc.qualified_orders(orders, _valid(orders), _averages(orders))


@query
def qualified_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = _qualified(_orders(spark, folder)).select(
        "row_key", "ship_city", "ship_state", "status", "amount",
        "valid_promotion_count", "state_avg_merchant_shipped_amount",
    )
    return _rounded(rows, "amount", "state_avg_merchant_shipped_amount")


@query
def city_cancellation(spark: SparkSession, folder: str) -> DataFrame:
    """The final table; its narrow orders are written once and read three times."""
    orders = shared.settle(_orders(spark, folder).drop("row_key", "promo_array"), "orders")
    result = cc.city_cancellation(orders, _valid(orders), _averages(orders))
    return _rounded(result, "state_avg_merchant_shipped_amount")


@query
def city_cancellation_by_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The same table through the order-level operators, keyed by the order."""
    result = cc.cancellation_by_city(_qualified(_orders(spark, folder)))
    return _rounded(result, "state_avg_merchant_shipped_amount")


@query
def city_cancellation_generated_key(spark: SparkSession, folder: str) -> DataFrame:
    """The same table through the order-level operators, keyed by generated ids."""
    orders = cc.with_row_key(_orders(spark, folder).drop("row_key"))
    result = cc.cancellation_by_city(_qualified(orders))
    return _rounded(result, "state_avg_merchant_shipped_amount")


@query
def clean_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = sales(
        spark, folder, "order_date", "amount", "ship_city", "ship_state", "sku"
    )
    return rp.clean_counts(table, cc.valid_promotions(_orders(spark, folder)))


# Deviation per SKU and month


@query
def prepare_sku_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_sku_orders(spark, folder), "amount")


@query
def promo_profile(spark: SparkSession, folder: str) -> DataFrame:
    # The total is exact to the cent, whereas a mean can lie half-way between two roundings.
    total = F.round(F.col("amount_mean") * F.col("n_orders"), 2)
    profile = _profile(spark, folder).withColumn("amount_total", total)
    return profile.drop("amount_mean", "amount_var")


@query
def promo_cume_dist(spark: SparkSession, folder: str) -> DataFrame:
    shares = dp.promo_cume_dist(_sku_orders(spark, folder))
    return _rounded(shares.drop("amount"), "cume_dist")


@query
def thresholds_exact(spark: SparkSession, folder: str) -> DataFrame:
    return dp.thresholds_exact(_profile(spark, folder))


@query
def thresholds_exact_by_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dp.thresholds_exact_by_rows(dp.promo_cume_dist(_sku_orders(spark, folder)))


@query
def thresholds_approx(spark: SparkSession, folder: str) -> DataFrame:
    return dp.thresholds_approx(_profile(spark, folder))


@query
def thresholds_approx_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return dp.thresholds_approx(_profile(spark, folder), accuracy=COARSE_ACCURACY)


@query
def orders_with_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    orders = _sku_orders(spark, folder)
    return dp.orders_with_thresholds(orders, _thresholds(orders)).drop("amount")


@query
def qualifying_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _qualifying_p90(spark, folder).drop("amount")


def _qualifying_p90(spark: SparkSession, folder: str) -> DataFrame:
    orders = _sku_orders(spark, folder)
    return dp.qualifying_orders(orders, _thresholds(orders), "p90_thresh_exact")


def _thresholds(orders: DataFrame) -> DataFrame:
    """Exact thresholds, settled so that a hot group can be split in joins."""
    return shared.settle(dp.thresholds_exact(dp.promo_profile(orders)), "thresholds")


@query
def sku_month_spine(spark: SparkSession, folder: str) -> DataFrame:
    return dp.sku_month_spine(_sku_orders(spark, folder))


@query
def spine_left_join(spark: SparkSession, folder: str) -> DataFrame:
    profile = _settled_profile(spark, folder)
    spine = dp.sku_month_spine(profile)
    counts = dp.qualifying_counts(
        profile, dp.thresholds_exact(profile), "p90_thresh_exact", "cnt_p90_exact")
    stds = counts.join(dp.sku_month_std_exact(profile).drop("std_p80_exact"), dp.GROUP)
    return _rounded(dp.spine_left_join(spine, stds, "std_p90_exact"), "std_p90_exact")


@query
def sku_month_std_exact(spark: SparkSession, folder: str) -> DataFrame:
    stds = dp.sku_month_std_exact(_profile(spark, folder))
    return _rounded(stds, "std_p90_exact", "std_p80_exact")


@query
def sku_month_std_approx(spark: SparkSession, folder: str) -> DataFrame:
    stds = dp.sku_month_std_approx(_settled_profile(spark, folder))
    return _rounded(stds, "std_p90_approx", "std_p80_approx")


@query
def sku_month_std(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        dp.sku_month_std(_settled_profile(spark, folder)),
        "std_p90_approx", "std_p80_approx", "std_p90_exact", "std_p80_exact",
    )


@query
def write_parquet_result(spark: SparkSession, folder: str) -> DataFrame:
    """The deviation table written as sorted parquet and read back."""
    path = shared.new_path(spark, "sku-month-std")
    sinks.write_parquet(sku_month_std(spark, folder), path, ["year", "month", "SKU"])
    return spark.read.parquet(path)


# Reports


def _compare(spark: SparkSession, folder: str, accuracy: int = dp.ACCURACY) -> DataFrame:
    profile = _settled_profile(spark, folder)
    return rp.threshold_compare(
        dp.thresholds_approx(profile, accuracy=accuracy), dp.thresholds_exact(profile)
    )


@query
def threshold_compare(spark: SparkSession, folder: str) -> DataFrame:
    return _compare(spark, folder)


@query
def threshold_diff_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rp.threshold_diff_summary(_compare(spark, folder))


@query
def threshold_diff_summary_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return rp.threshold_diff_summary(_compare(spark, folder, COARSE_ACCURACY))


@query
def threshold_disagreements(spark: SparkSession, folder: str) -> DataFrame:
    return rp.threshold_disagreements(_compare(spark, folder))


@query
def threshold_disagreements_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return rp.threshold_disagreements(_compare(spark, folder, COARSE_ACCURACY))


def _set_diff(spark: SparkSession, folder: str, accuracy: int = dp.ACCURACY) -> DataFrame:
    profile = _settled_profile(spark, folder)
    approx = dp.qualifying_counts(
        profile, dp.thresholds_approx(profile, accuracy=accuracy), "p90_thresh", "n_qualified_approx"
    )
    exact = dp.qualifying_counts(
        profile, dp.thresholds_exact(profile), "p90_thresh_exact", "n_qualified_exact"
    )
    return rp.qualifying_set_diff(approx, exact)


@query
def qualifying_set_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _set_diff(spark, folder)


@query
def qualifying_diff_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rp.qualifying_diff_summary(_set_diff(spark, folder))


@query
def qualifying_diff_summary_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return rp.qualifying_diff_summary(_set_diff(spark, folder, COARSE_ACCURACY))


@query
def qualifying_disagreements(spark: SparkSession, folder: str) -> DataFrame:
    return rp.qualifying_disagreements(_set_diff(spark, folder))


@query
def qualifying_disagreements_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return rp.qualifying_disagreements(_set_diff(spark, folder, COARSE_ACCURACY))


@query
def sku_month_sizes(spark: SparkSession, folder: str) -> DataFrame:
    sizes = rp.sku_month_sizes(_sku_orders(spark, folder))
    return _rounded(sizes, "est_size_mb")


@query
def largest_groups(spark: SparkSession, folder: str) -> DataFrame:
    sizes = rp.sku_month_sizes(_sku_orders(spark, folder))
    return _rounded(rp.largest_groups(sizes, MIN_ORDERS), "est_size_mb")


@query
def group_size_summary(spark: SparkSession, folder: str) -> DataFrame:
    sizes = rp.sku_month_sizes(_sku_orders(spark, folder))
    summary = rp.group_size_summary(sizes, MIN_ORDERS)
    return summary.withColumns({c: F.round(c, 8) for c in ("max_size_mb", "partition_ratio")})


def _std_diff(spark: SparkSession, folder: str, accuracy: int = dp.ACCURACY) -> DataFrame:
    return rp.std_diff(dp.sku_month_std(_settled_profile(spark, folder), accuracy=accuracy))


_STDS = ["std_p90_approx", "std_p80_approx", "std_p90_exact", "std_p80_exact",
         "diff_std_p90", "diff_std_p80"]


@query
def std_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_std_diff(spark, folder), *_STDS)


@query
def std_diff_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rp.std_diff_summary(_std_diff(spark, folder))


@query
def std_diff_summary_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return rp.std_diff_summary(_std_diff(spark, folder, COARSE_ACCURACY))


@query
def largest_std_diffs(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rp.largest_std_diffs(_std_diff(spark, folder)), *_STDS)


@query
def largest_std_diffs_coarse(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rp.largest_std_diffs(_std_diff(spark, folder, COARSE_ACCURACY)), *_STDS)

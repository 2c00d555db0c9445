"""Named queries over stored summaries, kept-up tables, streams and whole jobs.

Each gives the rows of a question by another mechanism than ``catalog``, or what
a job reports beside its result, over whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.operators import bitmaps as bm
from ordermill.operators import dispersion as dp
from ordermill.operators import heavy as hv
from ordermill.operators import reports as rp
from ordermill.operators import sketches as sk
from ordermill.operators import variety as vr
from ordermill.operators.rolling_store import RollingStore
from ordermill.plans.catalog import COARSE_ACCURACY, MIN_ORDERS, Query
from ordermill.plans.jobs import JOBS
from ordermill.sources import orders_csv, rejects
from ordermill.sources.shared import new_path, settle
from ordermill.sources.star import sales
from ordermill.sources.stored import Stored
from ordermill.streaming.rolling import RollingStream

QUERIES: dict[str, Query] = {}

# A sketch of so few values is not exact for a SKU's orders of all time.
SMALL_K = 100
BUCKETS = 8


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Percentiles from stored sketches


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    return sk.dated_orders(sales(spark, folder, "order_date", "sku", "amount", "promotion_ids"))


@query
def thresholds_percentile_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles by Spark's own summary of order rows."""
    orders = sales(spark, folder, "row_key", "order_date", "sku", "amount", "promotion_ids")
    return sk.thresholds_percentile_approx(dp.prepare_sku_orders(orders))


@query
def thresholds_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Exact and sketched percentiles by SKU and month, the latter from stored daily sketches."""
    orders = _dated_orders(spark, folder)
    daily = settle(sk.daily_sketches(orders), "daily-sketches")
    thresholds = sk.thresholds_sketch(sk.merged_sketches(daily, *dp.GROUP))
    errors = sk.rank_errors(sk.count_profile(orders, *dp.GROUP), thresholds)
    return errors.drop("p90_rank_error", "p80_rank_error")


@query
def thresholds_sketch_by_sku(spark: SparkSession, folder: str) -> DataFrame:
    """The same over all time by SKU, from small sketches that are not exact.

    The sketched values are left out: they are random within the bound.
    """
    orders = _dated_orders(spark, folder)
    daily = settle(sk.daily_sketches(orders, SMALL_K), "daily-sketches")
    thresholds = sk.thresholds_sketch(sk.merged_sketches(daily, "sku"))
    errors = sk.rank_errors(sk.count_profile(orders, "sku"), thresholds, SMALL_K)
    return errors.select(
        "sku", "n_orders", "p90_thresh_exact", "p80_thresh_exact", "p90_within", "p80_within")


# Rolling windows kept up to date, and as a stream

_PURCHASE_COLUMNS = ["order_date", "status", "qty", "size", "ship_state"]


def _span(rows: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    """First, middle and last day."""
    days = F.unix_date("order_date")
    middle = F.date_from_unix_date(F.percentile_approx(days, F.lit(0.5)))
    r = rows.agg(F.min("order_date").alias("a"), middle.alias("b"), F.max("order_date").alias("c"))
    return tuple(r.first())


@query
def rolling_top_size_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A base load, then the last day, then a middle day that arrives late."""
    rows = sales(spark, folder, *_PURCHASE_COLUMNS)
    _, late, last = _span(rows)
    day = F.col("order_date")
    store = RollingStore(spark, new_path(spark, "rolling-store"))
    store.load(rows.filter((day != late) & (day != last)))
    store.add(rows.filter(day == last), str(last))
    store.add(rows.filter(day == late), str(late))
    return store.top_size()


@query
def rolling_top_size_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals of files, each worked off by a run of the stream, then the end of time."""
    rows = sales(spark, folder, *_PURCHASE_COLUMNS)
    _, middle, last = _span(rows)
    inbox = new_path(spark, "inbox")
    stream = RollingStream(spark, inbox, new_path(spark, "rolling-stream"))
    for arrival in (F.col("order_date") <= middle, F.col("order_date") > middle):
        rows.filter(arrival).write.mode("append").parquet(inbox)
        stream.run()
    stream.close(last)
    return stream.top_size()


# Largest groups by a summary


@query
def largest_groups_by_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``largest_groups``, exact counts for candidates only."""
    orders = dp.prepare_sku_orders(sales(spark, folder, "order_date", "sku", "amount", "promotion_ids"))
    largest = hv.largest_groups_by_summary(orders, MIN_ORDERS)
    return largest.withColumn("est_size_mb", F.round("est_size_mb", 4))


# Distinct counts that roll up


def _bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    items = vr.sized_items(sales(spark, folder, "order_date", "size", "sku", "style", "ship_state"))
    return settle(bm.variety_bitmaps(items, bm.sku_dictionary(items)), "variety-bitmaps")


@query
def variety_by_month_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct SKUs per month, state and style from stored bitmaps."""
    return bm.variety(_bitmaps(spark, folder), "month", "state", "style")


@query
def variety_by_year_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct SKUs per year and state, from the months' bitmaps."""
    return bm.variety(_bitmaps(spark, folder), "year", "state")


@query
def median_variety_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Median over styles of a year's distinct SKUs, from the months' bitmaps."""
    return bm.median_variety_by(_bitmaps(spark, folder), "year", "state")


# Joins on a stored layout


def _stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    orders = dp.prepare_sku_orders(sales(spark, folder, "order_date", "sku", "amount", "promotion_ids"))
    return Stored(dp.promo_profile(orders), dp.GROUP, BUCKETS, "promo-profile").table()


@query
def threshold_compare_stored(spark: SparkSession, folder: str) -> DataFrame:
    """``threshold_compare`` on a profile stored in buckets: no shuffle."""
    profile = _stored_profile(spark, folder)
    return rp.threshold_compare(
        dp.thresholds_approx(profile, accuracy=COARSE_ACCURACY), dp.thresholds_exact(profile))


@query
def qualifying_set_diff_stored(spark: SparkSession, folder: str) -> DataFrame:
    """``qualifying_set_diff`` on a profile stored in buckets: no shuffle."""
    profile = _stored_profile(spark, folder)
    approx = dp.thresholds_approx(profile, accuracy=COARSE_ACCURACY)
    return rp.qualifying_set_diff(
        dp.qualifying_counts(profile, approx, "p90_thresh", "n_qualified_approx"),
        dp.qualifying_counts(
            profile, dp.thresholds_exact(profile), "p90_thresh_exact", "n_qualified_exact"))


# Whole jobs on an export with faults

_HEADER = ("Order ID,Date,Status,Fulfilment,ship-service-level,Courier Status,Qty,Amount,Size,SKU,"
           "Style,ship-city,ship-state,promotion-ids")


def _faulty_export(spark: SparkSession, folder: str) -> str:
    """Path of the sales as CSV lines, of which six in thirteen have a fault each.

    Cut off after the size, the 30th of February, no date, a blank size, blanks
    around size and state, an unreadable quantity.
    """
    key = F.col("row_key") % 13

    def faulty(fault: int, value: Column, otherwise: Column) -> Column:
        return F.when(key == fault, value).otherwise(otherwise)

    date = F.date_format("order_date", "MM-dd-yy")
    date = faulty(1, F.concat(F.lit("02-30-"), F.date_format("order_date", "yy")), date)
    start = [
        F.col("row_key").cast("string"), faulty(2, F.lit("n/a"), date), F.col("status"),
        F.col("fulfilment"), F.col("service_level"), F.col("courier_status"),
        faulty(5, F.lit("x"), F.col("qty").cast("string")), F.col("amount").cast("string"),
        faulty(3, F.lit("  "), faulty(4, F.concat(F.lit("\t"), "size", F.lit("  ")), F.col("size"))),
    ]
    end = [
        F.col("sku"), F.col("style"), F.col("ship_city"),
        faulty(4, F.concat(F.lit("  "), "ship_state", F.lit("\t")), F.col("ship_state")),
        F.concat(F.lit('"'), "promotion_ids", F.lit('"')),
    ]
    line = faulty(0, F.concat_ws(",", *start), F.concat_ws(",", *start, *end))
    path = new_path(spark, "faulty-export")
    (
        sales(spark, folder).select(line.alias(_HEADER))
        .write.option("header", True).option("sep", "\u0001").option("quote", "\u0000")
        .option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


@query
def scan_csv_padded(spark: SparkSession, folder: str) -> DataFrame:
    """The export scanned with trimming and days read as the month's last, as the two CSV jobs do."""
    columns = ["date", "status", "qty", "size", "sku", "style", "ship_state"]
    raw = orders_csv.read_orders(spark, _faulty_export(spark, folder), columns, trim=True)
    return orders_csv.type_orders(raw, clamp=True)


@query
def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the export by question and reason not to use them."""
    path = _faulty_export(spark, folder)
    questions = {
        "rolling-top-size": (
            ["date", "status", "qty", "size", "ship_state"], rejects.purchase_rules()),
        "median-variety": (["date", "sku", "style", "size", "ship_state"], rejects.item_rules()),
    }
    found = [
        rejects.counts_by_reason(
            rejects.with_reason(rejects.read_with_raw_lines(spark, path, columns), rules)
        ).select(F.lit(question).alias("question"), "reason", "n_lines")
        for question, (columns, rules) in questions.items()
    ]
    return found[0].unionByName(found[1])


@query
def job_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the four jobs count while they run on the export."""
    source = _faulty_export(spark, folder)
    rows = [
        (job, point, n)
        for job, run in JOBS.items()
        for point, n in run(spark, source, new_path(spark, job)).items()
    ]
    return spark.createDataFrame(rows, "job string, point string, n_rows long")

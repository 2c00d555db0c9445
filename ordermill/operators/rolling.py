"""Best-selling size per state over a rolling window of days.

A window dated *d* covers the ``days`` days before *d*, *d* itself excluded. A
window exists when at least one purchase falls inside it, so dates run up to
``days`` past the last order. A RANGE window frame would be wrong here: it
yields only dates that have an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordermill.functions.text import is_present, upper_stripped


def is_purchase() -> Column:
    """Whether a row counts as a purchase.

    Any status that contains "shipped" counts, so "Unshipped" does as well.
    """
    return (
        F.lower("status").contains("shipped")
        & (F.col("qty") > 0)
        & is_present("size")
        & is_present("ship_state")
        & F.col("order_date").isNotNull()
    )


def shipped_purchases(sales: DataFrame) -> DataFrame:
    """Rows that count as a purchase, with state and size in upper case."""
    kept = sales.filter(is_purchase())
    key = [c for c in ("row_key",) if c in sales.columns]
    return kept.select(
        *key,
        "order_date",
        upper_stripped("ship_state").alias("state"),
        upper_stripped("size").alias("size"),
        "qty",
    )


def daily_size_qty(purchases: DataFrame) -> DataFrame:
    """Units per day, state and size.

    Summing days before the fan-out keeps the fan-out off the raw rows. From
    here on the data has at most days x states x sizes rows, whatever share of
    the input one state or size holds.
    """
    return purchases.groupBy("order_date", "state", "size").agg(F.sum("qty").alias("qty"))


def rolling_fanout(daily: DataFrame, days: int = 7) -> DataFrame:
    """Copy each day's units to the window dates 1 to ``days`` days later."""
    dates = F.sequence(F.date_add("order_date", 1), F.date_add("order_date", days))
    return daily.select(
        F.explode(dates).alias("window_date"), "order_date", "state", "size", "qty"
    )


def rolling_size_qty(sales: DataFrame, days: int = 7) -> DataFrame:
    """Units per window date, state and size."""
    daily = daily_size_qty(shipped_purchases(sales))
    return sum_windows(rolling_fanout(daily, days))


def rolling_size_qty_event_time(sales: DataFrame, days: int = 7) -> DataFrame:
    """``rolling_size_qty`` through the event-time window function.

    The window function puts day D into the windows that end on D+1 to D+days,
    which are the same window dates. Timestamps without a zone keep the result
    independent of the session's time zone.
    """
    daily = daily_size_qty(shipped_purchases(sales))
    window = F.window(F.col("order_date").cast("timestamp_ntz"), f"{days} days", "1 day")
    windowed = daily.select(
        window.alias("covers"), "state", "size", "qty"
    ).select(F.col("covers.end").cast("date").alias("window_date"), "state", "size", "qty")
    return sum_windows(windowed)


def top_size(size_qty: DataFrame) -> DataFrame:
    """Size with most units per window date and state; ties go to the smallest text."""
    rank = F.struct((-F.col("qty")).alias("rank"), F.col("size").alias("size"))
    return size_qty.groupBy("window_date", "state").agg(
        F.min_by("size", rank).alias("most_bought_size")
    )


def rolling_top_size(sales: DataFrame, days: int = 7) -> DataFrame:
    """Most bought size per window date and state."""
    return top_size(rolling_size_qty(sales, days))


def sum_windows(windowed: DataFrame) -> DataFrame:
    """Units per window date, state and size of days already dealt to windows."""
    return windowed.groupBy("window_date", "state", "size").agg(F.sum("qty").alias("qty"))

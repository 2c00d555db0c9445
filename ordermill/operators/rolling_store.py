"""Rolling top sizes that are kept up to date day by day.

Two stored tables:

* ``daily``: units per day, state and size, partitioned by month and batch. A
  batch replaces its own partitions only, so it may be run again after a failure
  and rows that arrive late for an old day are a further batch of that month.
* ``windows``: the most bought size per window date and state, partitioned by
  window date.

A batch that brings day D changes the windows D+1 to D+7 alone. These are taken
anew from the at most 13 days of sums they cover, of one or two months; all
other partitions are neither read nor written. New orders are read once, old
ones never. The first load writes all partitions from its tasks at once.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.operators import rolling as rl
from ordermill.sources.shared import settle

_DAILY = "month date, batch string, order_date date, state string, size string, qty long"
_WINDOWS = "window_date date, state string, most_bought_size string"


def _any_of(column: str, days: list[dt.date]) -> Column:
    """Whether a column is one of these days, as ranges of days in a row."""
    runs: list[list[dt.date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] == dt.timedelta(1):
            runs[-1][1] = day
        else:
            runs.append([day, day])
    tests = [F.col(column).between(F.lit(first), F.lit(last)) for first, last in runs]
    return reduce(Column.__or__, tests, F.lit(False))


class RollingStore:
    """The two tables under one folder all executors reach.

    >>> store = RollingStore(spark, folder)
    >>> store.load(sales)
    >>> store.add(new_sales, "2022-05-01")
    >>> store.top_size()
    """

    def __init__(self, spark: SparkSession, folder: str, days: int = 7) -> None:
        self._spark = spark
        self._daily = f"{folder.rstrip('/')}/daily"
        self._windows = f"{folder.rstrip('/')}/windows"
        self._days = days

    def load(self, sales: DataFrame) -> None:
        """Start the store anew with these sales; what it held is replaced."""
        self._write(self._summed(sales, "base"), self._daily, "static", "month", "batch")
        self._write(rl.top_size(rl.sum_windows(rl.rolling_fanout(self.daily(), self._days))),
                    self._windows, "static", "window_date")

    def add(self, sales: DataFrame, batch: str) -> list[dt.date]:
        """Add a batch of sales and renew the windows it changes; returns their dates.

        The batch's days, one entry a day of the calendar, come to the driver. A
        batch with the name of an earlier one replaces that one's months.
        """
        if not re.fullmatch(r"[\w-]+", batch) or batch == "base":
            raise ValueError(f"batch name '{batch}' is taken or has other signs than letters, digits, _ and -")
        summed = settle(self._summed(sales, batch), "new-days")
        new = [r.order_date for r in summed.select("order_date").distinct().collect()]
        if not new:
            return []
        self._write(summed, self._daily, "dynamic", "month", "batch")
        touched = sorted(
            {day + dt.timedelta(n) for day in new for n in range(1, self._days + 1)})
        self._write(self.windows_anew(touched), self._windows, "dynamic", "window_date")
        return touched

    def _summed(self, sales: DataFrame, batch: str) -> DataFrame:
        daily = rl.daily_size_qty(rl.shipped_purchases(sales))
        return daily.withColumns(
            {"month": F.trunc("order_date", "month"), "batch": F.lit(batch)})

    def windows_anew(self, dates: list[dt.date]) -> DataFrame:
        """Most bought sizes of these window dates, from the days they cover alone."""
        covered = sorted({d - dt.timedelta(n) for d in dates for n in range(1, self._days + 1)})
        months = sorted({d.replace(day=1) for d in covered})
        daily = self.daily().filter(
            F.col("month").isin(months) & _any_of("order_date", covered))
        fanned = rl.rolling_fanout(daily, self._days).filter(_any_of("window_date", dates))
        return rl.top_size(rl.sum_windows(fanned))

    def daily(self) -> DataFrame:
        """Units per day, batch, state and size."""
        return self._spark.read.schema(_DAILY).parquet(self._daily)

    def top_size(self) -> DataFrame:
        """Most bought size per window date and state."""
        return self._spark.read.schema(_WINDOWS).parquet(self._windows).select(
            "window_date", "state", "most_bought_size")

    def _write(self, rows: DataFrame, path: str, overwritten: str, *partitions: str) -> None:
        """Overwrite all partitions (static) or those of ``rows`` (dynamic), one file each.

        A whole load is renamed file by file by its tasks; it can be run again if
        it fails half-way. Single partitions are replaced when all are written.
        """
        # A number given here keeps its tasks: small data would else be one task's files.
        tasks = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        (
            rows.repartition(tasks, *partitions)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", overwritten)
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .partitionBy(*partitions)
            .parquet(path)
        )

"""Best-selling size per state and rolling window, as a stream.

Sales files arrive in an inbox folder. Units are summed per window, state and
size in keyed state, then the size with most units is taken per window and state
by a second stateful step; a window is written once, when the watermark (the
latest day seen less ``delay_days``) has passed its end. Orders that come later
than that are dropped by Spark and counted in the progress.

Each call works off what has arrived and ends; the checkpoint in the target
folder says where to go on, after a lost executor or driver too, and the file
sink writes every window exactly once. State holds the open windows only: days x
states x sizes of ``days`` + ``delay_days`` days, whatever the number of orders.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.text import upper_stripped
from ordermill.operators.rolling import is_purchase

SCHEMA = "order_date date, status string, qty int, size string, ship_state string"
_DAY = 86_400


class Progress(NamedTuple):
    """What one call has read, and the late sums it dropped.

    Orders are added up per window, state and size before they meet the state,
    so ``late`` counts such sums; an order late for all its windows is in up to
    ``days`` of them.
    """

    rows: int
    late: int


def _midnight(day: Column) -> Column:
    """The day's first moment in UTC, whatever the session's time zone."""
    return F.timestamp_seconds(F.unix_date(day).cast("long") * _DAY)


def _day(moment: Column) -> Column:
    return F.date_from_unix_date((F.unix_seconds(moment) / _DAY).cast("int"))


def rolling_top_size(sales: DataFrame, days: int = 7, delay_days: int = 1) -> DataFrame:
    """Most bought size per window date and state, of a stream of sales.

    Every row with a date moves time on, also one that is no purchase. A filter
    would be applied before the watermark is taken, so rows that are no purchase
    stay in, without state, size and units, until the sums are taken.
    """
    timed = sales.withColumn("at", _midnight(F.col("order_date"))).withWatermark(
        "at", f"{delay_days} days")

    def of_purchases(value: Column) -> Column:
        return F.when(is_purchase(), value)

    summed = timed.groupBy(
        F.window("at", f"{days} days", "1 day").alias("covers"),
        of_purchases(upper_stripped("ship_state")).alias("state"),
        of_purchases(upper_stripped("size")).alias("size"),
    ).agg(F.sum(of_purchases(F.col("qty"))).alias("qty")).filter("qty > 0")
    rank = F.struct((-F.col("qty")).alias("rank"), F.col("size").alias("size"))
    top = summed.groupBy("covers", "state").agg(F.min_by("size", rank).alias("most_bought_size"))
    return top.select(
        _day(F.col("covers.end")).alias("window_date"), "state", "most_bought_size")


class RollingStream:
    """A stream from ``inbox`` to ``target``, one call at a time.

    >>> stream = RollingStream(spark, inbox, target)
    >>> stream.run()            # reads the files that have arrived since
    >>> stream.top_size()       # windows that are closed
    """

    def __init__(
        self, spark: SparkSession, inbox: str, target: str, days: int = 7, delay_days: int = 1
    ) -> None:
        self._spark = spark
        self._inbox = inbox
        self._result = f"{target.rstrip('/')}/windows"
        self._checkpoint = f"{target.rstrip('/')}/checkpoint"
        self._days = days
        self._delay = delay_days

    def run(self) -> Progress:
        """Work off all files that have arrived, and close the windows whose time is over."""
        sales = self._spark.readStream.schema(SCHEMA).parquet(self._inbox)
        query = (
            rolling_top_size(sales, self._days, self._delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", self._result)
            .option("checkpointLocation", self._checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return _progress(query)

    def tick(self, day: dt.date) -> None:
        """Put a row into the inbox that says time has reached ``day``."""
        row = self._spark.range(1).select(
            F.lit(day).cast("date").alias("order_date"),
            *[
                F.lit(None).cast(kind).alias(name)
                for name, kind in (c.split() for c in SCHEMA.split(", ")[1:])
            ],
        )
        row.write.mode("append").parquet(self._inbox)

    def close(self, last_day: dt.date) -> Progress:
        """Close every window of orders up to ``last_day``."""
        self.tick(last_day + dt.timedelta(self._days + self._delay + 1))
        return self.run()

    def top_size(self) -> DataFrame:
        """The closed windows, as a batch table."""
        schema = "window_date date, state string, most_bought_size string"
        return self._spark.read.schema(schema).parquet(self._result)


def _progress(query: StreamingQuery) -> Progress:
    """Sums over the micro-batches Spark keeps (100 of one call, by its own setting)."""
    steps = query.recentProgress
    return Progress(
        sum(step.numInputRows for step in steps),
        sum(op.numRowsDroppedByWatermark for step in steps for op in step.stateOperators[-1:]),
    )

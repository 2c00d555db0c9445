"""What queries really did, from Spark's own event log.

Spark writes one JSON line per event when ``spark.eventLog.enabled`` is set. The
log is read as a table: tasks give shuffle, rows and the largest task by stage,
and the last plan of a query is the one that ran, after all run-time changes.
Queries are told apart by their job description (``describe``).
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed names: fields of the log's events that are read here.
_SCHEMA = """
    `Event` string,
    `Stage ID` int,
    `Stage IDs` array<int>,
    `Properties` map<string,string>,
    `executionId` long, `description` string, `physicalPlanDescription` string,
    `Task End Reason` struct<`Reason`: string>,
    `Task Info` struct<`Launch Time`: long, `Finish Time`: long>,
    `Task Metrics` struct<
        `Executor Run Time`: long, `Memory Bytes Spilled`: long,
        `Input Metrics`: struct<`Records Read`: long>,
        `Output Metrics`: struct<`Records Written`: long>,
        `Shuffle Read Metrics`: struct<
            `Remote Bytes Read`: long, `Local Bytes Read`: long, `Total Records Read`: long>,
        `Shuffle Write Metrics`: struct<
            `Shuffle Bytes Written`: long, `Shuffle Records Written`: long>>
"""
_DESCRIPTION = "spark.job.description"


@contextlib.contextmanager
def described(spark: SparkSession, label: str) -> Iterator[str]:
    """Give the queries run inside a description of their own, found again in the log."""
    name = f"{label} {uuid.uuid4().hex}"
    spark.sparkContext.setJobDescription(name)
    try:
        yield name
    finally:
        spark.sparkContext.setJobDescription(None)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Events of one log file or folder, running applications included.

    The last line of a log that is still written may be cut off; it is left out.
    """
    event = F.from_json("value", _SCHEMA, {"mode": "PERMISSIVE"})
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.select(event.alias("e")).select("e.*").filter(F.col("Event").isNotNull())


def stage_report(events: DataFrame, description: str | None = None) -> DataFrame:
    """One row a stage: tasks, time, rows, shuffle, spill, and how uneven the tasks are.

    ``rows_in`` counts rows read from files and shuffles, ``skew`` is the largest
    task's share of the stage's rows times the number of tasks (1: all alike).
    Only successful tasks count, so a task run twice counts once.
    """
    tasks = events.filter(
        (F.col("Event") == "SparkListenerTaskEnd")
        & (F.col("`Task End Reason`.Reason") == "Success"))
    if description is not None:
        stages = events.filter(
            (F.col("Event") == "SparkListenerJobStart")
            & (F.col("Properties")[_DESCRIPTION] == description)
        ).select(F.explode("Stage IDs").alias("Stage ID")).distinct()
        tasks = tasks.join(stages, "Stage ID", "left_semi")

    def metric(*path: str) -> Column:
        return F.coalesce(F.col("`Task Metrics`." + ".".join(f"`{p}`" for p in path)), F.lit(0))

    measured = tasks.select(
        F.col("Stage ID").alias("stage"),
        metric("Executor Run Time").alias("ms"),
        (metric("Input Metrics", "Records Read")
         + metric("Shuffle Read Metrics", "Total Records Read")).alias("rows"),
        (metric("Shuffle Read Metrics", "Remote Bytes Read")
         + metric("Shuffle Read Metrics", "Local Bytes Read")).alias("read"),
        metric("Shuffle Write Metrics", "Shuffle Bytes Written").alias("written"),
        metric("Memory Bytes Spilled").alias("spilled"),
    )
    return measured.groupBy("stage").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum("ms").alias("task_ms"),
        F.max("ms").alias("longest_task_ms"),
        F.sum("rows").alias("rows_in"),
        F.max("rows").alias("largest_task_rows"),
        F.sum("read").alias("shuffle_bytes_read"),
        F.sum("written").alias("shuffle_bytes_written"),
        F.sum("spilled").alias("spilled_bytes"),
        F.coalesce(
            F.round(F.try_divide(F.max("rows") * F.count(F.lit(1)), F.sum("rows")), 2), F.lit(1.0)
        ).alias("skew"),
    )


def executed_plans(events: DataFrame, description: str) -> list[str]:
    """Texts of the final plans of the queries run under a description, in order.

    One text a query comes to the driver.
    """
    starts = events.filter(
        F.col("Event").endswith("SparkListenerSQLExecutionStart")
        & (F.col("description") == description)
    ).select("executionId")
    plans = events.filter(F.col("physicalPlanDescription").isNotNull()).withColumn(
        "updated", F.col("Event").endswith("SparkListenerSQLAdaptiveExecutionUpdate"))
    # An update with the final plan comes last; plans without run-time changes have none.
    place = F.struct("updated", F.col("physicalPlanDescription").contains("isFinalPlan=true"))
    last = (
        plans.join(starts, "executionId", "left_semi")
        .groupBy("executionId")
        .agg(F.max_by("physicalPlanDescription", place).alias("plan"))
        .orderBy("executionId")
    )
    return [r.plan for r in last.collect()]

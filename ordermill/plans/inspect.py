"""Plan and timing facts of a query, for reports and the bench."""

from __future__ import annotations

import contextlib
import io
import re
import statistics
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Join operators looked for in a plan.
JOIN_STRATEGIES = (
    "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
    "BroadcastNestedLoopJoin", "CartesianProduct",
)


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``explain`` prints; after an action, the plan that really ran."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue().split("== Initial Plan ==")[0]


def plan_report(df: DataFrame) -> dict[str, object]:
    """``plan_facts`` of a query: of the plan that ran if rows were collected before."""
    return plan_facts(plan_text(df))


def plan_facts(text: str) -> dict[str, object]:
    """Join strategies and number of shuffles (broadcasts not counted) in a plan's text."""
    text = text.split("== Initial Plan ==")[0]
    return {
        "joins": [s for s in JOIN_STRATEGIES if s in text],
        "exchanges": len(re.findall(r"\bExchange\b", text)),
    }


def run_to_nowhere(df: DataFrame) -> None:
    """Run the whole query and drop its rows. Unlike a count, nothing is pruned."""
    df.write.format("noop").mode("overwrite").save()


def stage_ids(spark: SparkSession, action: Callable[[], object]) -> list[int]:
    """Ids of the stages of the jobs ``action`` runs."""
    context = spark.sparkContext
    group = f"stages-{uuid.uuid4().hex}"
    context.setJobGroup(group, "count stages")
    try:
        action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    infos = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    return sorted({stage for info in infos if info for stage in info.stageIds})


def time_runs(action: Callable[[], object], runs: int = 9) -> tuple[float, float]:
    """Mean and population deviation, in ms, of repeated runs of ``action``."""
    spent = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        spent.append((time.perf_counter() - start) * 1000)
    return statistics.fmean(spent), statistics.pstdev(spent)

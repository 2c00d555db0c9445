"""Time the headline queries and print one JSON line.

Besides the queries it compares designs on the same tables, each with mean and
population deviation over nine runs: approximate against exact percentiles,
the profile against joining order rows, and windows with and without the
per-day sums before the fan-out. Plans, stages and skew are those of runs that
were timed, read from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.operators import dispersion as dp  # noqa: E402
from ordermill.operators import rolling as rl  # noqa: E402
from ordermill.operators import sketches as sk  # noqa: E402
from ordermill.plans.catalog import QUERIES  # noqa: E402
from ordermill.plans.eventlog import (  # noqa: E402
    described, executed_plans, read_log, stage_report,
)
from ordermill.plans.inspect import plan_facts, run_to_nowhere, time_runs  # noqa: E402
from ordermill.sources.shared import settle  # noqa: E402
from ordermill.sources.star import sales  # noqa: E402

HEADLINE = [
    "rolling_top_size", "median_variety", "city_cancellation", "city_cancellation_by_orders",
    "sku_month_std_approx", "sku_month_std_exact", "sku_month_std", "promo_cume_dist",
    "threshold_diff_summary", "largest_groups",
]
REPEATS = 5
RUNS = 9


def session(cpus: str, log: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ordermill bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log}")
        .config("spark.eventLog.compress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best_time(spark: SparkSession, name: str, folder: str) -> float:
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run_to_nowhere(QUERIES[name](spark, folder))
        times.append(time.perf_counter() - start)
    return min(times)


def std_by_order_rows(orders: DataFrame, thresholds: DataFrame, names: list[str]) -> DataFrame:
    """The plain formulation: join rows to thresholds, filter and aggregate per threshold."""
    result = dp.sku_month_spine(orders)
    for name in names:
        kept = dp.qualifying_orders(orders, thresholds, name)
        stds = dp.deviation(kept, f"std_{name}", f"cnt_{name}").drop(f"cnt_{name}")
        result = dp.spine_left_join(result, stds, f"std_{name}")
    return result


def thresholds_by_window(orders: DataFrame) -> DataFrame:
    ordered = Window.partitionBy(*dp.GROUP).orderBy("promo_count")
    shares = orders.withColumn("cume_dist", F.cume_dist().over(ordered))
    return dp.thresholds_exact_by_rows(shares)


def compare_designs(spark: SparkSession, folder: str) -> dict[str, tuple[str, dict[str, float]]]:
    """By design the description of one run in the event log, and its times."""
    orders = settle(
        dp.prepare_sku_orders(sales(spark, folder, "order_date", "sku", "amount", "promotion_ids")),
        "bench-orders",
    )
    rows = settle(
        sales(spark, folder, "order_date", "status", "qty", "size", "ship_state"), "bench-sales"
    )
    approx = [dp.approx_name(p) for p in dp.PERCENTILES]
    exact = [dp.exact_name(p) for p in dp.PERCENTILES]

    def windows_without_daily_sums() -> DataFrame:
        fanned = rl.rolling_fanout(rl.shipped_purchases(rows))
        summed = fanned.groupBy("window_date", "state", "size").agg(F.sum("qty").alias("qty"))
        return rl.top_size(summed)

    designs = {
        "approx_profile": lambda: dp.sku_month_std_approx(dp.promo_profile(orders)),
        "approx_order_rows": lambda: std_by_order_rows(
            orders, sk.thresholds_percentile_approx(orders), approx
        ),
        "exact_profile": lambda: dp.sku_month_std_exact(dp.promo_profile(orders)),
        "exact_order_rows": lambda: std_by_order_rows(orders, thresholds_by_window(orders), exact),
        "windows_daily_sums": lambda: rl.rolling_top_size(rows),
        "windows_order_rows": windows_without_daily_sums,
    }
    report = {}
    for name, build in designs.items():
        run_to_nowhere(build())
        mean, spread = time_runs(lambda: run_to_nowhere(build()), RUNS)
        with described(spark, name) as label:
            run_to_nowhere(build())
        report[name] = (label, {"mean_ms": round(mean, 1), "std_ms": round(spread, 1)})
    return report


FINAL_TABLES = ["rolling_top_size", "median_variety", "city_cancellation", "sku_month_std"]


def run_final_tables(spark: SparkSession, folder: str) -> dict[str, tuple[str, dict[str, float]]]:
    """By final table the description of one run in the event log."""
    labels = {}
    for name in FINAL_TABLES:
        with described(spark, name) as label:
            run_to_nowhere(QUERIES[name](spark, folder))
        labels[name] = (label, {})
    return labels


def executed(
    spark: SparkSession, log: str, runs: dict[str, tuple[str, dict[str, float]]]
) -> dict[str, dict[str, object]]:
    """What each run's last query did, and the stages of all its queries."""
    events = read_log(spark, f"file://{log}").cache()
    report = {}
    for name, (label, times) in runs.items():
        plans = executed_plans(events, label)
        stages = stage_report(events, label).collect()
        report[name] = {
            **times,
            **plan_facts(plans[-1]),
            "queries": len(plans),
            "stages": len(stages),
            "shuffle_mb": round(sum(s.shuffle_bytes_written for s in stages) / 1e6, 2),
            "largest_task_rows": max(s.largest_task_rows for s in stages),
            "worst_skew": max(s.skew for s in stages),
        }
    events.unpersist()
    return report


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    log = tempfile.mkdtemp(prefix="bench-events-")
    spark = session(os.environ.get("BENCH_CPUS", "8"), log)
    run_to_nowhere(QUERIES["rolling_top_size"](spark, folder))
    seconds = {name: round(best_time(spark, name, folder), 3) for name in HEADLINE}
    designs = compare_designs(spark, folder)
    finals = run_final_tables(spark, folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of 5, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "designs": executed(spark, log, designs),
                "plans": executed(spark, log, finals),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

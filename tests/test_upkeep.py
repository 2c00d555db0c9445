"""Stored summaries, kept-up tables, the stream, and what jobs report beside their result."""

import collections
import datetime as dt
import json
import os
import random
import subprocess
import sys

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import SparkSession, functions as F

from ordermill.operators import bitmaps, heavy, reports, rolling, sketches, variety
from ordermill.operators.rolling_store import RollingStore, _any_of
from ordermill.plans import eventlog, upkeep
from ordermill.plans.inspect import plan_text
from ordermill.plans.jobs import JOBS, SKU_MONTH_REPORTS
from ordermill.sources import rejects
from ordermill.sources.counts import Counts
from ordermill.sources.shared import new_path, settle
from ordermill.sources.stored import Stored
from ordermill.streaming.rolling import SCHEMA, RollingStream
from tests.test_sources import export, line

FOLDER = "/root/testdata/sf0.001"
DAY = dt.date(2022, 4, 8)


# Sketches


def counted(spark, rows):
    return spark.createDataFrame(rows, "sku string, order_date date, promo_count long")


def inverse(values, p):
    """Smallest value whose share of values up to it reaches p."""
    values = sorted(values)
    return next(v for i, v in enumerate(values, 1) if i / len(values) >= p)


def test_merged_sketches_are_those_of_all_orders(spark):
    pick = random.Random(1)
    rows = [("a", DAY + dt.timedelta(pick.randrange(60)), pick.randrange(30)) for _ in range(190)]
    rows += [("b", DAY, 3)]
    orders = counted(spark, rows)
    merged = sketches.thresholds_sketch(
        sketches.merged_sketches(sketches.daily_sketches(orders), "sku"), [0.0, 0.5, 0.8, 0.9, 1.0])
    direct = sketches.thresholds_sketch(
        orders.groupBy("sku").agg(F.kll_sketch_agg_bigint("promo_count", 200).alias("sketch")),
        [0.0, 0.5, 0.8, 0.9, 1.0])
    assert sorted(merged.collect()) == sorted(direct.collect())
    found = {r.sku: r for r in merged.collect()}
    values = [n for sku, _, n in rows if sku == "a"]
    assert found["a"].n_orders == 190 and found["b"].p90_thresh_sketch == 3
    for p, name in ((0.5, "p50"), (0.8, "p80"), (0.9, "p90"), (1.0, "p100")):
        assert found["a"][f"{name}_thresh_sketch"] == inverse(values, p)


def test_large_groups_stay_within_the_bound(spark):
    k, n = 200, 60_000
    orders = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id % 5)) AS sku",
        "date_add(date '2022-01-01', cast(id % 90 AS int)) AS order_date",
        "pmod(xxhash64(id), 10007) AS promo_count")
    thresholds = sketches.thresholds_sketch(
        sketches.merged_sketches(sketches.daily_sketches(orders, k), "sku"))
    rows = sketches.rank_errors(
        sketches.count_profile(orders, "sku"), thresholds, k).collect()
    assert sum(r.n_orders for r in rows) == n and len(rows) == 6
    for r in rows:
        # The bound holds at 99 %; three times it never fails in practice.
        assert max(r.p90_rank_error, r.p80_rank_error) <= 3 * sketches.rank_error_bound(k)
    values = collections.defaultdict(list)
    for r in orders.collect():
        values[r.sku].append(r.promo_count)
    for r in rows:
        assert r.p90_thresh_exact == inverse(values[r.sku], 0.9)
        share = [sum(v < r.p90_thresh_sketch for v in values[r.sku]) / r.n_orders,
                 sum(v <= r.p90_thresh_sketch for v in values[r.sku]) / r.n_orders]
        assert abs(r.p90_rank_error - max(0, share[0] - 0.9, 0.9 - share[1])) < 1e-12
        assert r.p90_within == (r.p90_rank_error <= sketches.rank_error_bound(k))


def test_a_wrong_threshold_is_out_of_bounds(spark):
    profile = counted(spark, [("a", DAY, n) for n in range(100)])
    thresholds = spark.createDataFrame(
        [("a", 100, 50, 79)], "sku string, n_orders long, p90_thresh_sketch long, p80_thresh_sketch long")
    (r,) = sketches.rank_errors(sketches.count_profile(profile, "sku"), thresholds, 200).collect()
    assert (round(r.p90_rank_error, 6), r.p90_within, r.p80_within) == (0.39, False, True)


# Largest groups by a summary


def sku_orders(spark, groups):
    rows = [(sku, 2022, 4) for sku, n in groups.items() for _ in range(n)]
    return spark.createDataFrame(rows, "sku string, year int, month int")


@settings(max_examples=8, deadline=None)
@given(
    groups=st.dictionaries(st.text("abcd", min_size=1, max_size=4), st.integers(1, 30), max_size=40),
    limit=st.integers(0, 25), width=st.sampled_from([1, 2, 7, 64]), depth=st.integers(1, 3))
def test_no_group_over_the_limit_is_lost(groups, limit, width, depth):
    spark = SparkSession.getActiveSession()
    orders = sku_orders(spark, groups)
    found = heavy.largest_groups_by_summary(orders, limit, 1000, width, depth).collect()
    assert {r.sku: r.n_orders for r in found} == {s: n for s, n in groups.items() if n > limit}
    exact = reports.largest_groups(reports.sku_month_sizes(orders), limit, 1000).collect()
    assert found == exact


def test_cells_are_never_below_a_groups_size_and_candidates_are_few(spark):
    groups = {f"s{i}": 200 if i < 5 else 1 + i % 3 for i in range(2000)}
    orders = settle(sku_orders(spark, groups), "orders")
    summary = settle(heavy.count_min(orders, 256, 3), "summary")
    cells = {(r.row, r.cell): r.n_cell for r in summary.collect()}
    assert len(cells) <= 3 * 256
    where = orders.distinct().select("sku", *[heavy._cell(r, 256).alias(f"c{r}") for r in range(3)])
    for r in where.collect():
        assert min(cells[i, r[f"c{i}"]] for i in range(3)) >= groups[r.sku]
    candidates = heavy.candidate_orders(orders, summary, 100, 256, 3)
    assert candidates.select("sku").distinct().count() < 50
    # No order row is shuffled to find the candidates.
    assert " Exchange " not in plan_text(candidates) and "BroadcastHashJoin" in plan_text(candidates)


# Distinct counts that roll up


def test_bitmaps_merge_to_any_coarser_group(spark):
    pick = random.Random(4)
    rows = [(f"{pick.choice([2021, 2022])}-{pick.randrange(1, 4):02}", pick.choice("AB"),
             pick.choice("xyz"), f"k{pick.randrange(40)}") for _ in range(600)]
    items = spark.createDataFrame(rows, "month string, state string, style string, sku string")
    stored = settle(bitmaps.variety_bitmaps(items, bitmaps.sku_dictionary(items)), "bitmaps")
    parts = {"month": 0, "state": 1, "style": 2}
    for keys in (["month", "state", "style"], ["month"], ["year", "style"], ["year"], ["state"]):
        sets = collections.defaultdict(set)
        for row in rows:
            sets[tuple(int(row[0][:4]) if k == "year" else row[parts[k]] for k in keys)].add(row[3])
        found = {tuple(r)[:-1]: r.variety for r in bitmaps.variety(stored, *keys).collect()}
        assert found == {key: len(skus) for key, skus in sets.items()}
    # Merging what is merged already is merging everything.
    months = bitmaps.merged_bitmaps(stored, "month", "state")
    assert sorted(bitmaps.variety(months, "state").collect()) == sorted(
        bitmaps.variety(stored, "state").collect())
    assert sorted(bitmaps.variety(stored, "month", "state", "style").collect()) == sorted(
        variety.variety_per_style(items).collect())


def test_bitmaps_over_many_ranges_of_numbers(spark):
    items = spark.range(70_000).selectExpr(
        "'2022-01' AS month", "'A' AS state", "'x' AS style", "concat('k', id % 66000) AS sku")
    numbered = spark.range(66_000).selectExpr("concat('k', id) AS sku", "id * 3 AS sku_number")
    stored = bitmaps.variety_bitmaps(items, numbered)
    assert stored.count() > 2
    assert bitmaps.variety(stored, "year").first().variety == 66_000


# Rolling windows kept up to date


PURCHASES = "order_date date, status string, qty int, size string, ship_state string"


def some_sales(spark, days, seed=1, each=30):
    pick = random.Random(seed)
    return spark.createDataFrame(
        [(d, pick.choice(["Shipped", "Cancelled"]), pick.randrange(4), pick.choice(["S", "m", " L"]),
          pick.choice(["goa", "Delhi "])) for d in days for _ in range(each)], PURCHASES)


def test_store_follows_a_full_recompute(spark):
    days = [dt.date(2022, 3, 20) + dt.timedelta(n) for n in range(30)]
    base, last = some_sales(spark, days[:12] + days[13:-1]), some_sales(spark, days[-1:], 2)
    late, more = some_sales(spark, days[12:13], 3), some_sales(spark, days[3:5] + days[20:21], 4)
    store = RollingStore(spark, new_path(spark, "store"))
    store.load(base)
    so_far = base
    for name, batch, dates in (("d1", last, 7), ("late", late, 7), ("more", more, 15)):
        assert len(store.add(batch, name)) == dates
        so_far = so_far.unionByName(batch)
        assert sorted(store.top_size().collect()) == sorted(rolling.rolling_top_size(so_far).collect())
    # A batch that is run again changes nothing.
    before = sorted(store.top_size().collect())
    store.add(late, "late")
    assert sorted(store.top_size().collect()) == before
    assert store.add(base.limit(0), "none") == []
    with pytest.raises(ValueError):
        store.add(base, "a/b")


def test_a_new_day_touches_few_partitions(spark):
    days = [dt.date(2021, 11, 1) + dt.timedelta(n) for n in range(120)]
    folder = new_path(spark, "store")
    store = RollingStore(spark, folder)
    store.load(some_sales(spark, days, each=3))
    windows = f"{folder.removeprefix('file:')}/windows"
    written = {p: os.stat(f"{windows}/{p}").st_mtime_ns for p in os.listdir(windows)}
    new = days[-1] + dt.timedelta(1)
    touched = store.add(some_sales(spark, [new], 9), "new")
    changed = {p for p in os.listdir(windows) if p.startswith("window_date=")
               and os.stat(f"{windows}/{p}").st_mtime_ns != written.get(p)}
    assert changed == {f"window_date={d}" for d in touched} and len(changed) == 7
    anew = store.windows_anew(touched)
    text = plan_text(anew, "formatted")
    assert "PartitionFilters: [month" in text and "PushedFilters: [" in text
    months = store.daily().filter(F.col("month").isin([d.replace(day=1) for d in touched]))
    assert len(months.select("month").distinct().collect()) <= 2 < len(
        store.daily().select("month").distinct().collect())


def test_days_in_a_row_are_one_range():
    spark = SparkSession.getActiveSession()
    days = [DAY, DAY + dt.timedelta(1), DAY + dt.timedelta(5)]
    rows = spark.createDataFrame([(DAY + dt.timedelta(n),) for n in range(-2, 9)], "d date")
    assert [r.d for r in rows.filter(_any_of("d", days)).collect()] == days
    assert rows.filter(_any_of("d", [])).collect() == []


# The stream


def arrive(spark, inbox, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def test_stream_drops_and_counts_late_orders(spark, conf):
    conf("spark.sql.shuffle.partitions", "2")
    inbox = new_path(spark, "inbox")
    stream = RollingStream(spark, inbox, new_path(spark, "stream"))

    def day(n):
        return DAY + dt.timedelta(n)

    arrive(spark, inbox, (day(0), "Shipped", 2, "L", "a"), (day(1), "Shipped", 1, "M", "a"),
           (day(20), "Cancelled", 1, "M", "a"), (None, "Shipped", 1, "M", "a"))
    first = stream.run()
    assert (first.rows, first.late) == (4, 0)
    arrive(spark, inbox, (day(0), "Shipped", 9, "S", "a"), (day(19), "Unshipped", 3, "s ", "b"))
    assert stream.run() == (2, 7)
    assert stream.run() == (0, 0)
    stream.close(day(20))
    on_time = [(day(0), "Shipped", 2, "L", "a"), (day(1), "Shipped", 1, "M", "a"),
               (day(19), "Unshipped", 3, "s ", "b")]
    batch = rolling.rolling_top_size(spark.createDataFrame(on_time, SCHEMA))
    assert sorted(stream.top_size().collect()) == sorted(batch.collect())


def test_stream_takes_orders_within_the_delay(spark, conf):
    conf("spark.sql.shuffle.partitions", "2")
    inbox = new_path(spark, "inbox")
    stream = RollingStream(spark, inbox, new_path(spark, "stream"), delay_days=3)
    rows = [(DAY + dt.timedelta(n), "Shipped", 1 + n % 2, "SML"[n % 3], "a") for n in (0, 4, 2, 6, 3, 9, 7)]
    for row in rows:
        arrive(spark, inbox, row)
        assert stream.run().late == 0
    stream.close(DAY + dt.timedelta(9))
    batch = rolling.rolling_top_size(spark.createDataFrame(rows, SCHEMA))
    assert sorted(stream.top_size().collect()) == sorted(batch.collect())


# Counts, rejects and reports of the jobs


LINES = [
    line(size="XXL", state="goa"), line(date="04-10-22", size="L", state=" goa\t", qty="3"),
    line(date="bad", state="goa"), line(qty="x"), line(status="Cancelled", size="3XL"),
    line(size=" "), line(state=""), "04-08-22,Shipped", line(date="02-30-22", size="6XL"),
]


def test_counts_are_those_of_separate_passes(spark, tmp_path):
    source = export(tmp_path, LINES)
    for job in JOBS:
        target = new_path(spark, job)
        taken = JOBS[job](spark, source, target)
        assert taken["read"] == len(LINES)
        read = spark.read.parquet if job in ("city-cancellation", "sku-month-std") else (
            spark.read.option("header", True).csv)
        assert taken["result"] == read(target).count()
        assert 0 < taken["kept"] < len(LINES)


def test_a_count_is_taken_while_the_rows_are_written(spark):
    counts = Counts()
    rows = counts.at("kept", counts.at("read", spark.range(100)).filter("id % 4 = 0"))
    counts.at("groups", rows.groupBy((F.col("id") % 10).alias("k")).count()).write.parquet(
        new_path(spark, "counted"))
    assert counts.taken() == {"read": 100, "kept": 25, "groups": 5}


@pytest.mark.parametrize("job", ["rolling-top-size", "median-variety"])
def test_rejects_beside_an_unchanged_result(spark, tmp_path, job):
    source = export(tmp_path, LINES)
    plain, checked, dropped = (new_path(spark, job) for _ in range(3))
    without = JOBS[job](spark, source, plain)
    counts = JOBS[job](spark, source, checked, rejects=dropped)
    assert {k: v for k, v in counts.items() if k != "rejected"} == without
    assert sorted(spark.read.text(plain).collect()) == sorted(spark.read.text(checked).collect())
    lines = spark.read.parquet(dropped).collect()
    assert len(lines) == counts["rejected"] == counts["read"] - counts["kept"]
    reasons = collections.Counter(r.reason for r in lines)
    if job == "rolling-top-size":
        assert reasons == {"unreadable date": 1, "no quantity": 1, "not shipped": 1, "no size": 1,
                           "no ship_state": 1, "short line": 1}
    (cut,) = [r for r in lines if r.reason == "short line"]
    assert cut.raw_line == "04-08-22,Shipped"


def test_a_long_line_is_kept_with_its_raw_text(spark, tmp_path):
    source = export(tmp_path, [line() + ",more", line()])
    lines = rejects.read_with_raw_lines(spark, source, ["date", "ship_state"]).collect()
    assert sorted((r.short, r.raw_line is not None) for r in lines) == [(False, False), (False, True)]


def test_reports_of_the_deviation_job(spark, tmp_path):
    folder = new_path(spark, "reports")
    JOBS["sku-month-std"](spark, export(tmp_path, LINES), new_path(spark, "std"), reports_to=folder,
                          min_orders=1)
    tables = {name: spark.read.parquet(f"{folder}/{name}").collect() for name in SKU_MONTH_REPORTS}
    assert tables["threshold_diff_summary"][0].n_diff_p90 == 0
    assert tables["largest_groups"][0].n_orders > 1
    assert tables["std_diff_summary"][0].n_groups == tables["qualifying_diff_summary"][0].n_groups


# Stored layout


@pytest.mark.parametrize("name", ["threshold_compare_stored", "qualifying_set_diff_stored"])
def test_stored_profile_is_joined_without_a_shuffle(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    result = upkeep.QUERIES[name](spark, FOLDER)
    result.collect()
    text = plan_text(result)
    assert "Exchange" not in text and "Bucketed: true" in text and "Join" in text


def test_stored_table_goes_when_dropped(spark):
    with Stored(spark.range(10), ["id"], 2, "ten") as stored:
        assert stored.table().count() == 10
        name = stored.name
    assert not spark.catalog.tableExists(name)


# The event log


def test_event_log_gives_stages_and_the_executed_plan(tmp_path):
    facts, text, stages, all_stages = logged(tmp_path, """
big = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 10 < 9, 1, id) AS k", "id")
small = spark.range(3).withColumnRenamed("id", "k").groupBy("k").count()
with described(spark, "one") as name:
    run_to_nowhere(big.repartition(4, "k").join(small, "k"))
with described(spark, "other"):
    run_to_nowhere(spark.range(10))
events = read_log(spark, log)
plans = executed_plans(events, name)
stages = [r.asDict() for r in stage_report(events, name).orderBy("stage").collect()]
found = [[plan_facts(p) for p in plans], plans[0], stages, stage_report(events).count()]
""")
    # At run time the small grouped side is broadcast, whatever was planned first.
    assert len(facts) == 1 and facts[0]["joins"] == ["BroadcastHashJoin"]
    assert "isFinalPlan=true" in text
    assert all_stages > len(stages) >= 2
    assert sum(s["shuffle_bytes_written"] for s in stages) > 0
    assert max(s["skew"] for s in stages) > 3
    assert max(s["largest_task_rows"] for s in stages) >= 36_000


def test_bloom_filter_drops_rows_before_the_shuffle(tmp_path):
    with_filter, without = logged(tmp_path, """
from ordermill.operators import cancellation as cc
from ordermill.sources.shared import settle
for name, value in {"autoBroadcastJoinThreshold": -1,
                    "optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": 1}.items():
    spark.conf.set(f"spark.sql.{name}", value)
# One promotion in fifty lasts, the others have a day each.
orders = settle(spark.range(0, 50_000, 1, 4).selectExpr(
    "id AS row_key", "date_add(date '2022-01-01', cast(id % 300 AS int)) AS order_date",
    "concat('P', if(id % 50 = 0, id % 400, id)) AS promotion_ids"), "orders")
found = []
for on in (True, False):
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", on)
    joined = cc.stored_valid_promo_rows(orders)
    with described(spark, "join") as name:
        rows = len(joined.collect())
    events = read_log(spark, log)
    moved = sum(r.shuffle_bytes_written for r in stage_report(events, name).collect())
    found.append([rows, "might_contain" in executed_plans(events, name)[-1], moved])
""")
    assert with_filter[0] == without[0] == 1000
    assert with_filter[1] and not without[1]
    assert with_filter[2] < without[2] / 5


def logged(tmp_path, body):
    """``found`` of a script run in a session of its own, which alone can switch the log on."""
    script = f"""
import json
from pyspark.sql import SparkSession, functions as F
from ordermill.plans.eventlog import *
from ordermill.plans.inspect import plan_facts, run_to_nowhere
log = "file://{tmp_path}"
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log)
    .config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.warehouse.dir", "{tmp_path}/warehouse")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
log = log + "/*local-*"
{body}
print("FOUND " + json.dumps(found))
"""
    out = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    lines = [s for s in out.stdout.splitlines() if s.startswith("FOUND ")]
    assert lines, out.stderr[-3000:]
    return json.loads(lines[0].removeprefix("FOUND "))

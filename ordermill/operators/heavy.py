"""The largest groups by a count-min summary, without counting every group exactly.

Every order is counted in ``depth`` rows of ``width`` cells, one cell a row by a
hash of its group. A cell holds at least the orders of every group that falls
into it, so a group's smallest cell is never below its true size: a group over
the limit can not be lost. Only groups whose cells are all over the limit are
counted exactly, which drops the few that merely share cells with large ones.

The summary has depth x width cells, however many groups there are, and combines
on the map side. A full count shuffles one row per group and map task instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordermill.operators.dispersion import GROUP
from ordermill.operators.reports import largest_groups, sku_month_sizes
from ordermill.sources.shared import settle

WIDTH = 1 << 14
DEPTH = 4


def _cell(row: int, width: int) -> Column:
    """Cell of a group in one row; the row's number is hashed along with the group."""
    return F.pmod(F.xxhash64(F.lit(row), *GROUP), F.lit(width)).cast("int")


def count_min(orders: DataFrame, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(row, cell, n_cell): the summary's cells that hold an order."""
    cells = F.array(
        *[F.struct(F.lit(r).alias("row"), _cell(r, width).alias("cell")) for r in range(depth)])
    return (
        orders.select(F.inline(cells)).groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n_cell"))
    )


def candidate_orders(
    orders: DataFrame, summary: DataFrame, min_orders: int, width: int = WIDTH, depth: int = DEPTH
) -> DataFrame:
    """Orders of the groups that may have more than ``min_orders`` orders.

    Semi joins with the summary's full cells, at most ``width`` a row; the planner
    sees their true size and sends them to all tasks, so no order is shuffled.
    """
    for r in range(depth):
        full = summary.filter((F.col("row") == r) & (F.col("n_cell") > min_orders)).select("cell")
        orders = orders.withColumn("cell", _cell(r, width)).join(full, "cell", "left_semi")
    return orders.drop("cell")


def largest_groups_by_summary(
    orders: DataFrame,
    min_orders: int = 1000,
    k: int = 20,
    width: int = WIDTH,
    depth: int = DEPTH,
    row_bytes: int = 200,
) -> DataFrame:
    """The rows of ``largest_groups``, counting only candidates exactly.

    Runs a job: the summary is written to the shared folder.
    """
    summary = settle(count_min(orders, width, depth), "count-min")
    candidates = candidate_orders(orders, summary, min_orders, width, depth)
    return largest_groups(sku_month_sizes(candidates, row_bytes), min_orders, k)

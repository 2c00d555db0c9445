"""Rows of a CSV scan that a question does not use, with the reason.

The scan keeps every line: fields by name, and for lines with too few or too
many fields the raw text as well (Spark's corrupt-record column). A list of
rules, in order, gives each row its first reason to be dropped or none; rows
without a reason are exactly those the question's filters keep.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.functions.dates import parse_any_date, parse_sale_date
from ordermill.functions.numbers import int_or_zero
from ordermill.functions.text import is_present, strip, upper_stripped
from ordermill.operators.variety import LARGE_SIZES
from ordermill.sources.orders_csv import resolve_columns

RAW = "raw_line"

Rules = list[tuple[str, Column]]


def read_with_raw_lines(
    spark: SparkSession, path: str | list[str], columns: Iterable[str]
) -> DataFrame:
    """Text columns under their canonical names, trimmed, with ``short`` and ``raw_line``.

    ``short`` is true for a line that ends before the last of the named columns.
    The raw line is null where a line has as many fields as the header.
    """
    columns = list(columns)
    header = spark.read.option("header", True).csv(path).columns
    resolved = resolve_columns(header, columns)
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in header)
    lines = (
        spark.read.schema(f"{fields}, {RAW} string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW)
        .option("columnPruning", False)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    last = max(resolved.values(), key=header.index)

    def field(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    return lines.select(
        *[strip(field(raw)).alias(c) for c, raw in resolved.items()],
        (F.col(RAW).isNotNull() & field(last).isNull()).alias("short"),
        RAW,
    )


def purchase_rules() -> Rules:
    """Why a line is no purchase of the rolling question."""
    return [
        ("short line", F.col("short")),
        ("not shipped", ~F.coalesce(F.lower("status").contains("shipped"), F.lit(False))),
        ("no quantity", int_or_zero(F.col("qty")) <= 0),
        *_blank("size", "ship_state", "date"),
        ("unreadable date", parse_any_date("date", clamp=True).isNull()),
    ]


def item_rules() -> Rules:
    """Why a line is no item of the variety question."""
    return [
        ("short line", F.col("short")),
        ("other size", ~F.coalesce(upper_stripped("size").isin(list(LARGE_SIZES)), F.lit(False))),
        *_blank("sku", "style", "ship_state", "date"),
        ("unreadable date", parse_sale_date("date", clamp=True).isNull()),
    ]


def _blank(*columns: str) -> Rules:
    return [(f"no {c}", ~F.coalesce(is_present(c), F.lit(False))) for c in columns]


def with_reason(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines with ``reason``, the first rule that holds; null for lines that are used."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    return lines.withColumn("reason", reason)


def rejected(checked: DataFrame) -> DataFrame:
    """The lines that are not used, with their fields, raw text and reason."""
    return checked.filter(F.col("reason").isNotNull()).drop("short")


def kept(checked: DataFrame) -> DataFrame:
    """The lines that are used, as the plain scan gives them."""
    return checked.filter(F.col("reason").isNull()).drop("short", "reason", RAW)


def counts_by_reason(checked: DataFrame) -> DataFrame:
    """Lines by reason, and as ``kept`` those without one."""
    reason = F.coalesce("reason", F.lit("kept")).alias("reason")
    return checked.groupBy(reason).agg(F.count(F.lit(1)).alias("n_lines"))

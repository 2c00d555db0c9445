"""Order rows from CSV files with a header line."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermill.functions.dates import SALE_DATE_FORMAT, parse_any_date, parse_sale_date
from ordermill.functions.numbers import double_or_null, int_or_zero
from ordermill.functions.text import strip

# Header names, after normalising, that stand for each column.
# The first alias found in the header wins.
COLUMN_ALIASES = {
    "date": ["date"],
    "status": ["status"],
    "fulfilment": ["fulfilment"],
    "courier_status": ["courier_status"],
    "service_level": ["ship_service_level"],
    "qty": ["qty"],
    "amount": ["amount"],
    "size": ["size"],
    "sku": ["sku"],
    "style": ["style"],
    "ship_city": ["ship_city"],
    "ship_state": ["ship_state", "shipstate", "state"],
    "promotion_ids": ["promotion_ids"],
}


def normalise_header(name: str) -> str:
    """Header name trimmed, in lower case, blanks and dashes as underscores."""
    return re.sub(r"\s+", "_", name.strip().lower()).replace("-", "_")


def resolve_columns(header: list[str], wanted: Iterable[str]) -> dict[str, str]:
    """Map each wanted column to the first header entry one of its aliases names."""
    by_name: dict[str, str] = {}
    for raw in header:
        by_name.setdefault(normalise_header(raw), raw)
    resolved = {}
    for column in wanted:
        hits = [by_name[a] for a in COLUMN_ALIASES[column] if a in by_name]
        if not hits:
            raise ValueError(f"column '{column}' not found in header: {','.join(header)}")
        resolved[column] = hits[0]
    return resolved


def read_orders(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] = COLUMN_ALIASES,
    trim: bool = False,
) -> DataFrame:
    """Read CSV orders as text columns under their canonical names.

    All fields stay text: no extra pass to infer types, and the same result
    whatever the first rows look like. Short rows are filled with nulls, which
    the required-field filters drop. Blank lines are skipped by the reader.
    ``trim`` takes white space off both ends of every field.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    resolved = resolve_columns(raw.columns, list(columns))
    fields = {c: _quoted(raw_name) for c, raw_name in resolved.items()}
    return raw.select(*[(strip(f) if trim else f).alias(c) for c, f in fields.items()])


def type_orders(
    raw: DataFrame, any_date_format: bool = False, clamp: bool = False
) -> DataFrame:
    """Give text orders typed columns: ``order_date``, ``qty`` and ``amount``.

    Unreadable dates and amounts become null and unreadable quantities 0, so
    the operators' filters drop them. Other columns are left as they are.
    ``clamp`` reads days 29 to 31 that a month does not have as its last day.
    """
    date: Column = parse_any_date("date", clamp=clamp) if any_date_format else parse_sale_date(
        "date", SALE_DATE_FORMAT, clamp
    )
    typed = {
        "order_date": ("date", date),
        "qty": ("qty", int_or_zero(strip("qty"))),
        "amount": ("amount", double_or_null(F.col("amount"))),
    }
    derived = {name: expr for name, (source, expr) in typed.items() if source in raw.columns}
    kept = [c for c in raw.columns if c != "date" and c not in derived]
    return raw.select(*[e.alias(n) for n, e in derived.items()], *kept)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")

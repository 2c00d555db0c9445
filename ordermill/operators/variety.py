"""Monthly median, per state, of the number of distinct SKUs per style."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ordermill.functions.dates import month_key
from ordermill.functions.text import is_present, strip, title_state, upper_stripped

# The sizes from XXL up.
LARGE_SIZES = ("XXL", "3XL", "4XL", "5XL", "6XL")


def sized_items(sales: DataFrame, sizes: Sequence[str] = LARGE_SIZES) -> DataFrame:
    """Rows of the given sizes with month, state, style and SKU.

    Neither status nor quantity is looked at.
    """
    kept = sales.filter(
        upper_stripped("size").isin(list(sizes))
        & is_present("sku")
        & is_present("style")
        & is_present("ship_state")
        & F.col("order_date").isNotNull()
    )
    key = [c for c in ("row_key",) if c in sales.columns]
    return kept.select(
        *key,
        month_key("order_date").alias("month"),
        title_state("ship_state").alias("state"),
        strip("style").alias("style"),
        strip("sku").alias("sku"),
    )


def distinct_style_skus(items: DataFrame) -> DataFrame:
    """One row per month, state, style and SKU."""
    return items.select("month", "state", "style", "sku").distinct()


def variety_per_style(items: DataFrame) -> DataFrame:
    """Distinct SKUs per month, state and style.

    Counting after a distinct lets both shuffles combine on the map side, so a
    style that holds much of the input is never gathered in one task as rows.
    """
    return (
        distinct_style_skus(items)
        .groupBy("month", "state", "style")
        .agg(F.count(F.lit(1)).alias("variety"))
    )


def median_variety(sales: DataFrame, sizes: Sequence[str] = LARGE_SIZES) -> DataFrame:
    """Exact median over styles of the number of distinct SKUs, per month and state."""
    return median_of(variety_per_style(sized_items(sales, sizes)))


def median_of(varieties: DataFrame) -> DataFrame:
    """Exact median of the styles' varieties, per month and state.

    ``median`` keeps one count per distinct value. Varieties of one group add
    up to its SKUs, so s SKUs give fewer than sqrt(2 s) distinct values.
    """
    return varieties.groupBy("month", "state").agg(F.median("variety").alias("median_variety"))

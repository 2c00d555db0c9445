"""Distinct SKUs that roll up: one stored bitmap per month, state and style.

SKUs get numbers from a stored dictionary; the SKUs of a group set the bits of
its bitmaps, one bitmap per range of numbers. The union of bitmaps is the
distinct set of any coarser group, so months merge to years, and styles or states
to totals, without the item rows and exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.operators.variety import distinct_style_skus
from ordermill.sources.shared import settle

KEYS = ("month", "state", "style")


def sku_dictionary(items: DataFrame) -> DataFrame:
    """(sku, sku_number): every SKU with a number of its own, written once.

    Numbers have gaps between the tasks that gave them, which costs empty ranges
    only. They differ from run to run, so they are stored before use.
    """
    numbered = items.select("sku").distinct().withColumn(
        "sku_number", F.monotonically_increasing_id())
    return settle(numbered, "sku-dictionary")


def variety_bitmaps(items: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(month, state, style, bucket, skus): the bitmaps of each group.

    Items are made distinct first, on the map side, so a SKU or style with a third
    of all items is a few rows when its number is looked up.
    """
    numbered = distinct_style_skus(items).join(dictionary, "sku")
    return numbered.groupBy(
        *KEYS, F.bitmap_bucket_number("sku_number").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("sku_number")).alias("skus"))


def merged_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of coarser groups, by ``month``, ``year``, ``state`` or ``style``; again bitmaps."""
    dated = bitmaps.withColumn("year", F.substring("month", 1, 4).cast("int"))
    return dated.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("skus").alias("skus"))


def variety(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct SKUs of each group of ``keys``."""
    return (
        merged_bitmaps(bitmaps, *keys)
        .groupBy(*keys)
        .agg(F.sum(F.bitmap_count("skus")).alias("variety"))
    )


def median_variety_by(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Median over styles of the distinct SKUs, per group of ``keys``."""
    return (
        variety(bitmaps, *keys, "style")
        .groupBy(*keys)
        .agg(F.median("variety").alias("median_variety"))
    )

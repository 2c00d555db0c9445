"""Expressions over the comma-separated promotion list of an order.

Two counts exist side by side and differ on purpose: the array drops blank
pieces, the raw count keeps them. ``a,b,`` has 2 promotions but counts 3.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def promo_array(col: str | Column) -> Column:
    """Trimmed, non-blank promotion ids in list order, repeats kept."""
    # The spaces around a comma go with it, so the pieces need no trimming.
    pieces = F.split(F.trim(F.coalesce(col, F.lit(""))), " *, *")
    return F.array_remove(pieces, "")


def raw_promo_count(col: str | Column) -> Column:
    """Number of pieces between commas, 0 for a null or blank list.

    Counts commas instead of splitting. Never lower than the array's size.
    """
    commas = F.length(col) - F.length(F.replace(col, F.lit(","), F.lit("")))
    return F.coalesce(F.when(F.trim(col) != "", commas + 1), F.lit(0)).cast("long")

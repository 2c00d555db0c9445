"""Number parsing that turns bad text into a fallback, never into an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def int_or_zero(col: Column) -> Column:
    """Whole number, 0 when the text is none (``x``, ``1.0``, blank, null)."""
    return F.coalesce(col.try_cast("int"), F.lit(0))


def double_or_null(col: Column) -> Column:
    """Double, null when the text is no number."""
    return col.try_cast("double")

"""Text clean-up expressions.

The four questions normalise text in three different ways. The spellings are
kept apart on purpose: merging them would change the groups in the results.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character up to and including the space (U+0000..U+0020).
CONTROL_AND_SPACE = "".join(map(chr, range(0x21)))

# State names, in lower case, that are spelled another way in the result.
STATE_ALIASES = {
    "orissa": "Odisha",
    "rajsthan": "Rajasthan",
}


def strip(col: str | Column) -> Column:
    """Drop blanks and control characters on both ends (not only spaces)."""
    return F.btrim(col, F.lit(CONTROL_AND_SPACE))


def is_present(col: str | Column) -> Column:
    """True for text with a character that ``strip`` would keep; null is not present."""
    return F.rlike(col, F.lit(r"[^\x00-\x20]"))


def upper_stripped(col: str | Column) -> Column:
    """Spelling of sizes and states in the rolling top-size question."""
    return F.upper(strip(col))


def lower_trimmed(col: str | Column) -> Column:
    """Spelling of status-like fields in the city cancellation question."""
    return F.lower(F.trim(col))


def upper_trimmed(col: str | Column) -> Column:
    """Spelling of cities and states in the city cancellation question."""
    return F.upper(F.trim(col))


def title_state(col: str | Column, aliases: dict[str, str] = STATE_ALIASES) -> Column:
    """State name in title case with single spaces, after the alias table.

    The alias lookup sees the name before its inner blanks are collapsed.
    """
    name = strip(col)
    result = F.initcap(F.regexp_replace(name, r"\s+", " "))
    for known, spelled in aliases.items():
        result = F.when(F.lower(name) == known, F.lit(spelled)).otherwise(result)
    return result

"""Result files. The defaults keep one file per task, which scales with the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.sources.counts import Counts


def _sorted(df: DataFrame, order_by: list[str], counts: Counts | None) -> DataFrame:
    rows = df.orderBy(*order_by)
    return counts.at("result", rows) if counts else rows


def write_csv(
    df: DataFrame,
    path: str,
    order_by: list[str],
    single_file: bool = False,
    counts: Counts | None = None,
    quoted: bool = False,
) -> None:
    """Write ``df`` sorted, as CSV with a header, replacing what was at ``path``.

    Values are written bare unless ``quoted`` asks for quotes around values
    that hold a comma or a quote. ``single_file`` is for small results: one
    task then merges the sorted partitions. ``counts`` takes the rows as "result".
    """
    rows = _sorted(df, order_by, counts)
    if single_file:
        rows = rows.coalesce(1)
    if quoted:
        rows.write.mode("overwrite").option("header", True).csv(path)
        return
    # One column holding the whole line, with a separator that cannot occur in it.
    line = F.concat_ws(
        ",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    )
    (
        rows.select(line.alias(",".join(df.columns)))
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(
    df: DataFrame,
    path: str,
    order_by: list[str],
    single_file: bool = False,
    counts: Counts | None = None,
) -> None:
    """Write ``df`` sorted, as parquet, replacing what was at ``path``."""
    rows = _sorted(df, order_by, counts)
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").parquet(path)

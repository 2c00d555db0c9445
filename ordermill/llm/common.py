"""What the operators share: input columns, row batches, hashes of ids."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MIN_LONG = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text, null texts as empty ones.

    All other columns are dropped, so their names cannot clash with an operator's.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with __k and __t, which tell rows apart but for repeated ones:
    the id, with a stand-in for null, and the hash of the text, null as empty.
    """
    return docs.withColumns({
        "__k": F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_LONG)),
        "__t": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(divisor)


def utf8(column: pa.Array) -> list[bytes]:
    """A string column of a batch as bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in each.

    A row is never cut: one very long text makes a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def trim() -> None:
    """Give freed memory back: a worker that waits for its next task keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # Where the C library has it.
    if trim is not None:
        trim(0)


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the longs that Spark stores."""
    return values.astype(np.uint64).view(np.int64)


def vocabulary() -> tuple[str, str]:
    """File of the public 50k byte-level vocabulary and its split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

"""Tables stored in buckets, so that joins and groupings on their keys shuffle nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ordermill.sources.shared import forget, new_path


class Stored:
    """A table in the shared folder, dealt to ``buckets`` by ``keys`` and sorted in each.

    The table is shuffled once, when it is written; every later join or grouping
    on the keys works bucket by bucket. Two tables stored with equal keys and
    numbers of buckets meet without a shuffle. As a context it drops itself.

    >>> with Stored(profile, ["sku", "year", "month"], 200, "profile") as stored:
    ...     thresholds_exact(stored.table())
    """

    def __init__(self, df: DataFrame, keys: list[str], buckets: int, label: str) -> None:
        self._spark = df.sparkSession
        self._path = new_path(self._spark, label)
        self.name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
        (
            df.repartition(buckets, *keys)
            .write.bucketBy(buckets, *keys)
            .sortBy(*keys)
            .option("path", self._path)
            .saveAsTable(self.name)
        )

    def table(self) -> DataFrame:
        return self._spark.table(self.name)

    def drop(self) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        forget(self._spark, self._path)

    def __enter__(self) -> Stored:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()

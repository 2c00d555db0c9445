"""Row counts taken while a job's own writes run, without reading anything again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


class Counts:
    """Named counts of rows that pass through points of running queries.

    >>> counts = Counts()
    >>> counts.at("read", raw).filter(...).write.parquet(path)
    >>> counts.taken()
    {'read': 128975}

    Put a point before a shuffle or after a sort, not between an aggregate and a
    sort: sorting samples the rows there first, and they would count twice. A
    task that is run again because its output was lost counts again.
    """

    def __init__(self) -> None:
        self._points: dict[str, Observation] = {}

    def at(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with its rows counted as ``name`` when it is run."""
        point = Observation(name)
        self._points[name] = point
        return df.observe(point, F.count(F.lit(1)).alias("rows"))

    def taken(self) -> dict[str, int]:
        """The counts, once the queries have run."""
        return {name: point.get.get("rows", 0) for name, point in self._points.items()}

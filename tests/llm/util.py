"""Small tables for the operators' tests, and what their jobs leave on disk."""

from __future__ import annotations

import glob
import os
import time

from ordermill.sources.shared import shared_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """Documents 0, 1, ... with these texts; extra columns by name."""
    n = len(texts)
    langs = columns.get("lang", ["en"] * n)
    sources = columns.get("source", ["s"] * n)
    ids = columns.get("doc_id", range(n))
    rows = [
        (i, t, g, s, len(t or "")) for i, t, g, s in zip(ids, texts, langs, sources, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def left_behind(spark, run):
    """The shuffle files that ``run`` leaves, and the labels of its tables in the shared folder."""
    def files():
        local = spark.sparkContext.getConf().get("spark.local.dir", os.environ.get("SPARK_LOCAL_DIRS", "/tmp"))
        return set(glob.glob(f"{local}/blockmgr-*/*/shuffle_*.data"))

    def tables():
        return {os.path.basename(p).rsplit("-", 1)[0]: p
                for p in glob.glob(f"{shared_folder(spark)}/*") if p not in earlier}

    earlier = set(glob.glob(f"{shared_folder(spark)}/*"))
    before = files()
    result = run()
    for _ in range(50):  # Spark drops them on its own thread.
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    return left, sorted(tables()), result

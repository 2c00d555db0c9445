"""Connected components of a link table, as joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.sources.shared import settle


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b).

    Every round gives each node the smallest label among its neighbours, hands
    that label to the node's old root as well, and then follows the label's own
    label, so the distance to the smallest node at least halves in practice.
    Labels only fall, and a round without a change ends the loop. Each round is
    written to the shared folder: the lineage stays short and survives lost
    executors. Only one count a round comes to the driver.
    """
    both = settle(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(),
        f"{label}-links",
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("root")), f"{label}-labels")
    while True:
        old = labels
        near = both.join(old, both.b == old.node).groupBy("a").agg(F.min("root").alias("near"))
        lower = old.join(near, old.node == near.a, "left").select(
            "node", "root", F.least("root", F.coalesce("near", "root")).alias("new"))
        hooked = lower.filter("new < root").groupBy(F.col("root").alias("node")).agg(
            F.min("new").alias("hook"))
        fallen = lower.join(hooked, "node", "left").select(
            "node", "root", F.least("new", F.coalesce("hook", "new")).alias("new"))
        parents = fallen.select(F.col("node").alias("new"), F.col("new").alias("up"))
        jumped = fallen.join(parents, "new", "left").select(
            "node", F.col("root").alias("old"),
            F.least("new", F.coalesce("up", "new")).alias("root"))
        written = settle(jumped, f"{label}-labels")
        labels = written.select("node", "root")
        if not written.filter("old <> root").limit(1).count():
            return labels

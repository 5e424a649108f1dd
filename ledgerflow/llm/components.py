"""Connected components of a graph of any size, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerflow.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id that its links reach, of every end of an edge.

    ``edges`` has the long columns ``a`` and ``b``. Labels are staged each round, so lineage stays
    short and a lost executor costs a round at most. A hub's rows are pre-aggregated by the minimum
    and its joins are ones that adaptive execution can split.
    """
    ends = edges.select("a", "b").union(edges.select("b", "a"))
    links = stage(ends.where("a <> b").distinct(), "links")
    labels = stage(
        links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "id"),
        "labels",
    )
    while True:
        near = links.join(labels.withColumnsRenamed({"id": "b", "label": "near"}), "b")
        near = near.groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select(
            "id", "label", F.least("label", "near").alias("lower")
        )
        # The label's own label, one jump further.
        target = labels.select(F.col("id").alias("lower"), F.col("label").alias("jump"))
        moved = lower.join(target, "lower", "left").select(
            "id", F.col("label").alias("before"),
            F.least("lower", F.coalesce("jump", "lower")).alias("label"),
        )
        moved = stage(moved, "labels")
        changed = moved.where("label <> before").limit(1).count()
        labels = moved.select("id", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")

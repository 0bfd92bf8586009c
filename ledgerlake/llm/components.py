"""Connected components of a graph that is never in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Per node (`id`) the smallest node it can reach over `links` (a, b): id, label.

    Every round takes the smallest label among a node and its neighbours and then
    the label of that label, until nothing changes. Rounds are written tables; the
    joins have one unique side, so that a hub can be cut into several tasks.
    """
    links = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = written(nodes.select("id", F.col("id").alias("label")), "labels")
    while True:
        near = (
            links.join(labels.select(F.col("id").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("id")).agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "id", "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        target = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        jumped = written(
            stepped.join(target, "label").select("id", "old", F.least("label", "further").alias("label")), "labels"
        )
        labels = jumped.select("id", "label")
        if jumped.where("old != label").isEmpty():
            return labels

"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.scale import Scratch, stage


def components(links: DataFrame) -> DataFrame:
    """node, component: for every node of `links` (a, b) the least node it is connected to.

    Each round takes the least label among neighbours and then the label of that
    label, so a chain of n links needs about log n rounds. Neighbours' labels are
    reduced before they are shuffled; every round is written to the shared folder.
    """
    with Scratch(links.sparkSession) as scratch:
        both = scratch.stage(
            links.select(F.col("a").alias("node"), F.col("b").alias("other"))
            .union(links.select(F.col("b"), F.col("a"))).filter("node != other").distinct(),
            "links",
        )
        labels = scratch.stage(
            both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
        )
        while True:
            near = (
                both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near"))
            )
            nearer = scratch.stage(
                labels.join(near, "node").select(
                    "node", F.least("component", "near").alias("component"), F.col("component").alias("before")
                ),
                "nearer",
            )
            jumped = nearer.alias("x").join(
                nearer.select(F.col("node").alias("at"), F.col("component").alias("then")).alias("y"),
                F.col("x.component") == F.col("y.at"),
                "left",
            )
            labels = scratch.stage(
                jumped.select(
                    "node", F.least("component", F.coalesce("then", "component")).alias("component"), "before"
                ),
                "labels",
            )
            moved = labels.filter("component != before").limit(1).count()
            labels = labels.select("node", "component")
            if not moved:
                return stage(labels, "components")

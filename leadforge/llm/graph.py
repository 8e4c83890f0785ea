"""Connected components of a link table, by labels that shrink to the minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of all ids in ``x, y``.

    A round takes the least label of each id's neighbours, then the label of
    that label (pointer jumping), so long chains end in logarithmically many
    rounds.  Every join is on plain exchanges, which AQE splits at hub ids;
    the minimum is a partial aggregate.  Each round's table cuts the lineage.
    """
    edges = stored(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x != y").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnsRenamed({"id": "y", "label": "seen"}), "y")
                .groupBy(F.col("x").alias("id")).agg(F.min("seen").alias("seen")))
        lower = stored(labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "seen").alias("label")), "labels")
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = stored(lower.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        if new.filter("label != old").isEmpty():
            return new.select("id", F.col("label").alias("component"))
        labels = new.select("id", "label")

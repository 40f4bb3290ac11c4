"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.session import staged


def components(links: DataFrame) -> DataFrame:
    """``(id, label)`` of every id in ``links(a, b)``; the label is the smallest id reachable.

    Each round takes the smallest label among the neighbours, then the label
    of that label (pointer jumping), and is written to the shared folder;
    it ends when no label changes. Joins meet two written tables, so a hub
    with very many links is split by AQE; sums are combined before shuffles.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        labels = staged(hooked.join(jump, "label").select("id", "old", F.least("label", "far").alias("label")), "labels")
        if labels.where("old <> label").isEmpty():
            return labels.select("id", "label")

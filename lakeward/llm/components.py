"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Folder


def connected_components(links: DataFrame, folder: Folder, name: str) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): root is the least id that
    links reach.  Each round takes the least root among neighbours, then jumps
    to the root's root, until nothing changes; rounds grow with the logarithm
    of the longest chain.  Labels are written after each round, and the round's before dropped."""
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    edges = folder.keep(edges.union(edges.select("dst", "src")).filter("src <> dst").distinct(), f"{name}-edges")
    labels = folder.keep(
        edges.groupBy(F.col("src").alias("id")).agg(F.least("id", F.min("dst")).alias("root")), f"{name}-0"
    )
    turn = 0
    while True:
        near = (
            edges.join(labels, edges.dst == labels.id)
            .groupBy("src")
            .agg(F.min("root").alias("near"))
            .withColumnRenamed("src", "id")
        )
        closer = labels.join(near, "id").select("id", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("root").alias("far"))
        moved = closer.join(jump, "next").select("id", F.least("next", "far").alias("root"), (F.least("next", "far") != F.col("root")).alias("moved"))
        turn += 1
        labels = folder.keep(moved, f"{name}-{turn}")
        folder.drop(f"{name}-{turn - 1}")
        if labels.filter("moved").isEmpty():
            folder.drop(f"{name}-edges")
            return labels.select("id", "root")
        labels = labels.select("id", "root")

"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; the component is its smallest id.

    Each round hangs every id below its smallest neighbour, follows the pointers to the roots
    by doubling, and replaces links by those between roots; every round at least halves the
    ids that still have links. All tables are written, so lineage stays short.
    """
    scratch = Scratch.of(links.sparkSession)
    links = links.filter("a IS NOT NULL AND b IS NOT NULL")
    labels = scratch.keep(
        links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "labels"
    )
    links = scratch.keep(links.filter("a <> b").distinct(), "links")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("parent"))
        parents = scratch.keep(parents, "parents")
        while True:
            above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
            jumped = scratch.keep(parents.join(above, "parent").select("id", "parent", "above"), "jumped")
            parents = jumped.select("id", F.col("above").alias("parent"))
            if jumped.filter("parent <> above").isEmpty():
                break
        root = parents.select(F.col("id").alias("component"), F.col("parent").alias("root"))
        labels = scratch.keep(
            labels.join(root, "component", "left").select("id", F.coalesce("root", "component").alias("component")), "labels"
        )
        a, b = (parents.select(F.col("id").alias(x), F.col("parent").alias(f"{x}_root")) for x in "ab")
        moved = links.join(a, "a").join(b, "b").filter("a_root <> b_root")
        links = scratch.keep(
            moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "links"
        )
    return labels

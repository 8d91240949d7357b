"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise


def compressed(parents: DataFrame) -> DataFrame:
    """Follow (node, parent) up to the roots; each step halves the way."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents = materialise(
            parents.join(up, "parent", "left").select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "parents",
        )
        if parents.filter("moved").isEmpty():
            return parents.select("node", "parent")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of each node that has a link: the smallest node it reaches.

    ``links`` has two columns with the ends of each link; repeated links, links of a
    node with itself and nulls are fine. Each round hooks every node to its smallest neighbour if
    that is smaller, follows the hooks to their roots and replaces nodes by roots. At least half
    of the nodes that are not yet alone go in two rounds. A node with very many
    links is pre-aggregated in the hooks and left to Spark's skew splitting in the joins.
    """
    a, b = links.columns
    links = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    links = materialise(links.filter("a < b").distinct(), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        hooks = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        parents = compressed(materialise(hooks, "hooks"))
        rounds.append(parents)
        for end in ("a", "b"):
            roots = parents.select(F.col("node").alias(end), F.col("parent").alias("root"))
            links = links.join(roots, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = materialise(links.filter("a < b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds.pop()
    while rounds:
        later = found.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        earlier = rounds.pop().join(later, "parent", "left")
        found = found.union(earlier.select("node", F.coalesce("above", "parent")))
    found = materialise(found, "components")
    roots = found.select(F.col("parent").alias("node")).distinct()
    return found.union(roots.select("node", F.col("node"))).toDF("node", "component")

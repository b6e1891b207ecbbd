"""Connected components of a table of links, by contraction.

In each round every node points to its smallest neighbour, or to itself; pointers are followed one
step further, links are led to where their ends point, and what has become one node is dropped.
The nodes that are left at least halve from round to round. Each round is written to the shared
folder, so plans stay small and a lost executor costs no more than its part of one round. Joins are
by sort and merge, which can split the rows of a very large component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.llm.tables import stored


def _led(links: DataFrame, pointers: DataFrame) -> DataFrame:
    """``links`` between the nodes that the ends of links point to."""
    for end in ("a", "b"):
        to = pointers.select(F.col("node").alias(end), F.col("component").alias("to")).hint("merge")
        links = links.join(to, end, "left").withColumn(end, F.coalesce("to", end)).select("a", "b")
    return links.where("a <> b")


def _followed(pointers: DataFrame, further: DataFrame) -> DataFrame:
    """``pointers`` (node, component) led on by ``further`` ones."""
    to = further.select(F.col("node").alias("component"), F.col("component").alias("to")).hint("merge")
    return pointers.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after ``links`` (a, b) between their nodes or new ones.

    The component is the smallest node. Nodes without a link have no label of their own.
    """
    links = links.select("a", "b").where("a <> b")
    links = stored((links if labels is None else _led(links, labels)).distinct(), "links")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        nearest = stored(nearest.select("node", F.least("node", "component").alias("component")), "nearest")
        pointers = stored(_followed(nearest, nearest), "pointers")
        if labels is None:
            labels = pointers
        else:
            fresh = pointers.join(labels.select("node").hint("merge"), "node", "left_anti")
            labels = stored(_followed(labels, pointers).union(fresh), "labels")
        links = stored(_led(links, pointers).distinct(), "links")
    return labels


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) with another node."""
    return merged(None, links)

"""Connected components of a graph given by its links.

Rounds of the large-star and small-star steps (Kiveris and others: Connected
components in MapReduce and beyond, SoCC 2014): each node's larger neighbours, then its
smaller ones, are hung on its smallest neighbour, until every link goes from a node
straight to the smallest node of its component. The number of rounds grows with the
logarithm of the number of nodes at worst in practice. Each round is a partial minimum
per node and a join that the planner may split at hot nodes; a round's links are written
to the shared folder, so a lost executor costs a retry of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.session import materialize


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """links: (u, v) with u > v, distinct. One step; same form."""
    if larger:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    if larger:
        moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def _mark(links: DataFrame) -> tuple:
    """Number of links and the sum of their hashes: tells whether a round changed anything."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in a link; component is its smallest node.

    `links` has the columns u and v; links of a node with itself or null are ignored.
    Nodes without a link are not returned: they are their own component.
    """
    ordered = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = materialize(ordered.distinct(), "links")
    mark = _mark(current)
    while mark[0]:
        current = materialize(_star(_star(current, larger=True), larger=False), "links")
        mark, last = _mark(current), mark
        if mark == last:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

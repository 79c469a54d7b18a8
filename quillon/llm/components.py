"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillon.session import materialize


def _edges(df: DataFrame) -> DataFrame:
    return df.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node (all, or the smaller ones) to the least of them.

    The minimum is a combined aggregate; it is written before the join, so that adaptive
    execution can split the rows of a node with very many neighbours.
    """
    sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = materialize(sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    met = sides.join(least, "u")
    if large:
        new = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return materialize(_edges(new), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of ``links`` (long columns u, v) with the least node it reaches.

    Alternates large and small star contraction until nothing changes, which takes a number
    of rounds logarithmic in the size of a component. A round writes its links once; no
    node's neighbours are gathered. Links of a node with itself, repeated and reversed links
    count once; links with a null end are left out; an empty table gives no rows.
    """
    nodes = links.where("u IS NOT NULL AND v IS NOT NULL").select("u", "v")
    edges = materialize(_edges(nodes), "links")
    before = None
    while True:
        edges = _star(_star(edges, True), False)
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
    alone = nodes.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))

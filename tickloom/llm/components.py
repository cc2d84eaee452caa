"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import written


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """Every node's neighbours are tied to the smallest of them or the node itself.

    ``both``: the neighbours that are larger than the node; else the node and the smaller ones.
    """
    if both:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # from the larger to the smaller
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # the smallest neighbour is a partial aggregate, so a node with many neighbours is joined, not gathered
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    tied = edges.join(least, "a")
    if both:
        found = tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return found.filter(F.col("a") != F.col("b")).distinct()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest node each node is connected with: columns node, root; edges are columns a, b.

    Alternates ties to the smallest neighbour among all and among the smaller ones until nothing changes,
    which takes a number of rounds that grows with the logarithm of the nodes. Each round's edges are
    written to the shared folder, so nothing is computed twice and lost executors cost one round.
    Rows with a null and loops are left out; an empty table gives no rows. Roots are rows too.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    edges, state = written(edges, "edges"), None
    for _ in range(most_rounds):
        edges = written(_stars(_stars(edges, True), False), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components are not stable after {most_rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())

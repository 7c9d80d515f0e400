"""Connected components of an edge table, by alternating large-star and small-star
steps (a logarithmic number of rounds, also for long chains). Every round is
written to the shared checkpoint folder; nothing but three numbers per round comes
to the driver. A vertex with very many neighbours is a partial minimum and a join
that Spark can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). Large: larger neighbours of a vertex move to its smallest
    one. Small: the vertex and its smaller neighbours do."""
    seen = (edges.union(edges.select("b", "a")) if large else edges).toDF("u", "v")
    low = seen.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
    if large:
        low = low.select("_u", F.least("_u", "m").alias("m"))
        moved = seen.where("v > u").join(low, F.col("u") == F.col("_u")).select("v", "m")
    else:
        moved = seen.join(low, F.col("u") == F.col("_u")).select("v", "m").union(low)
    return moved.toDF("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node with an edge to another.
    ``edges``: two columns of one type; order, repeats and loops don't matter."""
    a, b = edges.columns
    now = stored(edges.toDF("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    while True:
        last, mark = mark, tuple(now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
            F.bit_xor(F.xxhash64("b", "a"))).first())
        if mark == last or not mark[0]:
            break
        now = stored(_star(_star(now, True), False), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())

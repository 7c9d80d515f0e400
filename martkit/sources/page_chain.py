"""The chain of landed API pages, followed by their ``next`` cursors.

A sum of rows shows that something is missing; the chain shows what. Pointer doubling
follows all cursors at once: after each join a page points twice as far ahead, so a
chain of n pages takes log2(n) joins, whatever its order, holes and cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import stored

LINK = StructType([StructField("url", StringType()), StructField("info", StructType(
    [StructField("count", LongType()), StructField("next", StringType())]))])


def landed_links(spark: SparkSession, path: str) -> DataFrame:
    """``url, next`` of every landed page: the cursor it was fetched by and the one it
    names (pages landed with their ``url``)."""
    return spark.read.schema(LINK).option("mode", "FAILFAST").json(path).select("url", F.col("info.next").alias("next"))


def follow(links: DataFrame) -> DataFrame:
    """Per landed cursor: ``copies`` (how often it was landed), ``next`` (of copies that
    differ, the least), ``to_end`` (pages until the chain ends, itself included; NULL if
    it never does) and ``last`` (the last landed page; NULL in or before a cycle)."""
    pages = stored(links.where("url IS NOT NULL").groupBy("url").agg(
        F.count(F.lit(1)).alias("copies"), F.min("next").alias("next"),
        F.countDistinct("next").alias("nexts")), "pages")
    known = pages.select(F.col("url").alias("_u"))
    jump = stored(pages.join(known, F.col("next") == F.col("_u"), "left").select(
        "url", F.col("_u").alias("ahead"), F.lit(1).cast("long").alias("steps"), F.col("url").alias("last")), "page-jumps")
    n, reach = pages.count(), 1
    while reach < n and not jump.where("ahead IS NOT NULL").isEmpty():
        # a page's jump is followed by the jump of the page it leads to
        more = jump.select(F.col("url").alias("_u"), F.col("ahead").alias("_a"), F.col("steps").alias("_s"),
                           F.col("last").alias("_l"))
        jump = stored(jump.join(more, F.col("ahead") == F.col("_u"), "left").select(
            "url", F.col("_a").alias("ahead"), (F.col("steps") + F.coalesce("_s", F.lit(0))).alias("steps"),
            F.coalesce("_l", "last").alias("last")), "page-jumps")
        reach *= 2
    ends = F.col("ahead").isNull()
    out = pages.withColumnRenamed("url", "_url").join(jump, F.col("_url") == F.col("url"))
    return out.select("url", "copies", "next", "nexts", F.when(ends, F.col("steps")).alias("to_end"),
                      F.when(ends, F.col("last")).alias("last"))


def chain_findings(links: DataFrame, start: str) -> DataFrame:
    """What is wrong with landed pages, ``finding, url``: ``missing`` (a cursor that some
    page names, or ``start``, was not landed), ``doubled`` (landed more than once),
    ``differing`` (its copies name different next cursors), ``unreferenced`` (no page
    names it and it is not the start: what came before it is missing) and ``endless``
    (its chain never ends). No rows: one whole chain from ``start``."""
    pages = stored(follow(links), "page-chain")
    named = links.where("next IS NOT NULL").select(F.col("next").alias("url")).distinct()
    wanted = named.union(links.sparkSession.range(1).select(F.lit(start).alias("url"))).distinct()
    found = [("missing", wanted.join(pages, "url", "left_anti").select("url")),
             ("doubled", pages.where("copies > 1").select("url")),
             ("differing", pages.where("nexts > 1").select("url")),
             ("unreferenced", pages.join(wanted, "url", "left_anti").select("url")),
             ("endless", pages.where("to_end IS NULL").select("url"))]
    out = None
    for name, rows in found:
        part = rows.select(F.lit(name).alias("finding"), "url")
        out = part if out is None else out.unionByName(part)
    return out

"""Window and ordered-series queries (W*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import cents
from ..operators.ordered import (dense_rank_global, gaps, local_minima, pair_sum,
                                 pointer_compose, running_sum, runs, top_n_by_group,
                                 window_min)
from ..sources.tables import Tables
from .registry import query


@query("global_dense_rank", """
SELECT p_partkey, p_retailprice, dense_rank() OVER (ORDER BY p_retailprice DESC) AS rank
FROM part
""", "W1")
def global_dense_rank(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select("p_partkey", "p_retailprice")
    return dense_rank_global(p, "p_retailprice", "rank")


@query("rank_top_one", """
SELECT o_custkey, o_orderkey, o_totalprice, rnk FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS INTEGER) AS rnk
  FROM orders) WHERE rnk = 1
""", "W2")
def rank_top_one(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_by_group(o, "o_custkey", "o_totalprice", 1, "rank")


@query("dense_rank_top_n", """
SELECT p_brand, p_partkey, p_retailprice, rnk FROM (
  SELECT p_brand, p_partkey, p_retailprice,
         CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS INTEGER) AS rnk
  FROM part) WHERE rnk <= 3
""", "W3")
def dense_rank_top_n(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select("p_brand", "p_partkey", "p_retailprice")
    return top_n_by_group(p, "p_brand", "p_retailprice", 3, "dense_rank")


@query("rank_top_n", """
SELECT o_custkey, o_orderkey, o_totalprice, rnk FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS INTEGER) AS rnk
  FROM orders) WHERE rnk <= 3
""", "W2")
def rank_top_n(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_by_group(o, "o_custkey", "o_totalprice", 3, "rank")


@query("lag_lead_runs", """
WITH t AS (
  SELECT user_id, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
  FROM events)
SELECT DISTINCT user_id, event_type FROM t WHERE event_type = prev AND event_type = nxt
""", "W4")
def lag_lead_runs(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_type", "ts", "event_id")
    return runs(e, "user_id", ["ts", "event_id"], "event_type")


@query("window_min", """
SELECT event_id, user_id, ts, min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events
""", "W5")
def q_window_min(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return window_min(e, "user_id", "ts", "first_ts")


@query("running_sum", """
SELECT event_id, user_id, ts,
       sum(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT))
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) :: BIGINT
         AS running_cents
FROM events
""", "W6")
def q_running_sum(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("event_id", "user_id", "ts", cents("value").alias("c"))
    return running_sum(e, "user_id", ["ts", "event_id"], "c", "running_cents").drop("c")


@query("local_minimum", """
WITH t AS (
  SELECT user_id, event_id, ts, value,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
         lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
  FROM events),
h AS (SELECT * FROM t WHERE (prev IS NULL OR value < prev) AND (nxt IS NULL OR value < nxt))
SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts,
       arg_min(value, (ts, event_id)) AS value
FROM h GROUP BY user_id
""", "W7")
def local_minimum(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_id", "ts", "value")
    return local_minima(e, "user_id", ["ts", "event_id"], "value", first=True)


@query("local_minima_all", """
WITH t AS (
  SELECT user_id, event_id, ts, value,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
         lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
  FROM events)
SELECT user_id, event_id, ts, value FROM t
WHERE (prev IS NULL OR value < prev) AND (nxt IS NULL OR value < nxt)
""", "W7")
def local_minima_all(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_id", "ts", "value")
    return local_minima(e, "user_id", ["ts", "event_id"], "value", first=False)


@query("gap_detection", """
WITH k AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi
           FROM lineitem GROUP BY 1),
c AS (SELECT k.l_orderkey, CAST(g.i AS INTEGER) AS missing
      FROM k, generate_series(1, k.hi) g(i))
SELECT c.l_orderkey, c.missing FROM c
ANTI JOIN lineitem l ON l.l_orderkey = c.l_orderkey AND l.l_linenumber = c.missing
""", "W8")
def gap_detection(spark: SparkSession, d: str) -> DataFrame:
    """Missing line numbers in [1, max] per order."""
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber")
    return gaps(li, "l_orderkey", "l_linenumber", lo=1, out="missing")


PAIR_TARGET = 50


@query("pair_sum_match", f"""
WITH r AS (SELECT l_orderkey, l_quantity, l_linenumber, l_partkey, l_suppkey FROM lineitem),
m AS (SELECT a.l_orderkey,
             a.l_linenumber AS i_line, a.l_partkey AS i_part, a.l_suppkey AS i_supp,
             b.l_linenumber AS j_line, b.l_partkey AS j_part, b.l_suppkey AS j_supp
      FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey
       AND a.l_quantity + b.l_quantity = {PAIR_TARGET}
       AND (a.l_linenumber, a.l_partkey, a.l_suppkey) < (b.l_linenumber, b.l_partkey, b.l_suppkey))
SELECT l_orderkey, i_line, i_part, i_supp, j_line, j_part, j_supp FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY i_line, i_part, i_supp, j_line, j_part, j_supp) AS rn FROM m) WHERE rn = 1
""", "W9")
def pair_sum_match(spark: SparkSession, d: str) -> DataFrame:
    """First (i < j) pair of lines per order whose quantities add up to 50
    (the oracle enumerates pairs; the operator does not)."""
    li = Tables(spark, d).lineitem
    p = pair_sum(li, "l_orderkey", "l_quantity", ["l_linenumber", "l_partkey", "l_suppkey"],
                 PAIR_TARGET)
    return p.select("l_orderkey",
                    F.col("i.l_linenumber").alias("i_line"), F.col("i.l_partkey").alias("i_part"),
                    F.col("i.l_suppkey").alias("i_supp"),
                    F.col("j.l_linenumber").alias("j_line"), F.col("j.l_partkey").alias("j_part"),
                    F.col("j.l_suppkey").alias("j_supp"))


@query("pointer_compose", """
WITH m AS (SELECT p_partkey AS i, (7 * p_partkey + 3) % (SELECT count(*) FROM part) AS v FROM part)
SELECT a.i, a.v, b.v AS composed FROM m a LEFT JOIN m b ON a.v = b.i
""", "W10")
def q_pointer_compose(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    n = p.select(F.count(F.lit(1))).scalar()
    m = p.select(F.col("p_partkey").alias("i"), ((F.col("p_partkey") * 7 + 3) % n).alias("v"))
    return pointer_compose(m, "i", "v", "composed")

"""Aggregation queries (A*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import cents, ratio_half_up, seconds_between
from ..operators.aggs import (common_prefix, cube_bitmaps, distinct_bitmaps, divisible_difference,
                              entity_rollup, latest_by_key, merge_bitmaps, money_sum,
                              next_day_retention, summing_fold, user_price_report)
from ..session import stored
from ..sources.tables import TABLES, Tables
from ..sources.tables_io import footer_scan, footer_stats
from .registry import query



@query("table_count", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES), "A1")
def table_count(spark: SparkSession, d: str) -> DataFrame:
    """From the footers: no data page is read."""
    parts = [footer_stats(footer_scan(spark, f"{d.rstrip('/')}/{n}.parquet"))
             .select(F.lit(n).alias("table_name"), F.col("n_rows").alias("row_count")) for n in TABLES]
    return reduce(DataFrame.unionByName, parts)


@query("count_distinct", """
SELECT count(DISTINCT o.o_custkey) AS n_customers
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE date_diff('second', o.o_orderdate, l.l_shipdate) > 90 * 86400
""", "A2")
def count_distinct(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    late = j.where(seconds_between("o_orderdate", "l_shipdate") > 90 * 86400)
    return late.agg(F.countDistinct("o_custkey").alias("n_customers"))


@query("conditional_sum", """
SELECT l_suppkey, count(*) AS total_lines,
       sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) :: BIGINT AS returned_lines
FROM lineitem GROUP BY l_suppkey
""", "A3")
def conditional_sum(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem
    return li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long")
        .alias("returned_lines"))


@query("conditional_count_ratio", """
SELECT CAST(o_orderdate AS DATE) AS day,
       CASE WHEN count(*) = 0 THEN NULL ELSE
         ((count(*) FILTER (WHERE o_orderstatus <> 'F')) * 200 + count(*)) // (2 * count(*)) / 100.0
       END AS not_finished_rate
FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'
GROUP BY 1
""", "A4")
def conditional_count_ratio(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.where(F.col("o_orderdate").between(
        F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-03-31").cast("timestamp_ntz")))
    g = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(F.col("o_orderstatus") != "F", 1)).alias("_bad"))
    return g.select("day", ratio_half_up("_bad", "_n").alias("not_finished_rate"))


@query("sum_of_product", """
SELECT o.o_custkey,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2)))
            AS DOUBLE) AS spend
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_type = 'ECONOMY'
GROUP BY o.o_custkey
""", "A5")
def sum_of_product(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.part.where(F.col("p_type") == "ECONOMY"), F.col("l_partkey") == F.col("p_partkey")))
    prod = F.col("l_quantity").cast("decimal(18,2)") * F.col("p_retailprice").cast("decimal(18,2)")
    return j.groupBy("o_custkey").agg(F.sum(prod).cast("double").alias("spend"))


@query("avg_rounded", """
SELECT l_partkey,
       (sum(CAST(l_quantity AS BIGINT)) * 200 + count(*)) // (2 * count(*)) / 100.0 AS avg_qty
FROM lineitem GROUP BY l_partkey
""", "A6")
def avg_rounded(spark: SparkSession, d: str) -> DataFrame:
    """round(avg(quantity), 2), half-up, computed exactly from the integer sum
    and count (quantities are whole numbers)."""
    li = Tables(spark, d).lineitem
    g = li.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("_s"),
                                    F.count(F.lit(1)).alias("_n"))
    return g.select("l_partkey", ratio_half_up("_s", "_n").alias("avg_qty"))


@query("min_max_duration", """
SELECT o.o_custkey,
       date_diff('second', min(o.o_orderdate), min(l.l_shipdate)) AS span_sec,
       min(date_diff('second', o.o_orderdate, l.l_shipdate)) AS min_sec,
       max(date_diff('second', o.o_orderdate, l.l_shipdate)) AS max_sec
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_custkey
""", "A7")
def min_max_duration(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    dur = seconds_between("o_orderdate", "l_shipdate")
    return j.groupBy("o_custkey").agg(
        seconds_between(F.min("o_orderdate"), F.min("l_shipdate")).alias("span_sec"),
        F.min(dur).alias("min_sec"), F.max(dur).alias("max_sec"))


@query("any_value", """
SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS some_status FROM orders GROUP BY 1
""", "A8")
def any_value(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic 'any': the value of the smallest order key."""
    o = Tables(spark, d).orders
    return o.groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("some_status"))


@query("group_having", """
SELECT o_custkey, count(*) AS n_orders FROM orders
WHERE month(o_orderdate) = 8 GROUP BY o_custkey HAVING count(*) = 3
""", "A9")
def group_having(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.where(F.month("o_orderdate") == 8)
    return (o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
             .where(F.col("n_orders") == 3))


@query("group_as_distinct", "SELECT p_brand FROM part GROUP BY p_brand", "A10")
def group_as_distinct(spark: SparkSession, d: str) -> DataFrame:
    # DISTINCT is planned as a grouping aggregate (partial on each task)
    return Tables(spark, d).part.select("p_brand").distinct()


@query("named_multi_agg", """
SELECT o_custkey, min(o_totalprice) AS min_payment, max(o_totalprice) AS max_payment,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_payment
FROM orders GROUP BY o_custkey
""", "A12")
def named_multi_agg(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.groupBy("o_custkey").agg(F.min("o_totalprice").alias("min_payment"),
                                      F.max("o_totalprice").alias("max_payment"),
                                      money_sum("o_totalprice").alias("total_payment"))


@query("user_price_report", """
WITH s AS (SELECT l_suppkey, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt
           FROM lineitem GROUP BY 1, 2),
best AS (SELECT l_suppkey, arg_max(l_partkey, (amt, -l_partkey)) AS best_product FROM s GROUP BY 1),
st AS (SELECT l_suppkey, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
              (sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(*) * 100)
                // (2 * count(*) * 100) / 100.0 AS avg_price
       FROM lineitem GROUP BY 1)
SELECT st.*, best.best_product FROM st JOIN best USING (l_suppkey)
""", "A13")
def q_user_price_report(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem
    return user_price_report(li, "l_suppkey", "l_partkey", "l_extendedprice")


@query("next_day_retention", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY 1),
b AS (SELECT DISTINCT d.user_id FROM d JOIN f ON d.user_id = f.user_id
      AND d.day = f.first_day + INTERVAL 1 DAY)
SELECT ((SELECT count(*) FROM b) * 200 + (SELECT count(*) FROM f))
       // (2 * (SELECT count(*) FROM f)) / 100.0 AS fraction
""", "A14")
def q_next_day_retention(spark: SparkSession, d: str) -> DataFrame:
    return next_day_retention(Tables(spark, d).events, "user_id", "ts")


@query("first_event_date", """
SELECT user_id, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY 1
""", "A15")
def first_event_date(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return e.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_day"))


@query("domain_popularity", """
SELECT split_part(url, '/', 3) AS host, count(*) AS n_pages FROM pages
GROUP BY 1 ORDER BY n_pages DESC, host
""", "A16")
def domain_popularity(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).pages
    return (p.groupBy(F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
             .agg(F.count(F.lit(1)).alias("n_pages"))
             .orderBy(F.col("n_pages").desc(), "host"))


@query("entity_rollup", """
SELECT n.n_nationkey, n.n_name,
       COALESCE(c.n_customers, 0) AS n_customers, COALESCE(s.n_suppliers, 0) AS n_suppliers
FROM nation n
LEFT JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY 1) c
  ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1) s
  ON n.n_nationkey = s.s_nationkey
""", "A17")
def q_entity_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return entity_rollup(t.nation.select("n_nationkey", "n_name"), "n_nationkey",
                         {"n_customers": (t.customer, "c_nationkey"),
                          "n_suppliers": (t.supplier, "s_nationkey")})


@query("richest_entity", """
SELECT CAST(max(w) AS DOUBLE) AS max_wealth FROM
  (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS w FROM orders GROUP BY 1)
""", "A18")
def richest_entity(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    w = o.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("w"))
    return w.agg(F.max("w").cast("double").alias("max_wealth"))


@query("divisible_difference", """
SELECT sum(CASE WHEN CAST(l_quantity AS BIGINT) % 3 <> 0 THEN CAST(l_quantity AS BIGINT)
                ELSE -CAST(l_quantity AS BIGINT) END) :: BIGINT AS difference
FROM lineitem
""", "A19")
def q_divisible_difference(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select(F.col("l_quantity").cast("long").alias("q"))
    return divisible_difference(li, "q", 3)


@query("common_prefix", """
WITH m AS (SELECT c_nationkey, min(c_name) AS a, max(c_name) AS b FROM customer GROUP BY 1)
SELECT c_nationkey,
       COALESCE((SELECT substr(a, 1, max(i)) FROM range(1, least(length(a), length(b)) + 1) r(i)
                 WHERE substr(a, 1, i) = substr(b, 1, i)), '') AS prefix
FROM m
""", "A20")
def q_common_prefix(spark: SparkSession, d: str) -> DataFrame:
    return common_prefix(Tables(spark, d).customer, "c_nationkey", "c_name")


FOLD_SPLIT = "2024-01-15 00:00:00"


@query("summing_fold", """
SELECT event_type, count(*) AS n_events,
       sum(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)) :: BIGINT AS value_cents
FROM events GROUP BY 1
""", "A21")
def q_summing_fold(spark: SparkSession, d: str) -> DataFrame:
    """Fold two halves of the events (state before the split, delta after)."""
    e = Tables(spark, d).events
    cut = F.lit(FOLD_SPLIT).cast("timestamp_ntz")

    def part(df):
        return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                            F.sum(cents("value")).alias("value_cents"))
    return summing_fold(part(e.where(F.col("ts") < cut)), part(e.where(F.col("ts") >= cut)),
                        ["event_type"], ["n_events", "value_cents"])


@query("latest_by_key", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
""", "A22")
def q_latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by_key(e, ["user_id"], ["ts"], ["event_id"])


@query("distinct_bitmap_cube", """
SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS n_customers,
       CAST(GROUPING(o_orderstatus, o_orderpriority) AS INTEGER) AS gid
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""", "A2")
def distinct_bitmap_cube(spark: SparkSession, d: str) -> DataFrame:
    """Customers per cell of a cube, from stored bitmaps of two loads (orders before 1998
    and since) merged at the finest grain: the orders themselves are read once."""
    o = Tables(spark, d).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    dims = ["o_orderstatus", "o_orderpriority"]
    loads = [stored(distinct_bitmaps(o.where(c), dims, "o_custkey"), "customer-bitmaps")
             for c in (F.col("o_orderdate") < cut, ~(F.col("o_orderdate") < cut) | F.col("o_orderdate").isNull())]
    merged = stored(merge_bitmaps(reduce(DataFrame.unionByName, loads), dims), "customer-bitmaps")
    return cube_bitmaps(merged, dims, "n_customers")

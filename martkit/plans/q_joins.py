"""Join queries (J*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggs import money_sum
from ..operators.joins import (asof_left, cutoff_left, not_in, or_join, parent_left_join,
                                role_playing, valid_key_left_join)
from ..sources.json_docs import nest_lines_per_order, unnest_json
from ..sources.tables import Tables
from .registry import query


@query("inner_join_chain", """
SELECT c.c_custkey, o.o_orderkey, l.l_linenumber, l.l_partkey, p.p_name, l.l_quantity
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
""", "J1")
def inner_join_chain(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    c = t.customer.select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = t.part.select("p_partkey", "p_name")
    return (c.join(o, c.c_custkey == o.o_custkey)
             .join(li, o.o_orderkey == li.l_orderkey)
             .join(p, li.l_partkey == p.p_partkey)
             .select("c_custkey", "o_orderkey", "l_linenumber", "l_partkey", "p_name",
                     "l_quantity"))


@query("left_join", """
SELECT o.o_orderkey, l.l_linenumber, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""", "J2")
def left_join(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return parent_left_join(o, li, "o_orderkey", "l_orderkey").drop("l_orderkey")


@query("multi_key_left_join", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, k.n_copies
FROM lineitem l LEFT JOIN k ON l.l_orderkey = k.l_orderkey AND l.l_linenumber = k.l_linenumber
""", "J3")
def multi_key_left_join(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    k = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_copies"))
    return li.join(k, ["l_orderkey", "l_linenumber"], "left")


@query("role_playing_join", """
SELECT cn.n_name AS cust_nation, sn.n_name AS supp_nation, count(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY 1, 2
""", "J4")
def role_playing_join(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    f = (t.lineitem.select("l_orderkey", "l_suppkey")
         .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    f = role_playing(f, t.nation.select("n_nationkey", "n_name"), "n_nationkey",
                     {"cust_": "c_nationkey", "supp_": "s_nationkey"}, how="inner")
    return (f.groupBy(F.col("cust_n_name").alias("cust_nation"),
                      F.col("supp_n_name").alias("supp_nation"))
             .agg(F.count(F.lit(1)).alias("n_lines")))


@query("self_join_compare", """
SELECT c.p_partkey, c.p_retailprice, p.p_partkey AS parent_key, p.p_retailprice AS parent_price
FROM part c JOIN part p ON p.p_partkey = c.p_partkey // 10
WHERE c.p_retailprice > p.p_retailprice
""", "J5")
def self_join_compare(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select("p_partkey", "p_retailprice")
    parent = p.select(F.col("p_partkey").alias("parent_key"),
                      F.col("p_retailprice").alias("parent_price"))
    child = p.withColumn("_pk", F.floor(F.col("p_partkey") / 10).cast("long"))
    return (child.join(parent, child._pk == parent.parent_key)
                 .where(F.col("p_retailprice") > F.col("parent_price"))
                 .drop("_pk"))


@query("left_anti_join", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL
""", "J6")
def left_anti_join(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return (t.orders.select("o_orderkey", "o_custkey")
             .join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"),
                   "left_anti"))


@query("null_aware_anti_join", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""", "J7")
def null_aware_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """NOT IN twice, with SQL's NULL semantics, as plain equi anti-joins
    (``not_in``): no nested-loop fallback when a subquery is too big to
    broadcast."""
    t = Tables(spark, d)
    c = t.customer
    o = t.orders.select("o_orderkey", "o_custkey")
    o = not_in(o, "o_custkey", c.where(F.col("c_mktsegment") == "BUILDING"), "c_custkey")
    return not_in(o, "o_custkey", c.where(F.col("c_acctbal") < 0), "c_custkey")


@query("disjunctive_join", """
SELECT DISTINCT l.l_orderkey, p.p_partkey FROM lineitem l
JOIN part p ON p.p_partkey = l.l_partkey OR p.p_partkey = l.l_suppkey
""", "J8")
def disjunctive_join(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return or_join(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey"),
                   t.part.select("p_partkey"),
                   [("l_partkey", "p_partkey"), ("l_suppkey", "p_partkey")],
                   ["l_orderkey", "p_partkey"])


DAILY_SQL = """
SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1
"""


def daily_value(t: Tables) -> DataFrame:
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(money_sum("value").alias("total"))


@query("date_shift_self_join", f"""
WITH d AS ({DAILY_SQL})
SELECT a.day, a.total, b.total AS prev_total
FROM d a JOIN d b ON a.day = b.day + INTERVAL 1 DAY
WHERE a.total > b.total
""", "J9")
def date_shift_self_join(spark: SparkSession, d: str) -> DataFrame:
    day = daily_value(Tables(spark, d))
    prev = day.select(F.date_add("day", 1).alias("day"), F.col("total").alias("prev_total"))
    return day.join(prev, "day").where(F.col("total") > F.col("prev_total"))


@query("cutoff_join", """
WITH cut AS (SELECT user_id, min(ts) AS cut FROM events
             WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-01' GROUP BY 1)
SELECT DISTINCT e.user_id, e.event_type, CAST(e.ts AS DATE) AS day
FROM events e LEFT JOIN cut c ON e.user_id = c.user_id
WHERE c.cut IS NULL OR e.ts < c.cut
""", "J10")
def cutoff_join(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    cut = e.where((F.col("event_type") == "error")
                  & (F.to_date("ts") == F.lit("2024-01-01").cast("date")))
    left = e.select("user_id", "event_type", "ts")
    kept = cutoff_left(left, cut.select("user_id", F.col("ts").alias("cut_ts")),
                       "user_id", "ts", "cut_ts")
    return kept.select("user_id", "event_type", F.to_date("ts").alias("day")).distinct()


JUNK_KEY_SQL = """
CASE WHEN l_linenumber = 1 THEN 'x' || CAST(l_orderkey AS VARCHAR)
     ELSE CAST(l_orderkey AS VARCHAR) END
"""


@query("safe_cast_key_join", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {JUNK_KEY_SQL} AS key_text
           FROM lineitem)
SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.key_text, o.o_orderstatus
FROM t LEFT JOIN orders o ON TRY_CAST(t.key_text AS BIGINT) = o.o_orderkey
""", "J11")
def safe_cast_key_join(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           F.expr(JUNK_KEY_SQL.replace("VARCHAR", "STRING")).alias("key_text"))
    li = li.withColumn("_k", F.col("key_text").try_cast("bigint"))
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return valid_key_left_join(li, o, "_k", "o_orderkey").drop("_k", "o_orderkey")


@query("asof_left_join", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS view_ts, event_id AS view_id FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts
""", "J12")
def asof_left_join(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    p = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = e.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return asof_left(p, v, "user_id", "ts", "view_ts", ["view_id", "view_ts"], tie="view_id")


def _purchases_views(spark: SparkSession, d: str):
    e = Tables(spark, d).events
    p = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = e.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return p, v


@query("asof_forward_join", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS view_ts, event_id AS view_id FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.view_ts
""", "J12")
def asof_forward_join(spark: SparkSession, d: str) -> DataFrame:
    """The first view at or after each purchase."""
    p, v = _purchases_views(spark, d)
    return asof_left(p, v, "user_id", "ts", "view_ts", ["view_id", "view_ts"], tie="view_id",
                     direction="forward")


@query("asof_nearest_join", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS view_ts, event_id AS view_id FROM events WHERE event_type = 'view'),
b AS (SELECT p.event_id, v.view_id AS b_id, v.view_ts AS b_ts
      FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts),
f AS (SELECT p.event_id, v.view_id AS f_id, v.view_ts AS f_ts
      FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.view_ts),
c AS (SELECT p.*, b.b_id, b.b_ts, f.f_id, f.f_ts,
             b.b_id IS NOT NULL AND (f.f_id IS NULL OR
               epoch_us(p.ts) - epoch_us(b.b_ts) <= epoch_us(f.f_ts) - epoch_us(p.ts)) AS use_b
      FROM p JOIN b USING (event_id) JOIN f USING (event_id))
SELECT event_id, user_id, ts, CASE WHEN use_b THEN b_id ELSE f_id END AS view_id,
       CASE WHEN use_b THEN b_ts ELSE f_ts END AS view_ts
FROM c
""", "J12")
def asof_nearest_join(spark: SparkSession, d: str) -> DataFrame:
    """The view nearest in time to each purchase, either side (the earlier on
    a tie) -- what the as-of task's prose asks for."""
    p, v = _purchases_views(spark, d)
    return asof_left(p, v, "user_id", "ts", "view_ts", ["view_id", "view_ts"], tie="view_id",
                     direction="nearest")


@query("lateral_unnest", """
SELECT l_orderkey, l_linenumber, CAST(1 AS INTEGER) AS n_flights FROM lineitem
""", "J13")
def lateral_unnest(spark: SparkSession, d: str) -> DataFrame:
    """One row per ticket; orders whose ticket array is empty drop out."""
    docs = nest_lines_per_order(Tables(spark, d))
    tickets = unnest_json(docs, "json_data", "tickets", keep=["book_ref"])
    return tickets.select(F.col("book_ref").alias("l_orderkey"),
                          F.col("linenumber").alias("l_linenumber"),
                          F.size("flights").alias("n_flights"))


@query("nested_unnest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
""", "J14")
def nested_unnest(spark: SparkSession, d: str) -> DataFrame:
    docs = nest_lines_per_order(Tables(spark, d))
    tickets = unnest_json(docs, "json_data", "tickets", keep=["book_ref"])
    flights = tickets.select("book_ref", "linenumber", F.explode("flights").alias("f"))
    return flights.select(F.col("book_ref").alias("l_orderkey"),
                          F.col("linenumber").alias("l_linenumber"),
                          F.col("f.partkey").alias("l_partkey"),
                          F.col("f.suppkey").alias("l_suppkey"),
                          F.col("f.quantity").alias("l_quantity"))


@query("fanout_join_count", """
SELECT CAST(month(o.o_orderdate) AS INTEGER) AS month, count(*) AS n_lines
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE year(o.o_orderdate) = 1997 AND l.l_returnflag = 'R'
GROUP BY 1 ORDER BY n_lines DESC, month
""", "J15")
def fanout_join_count(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    # a date range, which the scan can use, instead of a function of the date
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1997-01-01", "1998-01-01"))
    o = t.orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select("o_orderkey", "o_orderdate")
    li = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
             .groupBy(F.month("o_orderdate").cast("int").alias("month"))
             .agg(F.count(F.lit(1)).alias("n_lines"))
             .orderBy(F.col("n_lines").desc(), "month"))


@query("direct_report_count", """
SELECT c.c_custkey, c.c_name, k.n_orders
FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1 HAVING count(*) >= 5) k
JOIN customer c ON c.c_custkey = k.o_custkey
""", "J18")
def direct_report_count(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    k = (t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
          .where(F.col("n_orders") >= 5))
    return (k.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
             .select("c_custkey", "c_name", "n_orders"))

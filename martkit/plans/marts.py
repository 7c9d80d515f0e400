"""Marts: the wide fact table (J16), its cube report (A11) and the as-of
enriched event mart (J17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import money
from ..operators.aggs import cube_report, money_sum
from ..operators.joins import asof_probes, role_playing
from ..sources.tables import Tables
from .registry import query

MART_SINCE = "1997-01-01"
MART_STATUS = "F"


def wide_fact_mart(t: Tables, since: str = MART_SINCE, status: str = MART_STATUS) -> DataFrame:
    """Orders -> customer -> lineitem -> supplier (+ part if any), with the
    nation dimension joined once per role (J4), filtered (P5).

    The filters sit on the orders scan, so they are pushed into parquet; the
    big-big join (orders x lineitem) shuffles on the order key and everything
    else is left to AQE (broadcast under the measured threshold).
    """
    o = (t.orders.where((F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
                        & (F.col("o_orderstatus") == status))
         .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_discount",
                           "l_returnflag", "l_linestatus", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    p = t.part.select("p_partkey", "p_name", "p_type")
    n = t.nation.select("n_nationkey", "n_name")
    fact = (o.join(c, o.o_custkey == c.c_custkey)
             .join(li, o.o_orderkey == li.l_orderkey)
             .join(s, li.l_suppkey == s.s_suppkey)
             .join(p, li.l_partkey == p.p_partkey, "left"))
    fact = role_playing(fact, n, "n_nationkey", {"cust_": "c_nationkey", "supp_": "s_nationkey"},
                        how="inner")
    return fact.select(
        "o_orderkey", "o_custkey", "c_name", F.col("cust_n_name").alias("cust_nation"),
        "l_linenumber", "l_partkey", "l_suppkey", "s_name",
        F.col("supp_n_name").alias("supp_nation"), "p_name", "p_type",
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
        "l_shipdate", "o_orderdate", "o_orderstatus", "o_totalprice")


WIDE_FACT_SQL = f"""
SELECT o.o_orderkey, o.o_custkey, c.c_name, cn.n_name AS cust_nation,
       l.l_linenumber, l.l_partkey, l.l_suppkey, s.s_name, sn.n_name AS supp_nation,
       p.p_name, p.p_type, l.l_quantity, l.l_extendedprice, l.l_discount,
       l.l_returnflag, l.l_linestatus, l.l_shipdate, o.o_orderdate, o.o_orderstatus,
       o.o_totalprice
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
WHERE o.o_orderdate >= TIMESTAMP '{MART_SINCE}' AND o.o_orderstatus = '{MART_STATUS}'
"""


@query("wide_fact_mart", WIDE_FACT_SQL, "J16")
def q_wide_fact_mart(spark: SparkSession, d: str) -> DataFrame:
    return wide_fact_mart(Tables(spark, d))


def mart_report(mart: DataFrame) -> DataFrame:
    """A11 on the mart: revenue and counts for every combination of customer
    nation, supplier nation and return flag, with subtotals."""
    rep = cube_report(mart, ["cust_nation", "supp_nation", "l_returnflag"],
                      {"total_revenue": money("l_extendedprice")}, count="line_count")
    return rep.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("mart_cube_report", f"""
WITH m AS ({WIDE_FACT_SQL})
SELECT cust_nation, supp_nation, l_returnflag,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       COUNT(*) AS line_count,
       CAST(GROUPING(cust_nation, supp_nation, l_returnflag) AS INTEGER) AS gid
FROM m GROUP BY CUBE (cust_nation, supp_nation, l_returnflag)
""", "A11")
def q_mart_cube_report(spark: SparkSession, d: str) -> DataFrame:
    return mart_report(wide_fact_mart(Tables(spark, d)))


@query("cube_report", """
SELECT l.l_returnflag, l.l_linestatus, p.p_type,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_qty,
       COUNT(*) AS row_count, COUNT(DISTINCT l.l_orderkey) AS n_orders,
       CAST(GROUPING(l.l_returnflag, l.l_linestatus, p.p_type) AS INTEGER) AS gid
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY CUBE (l.l_returnflag, l.l_linestatus, p.p_type)
""", "A11")
def q_cube_report(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return cube_report(j, ["l_returnflag", "l_linestatus", "p_type"],
                       {"total_price": money("l_extendedprice"), "total_qty": money("l_quantity")},
                       distinct={"n_orders": "l_orderkey"}) \
        .withColumns({c: F.col(c).cast("double") for c in ("total_price", "total_qty")})


# --------------------------------------------------------------------------
# Marts with as-of probes
# --------------------------------------------------------------------------
def nation_days(t: Tables) -> DataFrame:
    """A time series by place: what each nation's customers ordered on a day."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("nation"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .groupBy("nation", F.col("o_orderdate").alias("day_ts"))
            .agg(F.count(F.lit(1)).alias("day_orders"), money_sum("o_totalprice").alias("day_total")))


@query("weather_fact_mart", f"""
WITH fm AS ({WIDE_FACT_SQL}),
w AS (SELECT n.n_name AS nation, o.o_orderdate AS day_ts, count(*) AS day_orders,
             CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS day_total
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2),
a AS (SELECT fm.*, w.day_ts AS dep_day_ts, w.day_orders AS dep_day_orders, w.day_total AS dep_day_total
      FROM fm ASOF LEFT JOIN w ON fm.cust_nation = w.nation AND fm.o_orderdate >= w.day_ts)
SELECT a.*, w.day_ts AS arr_day_ts, w.day_orders AS arr_day_orders, w.day_total AS arr_day_total
FROM a ASOF LEFT JOIN w ON a.supp_nation = w.nation AND a.l_shipdate >= w.day_ts
WHERE o_orderstatus = 'F' AND o_orderdate IS NOT NULL AND l_shipdate IS NOT NULL
  AND o_orderdate > TIMESTAMP '1970-01-01' AND l_shipdate > TIMESTAMP '1970-01-01'
""", "J17")
def q_weather_fact_mart(spark: SparkSession, d: str) -> DataFrame:
    """The wide mart (J16) enriched twice from one series by place and time: at the
    customer's nation when ordered, and at the supplier's nation when shipped."""
    t = Tables(spark, d)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    mart = wide_fact_mart(t).where(
        (F.col("o_orderstatus") == "F") & F.col("o_orderdate").isNotNull() & F.col("l_shipdate").isNotNull()
        & (F.col("o_orderdate") > epoch) & (F.col("l_shipdate") > epoch))
    cols = ["day_ts", "day_orders", "day_total"]
    return asof_probes(mart, nation_days(t), {"dep_": ("cust_nation", "o_orderdate", None, cols),
                                              "arr_": ("supp_nation", "l_shipdate", None, cols)},
                       right_by="nation", right_ts="day_ts")


@query("event_probe_mart", """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS view_ts, event_id AS view_id, value AS view_value
      FROM events WHERE event_type = 'view'),
a AS (SELECT p.*, v.view_id, v.view_ts, v.view_value
      FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts)
SELECT a.*, v.view_id AS h1_view_id, v.view_ts AS h1_view_ts
FROM a ASOF LEFT JOIN v ON a.user_id = v.user_id AND a.ts + INTERVAL 1 HOUR >= v.view_ts
""", "J17")
def q_event_probe_mart(spark: SparkSession, d: str) -> DataFrame:
    """Purchases with the user's latest view at the purchase and one hour later."""
    ev = Tables(spark, d).events
    purchases = ev.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", "value")
    views = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"),
        F.col("value").alias("view_value"))
    return asof_probes(purchases, views, {
        "": ("user_id", "ts", None, ["view_id", "view_ts", "view_value"]),
        "h1_": ("user_id", "ts", F.expr("INTERVAL 1 HOUR"), ["view_id", "view_ts"])},
        right_by="user_id", right_ts="view_ts", tie="view_id")

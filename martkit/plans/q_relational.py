"""Projections, predicates, schema operations (P*) and sorts/limits (T*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import parent_left_join, prefix
from ..operators.ordered import dense_id, positional_join
from ..operators.quality import (as_text, assert_domain, check, domain, evolve,
                                 typed_view, unique, validate)
from ..operators.upsert import extend_key_map, with_serial_id
from ..session import stored
from ..sources.tables import Tables
from .registry import query


@query("prefixed_dimension", """
SELECT c.c_custkey, c.c_name, n.n_nationkey AS cust_n_nationkey, n.n_name AS cust_n_name,
       n.n_regionkey AS cust_n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""", "P1")
def prefixed_dimension(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    n = prefix(t.nation, "cust_")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return c.join(n, c.c_nationkey == n.cust_n_nationkey).drop("c_nationkey")


ORDERS_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
                "o_orderpriority": "string"}


@query("typed_view", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
""", "P2")
def q_typed_view(spark: SparkSession, d: str) -> DataFrame:
    raw = as_text(Tables(spark, d).orders)
    raw.createOrReplaceTempView("orders_raw")
    return typed_view(spark.table("orders_raw"), ORDERS_TYPES)


@query("safe_cast", """
SELECT p_partkey,
       TRY_CAST(split_part(p_name, ' ', 1) AS INTEGER) AS name_num,
       TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_num
FROM part
""", "P3")
def safe_cast(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    return p.select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(1)).try_cast("int").alias("name_num"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_num"))


EPOCH = "1970-01-01 00:00:00"


@query("sentinel_coalesce", f"""
SELECT o.o_orderkey, l.l_linenumber,
       COALESCE(l.l_shipdate, TIMESTAMP '{EPOCH}') AS ship_ts,
       COALESCE(l.l_shipdate, TIMESTAMP '{EPOCH}') = TIMESTAMP '{EPOCH}' AS is_sentinel
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""", "P4")
def sentinel_coalesce(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = parent_left_join(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    ship = F.coalesce(F.col("l_shipdate"), epoch)
    return j.select("o_orderkey", "l_linenumber", ship.alias("ship_ts"),
                    (ship == epoch).alias("is_sentinel"))


@query("filter_conjunction", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_shipdate
FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 10 AND l_discount >= 0.02 AND l_discount <= 0.08
  AND l_shipdate < TIMESTAMP '1999-01-01 00:00:00' AND l_tax IS NOT NULL
""", "P5")
def filter_conjunction(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem
    return (li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 10)
                     & (F.col("l_discount") >= 0.02) & (F.col("l_discount") <= 0.08)
                     & (F.col("l_shipdate") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
                     & F.col("l_tax").isNotNull())
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                      "l_shipdate"))


@query("filter_between", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-03'
""", "P6")
def filter_between(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return (o.where(F.to_date("o_orderdate").between(F.lit("1996-01-01").cast("date"),
                                                     F.lit("1996-01-03").cast("date")))
             .select("o_orderkey", "o_custkey", "o_orderdate"))


@query("schema_evolve", """
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE), o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
""", "P7")
def schema_evolve(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    old = o.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    new = o.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_custkey", "o_totalprice",
                                                     "o_orderpriority")
    out = evolve([old, new], casts={"o_totalprice": "decimal(12,2)"})
    return out.select("o_orderkey", "o_custkey",
                      F.col("o_totalprice").cast("double").alias("o_totalprice"),
                      "o_orderpriority")


@query("surrogate_key", """
SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS id FROM part
""", "P8")
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select("p_partkey", "p_name")
    return dense_id(p, ["p_partkey"], "id")


@query("serial_id_across_loads", """
WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
a AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS id FROM f),
b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
      AND o_custkey NOT IN (SELECT o_custkey FROM f)),
m AS (SELECT o_custkey, id FROM a UNION ALL
      SELECT o_custkey, (SELECT count(*) FROM f) + row_number() OVER (ORDER BY o_custkey) FROM b)
SELECT o.o_orderkey, o.o_custkey, m.id AS customer_id FROM orders o LEFT JOIN m USING (o_custkey)
""", "P8")
def serial_id_across_loads(spark: SparkSession, d: str) -> DataFrame:
    """Customers numbered by three loads of orders: those before 1996, all of them (known
    customers keep their number), and the first ones again (nothing new)."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    first = o.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    ids = stored(o.limit(0).select("o_custkey", F.lit(0).cast("long").alias("customer_id")), "customer-ids")
    for load in (first, o, first):
        ids = stored(extend_key_map(ids, load, "o_custkey", "customer_id"), "customer-ids")
    return with_serial_id(o.select("o_orderkey", "o_custkey"), ids, "o_custkey", "customer_id")


LINE_RULES_SQL = """
WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_discount,
       'discount_le_5pct' AS rule
FROM lineitem l WHERE NOT COALESCE(l.l_discount <= 0.05, TRUE)
UNION ALL
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_discount, 'line_key_unique'
FROM lineitem l SEMI JOIN d ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
"""


def _line_rules(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
    return validate(li, [check("discount_le_5pct", F.col("l_discount") <= 0.05),
                         unique("line_key_unique", "l_orderkey", "l_linenumber")])


@query("constraint_check", LINE_RULES_SQL, "P9")
def constraint_check(spark: SparkSession, d: str) -> DataFrame:
    return _line_rules(Tables(spark, d))[1]


@query("constraint_check_good", """
WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT l.l_returnflag, count(*) AS good_rows
FROM lineitem l ANTI JOIN d ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
WHERE COALESCE(l.l_discount <= 0.05, TRUE)
GROUP BY l.l_returnflag
""", "P9")
def constraint_check_good(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_discount",
                                          "l_returnflag")
    good, _ = validate(li, [check("discount_le_5pct", F.col("l_discount") <= 0.05),
                            unique("line_key_unique", "l_orderkey", "l_linenumber")])
    return good.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("good_rows"))


@query("vector_filter", """
SELECT s_suppkey, s_acctbal + 1 AS bal_plus_one FROM supplier WHERE s_acctbal + 1 > 5000
""", "P10")
def vector_filter(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).supplier.withColumn("bal_plus_one", F.col("s_acctbal") + 1)
    return s.where(F.col("bal_plus_one") > 5000).select("s_suppkey", "bal_plus_one")


@query("enum_domain_check", """
SELECT o_orderkey, o_orderstatus, 'status_in_OF' AS rule FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F')
""", "P11")
def enum_domain_check(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return validate(o, [domain("status_in_OF", "o_orderstatus", ["O", "F"])])[1]


@query("enum_domain_assert", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority
""", "P11")
def enum_domain_assert(spark: SparkSession, d: str) -> DataFrame:
    """Fail-fast form: every priority is in the declared set, so no error."""
    o = Tables(spark, d).orders
    allowed = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return (o.select(assert_domain("o_orderpriority", allowed).alias("o_orderpriority"))
             .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")))


@query("positional_column", """
WITH a AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS rn FROM part),
     b AS (SELECT s_acctbal, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier)
SELECT a.p_partkey, a.p_name, b.s_acctbal FROM a LEFT JOIN b ON a.rn = b.rn
""", "P12")
def positional_column(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return positional_join(t.part.select("p_partkey", "p_name"), ["p_partkey"],
                           t.supplier.select("s_suppkey", "s_acctbal"), ["s_suppkey"]
                           ).drop("s_suppkey")


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders", "P13")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).orders.select("o_custkey", "o_orderstatus").distinct()


@query("scalar_subquery_second_highest", """
SELECT max(p_retailprice) AS second_highest FROM part
WHERE p_retailprice < (SELECT max(p_retailprice) FROM part)
""", "P14")
def second_highest(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    top = p.select(F.max("p_retailprice")).scalar()
    return p.where(F.col("p_retailprice") < top).agg(F.max("p_retailprice").alias("second_highest"))


@query("weekday_gate", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events
FROM events WHERE isodow(ts) <= 5 GROUP BY 1
""", "P15")
def weekday_gate(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    return (e.where(F.weekday("ts") < 5)  # 0 = Monday
             .groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events")))


@query("cte_pipeline", """
WITH per_cust AS (
  SELECT o_custkey, count(*) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders GROUP BY o_custkey),
busy AS (SELECT * FROM per_cust WHERE n_orders >= 12)
SELECT c.c_custkey, c.c_name, b.n_orders, b.total
FROM busy b JOIN customer c ON c.c_custkey = b.o_custkey
""", "P16")
def cte_pipeline(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    per_cust = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    busy = per_cust.where(F.col("n_orders") >= 12)
    return (busy.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
                .select("c_custkey", "c_name", "n_orders", "total"))


# ------------------------------------------------------------------ T*
@query("multi_key_sort", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority ASC NULLS FIRST, o_totalprice DESC, o_orderkey
""", "T1")
def multi_key_sort(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return (o.select("o_orderkey", "o_orderpriority", "o_totalprice")
             .orderBy(F.col("o_orderpriority").asc_nulls_first(), F.col("o_totalprice").desc(),
                      "o_orderkey"))


@query("top_k_by_count", """
SELECT o_custkey, count(*) AS n_orders FROM orders
GROUP BY o_custkey ORDER BY n_orders DESC, o_custkey LIMIT 10
""", "T2")
def top_k_by_count(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    # partial counts per key, then TakeOrderedAndProject (a per-task top 10)
    return (o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
             .orderBy(F.col("n_orders").desc(), "o_custkey").limit(10))


@query("limit_offset", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5
""", "T3")
def limit_offset(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return (o.select("o_orderkey", "o_custkey", "o_totalprice")
             .orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(5).limit(10))

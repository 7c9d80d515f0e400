"""Scalar-function queries (F*) and SQL UDFs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import (digits_only, first_capital, is_palindrome, ntz_text,
                                last_word, parse_any, pct_change, readable_size, round_dec,
                                seconds_between, yyyymm)
from ..functions.sql_udfs import register_sql_udfs
from ..operators.joins import parent_left_join
from ..sources.tables import Tables
from .q_joins import DAILY_SQL, daily_value
from .registry import query


@query("date_parts", """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm,
       strftime(o_orderdate, '%Y%m') AS yyyymm_text
FROM orders
""", "F1")
def date_parts(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select("o_orderkey", F.month("o_orderdate").alias("month"),
                    F.extract(F.lit("YEAR"), "o_orderdate").cast("int").alias("year"),
                    yyyymm("o_orderdate").alias("yyyymm"),
                    ntz_text("o_orderdate", "yyyyMM").alias("yyyymm_text"))


@query("date_arithmetic", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       date_diff('second', o.o_orderdate, l.l_shipdate) AS ship_sec,
       CAST(o.o_orderdate AS DATE) + 1 AS next_day,
       o.o_orderdate + INTERVAL 1 DAY AS next_ts,
       date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) :: INTEGER AS ship_days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""", "F2")
def date_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    seconds_between("o_orderdate", "l_shipdate").alias("ship_sec"),
                    F.date_add(F.to_date("o_orderdate"), 1).alias("next_day"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("next_ts"),
                    F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("ship_days"))


# formats chosen by priority so every row has one shape; '4-' rows are junk
TEXT_SQL = """
CASE substr(o_orderpriority, 1, 1)
  WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN '3' THEN strftime(o_orderdate, '%Y%m%d %H:%M:%S')
  WHEN '5' THEN strftime(o_orderdate, '%Y/%m/%d %H:%M')
  ELSE 'n/a ' || CAST(o_orderkey AS VARCHAR) END
"""
SPARK_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd HH:mm:ss", "yyyy/MM/dd HH:mm"]


@query("timestamp_parse", f"""
WITH t AS (SELECT o_orderkey, {TEXT_SQL} AS txt FROM orders)
SELECT o_orderkey, txt,
       COALESCE(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%d/%m/%Y'),
                try_strptime(txt, '%Y%m%d %H:%M:%S'), try_strptime(txt, '%Y/%m/%d %H:%M')) AS parsed
FROM t
""", "F3")
def timestamp_parse(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    p = F.substring("o_orderpriority", 1, 1)
    ts = F.col("o_orderdate")
    txt = (F.when(p == "1", ntz_text(ts, "yyyy-MM-dd"))
            .when(p == "2", ntz_text(ts, "dd/MM/yyyy"))
            .when(p == "3", ntz_text(ts, "yyyyMMdd HH:mm:ss"))
            .when(p == "5", ntz_text(ts, "yyyy/MM/dd HH:mm"))
            .otherwise(F.concat(F.lit("n/a "), F.col("o_orderkey").cast("string"))))
    t = o.select("o_orderkey", txt.alias("txt"))
    return t.select("o_orderkey", "txt",
                    parse_any("txt", SPARK_FORMATS).alias("parsed"))


@query("type_conversion", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
       CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS key_back,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_num,
       CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_rank,
       CAST(o_totalprice AS FLOAT) AS price_f32,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price_text,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_text
FROM orders
""", "F4")
def type_conversion(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderkey").cast("string").cast("bigint").alias("key_back"),
        F.col("o_orderpriority").try_cast("int").alias("priority_num"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("priority_rank"),
        F.col("o_totalprice").cast("float").alias("price_f32"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("price_text"),
        F.to_date("o_orderdate").cast("string").alias("date_text"))


@query("json_extract", """
SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) :: BIGINT AS k_sum,
       count(json_extract_string(props, '$.k')) AS k_count
FROM events GROUP BY event_type
""", "F5")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    """One declared-schema parse per row (from_json), not one per path."""
    e = Tables(spark, d).events
    parsed = e.select("event_type", F.from_json("props", "k INT").alias("p"))
    return parsed.groupBy("event_type").agg(F.sum("p.k").alias("k_sum"),
                                            F.count("p.k").alias("k_count"))


@query("json_path_text", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.missing') AS missing_text
FROM events
""", "F5")
def json_path_text(spark: SparkSession, d: str) -> DataFrame:
    """`->>` semantics: text of the value at a path, NULL when absent."""
    e = Tables(spark, d).events
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                    F.get_json_object("props", "$.missing").alias("missing_text"))


@query("string_split", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
       split_part(p_name, ' ', 2) AS second_word, split_part(trim(p_name), ' ', -1) AS last_word,
       split_part(p_brand, '#', 2) AS brand_suffix
FROM part
""", "F6")
def string_split(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    return p.select("p_partkey",
                    F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"),
                    F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second_word"),
                    last_word("p_name").alias("last_word"),
                    F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_suffix"))


@query("regex_strip", """
SELECT p_partkey, TRY_CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) AS brand_digits,
       substr(regexp_replace(p_brand, '[^A-Z]', '', 'g'), 1, 1) AS brand_capital
FROM part
""", "F7")
def regex_strip(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    return p.select("p_partkey", digits_only("p_brand").alias("brand_digits"),
                    first_capital("p_brand").alias("brand_capital"))


@query("string_reverse", """
SELECT p_partkey, reverse(CAST(p_partkey AS VARCHAR)) AS reversed,
       reverse(CAST(p_partkey AS VARCHAR)) = CAST(p_partkey AS VARCHAR) AS is_palindrome,
       reverse(p_name) AS name_reversed
FROM part
""", "F8")
def string_reverse(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    k = F.col("p_partkey").cast("string")
    return p.select("p_partkey", F.reverse(k).alias("reversed"),
                    is_palindrome(k).alias("is_palindrome"),
                    F.reverse("p_name").alias("name_reversed"))


@query("null_and_case", """
SELECT o.o_orderkey, l.l_linenumber, COALESCE(l.l_quantity, 0) AS qty,
       CASE WHEN l.l_returnflag IS NULL THEN 'none' WHEN l.l_returnflag = 'R' THEN 'returned'
            ELSE 'kept' END AS line_state,
       l.l_orderkey IS NULL AS no_lines
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""", "F9")
def null_and_case(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    j = parent_left_join(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    rf = F.col("l_returnflag")
    return j.select("o_orderkey", "l_linenumber",
                    F.coalesce(F.col("l_quantity"), F.lit(0.0)).alias("qty"),
                    F.when(rf.isNull(), "none").when(rf == "R", "returned").otherwise("kept")
                    .alias("line_state"),
                    F.col("l_orderkey").isNull().alias("no_lines"))


def _r6(sql_expr: str) -> str:
    return f"CAST(round(CAST({sql_expr} AS DECIMAL(38,10)), 6) AS DOUBLE)"


@query("math_functions", f"""
SELECT q, {_r6('power(q, 3)')} AS cube, {_r6('sqrt(q)')} AS root,
       {_r6('abs(-q)')} AS absolute, {_r6('least(q, 10)')} AS capped,
       {_r6('exp(q / 10)')} AS exp_q, {_r6('pi() * q')} AS pi_q,
       {_r6('radians(q)')} AS rad, {_r6('sin(q)')} AS sin_q, {_r6('cos(q)')} AS cos_q,
       {_r6('power(q, 1.0 / 3)')} AS cbrt_q
FROM (SELECT DISTINCT l_quantity AS q FROM lineitem)
""", "F10")
def math_functions(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("q")
    li = Tables(spark, d).lineitem.select(F.col("l_quantity").alias("q")).distinct()
    return li.select("q", round_dec(F.pow(q, 3), 6).alias("cube"),
                     round_dec(F.sqrt(q), 6).alias("root"), round_dec(F.abs(-q), 6).alias("absolute"),
                     round_dec(F.least(q, F.lit(10.0)), 6).alias("capped"),
                     round_dec(F.exp(q / 10), 6).alias("exp_q"),
                     round_dec(F.pi() * q, 6).alias("pi_q"),
                     round_dec(F.radians(q), 6).alias("rad"),
                     round_dec(F.sin(q), 6).alias("sin_q"), round_dec(F.cos(q), 6).alias("cos_q"),
                     round_dec(F.pow(q, F.lit(1.0) / 3), 6).alias("cbrt_q"))


def _r2(sql_expr: str) -> str:
    return f"CAST(round(CAST({sql_expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


@query("formula_projection", f"""
SELECT a, b, {_r2('a * a * a + 2 * a * a + 1')} AS cubic,
       {_r2('sqrt(a * a + b * b)')} AS hypotenuse,
       {_r2('a * a * sqrt(3) / 4')} AS equilateral_area,
       {_r2('a + b + c')} AS perimeter,
       {_r2('sqrt(h * (h - a) * (h - b) * (h - c))')} AS heron_area,
       {_r2('4 * pi() * a * a')} AS sphere_area,
       {_r2('0.5 * a * b * sin(radians(angle))')} AS angle_area,
       {_r2('pow(sin(radians(angle)), 2) + pow(cos(radians(angle)), 2)')} AS unit_sum,
       'S=' || CAST(CAST(round(CAST(a * b AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS VARCHAR) AS area_text
FROM (SELECT a, b, sqrt(a * a + b * b) AS c, (a + b + sqrt(a * a + b * b)) / 2 AS h, 10 * b AS angle
      FROM (SELECT DISTINCT l_quantity AS a, CAST(l_linenumber AS DOUBLE) AS b FROM lineitem))
""", "F11")
def formula_projection(spark: SparkSession, d: str) -> DataFrame:
    """A cubic, the hypotenuse, triangle areas (equilateral, Heron's with the perimeter,
    two sides and an angle), the sphere, sin^2 + cos^2, and a formatted text."""
    li = Tables(spark, d).lineitem.select(F.col("l_quantity").alias("a"),
                                          F.col("l_linenumber").cast("double").alias("b")).distinct()
    a, b = F.col("a"), F.col("b")
    c = F.sqrt(a * a + b * b)
    half, angle = (a + b + c) / 2, F.radians(10 * b)
    return li.select(
        "a", "b", round_dec(a * a * a + 2 * a * a + 1, 2).alias("cubic"), round_dec(c, 2).alias("hypotenuse"),
        round_dec(a * a * F.sqrt(F.lit(3.0)) / 4, 2).alias("equilateral_area"),
        round_dec(a + b + c, 2).alias("perimeter"),
        round_dec(F.sqrt(half * (half - a) * (half - b) * (half - c)), 2).alias("heron_area"),
        round_dec(F.lit(4) * F.pi() * a * a, 2).alias("sphere_area"),
        round_dec(F.lit(0.5) * a * b * F.sin(angle), 2).alias("angle_area"),
        round_dec(F.pow(F.sin(angle), F.lit(2)) + F.pow(F.cos(angle), F.lit(2)), 2).alias("unit_sum"),
        F.concat(F.lit("S="), F.round((a * b).cast("decimal(18,2)"), 2).cast("string")).alias("area_text"))


@query("percent_change", f"""
WITH d AS ({DAILY_SQL}),
c AS (SELECT a.day, a.total, b.total AS prev_total,
             CAST(CAST(a.total AS DECIMAL(18,2)) * 100 AS BIGINT) AS nc,
             CAST(CAST(b.total AS DECIMAL(18,2)) * 100 AS BIGINT) AS oc
      FROM d a JOIN d b ON a.day = b.day + INTERVAL 1 DAY)
SELECT day, total, prev_total,
       CASE WHEN oc = 0 THEN NULL ELSE (abs(nc - oc) * 100 * 200 + abs(oc)) // (2 * abs(oc)) / 100.0 END
         AS pct_change
FROM c
""", "F12")
def percent_change(spark: SparkSession, d: str) -> DataFrame:
    day = daily_value(Tables(spark, d))
    prev = day.select(F.date_add("day", 1).alias("day"), F.col("total").alias("prev_total"))
    j = day.join(prev, "day")
    return j.select("day", "total", "prev_total",
                    pct_change("total", "prev_total").alias("pct_change"))


@query("readable_size", """
WITH t AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS b FROM orders)
SELECT o_orderkey, b AS n_bytes,
  CASE WHEN b < 1024 THEN CAST(b AS VARCHAR) || ' B'
       WHEN b < 1048576 THEN CAST((b * 200 + 1024) // 2048 // 100 AS VARCHAR) || '.' ||
            lpad(CAST((b * 200 + 1024) // 2048 % 100 AS VARCHAR), 2, '0') || ' KiB'
       WHEN b < 1073741824 THEN CAST((b * 200 + 1048576) // 2097152 // 100 AS VARCHAR) || '.' ||
            lpad(CAST((b * 200 + 1048576) // 2097152 % 100 AS VARCHAR), 2, '0') || ' MiB'
       ELSE CAST((b * 200 + 1073741824) // 2147483648 // 100 AS VARCHAR) || '.' ||
            lpad(CAST((b * 200 + 1073741824) // 2147483648 % 100 AS VARCHAR), 2, '0') || ' GiB'
  END AS size_text
FROM t
""", "F13")
def q_readable_size(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey",
                                       F.floor("o_totalprice").cast("long").alias("n_bytes"))
    return o.select("o_orderkey", "n_bytes", readable_size("n_bytes").alias("size_text"))


# ------------------------------------------------------------------ U1 / U2
@query("sql_scalar_udf", """
SELECT p_partkey, TRY_CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) AS row_no,
       substr(regexp_replace(p_brand, '[^A-Z]', '', 'g'), 1, 1) AS seat,
       split_part(trim(p_name), ' ', 1) AS first_name,
       split_part(trim(p_name), ' ', -1) AS last_name
FROM part
""", "U1")
def sql_scalar_udf(spark: SparkSession, d: str) -> DataFrame:
    register_sql_udfs(spark)
    return spark.sql("""
        SELECT p_partkey, get_row(p_brand) AS row_no, get_seat(p_brand) AS seat,
               get_first_name(p_name) AS first_name, get_last_name(p_name) AS last_name
        FROM {part}""", part=Tables(spark, d).part)


@query("udf_enriched_table", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
       TRY_CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) AS row_no,
       substr(regexp_replace(p_brand, '[^A-Z]', '', 'g'), 1, 1) AS seat,
       split_part(trim(p_name), ' ', 1) AS first_name,
       split_part(trim(p_name), ' ', -1) AS last_name
FROM part
""", "U2")
def udf_enriched_table(spark: SparkSession, d: str) -> DataFrame:
    register_sql_udfs(spark)
    return spark.sql("""
        SELECT *, get_row(p_brand) AS row_no, get_seat(p_brand) AS seat,
               get_first_name(p_name) AS first_name, get_last_name(p_name) AS last_name
        FROM {part}""", part=Tables(spark, d).part)

"""Source, sink, upsert and table-maintenance queries (S*, U3).

Each query writes what it needs under the shared checkpoint root (a fresh
directory per call) and returns a DataFrame read back from it, so the oracle
compares what actually landed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..operators.upsert import (first_n_by_key, insert_if_absent, merge_upsert,
                                with_audit_stamp)
from ..functions.scalar import readable_size
from ..operators.quality import as_text
from ..session import scratch_path, stored
from ..sources.files import csv_scan, csv_scan_rejects, csv_sink
from ..sources.json_docs import (TableSpec, build_pages, ingest_pages, json_scan_rejects, land_pages,
                                 nest_lines_per_order, read_transaction_docs, reconcile_pages,
                                 unnest_json, write_transaction_docs)
from ..sources.layouts import curve_layout, lookup
from ..sources.page_chain import chain_findings, landed_links
from ..sources.published import publish, published
from ..sources.tables import Tables
from ..sources.tables_io import (clustered_layout, commit, ctas, describe_schema, footer_scan,
                                 footer_stats, insert_select, month_range, partition_row_counts,
                                 read_months, reload_months, table_size_report, truncate_reload,
                                 typed_compact_rewrite, write_month_partitioned, write_table)
from .registry import query

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType())])


@query("csv_scan", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""", "S2")
def q_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Customer landed as CSV with a header, read back with a declared schema."""
    path = scratch_path(spark, "customer_csv")
    csv_sink(Tables(spark, d).customer, path)
    return csv_scan(spark, path, CUSTOMER_SCHEMA)


@query("csv_sink", """
SELECT count(*) AS data_lines, count(*) AS distinct_keys FROM orders
""", "S3")
def q_csv_sink(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as CSV (header, no index column); the files hold one
    header line per file and one line per row."""
    o = Tables(spark, d).orders
    path = scratch_path(spark, "orders_csv")
    csv_sink(o, path)
    header = ",".join(o.columns)
    lines = spark.read.text(path).where(F.col("value") != header)
    return lines.agg(F.count(F.lit(1)).alias("data_lines"),
                     F.countDistinct(F.split_part("value", F.lit(","), F.lit(1))).alias("distinct_keys"))


@query("ingest_rejects", """
SELECT 'csv' AS kind, count(*) AS n_input, count(*) FILTER (c_custkey % 7 <> 3 AND c_custkey % 11 <> 5) AS n_good,
       count(*) FILTER (c_custkey % 7 = 3 OR c_custkey % 11 = 5) AS n_rejected,
       CAST(sum(c_custkey) FILTER (c_custkey % 7 <> 3 AND c_custkey % 11 <> 5) AS BIGINT) AS good_keys
FROM customer
UNION ALL
SELECT 'json', count(*), count(*) FILTER (c_custkey % 5 <> 2), count(*) FILTER (c_custkey % 5 = 2),
       CAST(sum(c_custkey) FILTER (c_custkey % 5 <> 2) AS BIGINT)
FROM customer
""", "S2")
def ingest_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Customers landed as CSV and as JSON lines with some rows spoilt (a balance that is
    no number, a field too many, a document cut short): the good rows load, the others
    are kept as they came, and the two add up to the input."""
    c = Tables(spark, d).customer.select(*CUSTOMER_SCHEMA.fieldNames())
    key, header = F.col("c_custkey"), ",".join(CUSTOMER_SCHEMA.fieldNames())
    balance = F.when(key % 7 == 3, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat_ws(",", key.cast("string"), "c_name", F.col("c_nationkey").cast("string"), balance, "c_mktsegment")
    csv = scratch_path(spark, "spoilt_csv")
    lines = c.select(F.when(key % 11 == 5, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"))
    # one column named like the whole header line, written unquoted: every file has the header
    lines.withColumnRenamed("value", header).write.options(header=True, sep="\t", quote="").csv(csv)
    doc = F.to_json(F.struct(*c.columns))
    docs = scratch_path(spark, "spoilt_json")
    c.select(F.when(key % 5 == 2, F.substring(doc, 1, 20)).otherwise(doc).alias("value")).write.text(docs)
    out = []
    for kind, (good, bad) in (("csv", csv_scan_rejects(spark, csv, CUSTOMER_SCHEMA)),
                              ("json", json_scan_rejects(spark, docs, CUSTOMER_SCHEMA))):
        n_bad = bad.agg(F.count(F.lit(1)).alias("n_rejected"))
        n_good = good.agg(F.count(F.lit(1)).alias("n_good"), F.sum("c_custkey").alias("good_keys"))
        both = n_good.select(F.lit(1).alias("_one"), "*").join(n_bad.select(F.lit(1).alias("_one"), "*"), "_one")
        out.append(both.select(F.lit(kind).alias("kind"), (F.col("n_good") + F.col("n_rejected")).alias("n_input"),
                               "n_good", "n_rejected", "good_keys"))
    return reduce(DataFrame.unionByName, out)


@query("json_document_scan", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
       CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS id,
       CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS product_id,
       l_extendedprice AS price_usd
FROM lineitem
""", "S4")
def json_document_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "tx_docs")
    write_transaction_docs(Tables(spark, d).lineitem, path)
    return read_transaction_docs(spark, path)


CHAR_ITEM = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                        StructField("c_mktsegment", StringType())])


def _land_customer_pages(spark: SparkSession, d: str, declared=None) -> str:
    cust = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    pages = build_pages(cust, ["c_custkey"], 100, "https://api.example/customers",
                        declared_count=declared)
    path = scratch_path(spark, "customer_pages")
    land_pages(pages, path)
    return path


@query("paged_json_ingest", """
SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone FROM customer
""", "S5")
def paged_json_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Fields are chosen per call; one (c_phone) is absent from the items and
    comes back NULL (non-strict), and the key keeps the first page's copy."""
    path = _land_customer_pages(spark, d)
    return ingest_pages(spark, path, CHAR_ITEM, ["c_custkey", "c_name", "c_mktsegment", "c_phone"],
                        key="c_custkey")


NATION_ITEM = StructType([StructField("n_nationkey", IntegerType()),
                          StructField("n_name", StringType()),
                          StructField("n_regionkey", IntegerType())])
REGION_ITEM = StructType([StructField("r_regionkey", IntegerType()),
                          StructField("r_name", StringType())])
SUPPLIER_ITEM = StructType([StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
                            StructField("s_nationkey", IntegerType())])
SPECS = (TableSpec("nation", NATION_ITEM, ("n_nationkey", "n_name", "n_regionkey"), "n_nationkey"),
         TableSpec("region", REGION_ITEM, ("r_regionkey", "r_name"), "r_regionkey"),
         TableSpec("supplier", SUPPLIER_ITEM, ("s_suppkey", "s_name", "s_nationkey"), "s_suppkey"))


def run_load(spark: SparkSession, d: str, specs=SPECS) -> list[tuple[str, DataFrame]]:
    """One spec list drives land -> create -> truncate -> load per table.
    Stops at the first failed step (an exception propagates)."""
    t = Tables(spark, d)
    out = []
    for spec in specs:
        src = getattr(t, spec.name).select(*spec.fields)
        pages_path = scratch_path(spark, f"{spec.name}_pages")
        land_pages(build_pages(src, [spec.key], 100, f"https://api.example/{spec.name}"), pages_path)
        table_path = scratch_path(spark, spec.name)
        # create (empty, declared layout), then truncate + load from the pages
        spark.createDataFrame([], StructType([spec.item[f] for f in spec.fields])) \
            .write.parquet(table_path)
        rows = ingest_pages(spark, pages_path, spec.item, list(spec.fields), key=spec.key)
        out.append((spec.name, truncate_reload(spark, table_path, rows)))
    return out


@query("spec_driven_ingest", """
SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation
UNION ALL SELECT 'region', count(*) FROM region
UNION ALL SELECT 'supplier', count(*) FROM supplier
""", "S6")
def spec_driven_ingest(spark: SparkSession, d: str) -> DataFrame:
    loaded = run_load(spark, d)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in loaded]
    return reduce(DataFrame.unionByName, parts)


@query("page_count_reconcile", """
SELECT count(*) AS declared, count(*) AS loaded, TRUE AS ok FROM customer
""", "S7")
def page_count_reconcile(spark: SparkSession, d: str) -> DataFrame:
    path = _land_customer_pages(spark, d)
    return reconcile_pages(spark, path, CHAR_ITEM)


PAGE_ROWS = 20


@query("page_chain_audit", f"""
WITH p AS (SELECT ((count(*) + {PAGE_ROWS - 1}) // {PAGE_ROWS})::BIGINT AS n FROM customer),
u AS (SELECT unnest(range(1, n + 1)) AS k, n FROM p)
SELECT 'missing' AS finding, 'https://api.example/customers?page=' || k AS url FROM u WHERE k = 3
UNION ALL SELECT 'doubled', 'https://api.example/customers?page=' || k FROM u WHERE k = 2
UNION ALL SELECT 'unreferenced', 'https://api.example/customers?page=' || k FROM u WHERE k = 4
UNION ALL SELECT 'endless', 'https://api.example/customers?page=' || k FROM u WHERE k IN (6, 7)
UNION ALL SELECT 'unreferenced', 'https://api.example/customers?page=' || k FROM u WHERE k = 8
UNION ALL SELECT 'endless', 'https://api.example/customers?page=' || k FROM u WHERE k IN (4, 5) AND n >= 7
UNION ALL SELECT 'missing', 'https://api.example/customers?page=1' FROM p WHERE n = 0
""", "S7")
def page_chain_audit(spark: SparkSession, d: str) -> DataFrame:
    """Customer pages landed with the third missing, the second twice, and the seventh
    pointing back to the sixth: what is wrong, from the chain of cursors alone."""
    cust = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    url = "https://api.example/customers"
    pages = stored(build_pages(cust, ["c_custkey"], PAGE_ROWS, url).select(
        "url", "_page", "results", F.struct("info.count", F.when(F.col("_page") == 6, F.lit(f"{url}?page=6")).otherwise(
            F.col("info.next")).alias("next")).alias("info")), "pages")
    landed = pages.where("_page <> 2").unionByName(pages.where("_page = 1"))
    path = scratch_path(spark, "customer_pages")
    land_pages(landed, path, with_url=True)
    return chain_findings(landed_links(spark, path), f"{url}?page=1")


@query("ctas_backup", "SELECT * FROM orders", "S8")
def ctas_backup(spark: SparkSession, d: str) -> DataFrame:
    return ctas(spark, Tables(spark, d).orders, "orders_backup")


@query("insert_select", "SELECT * FROM orders", "S9")
def q_insert_select(spark: SparkSession, d: str) -> DataFrame:
    """Two appends (halves split on the order date) rebuild the table; the
    second insert lists its columns in another order (insert is by name)."""
    o = Tables(spark, d).orders
    path = scratch_path(spark, "orders_appended")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    insert_select(o.where(F.col("o_orderdate") < cut), path)
    later = o.where(F.col("o_orderdate") >= cut)
    insert_select(later.select(*reversed(later.columns)), path)
    return spark.read.parquet(path)


@query("truncate_reload", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""", "S10")
def q_truncate_reload(spark: SparkSession, d: str) -> DataFrame:
    """Reload a table from a query over its own current content."""
    path = write_table(Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
                       scratch_path(spark, "orders_small"))
    cur = spark.read.parquet(path)
    return truncate_reload(spark, path, cur.where(F.col("o_orderstatus") == "F"))


INSERT_IF_ABSENT_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice + 1 FROM orders
WHERE NOT (o_orderdate < TIMESTAMP '1998-01-01')
"""


@query("insert_if_absent", INSERT_IF_ABSENT_SQL, "S11")
def q_insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    """Base holds the orders before 1998; the incoming batch is every order
    with a changed price, twice (in-batch duplicates): existing keys keep
    their old row, new keys are inserted once."""
    o = Tables(spark, d).orders
    base = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_totalprice")
    inc = o.select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    inc2 = o.select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 2).alias("o_totalprice"))
    merged = insert_if_absent(commit(base, "orders_base"), inc.unionByName(inc2), "o_orderkey",
                              tie="o_totalprice")
    return commit(merged, "orders_if_absent")


MERGE_SQL = """
WITH tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
             WHERE o_orderdate < TIMESTAMP '1999-01-01'),
src AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice
        FROM orders WHERE year(o_orderdate) = 1996
        UNION ALL
        SELECT o_orderkey, o_custkey, 'N', o_totalprice FROM orders
        WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT t.* FROM tgt t ANTI JOIN src s ON t.o_orderkey = s.o_orderkey
UNION ALL
SELECT s.o_orderkey, COALESCE(t.o_custkey, s.o_custkey), s.o_orderstatus, s.o_totalprice
FROM src s LEFT JOIN tgt t ON s.o_orderkey = t.o_orderkey
"""


def _merge_inputs(spark: SparkSession, d: str):
    o = Tables(spark, d).orders
    tgt = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1996-01-01", "1997-01-01"))
    upd = o.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"))
    ins = o.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return tgt, upd.unionByName(ins)


@query("merge_upsert", MERGE_SQL, "S12")
def q_merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """WHEN MATCHED update status and price (customer kept), WHEN NOT MATCHED insert."""
    tgt, src = _merge_inputs(spark, d)
    target = commit(tgt, "orders_target")
    merged = merge_upsert(target, src, "o_orderkey", update_cols=["o_orderstatus", "o_totalprice"])
    return commit(merged, "orders_merged")


@query("merge_twice_idempotent", MERGE_SQL, "S12")
def merge_twice(spark: SparkSession, d: str) -> DataFrame:
    """Merging the same source twice equals merging it once."""
    tgt, src = _merge_inputs(spark, d)
    once = commit(merge_upsert(commit(tgt, "orders_target"), src, "o_orderkey",
                               update_cols=["o_orderstatus", "o_totalprice"]), "orders_merged")
    return commit(merge_upsert(once, src, "o_orderkey",
                               update_cols=["o_orderstatus", "o_totalprice"]), "orders_merged2")


@query("merge_batch_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100
""", "S13")
def merge_batch_limit(spark: SparkSession, d: str) -> DataFrame:
    """The first 100 order keys merged into an empty table."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    empty = commit(o.limit(0), "orders_empty")
    return commit(merge_upsert(empty, first_n_by_key(o, "o_orderkey", 100), "o_orderkey"),
                  "orders_first100")


@query("audit_timestamp", """
SELECT count(*) AS n_rows, count(*) AS n_stamped FROM orders
""", "S14")
def audit_timestamp(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    t = commit(with_audit_stamp(o), "orders_stamped")
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count("_etl_updated_dttm").alias("n_stamped"))


MONTH_LO, MONTH_HI = "1997-01-01", "1997-04-01"


@query("month_partitioned_table", f"""
SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym, count(*) AS n_rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{MONTH_LO}' AND l_shipdate < TIMESTAMP '{MONTH_HI}'
GROUP BY 1
""", "S15")
def month_partitioned_table(spark: SparkSession, d: str) -> DataFrame:
    """Write lineitem partitioned by ship month, then read one quarter: the
    ``ym`` predicate added by ``month_range`` prunes the other partitions."""
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice")
    path = write_month_partitioned(li, "l_shipdate", scratch_path(spark, "lineitem_by_month"), sort_by=["l_orderkey"])
    q = month_range(read_months(spark, path, li.schema), "l_shipdate", MONTH_LO, MONTH_HI)
    return q.groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"),
                               F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
                               .cast("double").alias("revenue"))


@query("view_registry", """
SELECT o_orderstatus, count(*) AS n_orders FROM orders WHERE o_totalprice > 100000 GROUP BY 1
""", "S16")
def view_registry(spark: SparkSession, d: str) -> DataFrame:
    """A named view, replaced by a narrower definition, queried by name."""
    o = Tables(spark, d).orders
    o.createOrReplaceTempView("orders_v")
    o.where(F.col("o_totalprice") > 100000).createOrReplaceTempView("orders_v")
    return spark.sql("SELECT o_orderstatus, count(*) AS n_orders FROM orders_v GROUP BY 1")


@query("partition_row_counts", """
SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym, count(*) AS n_rows
FROM lineitem GROUP BY 1
""", "S17")
def q_partition_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per month of a partitioned table, from the footers of its files alone."""
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_shipdate")
    path = write_month_partitioned(li, "l_shipdate", scratch_path(spark, "lineitem_months"))
    schema = read_months(spark, path, li.schema).schema
    return partition_row_counts(footer_scan(spark, path, schema), "ym")


@query("footer_column_stats", """
SELECT 'orders' AS table_name, count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders
UNION ALL SELECT 'lineitem', count(*), min(l_orderkey), max(l_orderkey) FROM lineitem
UNION ALL SELECT 'events', count(*), min(event_id), max(event_id) FROM events
""", "A1")
def footer_column_stats(spark: SparkSession, d: str) -> DataFrame:
    """Rows and key range of whole tables without reading a data page."""
    out = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "event_id")):
        stats = footer_stats(footer_scan(spark, f"{d.rstrip('/')}/{name}.parquet"), [key])
        out.append(stats.select(F.lit(name).alias("table_name"), "n_rows",
                                F.col(f"min_{key}").alias("min_key"), F.col(f"max_{key}").alias("max_key")))
    return reduce(DataFrame.unionByName, out)


@query("month_reload", """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym, count(*) AS n_rows,
       CAST(sum(CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 5)
                THEN CASE WHEN o_orderstatus <> 'P' THEN 2 * CAST(o_totalprice AS DECIMAL(18,2)) END
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS revenue
FROM orders
WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 5) AND o_orderstatus = 'P')
GROUP BY 1
""", "S15")
def month_reload(spark: SparkSession, d: str) -> DataFrame:
    """Two months of a partitioned table are computed anew from the table itself (prices
    doubled, pending orders gone) and put in their place; no other month is written."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = write_month_partitioned(o, "o_orderdate", scratch_path(spark, "orders_by_month"))
    now = read_months(spark, path, o.schema)
    anew = now.where("ym IN (199702, 199705) AND o_orderstatus <> 'P'").drop("ym") \
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    table = reload_months(anew, "o_orderdate", path)
    return table.groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query("table_size_report", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, TRUE AS has_bytes, TRUE AS readable_ok FROM {n}"
    for n in ("orders", "lineitem", "customer")), "S18")
def q_table_size_report(spark: SparkSession, d: str) -> DataFrame:
    """Bytes depend on the writer: what is checked is the rows, that there are bytes,
    and that the readable size is that of the bytes."""
    t = Tables(spark, d)
    report = reduce(DataFrame.unionByName, [table_size_report(getattr(t, n), n)
                                            for n in ("orders", "lineitem", "customer")])
    return report.select("table_name", "n_rows", (F.col("bytes") > 0).alias("has_bytes"),
                         (F.col("readable") == readable_size("bytes")).alias("readable_ok"))


@query("describe_schema", """
SELECT column_name, data_type, non_null, n_rows FROM (VALUES
  ('o_orderkey', 'bigint', (SELECT count(o_orderkey) FROM orders)),
  ('o_custkey', 'bigint', (SELECT count(o_custkey) FROM orders)),
  ('o_orderstatus', 'string', (SELECT count(o_orderstatus) FROM orders)),
  ('o_totalprice', 'double', (SELECT count(o_totalprice) FROM orders)),
  ('o_orderdate', 'timestamp_ntz', (SELECT count(o_orderdate) FROM orders)),
  ('o_orderpriority', 'string', (SELECT count(o_orderpriority) FROM orders))
) v(column_name, data_type, non_null), (SELECT count(*) AS n_rows FROM orders)
""", "S19")
def q_describe_schema(spark: SparkSession, d: str) -> DataFrame:
    return describe_schema(Tables(spark, d).orders)


@query("typed_compact_rewrite", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       'c' || o_custkey || '@mail.example' AS email, '+7' || CAST(o_custkey AS VARCHAR) AS phone,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym
FROM orders
""", "S20")
def q_typed_compact_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text with a JSON contact column, rewritten by month with narrower
    types and the e-mail and phone lifted out of the JSON."""
    o = Tables(spark, d).orders
    contact = F.to_json(F.struct(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@mail.example")).alias("email"),
        F.concat(F.lit("+7"), F.col("o_custkey").cast("string")).alias("phone")))
    raw = as_text(o).withColumn("contact_data", contact)
    types = {"o_orderkey": "bigint", "o_custkey": "int", "o_orderstatus": "string",
             "o_totalprice": "decimal(12,2)", "o_orderdate": "date"}
    out = typed_compact_rewrite(spark, raw, types, ["o_custkey", "o_orderkey"],
                                domains={"o_orderstatus": ["O", "F", "P"]}, month_of="o_orderdate",
                                json_fields={"email": ("contact_data", "$.email"),
                                             "phone": ("contact_data", "$.phone")})
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("clustered_layout", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
   OR (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem
                                 WHERE l_orderkey = (SELECT min(o_orderkey) FROM orders))
""", "S21")
def q_clustered_layout(spark: SparkSession, d: str) -> DataFrame:
    """Point lookup and pair lookup on lineitem rewritten clustered on the key
    with bloom filters; the lookup values themselves come from the data."""
    t = Tables(spark, d)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    li = clustered_layout(spark, t.lineitem.select(*cols), ["l_orderkey"], bloom_cols=["l_orderkey", "l_partkey"])
    return _order_or_pairs(t, li)


def _order_or_pairs(t: Tables, li: DataFrame) -> DataFrame:
    """The lines of one order, and those with a (part, supplier) pair of another order."""
    key = t.orders.where(F.col("o_orderstatus") == "F").agg(F.max("o_orderkey").alias("l_orderkey"))
    first = t.orders.agg(F.min("o_orderkey").alias("l_orderkey"))
    point = lookup(li, key)
    pair = lookup(li, lookup(li, first).select("l_partkey", "l_suppkey"))
    # rows matching either lookup, once each (no OR across a join)
    return point.unionByName(pair.join(key, "l_orderkey", "left_anti"))


@query("curve_layout_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
   OR (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem
                                 WHERE l_orderkey = (SELECT min(o_orderkey) FROM orders))
""", "S21")
def curve_layout_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The same lookups on one layout that serves all three keys: lineitem along a
    Z-order curve over order, part and supplier."""
    t = Tables(spark, d)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    li = curve_layout(spark, t.lineitem.select(*cols), ["l_orderkey", "l_partkey", "l_suppkey"],
                      bloom_cols=["l_partkey"])
    return _order_or_pairs(t, li)


# ------------------------------------------------------------------ U3
STAMP = "_etl_updated_dttm"


def load_sources(t: Tables) -> list[tuple[str, DataFrame, list[str]]]:
    """The three sources of the load, out of the nested documents. A load reads a source
    several times, so the unnested tickets and each source are stored: the documents are
    joined, written as JSON and parsed once."""
    docs = nest_lines_per_order(t)
    tickets = stored(unnest_json(docs, "json_data", "tickets", keep=["book_ref"]), "load-unnested")
    flights = tickets.select("book_ref", "linenumber", F.explode("flights").alias("f")).select(
        "book_ref", "linenumber", "f.partkey", "f.suppkey", "f.quantity")
    sources = [("bookings", docs.select("book_ref", "book_date").distinct(), ["book_ref"]),
               ("tickets", tickets.groupBy("book_ref", "linenumber").agg(F.count(F.lit(1)).alias("n_flights")),
                ["book_ref", "linenumber"]),
               ("ticket_flights", flights.groupBy("book_ref", "linenumber", "partkey", "suppkey")
                .agg(F.sum("quantity").alias("quantity")), ["book_ref", "linenumber", "partkey", "suppkey"])]
    return [(name, stored(df, f"load-{name}"), keys) for name, df, keys in sources]


def load_steps(sources: list[tuple[str, DataFrame, list[str]]]) -> dict:
    """A merge per table in order: known keys get the source's values, new keys are
    inserted, and either is stamped with the write time. The whole source is loaded;
    ``first_n_by_key`` cuts a source down where a batch is wanted."""
    def step(src: DataFrame, keys: list[str]):
        def merged(target: DataFrame | None) -> DataFrame:
            return merge_upsert(src.limit(0) if target is None else target, src, keys, stamp=STAMP)
        return merged
    return {name: step(src, keys) for name, src, keys in sources}


@query("load_procedure", """
SELECT 'bookings' AS table_name, count(*) AS n_rows, count(*) AS n_stamped,
       CAST(sum(date_diff('day', TIMESTAMP '1970-01-01', book_date)) AS BIGINT) AS check_sum
FROM (SELECT DISTINCT o_orderkey, o_orderdate AS book_date FROM orders)
UNION ALL
SELECT 'tickets', count(*), count(*), CAST(sum(n) AS BIGINT) FROM
  (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
UNION ALL
SELECT 'ticket_flights', count(*), count(*), CAST(sum(q * (l_linenumber + 1)) AS BIGINT) FROM
  (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2, 3, 4)
""", "U3")
def q_load_procedure(spark: SparkSession, d: str) -> DataFrame:
    """The targets hold two thirds of the keys with stale values; the load updates
    those and inserts the others, and the sums are over the values that landed."""
    root = scratch_path(spark, "catalog")
    sources = load_sources(Tables(spark, d))
    publish(spark, root, _stale(sources, lambda keys: F.pmod(F.xxhash64(*keys), F.lit(3)) != 0))
    publish(spark, root, load_steps(sources))
    return _checked(spark, root, "n_stamped")


STALE = {"bookings": ("book_date", "TIMESTAMP_NTZ'1990-01-01'"), "tickets": ("n_flights", "-1L"),
         "ticket_flights": ("quantity", "-5.0D")}


def _stale(sources, known) -> dict:
    """Steps that publish the sources' known keys with stale values."""
    return {name: lambda _, src=src, keys=keys, c=STALE[name][0], v=STALE[name][1]:
            src.where(known(keys)).withColumn(c, F.expr(v)) for name, src, keys in sources}


def _checked(spark: SparkSession, root: str, *more: str) -> DataFrame:
    check = {"bookings": F.sum(F.unix_date(F.col("book_date").cast("date")).cast("long")), "tickets": F.sum("n_flights"),
             "ticket_flights": F.sum(F.col("quantity") * (F.col("linenumber") + 1)).cast("long")}
    out = []
    for name, total in check.items():
        df = published(spark, root, name)
        stamped = F.count(STAMP) if STAMP in df.columns else F.lit(0).cast("long")
        out.append(df.agg(F.count(F.lit(1)).alias("n_rows"), stamped.alias("n_stamped"), total.alias("check_sum"))
                   .select(F.lit(name).alias("table_name"), "n_rows", *more, "check_sum"))
    return reduce(DataFrame.unionByName, out)


@query("publish_all_or_nothing", """
WITH t AS (
  SELECT 'bookings' AS table_name, 1 AS old, count(*) AS n_rows,
         CAST(sum(date_diff('day', TIMESTAMP '1970-01-01', TIMESTAMP '1990-01-01')) AS BIGINT) AS check_sum
  FROM (SELECT DISTINCT o_orderkey FROM orders) WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT 'bookings', 0, count(*), CAST(sum(date_diff('day', TIMESTAMP '1970-01-01', book_date)) AS BIGINT)
  FROM (SELECT DISTINCT o_orderkey, o_orderdate AS book_date FROM orders)
  UNION ALL SELECT 'tickets', 1, count(*), CAST(-count(*) AS BIGINT)
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 <> 0)
  UNION ALL SELECT 'tickets', 0, count(*), CAST(sum(n) AS BIGINT)
  FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
  UNION ALL SELECT 'ticket_flights', 1, count(*), CAST(sum(-5 * (l_linenumber + 1)) AS BIGINT)
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 3 <> 0)
  UNION ALL SELECT 'ticket_flights', 0, count(*), CAST(sum(q * (l_linenumber + 1)) AS BIGINT) FROM
    (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2, 3, 4))
SELECT 'after a failed load' AS seen, table_name, n_rows, check_sum FROM t WHERE old = 1
UNION ALL SELECT 'after a whole load', table_name, n_rows, check_sum FROM t WHERE old = 0
""", "U3")
def publish_all_or_nothing(spark: SparkSession, d: str) -> DataFrame:
    """A load whose third merge fails (its source repeats a key) leaves readers on the old
    versions of all three tables; the load that succeeds shows all three new."""
    root = scratch_path(spark, "catalog")
    sources = load_sources(Tables(spark, d))
    publish(spark, root, _stale(sources, lambda keys: F.col("book_ref") % 3 != 0))
    name, flights, keys = sources[2]
    twice = flights.unionByName(flights.withColumn("quantity", F.col("quantity") + 1))
    empty = flights.isEmpty()  # then nothing repeats, and the load succeeds
    try:
        if not empty:
            publish(spark, root, load_steps([*sources[:2], (name, twice, keys)]))
            raise AssertionError("a repeated key must fail the load")
    except PySparkException:
        pass
    before = _checked(spark, root).select(F.lit("after a failed load").alias("seen"), "*")
    publish(spark, root, load_steps(sources))
    return before.unionByName(_checked(spark, root).select(F.lit("after a whole load").alias("seen"), "*"))

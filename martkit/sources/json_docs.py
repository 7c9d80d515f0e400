"""JSON documents and landed API pages.

Documents are parsed once per row with a declared schema (``from_json``) and
unnested with ``explode``; nothing is parsed on the driver. Landed API pages
are JSON-lines files read in parallel (one task per file split).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ..operators.joins import NEST_ROWS, nest_children
from ..operators.ordered import dense_id
from .files import CORRUPT, split_rejects

FLIGHT = StructType([StructField("partkey", LongType()), StructField("suppkey", LongType()),
                     StructField("quantity", DoubleType())])
TICKET = StructType([StructField("linenumber", IntegerType()),
                     StructField("flights", ArrayType(FLIGHT))])
BOOKING_JSON = StructType([StructField("tickets", ArrayType(TICKET))])

TRANSACTION = StructType([StructField("id", StringType()), StructField("user_id", StringType()),
                          StructField("product_id", StringType()),
                          StructField("price_usd", DoubleType())])
TRANSACTIONS_DOC = StructType([StructField("transactions", ArrayType(TRANSACTION))])


def nest_lines_per_order(t, max_tickets: int = NEST_ROWS) -> DataFrame:
    """Bookings-like documents built from orders -> lineitem, one document per order with
    a ticket for each of its lines: ``{"tickets": [{"linenumber", "flights": [{...}]}, ...]}``;
    orders without lines get an empty ``tickets`` array. An order of more than
    ``max_tickets`` lines comes as several documents, each with a run of its tickets, so
    no document grows with a hot key."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    flight = F.struct(F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
                      F.col("l_quantity").alias("quantity"))
    ticket = F.struct(F.col("l_linenumber").alias("linenumber"),
                      F.array(flight).alias("flights"))
    j = nest_children(o, li, "o_orderkey", "l_orderkey", ticket, "tickets", max_tickets)
    return j.select(F.col("o_orderkey").alias("book_ref"), F.col("o_orderdate").alias("book_date"),
                    F.to_json(F.struct("tickets")).alias("json_data"))


def unnest_json(df: DataFrame, col: str, field: str, keep: Sequence[str] = (),
                schema: StructType = BOOKING_JSON) -> DataFrame:
    """Parse ``col`` with ``schema`` and emit one row per element of
    ``field`` with the parent's ``keep`` columns (LATERAL / ARRAY JOIN: a NULL or
    empty array drops the parent; text that is no such document is an error)."""
    parsed = df.select(*keep, F.from_json(F.col(col), schema, {"mode": "FAILFAST"}).alias("_doc"))
    return parsed.select(*keep, F.explode(F.col(f"_doc.{field}")).alias("_e")).select(*keep, "_e.*")


# ---------------------------------------------------------------- S4
def write_transaction_docs(lines: DataFrame, path: str, per_doc_col: str = "l_orderkey",
                           max_per_doc: int = 1000) -> None:
    """Write ``{"transactions": [...]}`` documents (JSON lines), one per order
    and at most ``max_per_doc`` transactions each: rows get dense ids in
    (order, line) order, and a document is a run of ids inside one order, so
    no document (and no task) has to hold a hot order whole."""
    tx = F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                              F.col("l_linenumber").cast("string"),
                              F.col("l_partkey").cast("string"),
                              F.col("l_suppkey").cast("string")).alias("id"),
                  F.col("l_suppkey").cast("string").alias("user_id"),
                  F.col("l_partkey").cast("string").alias("product_id"),
                  F.col("l_extendedprice").alias("price_usd"))
    order = [per_doc_col, "l_linenumber", "l_partkey", "l_suppkey"]
    ided = dense_id(lines.select(*order, "l_extendedprice"), order, "_rid")
    docs = (ided.groupBy(per_doc_col, F.floor(F.col("_rid") / max_per_doc).alias("_doc"))
                .agg(F.collect_list(tx).alias("transactions")))
    docs.select("transactions").write.mode("overwrite").json(path)


def read_transaction_docs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Declared-schema JSON scan + explode into typed rows; a malformed document
    is an error."""
    docs = (spark.read.schema(TRANSACTIONS_DOC).option("multiLine", multi_line)
            .option("mode", "FAILFAST").json(path))
    return docs.select(F.explode("transactions").alias("t")).select("t.*")


def json_scan_rejects(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines as ``(good, rejected)``, instead of an error at the first bad one:
    the rows of ``schema``, and ``file, raw`` of each line that is no such document. The
    files are parsed once and kept, so that the two always add up to the lines."""
    parsed = spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(path)
    return split_rejects(parsed, schema.fieldNames())


# ---------------------------------------------------------------- S5-S7
def page_schema(item: StructType) -> StructType:
    info = StructType([StructField("count", LongType()), StructField("next", StringType())])
    return StructType([StructField("info", info), StructField("results", ArrayType(item))])


def build_pages(df: DataFrame, order: Sequence[str], page_size: int, url: str,
                declared_count=None) -> DataFrame:
    """Land ``df`` as API pages ``{info: {count, next}, results: [...]}``:
    dense ids give each row its page; a page holds at most ``page_size`` rows."""
    ided = dense_id(df, list(order), "_rid", start=0)
    paged = ided.withColumn("_page", F.floor(F.col("_rid") / page_size).cast("long"))
    total = df.select(F.count(F.lit(1))).scalar() if declared_count is None else F.lit(declared_count)
    cols = [c for c in df.columns]
    pages = paged.groupBy("_page").agg(
        F.sort_array(F.collect_list(F.struct("_rid", *cols))).alias("_rows"))
    last_page = paged.select(F.max("_page")).scalar()
    nxt = F.when(F.col("_page") < last_page,
                 F.concat(F.lit(url + "?page="), (F.col("_page") + 2).cast("string")))
    return pages.select(
        F.col("_page"), F.concat(F.lit(url + "?page="), (F.col("_page") + 1).cast("string")).alias("url"),
        F.struct(total.cast("long").alias("count"), nxt.alias("next")).alias("info"),
        F.transform("_rows", lambda r: r.dropFields("_rid")).alias("results"))


def land_pages(pages: DataFrame, path: str, with_url: bool = False) -> None:
    """One JSON line per page; ``with_url``: and the cursor that it was fetched by, which
    ``page_chain`` follows."""
    cols = (["url"] if with_url else []) + ["info", "results"]
    pages.select(F.to_json(F.struct(*cols)).alias("value")).write.mode("overwrite").text(path)


def ingest_pages(spark: SparkSession, path: str, item: StructType, fields: Sequence[str],
                 key: str | None = None, strict: bool = False) -> DataFrame:
    """Landed pages -> rows of the chosen fields. A missing field is NULL
    (or an error when ``strict``), and a malformed page is an error. With ``key``,
    the first page wins, and inside a page the first item; pages are ordered by
    the page number in ``info.next`` (the page without one is the last), and by
    ``info.next`` itself where it holds another kind of cursor."""
    pages = spark.read.schema(page_schema(item)).option("mode", "FAILFAST").json(path)
    rows = pages.select(F.posexplode("results").alias("_pos", "r"),
                        F.col("info.next").alias("_next"))
    names = set(item.fieldNames())
    cols = []
    for f in fields:
        if f in names:
            c = F.col(f"r.{f}")
            if strict:
                c = F.when(c.isNotNull(), c).otherwise(
                    F.raise_error(F.lit(f"missing field {f}")))
            cols.append(c.alias(f))
        elif strict:
            raise KeyError(f"field {f} not in item schema")
        else:
            cols.append(F.lit(None).cast("string").alias(f))
    out = rows.select(*cols, "_next", "_pos")
    if key is not None:
        page = F.struct(
            F.col("_next").isNull().alias("last"),
            F.coalesce(F.regexp_extract("_next", r"page=(\d+)", 1).try_cast("long"), F.lit(1 << 62)).alias("number"),
            F.coalesce("_next", F.lit("")).alias("cursor"), F.col("_pos").alias("item"))
        rest = [f for f in fields if f != key]
        out = (out.groupBy(key).agg(F.min_by(F.struct(*rest), page).alias("_r")).select(key, "_r.*")
               if rest else out.select(key).distinct())
    return out.select(*fields)


def reconcile_pages(spark: SparkSession, path: str, item: StructType) -> DataFrame:
    """Declared ``info.count`` vs rows loaded; a missing count raises."""
    pages = spark.read.schema(page_schema(item)).option("mode", "FAILFAST").json(path)
    agg = pages.agg(F.max("info.count").alias("declared"),
                    F.sum(F.size("results")).cast("long").alias("loaded"),
                    F.count_if(F.col("info.count").isNull()).alias("_missing"))
    return agg.select(
        F.when(F.col("_missing") == 0, F.col("declared"))
         .otherwise(F.raise_error(F.lit("page without info.count"))).alias("declared"),
        "loaded", (F.col("declared") == F.col("loaded")).alias("ok"))


@dataclass(frozen=True)
class TableSpec:
    """One spec per table: name, item schema, fields to keep, key."""
    name: str
    item: StructType
    fields: tuple
    key: str

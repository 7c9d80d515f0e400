"""Line dedup over a corpus, in DataFrame operations only.

Every line gets the 64-bit hash of its key (white space stripped at both ends,
A-Z lower-cased). The (hash, document, position) rows are range-partitioned by
(hash, document) and sorted by position inside, so one pass streams over the
first occurrence of each line in each document; a hash that a third of all
documents share spans as many partitions as its rows need, because the document
is part of the range key. Only partial counts per hash are shuffled further.
What comes back to a document is its compressed keep bitmap, not its text: the
runs of kept lines (start, length). ``deduped`` cuts the texts by these runs.

Lines are equal by one 64-bit hash of their keys: with n different lines, n^2 / 2^65
pairs share one by chance, and a rare line that shares a frequent one's goes with it.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` (1 at least) code points are always kept; documents are rows, so a
repeated row counts again, and rows with the same id and text share one bitmap;
a null id is a value like any other; an empty table gives an empty table;
further columns pass through ``deduped`` unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, ascii_lower, let, stored


def _dropped(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int,
             keep: str) -> DataFrame:
    """Positions of the lines that go, for the documents that lose any."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(WS)))
    hashes = F.transform(
        keys, lambda k: F.when(F.char_length(k) >= max(min_chars, 1), F.xxhash64(k)))
    lines = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"),
                        F.posexplode(hashes).alias("_pos", "_h")).where("_h IS NOT NULL")
    in_doc = Window.partitionBy("_h", "_id", "_th").orderBy("_pos")
    # Repeated rows repeat each of their positions, so equality counts them all.
    firsts = lines.repartitionByRange("_h", "_id", "_th").withColumn(
        "_first", F.col("_pos") == F.first("_pos").over(in_doc)).where("_first")
    place = F.struct("_id", "_th", "_pos")
    # Stored, so that its size is known: a join with it is broadcast where that is
    # small, and elsewhere Spark can split the lines of a hot key.
    common = stored(firsts.groupBy("_h").agg(F.count("*").alias("_docs"), F.min(place).alias("_place"))
                    .where(F.col("_docs") >= min_docs).select("_h", "_place"), "line-dedup-keys")
    if keep == "first":
        hit = lines.join(common, "_h").where(~place.eqNullSafe(F.col("_place")))
    else:
        hit = lines.join(common.select("_h"), "_h", "left_semi")
    return (hit.groupBy("_id", "_th")
            .agg(F.sort_array(F.collect_set("_pos")).alias("_dropped")))


def _keep_runs(n: Column, dropped: Column) -> Column:
    """Runs of kept lines between the dropped positions (sorted)."""
    def runs(d: Column) -> Column:
        all_runs = F.transform(F.sequence(F.lit(0), F.size(d)), lambda j: F.struct(
            F.when(j == 0, 0).otherwise(F.get(d, j - 1) + 1).alias("start"),
            (F.when(j == F.size(d), n).otherwise(F.get(d, j))
             - F.when(j == 0, 0).otherwise(F.get(d, j - 1) + 1)).alias("len")))
        return F.filter(all_runs, lambda r: r["len"] > 0)
    return let(dropped, runs)


def _marked(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int,
            keep: str) -> DataFrame:
    """Columns ``_doc`` (the row), ``_lines`` (its lines) and ``_dropped``."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    gone = _dropped(docs, id_col, text_col, min_docs, min_chars, keep)
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_i"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
    on = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_th"))
    none = F.array().cast("array<int>")
    return rows.join(gone, on, "left").select(
        "_doc", F.coalesce("_dropped", none).alias("_dropped"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _cut(lines: Column, keep: Column) -> Column:
    return F.array_join(F.flatten(F.transform(
        keep, lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1, keep: str = "none",
                 with_text: bool = False) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_dropped`` and ``keep``, the keep
    bitmap as runs (start, len) of kept lines.

    A key found in at least ``min_docs`` documents loses all its lines
    (``keep="none"``) or all but its first in (document, position) order
    (``keep="first"``). ``with_text`` adds ``kept_text``.
    """
    m = _marked(docs, id_col, text_col, min_docs, min_chars, keep)
    lines = _lines(F.col("_doc").getField(text_col))
    out = m.select(
        F.col("_doc").getField(id_col).alias(id_col),
        let(lines, lambda ls: F.struct(
            F.size(ls).alias("n"), _keep_runs(F.size(ls), F.col("_dropped")).alias("keep"),
            (let(_keep_runs(F.size(ls), F.col("_dropped")), lambda k: _cut(ls, k)) if with_text
             else F.lit(None).cast("string")).alias("kept"))).alias("_x"),
        F.size("_dropped").cast("long").alias("n_dropped"))
    cols = [id_col, F.col("_x.n").cast("long").alias("n_lines"), "n_dropped",
            F.col("_x.keep").alias("keep")]
    return out.select(*cols, *([F.col("_x.kept").alias("kept_text")] if with_text else []))


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
            min_chars: int = 1, keep: str = "none") -> DataFrame:
    """The documents with their texts cut; same columns, same number of rows.
    A null text stays null."""
    m = _marked(docs, id_col, text_col, min_docs, min_chars, keep)
    text = F.col("_doc").getField(text_col)
    cut = F.when(F.size("_dropped") == 0, text).otherwise(let(_lines(text), lambda ls: let(
        _keep_runs(F.size(ls), F.col("_dropped")), lambda k: _cut(ls, k))))
    return m.select(*[cut.alias(c) if c == text_col else F.col("_doc").getField(c).alias(c)
                      for c in docs.columns])

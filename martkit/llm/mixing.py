"""Mixing sources to target weights by capped water-filling, in DataFrame
operations only.

Each source's target is its share by weight of the wanted total, clamped at
``max_epochs`` times its size; what the clamped sources leave over goes to the
others by weight until none is above its cap. Sorted by cap per weight, the
clamped sources are a prefix of that order, so running sums over one row per
source give the level at once.

Documents are then taken in whole and fractional repetitions: every document
``floor(target / size)`` times, and the rest of the target by a seeded draw: each
document draws 24 bits from its id; partial sums of sizes over the first 12 bits,
then over the last 12 of the one bucket where the rest runs out, give the
threshold below which documents are taken once more; documents exactly in the
last bucket are taken in part. So a source takes its target to within a few words
at any size, no document counts more than ``max_epochs`` times, and reruns agree.

Defined results: null text has size 0 and takes nothing; a null source is a
source, last in order; null ids draw like the empty string; repeated rows count
as they stand; a source of size 0 has target 0; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, words

BUCKETS = 4096  # 12 bits, as three hexadecimal digits of the draw


def source_targets(sizes: DataFrame, weights: list[int], share: tuple[int, int],
                   max_epochs: int) -> DataFrame:
    """One row per source: ``source, source_size, target``. ``sizes`` has
    ``source, size``; weights repeat over the sources in code-point order (null
    last); the targets add up to ``share[0]/share[1]`` of all sizes, if the caps
    let them."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.select("*", F.row_number().over(order).alias("_rn"))
    ranked = ranked.withColumn("_w", F.element_at(
        F.array(*[F.lit(int(w)).cast("long") for w in weights]),
        ((F.col("_rn") - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size") * max_epochs)
    every = Window.partitionBy()
    # Ratio cap/weight ascending: the clamped sources come first.
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_rn")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * share[0] / share[1]
    filled = ranked.select(
        "*", total.alias("_total"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0)).alias("_used"),
        F.sum("_w").over(after).alias("_left"))
    # Clamped when, with all before it clamped, its own share is above its cap.
    filled = filled.withColumn(
        "_clamped", (F.col("_total") - F.col("_used")) * F.col("_w") >= F.col("_cap") * F.col("_left"))
    level = filled.select(
        "*", F.sum(F.when(F.col("_clamped"), F.col("_cap")).otherwise(0)).over(every).alias("_c"),
        F.sum(F.when(F.col("_clamped"), 0).otherwise(F.col("_w"))).over(every).alias("_r"))
    return level.select("source", "source_size", F.when(F.col("_clamped"), F.col("_cap").cast("double"))
                        .otherwise(F.col("_w") * (F.col("_total") - F.col("_c")) / F.col("_r"))
                        .alias("target"))


def _draw(id_col: Column, seed: int, digits_from: int) -> Column:
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, digits_from, 3), 16, 10).cast("int")


def _crossing(rows: DataFrame, keys: list[str], bucket: str, budget: str) -> DataFrame:
    """Per key the bucket where the running size first exceeds the budget, and
    what the buckets before it leave: ``keys, _at, _rest, _bucket_size``."""
    sums = rows.groupBy(*keys, bucket).agg(F.sum("size").alias("_s"), F.first(budget).alias("_b"))
    run = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_cum", F.sum("_s").over(run))
    # Of the buckets that pass the budget, the first.
    return (sums.where("_cum > _b").groupBy(*keys)
            .agg(F.min_by(F.struct(F.col(bucket).alias("at"), (F.col("_b") - F.col("_cum") + F.col("_s")).alias("rest"),
                                   F.col("_s").alias("size")), F.col(bucket)).alias("_x"))
            .select(*keys, F.col("_x.at").alias("_at"), F.col("_x.rest").alias("_rest"),
                    F.col("_x.size").alias("_bucket_size")))


def mixing_plan(sizes: DataFrame, weights: list[int], share: tuple[int, int] = (3, 2),
                max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """One row per source: its target and the thresholds of the draw.
    ``sizes``: ``doc_id, source, size``, a stored table, as it is read three times."""
    # Tables of a row per source are stored, so that their sizes are known: joins with
    # them are broadcast where they are small, else Spark can split a hot source.
    targets = source_targets(sizes, weights, share, max_epochs).select(
        F.col("source").alias("_src"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).alias("_whole"))
    targets = stored(targets.withColumn(
        "_budget", F.col("target") - F.col("_whole") * F.col("source_size")), "mixing-targets")
    same = F.col("source").eqNullSafe(F.col("_src"))
    rows = (sizes.join(targets, same).drop("_src")
            .withColumns({"_u1": _draw(F.col("doc_id"), seed, 1), "_u2": _draw(F.col("doc_id"), seed, 4)}))
    one = stored(_crossing(rows, ["source"], "_u1", "_budget").select(
        F.col("source").alias("_src"), F.col("_at").alias("_at1"), F.col("_rest").alias("_rest1")), "mixing-buckets")
    inside = rows.join(one, same & (F.col("_u1") == F.col("_at1"))).drop("_src")
    two = _crossing(inside, ["source"], "_u2", "_rest1").select(
        F.col("source").alias("_src2"), F.col("_at").alias("_at2"), F.col("_rest").alias("_rest2"),
        "_bucket_size")
    cut = one.join(two, F.col("_src").eqNullSafe(F.col("_src2"))).drop("_src2", "_rest1")
    return stored(targets.withColumnRenamed("_src", "_source")
                  .join(cut, F.col("_source").eqNullSafe(F.col("_src")), "left").drop("_src", "_budget"),
                  "mixing-plan")


def _taken(doc_id: Column, size: Column, seed: int) -> Column:
    """Words taken of a document joined with its source's row of the plan."""
    u1, u2 = _draw(doc_id, seed, 1), _draw(doc_id, seed, 4)
    again = (F.when(F.col("_at1").isNull(), 0)  # a source without words
             .when((u1 < F.col("_at1")) | ((u1 == F.col("_at1")) & (u2 < F.col("_at2"))), size)
             .when((u1 == F.col("_at1")) & (u2 == F.col("_at2")),
                   F.floor(size * F.col("_rest2") / F.col("_bucket_size")))
             .otherwise(0))
    return (F.col("_whole") * size + again).cast("long")


def mix_sizes(sizes: DataFrame, weights: list[int], share: tuple[int, int] = (3, 2),
              max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """``sizes`` (see ``mixing_plan``) with ``source_size, target, taken``."""
    plan = mixing_plan(sizes, weights, share, max_epochs, seed)
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target",
        _taken(F.col("doc_id"), F.col("size"), seed).alias("taken"))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"))


def mixed(docs: DataFrame, weights: list[int], share: tuple[int, int] = (3, 2),
          max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """The documents as the mix takes them, with their own columns: a row for each
    whole repetition, and one with the first words of the text for a part of one.
    Documents of which no word is taken go."""
    sizes = stored(document_sizes(docs), "mixing-sizes")
    plan = mixing_plan(sizes, weights, share, max_epochs, seed)
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"),
                       F.col("source").alias("_s"), n_words(F.col("text")).alias("_n"))
    rows = rows.join(plan, F.col("_s").eqNullSafe(F.col("_source"))).select(
        "_doc", "_n", _taken(F.col("_id"), F.col("_n"), seed).alias("_taken")).where("_taken > 0")
    text, part = F.col("_doc").getField("text"), F.col("_taken") % F.col("_n")
    copies = F.concat(
        F.array_repeat(text, F.floor(F.col("_taken") / F.col("_n")).cast("int")),
        F.when(part > 0, F.array(F.array_join(F.slice(words(text), 1, part.cast("int")), " ")))
        .otherwise(F.array().cast("array<string>")))
    return rows.select("_doc", F.explode(copies).alias("_text")).select(
        *[F.col("_text").alias(c) if c == "text" else F.col("_doc").getField(c).alias(c)
          for c in docs.columns])

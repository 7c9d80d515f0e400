"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Base rules are fixed limits. Every other rule is a per-document statistic that is
large for bad text and a cutoff above which the document goes. The cutoffs are
certified on labelled documents, per stratum (language), in two ways:

* jointly: ``PATH`` is one fixed sequence of vectors of cutoffs, each stricter than
  the one before in one rule. A vector is certified while the exact binomial test
  rejects "all its rules together reject more than ``alpha`` of the good documents",
  that is while P(Binomial(n, alpha) <= k) <= delta/strata for the k among n good
  labelled documents that any of its rules rejects; the first failure ends the
  sequence. With four strata, 218 labels without a false rejection suffice.
* each rule alone, at ``alpha``/rules and delta/(rules x strata), along its own
  cutoffs. This takes far more labels, but a rule that does not suit a language
  ends its own sequence only.

Fixed-sequence testing needs no share of delta per cutoff; ``JOINT`` of ``delta`` goes
to the first way and the rest to the second. So with probability 1 - ``delta`` both
vectors of every stratum reject at most ``alpha`` of its good documents, and whichever
rejects more of the documents labelled bad is used. A stratum with too few labels
for either certifies nothing and loses nothing beyond the base rules.

Defined results: null, empty and blank texts have no words and fail the base
rules; a null stratum is a stratum; repeated labels of a document count once, as
bad if any says so; labels without a document and null labels are left out; empty
documents give an empty table, empty labels leave the base rules alone; repeated
rows are judged alike; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, let, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PCT = 30

#: rule -> (numerator, denominator, cutoffs from lenient to strict), as ratios.
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols", "n_words", (1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    "shouted_words": ("n_shouted", "n_words", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "marks_per_word": ("n_marks", "n_words", (1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1)),
    "duplicate_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeated_words": ("n_repeat_words", "n_words", (0.29, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "word_length": ("word_chars", "n_words", (20.0, 15.0, 12.0, 10.0, 9.0, 8.0)),
}

#: (rule, cutoff) in the order in which joint vectors take them up: all rules
#: advance alike, from their most lenient cutoffs to their strictest.
PATH: list[tuple[str, float]] = [(r, c) for _, r, c in sorted(
    ((i / len(cuts), r, c) for r, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts)),
    key=lambda x: x[0])]
#: Share of delta that the joint vectors get.
JOINT = 0.98


def _repeat_words(ws: Column) -> Column:
    """Words that lie in a window of 8 whose words occur twice or more in the text."""
    def hashed(hw: Column) -> Column:
        n = F.size(hw) - (WINDOW - 1)
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
            *[F.get(hw, i + k) for k in range(WINDOW)]))

    def repeated(win: Column) -> Column:
        def flagged(s: Column) -> Column:
            at = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
            starts = F.sort_array(F.transform(at, lambda x: x["i"]))
            return let(starts, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.when(j == 0, WINDOW).otherwise(
                    F.least(F.lit(WINDOW), x - F.get(p, j - 1)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x))
        ordered = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # Sorting the bare hashes is cheap and settles most documents.
        twice = F.size(F.array_distinct(win)) < F.size(win)
        return F.when(twice, let(ordered, flagged)).otherwise(F.lit(0).cast("long"))

    hw = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) < WINDOW, F.lit(0).cast("long")).otherwise(
        let(hw, lambda a: let(hashed(a), repeated)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang", also: Sequence[Column] = ()) -> DataFrame:
    """One row per document: ``doc_id, stratum``, the statistics of its whole text
    and the columns ``also``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")

    def less(t: Column, chars: str) -> Column:
        return F.char_length(t) - F.char_length(F.translate(t, chars, ""))

    stats = let(words(text), lambda ws: F.struct(
        F.size(ws).alias("n_words"), _repeat_words(ws).alias("n_repeat_words"),
        F.size(F.filter(ws, lambda w: (F.upper(w) == w) & (F.lower(w) != w)
                        & (F.char_length(w) > 1))).alias("n_shouted")))
    by_line = let(lines, lambda ls: F.struct(
        F.size(ls).alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines")))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"),
        F.char_length(F.translate(text, WS, "")).cast("long").alias("word_chars"),
        less(text, SYMBOLS).cast("long").alias("n_symbols"), less(text, "!").cast("long").alias("n_marks"),
        stats.alias("_s"), by_line.alias("_l"), F.struct(F.lit(0), *also).alias("_also")).select(
        "doc_id", "stratum", F.col("_s.n_words").cast("long").alias("n_words"), "word_chars",
        "n_symbols", F.col("_l.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("_s.n_repeat_words").cast("long").alias("n_repeat_words"), "n_marks",
        F.col("_l.n_lines").cast("long").alias("n_lines"),
        F.col("_s.n_shouted").cast("long").alias("n_shouted"), "_also.*").drop("col1")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PCT * F.col("n_words"))


def _score(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term in logarithms; exact to rounding.
    Above the mean, where no cutoff is certified, it is 1 without summing."""
    ln_p, ln_q = F.log(F.lit(p)), F.log1p(F.lit(-p))
    start = F.struct((n * ln_q).alias("t"), (n * ln_q).alias("s"))

    def step(acc: Column, i: Column) -> Column:
        t = acc["t"] + F.log((n - i + 1) / i) + ln_p - ln_q
        hi, lo = F.greatest(acc["s"], t), F.least(acc["s"], t)
        return F.struct(t.alias("t"), (hi + F.log1p(F.exp(lo - hi))).alias("s"))

    upto = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(
        F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(
        F.exp(F.aggregate(upto, start, step, lambda a: a["s"])))


def _one_per_id(feats: DataFrame) -> DataFrame:
    """One row per id: where an id comes with several texts, the one of the least
    features, so that reruns certify the same cutoffs."""
    rest = [c for c in feats.columns if c != "doc_id"]
    return feats.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("_row")).select("doc_id", "_row.*")


def certified_cutoffs(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                      label_col: str = "quality", alpha: float = 0.02,
                      delta: float = 0.05) -> DataFrame:
    """``stratum, rule, cutoff``: the strictest cutoff of each rule that is certified for
    the rule alone in each stratum (a row for every rule; null where there is none)."""
    good = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
            .agg(F.min(label_col).alias("_good")).where("_good = 1"))
    held = _one_per_id(feats.where(~base_failed())).join(good, F.col("doc_id") == F.col("_id"), "left_semi")
    counts = held.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.count_if(_score(r) > c).alias(f"{r}_{i}")
          for r, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts)])
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                               F.col(f"{r}_{i}").alias("k"))
                      for r, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts)])
    strata = counts.select(F.count("*")).scalar()
    flat = counts.select("stratum", "n", F.explode(tests).alias("x")).select("stratum", "n", "x.*")
    # At most strata x cutoffs rows from here on, whatever the size of the corpus.
    tested = flat.withColumn(
        "pass", binomial_cdf(F.col("k"), F.col("n"), alpha / len(RULES))
        <= F.lit(delta) / (strata * len(RULES)))
    failed = F.min(F.when(~F.col("pass"), F.col("step")))
    seq = tested.groupBy("stratum", "rule").agg(
        F.coalesce(failed, F.lit(10_000)).alias("_stop"),
        F.collect_list(F.struct("step", "cutoff")).alias("_cuts"))
    return seq.select("stratum", "rule", F.array_min(F.transform(
        F.filter("_cuts", lambda c: c["step"] < F.col("_stop")), lambda c: c["cutoff"])).alias("cutoff"))


def joint_steps(held: DataFrame, alpha: float, delta: float) -> DataFrame:
    """``stratum, step``: the last step of ``PATH`` whose joint vector is certified, -1
    for none, for every stratum with a good document among the labelled ``held``."""
    steps = {r: [i for i, (rule, _) in enumerate(PATH) if rule == r] for r in RULES}

    def first_step(rule: str) -> Column:
        out = F.lit(len(PATH))
        for i in reversed(steps[rule]):
            out = F.when(_score(rule) > PATH[i][1], i).otherwise(out)
        return out

    at = held.where("_good = 1").groupBy("stratum", F.least(*map(first_step, RULES)).alias("at")).agg(
        F.count("*").alias("k"))
    hist = at.groupBy("stratum").agg(F.sum("k").alias("n"), F.collect_list(F.struct("at", "k")).alias("hist"))
    strata = hist.select(F.count("*")).scalar()
    # At most strata x cutoffs rows from here on, whatever the size of the corpus.
    flat = hist.select("stratum", "n", "hist", F.explode(F.sequence(F.lit(0), F.lit(len(PATH) - 1))).alias("step"))
    k = F.aggregate(F.filter("hist", lambda x: x["at"] <= F.col("step")), F.lit(0).cast("long"),
                    lambda acc, x: acc + x["k"])
    tested = flat.select("stratum", "n", "step", k.alias("k")).withColumn(
        "pass", binomial_cdf(F.col("k"), F.col("n"), alpha) <= F.lit(delta) / strata)
    return tested.groupBy("stratum").agg(
        (F.coalesce(F.min(F.when(~F.col("pass"), F.col("step"))), F.lit(len(PATH))) - 1).alias("step"))


def _exceeds(cut: str) -> Column:
    """Whether any rule's statistic is above its cutoff in the column ``cut`` + rule."""
    out = F.lit(False)
    for r in RULES:
        out = out | F.coalesce(_score(r) > F.col(f"{cut}{r}"), F.lit(False))
    return out


def certified_vectors(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                      label_col: str = "quality", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``_stratum`` and a column ``_cut_`` + rule for every rule (null: not used): per
    stratum the joint vector or the vector of the rules certified alone, whichever
    rejects more of the documents labelled bad."""
    told = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
            .agg(F.min(label_col).alias("_good")))
    held = feats.where(~base_failed()).join(told, F.col("doc_id") == F.col("_id")).drop("_id")
    held = stored(_one_per_id(held), "quality-held")
    alone = certified_cutoffs(held.drop("_good"), held.select(F.col("doc_id").alias(id_col), F.col("_good").alias(label_col)),
                              id_col, label_col, alpha, (1 - JOINT) * delta)
    alone = alone.groupBy(F.col("stratum").alias("_s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_alone_{r}") for r in RULES])
    joint = joint_steps(held, alpha, JOINT * delta).select(F.col("stratum").alias("_stratum"), *[
        F.least(*[F.when(F.col("step") >= i, c) for i, (rule, c) in enumerate(PATH) if rule == r]).alias(f"_joint_{r}")
        for r in RULES])
    both = stored(joint.join(alone, F.col("_stratum").eqNullSafe(F.col("_s"))).drop("_s"), "quality-vectors")
    caught = held.where("_good <> 1").join(both, F.col("stratum").eqNullSafe(F.col("_stratum"))).groupBy(
        F.col("stratum").alias("_s")).agg(
        (F.count_if(_exceeds("_alone_")) > F.count_if(_exceeds("_joint_"))).alias("_alone"))
    # Stored, so that its size is known and joins with it broadcast: a stratum may be hot.
    return stored(both.join(caught, F.col("_stratum").eqNullSafe(F.col("_s")), "left").select("_stratum", *[
        F.when(F.col("_alone"), F.col(f"_alone_{r}")).otherwise(F.col(f"_joint_{r}")).alias(f"_cut_{r}")
        for r in RULES]), "quality-cutoffs")


def judged(feats: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``feats`` (a stored table: it is read twice) with ``base_failed`` and ``kept``."""
    cuts = certified_vectors(feats, labels, alpha=alpha, delta=delta)
    out = feats.join(cuts, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return out.select(*feats.columns, base_failed().alias("base_failed"),
                      (~(base_failed() | _exceeds("_cut_"))).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, alpha: float = 0.02,
             delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns. Verdicts
    travel by (id, hash of the text), as rows may share an id."""
    th = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    feats = stored(features(docs, also=[th.alias("_th")]), "quality-features")
    bad = judged(feats, labels, alpha, delta).where("NOT kept").select(
        F.col("doc_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), th.alias("_text_hash"))
    return rows.join(bad, F.col("_id").eqNullSafe(F.col("_bad_id")) & (F.col("_text_hash") == F.col("_bad_th")),
                     "left_anti").select("_doc.*")

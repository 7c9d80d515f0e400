"""Typing and data-quality operators.

Parquet tables refuse declared constraints, so checks are data: a rule list
turns one DataFrame into (good rows, rejected rows tagged with the rule).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



@dataclass(frozen=True)
class Rule:
    """``kind`` is one of ``not_null``, ``check``, ``unique``, ``primary_key``, ``domain``.

    * not_null: ``cols`` must be non-NULL.
    * check: boolean ``expr``; as in SQL, a NULL result passes.
    * unique: every copy of a repeated key is rejected; as in SQL, keys with a
      NULL never repeat.
    * primary_key: unique, and no column of the key may be NULL.
    * domain: ``cols[0]`` must be in ``values`` (NULL passes, like a CHECK).
    """
    name: str
    kind: str
    cols: tuple = ()
    expr: Column | None = None
    values: tuple = field(default=())


def not_null(name, *cols):
    return Rule(name, "not_null", tuple(cols))


def check(name, expr):
    return Rule(name, "check", (), expr)


def unique(name, *cols):
    return Rule(name, "unique", tuple(cols))


def domain(name, col_, values):
    return Rule(name, "domain", (col_,), None, tuple(values))


def primary_key(name, *cols):
    return Rule(name, "primary_key", tuple(cols))


def _row_failure(r: Rule) -> Column | None:
    """Whether a row alone fails the rule; None if that takes other rows."""
    missing = F.lit(False)
    for c in r.cols:
        missing = missing | F.col(c).isNull()
    if r.kind in ("not_null", "primary_key"):
        return missing
    if r.kind == "check":
        return ~F.coalesce(r.expr, F.lit(True))
    if r.kind == "domain":
        c = F.col(r.cols[0])
        return c.isNotNull() & ~c.isin(*r.values)
    if r.kind == "unique":
        return None
    raise ValueError(r.kind)


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows passing every rule and one rejected row per
    (row, failed rule) with a ``rule`` column.

    All rules on single rows are one array of failed names, computed in one pass;
    a key rule adds a partial count per key and a join with the repeated keys."""
    checks = [F.when(_row_failure(r), F.lit(r.name)) for r in rules if _row_failure(r) is not None]
    marked = df.withColumn("_failed", F.array_compact(F.array(*checks)) if checks
                           else F.array().cast("array<string>"))
    for i, r in enumerate(rules):
        if r.kind not in ("unique", "primary_key"):
            continue
        key = F.struct(*[F.col(c) for c in r.cols])
        some = F.lit(True)
        for c in r.cols:
            some = some & F.col(c).isNotNull()
        dup = (df.where(some).groupBy(key.alias(f"_k{i}")).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > 1).select(f"_k{i}", F.lit(r.name).alias(f"_d{i}")))
        marked = (marked.join(dup, key == F.col(f"_k{i}"), "left")
                  .withColumn("_failed", F.array_union("_failed", F.array_compact(F.array(f"_d{i}"))))
                  .drop(f"_k{i}", f"_d{i}"))
    good = marked.where(F.size("_failed") == 0).select(*df.columns)
    return good, marked.select(*df.columns, F.explode("_failed").alias("rule"))


def assert_domain(c, values) -> Column:
    """P11, fail-fast form: the value itself, or a runtime error naming it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull() | c.isin(*values), c).otherwise(
        F.raise_error(F.concat(F.lit("value outside domain: "), c.cast("string"))))


def typed_view(df: DataFrame, schema: StructType | dict[str, str], safe: bool = False) -> DataFrame:
    """Cast text columns to declared types. ``safe`` gives NULL for
    bad input (try_cast); otherwise ANSI casts raise on bad text."""
    items = ([(f.name, f.dataType.simpleString()) for f in schema.fields]
             if isinstance(schema, StructType) else list(schema.items()))
    cols = []
    for name, t in items:
        c = F.col(name)
        cols.append((c.try_cast(t) if safe else c.cast(t)).alias(name))
    return df.select(*cols)


def as_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every column rendered as text (the raw landing layout)."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


def evolve(frames: Sequence[DataFrame], casts: dict[str, str] | None = None) -> DataFrame:
    """Union old and new layouts by name; missing columns become NULL;
    ``casts`` widens/limits types first."""
    casts = casts or {}
    out = None
    for f in frames:
        f = f.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c)
                       for c in f.columns])
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out

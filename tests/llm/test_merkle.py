"""The Merkle manifest against a plain tree."""

import random
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from martkit.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return sha256(s.encode()).hexdigest()


def plain_leaf(r):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in
                     (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([h("".join(a[i:i + 2])) for i in range(0, len(a), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else None, i ^ 1 < i))
        i //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[g] = plain_tree([plain_leaf(r) for r in groups[g]])
    top = plain_tree([trees[g][-1][0] for g in order]) if order else None
    return Counter((r["doc_id"], plain_leaf(r), i, trees[g][-1][0], top[-1][0],
                    tuple(siblings(trees[g], i) + siblings(top, at)))
                   for at, g in enumerate(order) for i, r in enumerate(groups[g]))


def found(df):
    return Counter((r.doc_id, r.leaf, r.position, r.subroot, r.root, tuple((s.sibling, s.left) for s in r.proof))
                   for r in df.collect())


def some_rows(n, langs, seed):
    rng = random.Random(seed)
    rows = [dict(doc_id=rng.choice([None, rng.randrange(3 * n), -rng.randrange(9)]), lang=rng.choice(langs),
                 text=rng.choice([None, "", "é\n" * rng.randrange(5), "x" * 40]), source=rng.choice([None, "a", "ß"]),
                 n_chars=rng.choice([None, 0, 2**63 - 1, rng.randrange(99)])) for _ in range(n)]
    return rows + rows[: n // 4]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (9, [None]), (23, [None, "", "en", "fr"]), (80, ["en"]),
                                      (40, [None, *map(str, range(30))])])
def test_manifest(spark, n, langs):
    rows = some_rows(n, langs, n)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), block=4)
    assert found(got) == brute(rows)
    checked = got.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"),
                         (merkle.fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).alias("bad"))
    assert {(r.ok, r.bad) for r in checked.collect()} == {(True, False)}


def test_default_block_crosses_rounds(spark):
    rows = [dict(doc_id=i, lang="en" if i % 8 else "de", text=str(i), source=None, n_chars=i) for i in range(2500)]
    assert found(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = some_rows(12, ["en", "fr"], 1)
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("g", "idx", "n", "digest", "leaf", "root", "proof", "block", "_tie")})
    assert found(merkle.manifest(df, block=4)) == brute(rows)


def test_numbers_of_time(spark):
    tree = merkle.climb([h(str(i)) for i in range(5)], 3)
    assert tree == plain_tree(tree[0]) and [len(x) for x in tree] == [5, 3, 2, 1]
    assert merkle.descend(tree, [("up", True)]) == [siblings(tree, i) + [("up", True)] for i in range(5)]
    lone = merkle.climb([h("a")], 2)  # the last block of a larger tree
    assert lone == [[h("a")], [h(h("a"))], [h(h(h("a")))]]

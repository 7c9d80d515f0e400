"""The reference's worked examples (stated inputs and answers), run through
the Spark operators on tiny in-test frames."""

from pyspark.sql import functions as F

from martkit.operators.aggs import common_prefix, divisible_difference
from martkit.operators.ordered import gaps, local_minima, pair_sum, pointer_compose, running_sum


def seq(spark, values, key=0):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "k int, i int, v long")


def test_running_sum(spark):
    for vals, want in [([1, 2, 3, 4], [1, 3, 6, 10]), ([1, 1, 1, 1, 1], [1, 2, 3, 4, 5]),
                       ([3, 1, 2, 10, 1], [3, 4, 6, 16, 17])]:
        out = running_sum(seq(spark, vals), "k", "i", "v", "r", rows_per_bucket=2).orderBy("i")
        assert [r.r for r in out.collect()] == want


def test_richest_entity(spark):
    for accounts, want in [([[1, 2, 3], [3, 2, 1]], 6), ([[1, 5], [7, 3], [3, 5]], 10),
                           ([[2, 8, 7], [7, 1, 3], [1, 9, 5]], 17)]:
        df = spark.createDataFrame([(c, m) for c, row in enumerate(accounts) for m in row],
                                   "c int, m long")
        got = df.groupBy("c").agg(F.sum("m").alias("w")).agg(F.max("w")).first()[0]
        assert got == want


def test_pair_sum(spark):
    out = pair_sum(seq(spark, [2, 7, 11, 15]), "k", "v", ["i"], 9).first()
    assert (out.i.i, out.j.i) == (0, 1)


def test_common_prefix(spark):
    df = spark.createDataFrame([(1, "flower"), (1, "flow"), (1, "flight"), (2, "dog"),
                                (2, "racecar"), (3, None), (3, "solo")], "g int, s string")
    got = {r.g: r.prefix for r in common_prefix(df, "g", "s").collect()}
    assert got == {1: "fl", 2: "", 3: "solo"}


def test_gap_detection(spark):
    out = gaps(seq(spark, [3, 0, 1]).select("k", F.col("v").alias("id")), "k", "id", lo=0, hi=3)
    assert [r.missing for r in out.collect()] == [2]


def test_pointer_compose(spark):
    nums = [0, 2, 1, 5, 3, 4]
    df = spark.createDataFrame(list(enumerate(nums)), "i long, v long")
    out = pointer_compose(df, "i", "v", "c").orderBy("i")
    assert [r.c for r in out.collect()] == [0, 1, 2, 4, 5, 3]


def test_divisible_difference(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "x")
    assert divisible_difference(df, "x", 3).first()[0] == 19


def test_local_minimum(spark):
    out = local_minima(seq(spark, [3, 2, 1, 4]), "k", ["i"], "v", first=True).first()
    assert out.i == 2
    # ends count as +infinity
    out = local_minima(seq(spark, [1, 2, 3]), "k", ["i"], "v", first=False).collect()
    assert [r.i for r in out] == [0]

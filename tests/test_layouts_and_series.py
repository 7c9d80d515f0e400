"""Metadata counts, month reload, curve layout, small-series as-of, cubes and bitmaps."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.aggs import (count_bitmaps, cube_bitmaps, cube_report, distinct_bitmaps,
                                    merge_bitmaps)
from martkit.operators.joins import asof_left, asof_probes, asof_series, small_series
from martkit.session import scratch_path
from martkit.sources.layouts import curve_layout, lookup
from martkit.sources.tables_io import (footer_scan, footer_stats, partition_row_counts, read_months,
                                       reload_months, write_month_partitioned)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, n=300, seed=0):
    rng = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [(i, None if i % 50 == 0 else start + dt.timedelta(days=rng.randrange(120), hours=rng.randrange(24)),
          rng.choice([None, 1.5, 2.5])) for i in range(n)], "id long, ts timestamp_ntz, v double")


# ---------------------------------------------------------------- footers
def test_footer_counts_read_no_rows(spark):
    ev = events(spark)
    path = write_month_partitioned(ev, "ts", scratch_path(spark, "months"))
    table = footer_scan(spark, path, read_months(spark, path, ev.schema).schema)
    whole, months = footer_stats(table, ["id"]), partition_row_counts(table)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan(whole)
    assert "PushedAggregation: [COUNT(*)]" in plan(months) and "PushedGroupBy: [ym]" in plan(months)
    assert tuple(whole.first()) == (300, 0, 299)
    want = {r.ym: r.n for r in ev.groupBy((F.year("ts") * 100 + F.month("ts")).alias("ym")).agg(F.count("*").alias("n")).collect()}
    assert {r.ym: r.n_rows for r in months.collect()} == want and None in want


def test_footer_counts_of_nothing(spark):
    ev = events(spark).limit(0)
    path = write_month_partitioned(ev, "ts", scratch_path(spark, "months"))
    table = footer_scan(spark, path, read_months(spark, path, ev.schema).schema)
    assert tuple(footer_stats(table, ["id"]).first()) == (0, None, None)
    assert partition_row_counts(table).collect() == []
    assert read_months(spark, path, ev.schema).count() == 0


def test_footer_scan_leaves_other_reads(spark):
    path = scratch_path(spark, "plain")
    events(spark).write.parquet(path)
    footer_scan(spark, path)
    assert "FileScan parquet" in plan(spark.read.parquet(path))


# ---------------------------------------------------------------- one-month reload
def files(path):
    return {os.path.relpath(f, path): os.path.getmtime(f) for f in glob.glob(f"{path}/ym=*/*.parquet")}


def test_reload_touches_its_months_only(spark):
    ev = events(spark)
    path = write_month_partitioned(ev, "ts", scratch_path(spark, "months"))
    old = files(path)
    now = read_months(spark, path, ev.schema)
    anew = now.where("ym = 202002 AND v IS NOT NULL").drop("ym").withColumn("v", -F.col("v"))
    got = reload_months(anew, "ts", path)
    new = files(path)
    same = {f: t for f, t in old.items() if not f.startswith("ym=202002")}
    assert same == {f: t for f, t in new.items() if not f.startswith("ym=202002")} and len(same) > 3
    assert not {f for f in old if f.startswith("ym=202002")} & set(new)
    rows = ev.collect()
    feb = {r.id: -r.v for r in rows if r.ts and r.ts.month == 2 and r.v is not None}
    rest = {r.id: r.v for r in rows if not (r.ts and r.ts.month == 2)}
    assert {r.id: r.v for r in got.collect()} == feb | rest


def test_reload_of_nothing_changes_nothing(spark):
    ev = events(spark)
    path = write_month_partitioned(ev, "ts", scratch_path(spark, "months"))
    old = files(path)
    assert reload_months(ev.limit(0), "ts", path).count() == 300 and files(path) == old


# ---------------------------------------------------------------- curve layout
def scanned_rows(df):
    """Rows that the parquet scans of a finished query gave out."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.executedPlan())
            continue
        if "Scan parquet" in p.nodeName():
            total += p.metrics().apply("numOutputRows").value()
        if "QueryStage" in p.nodeName():
            todo.append(p.plan())
        it = p.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return total


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(40_000).selectExpr("id", "CAST(pmod(hash(id), 1000) AS INT) AS a",
                                          "pmod(hash(id, 7), 5000) AS b", "pmod(xxhash64(id), 97) / 7.0 AS v").cache()


def test_curve_layout_skips_on_every_key(spark, points):
    t = curve_layout(spark, points, ["id", "a", "b"], bits=6, n_files=64)
    assert sorted(t.collect()) == sorted(points.collect())
    key = points.where("id = 12345").first()
    for cols, share in ((["id"], 0.5), (["a"], 0.5), (["b"], 0.5), (["a", "b"], 0.25), (["id", "a", "b"], 0.1)):
        found = lookup(t, spark.createDataFrame([key]).select(*cols))
        want = points.where(" AND ".join(f"{c} = {key[c]}" for c in cols))
        assert sorted(found.collect()) == sorted(want.collect())
        assert scanned_rows(found) <= share * 40_000, cols


def test_lookup_literals_or_join(spark, points):
    keys = points.where("id % 4000 = 0").select("a", "b")
    keys = keys.union(keys).union(spark.createDataFrame([(None, 1)], "a int, b int"))
    want = sorted(points.join(keys.distinct(), ["a", "b"], "left_semi").select(points.columns).collect())
    assert sorted(lookup(points, keys).collect()) == want
    assert sorted(lookup(points, keys, max_keys=3).select(points.columns).collect()) == want
    assert lookup(points, keys.limit(0)).collect() == []


def test_curve_of_odd_columns(spark):
    rows = [(None, 1, dt.date(2020, 1, 1)), (5, None, None), (5, 5, dt.date(2021, 1, 1))] * 5
    df = spark.createDataFrame(rows, "a int, b int, d date")
    assert sorted(map(str, curve_layout(spark, df, ["a", "b", "d"]).collect())) == sorted(map(str, df.collect()))
    assert curve_layout(spark, df.limit(0), ["a", "b"]).collect() == []
    with pytest.raises(TypeError):
        curve_layout(spark, df.withColumn("s", F.lit("x")), ["a", "s"])


# ---------------------------------------------------------------- small series
def series_data(spark, seed, kind):
    rng = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    at = {"timestamp_ntz": lambda x: base + dt.timedelta(minutes=x), "bigint": lambda x: x,
          "date": lambda x: (base + dt.timedelta(days=x)).date(), "double": lambda x: x / 4}[kind]
    odd = lambda x: None if rng.random() < 0.05 else x
    when = lambda: rng.choice([rng.randrange(40), rng.randrange(400), rng.randrange(400), 5_000])  # noqa: E731 - an outlier
    left = [(odd(rng.randrange(5)), odd(at(when())), i) for i in range(150)]
    right = [(odd(rng.randrange(4)), odd(at(when())), rng.randrange(3), odd(f"r{i}")) for i in range(700)]
    return (spark.createDataFrame(left, f"k int, t {kind}, i int"),
            spark.createDataFrame(right, f"k int, at {kind}, seq int, name string"))


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "bigint", "date", "double"])
def test_small_series_like_the_window_form(spark, kind, direction):
    left, right = series_data(spark, len(kind), kind)
    cols = ["at", "seq", "name"]
    series = small_series(right, "k", "at", cols, tie=["seq", "name"])
    got = asof_series(left, series, "k", "t", cols, prefix_="r_", direction=direction)
    want = asof_left(left, right, "k", "t", "at", cols, tie=["seq", "name"], prefix_="r_", direction=direction)
    assert series.n > 1 and got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_probes_both_ways_and_no_exchange(spark):
    left, right = series_data(spark, 3, "timestamp_ntz")
    left = left.withColumn("name", F.lit("own")).withColumn("k2", F.col("k") + 1)
    probes = {"a_": ("k", "t", None, ["at", "name"]), "b_": ("k2", "t", F.expr("INTERVAL 2 HOURS"), ["seq"])}
    small = asof_probes(left, right, probes, "k", "at", tie=["seq", "name"])
    large = asof_probes(left, right, probes, "k", "at", tie=["seq", "name"], max_bytes=0)
    assert small.columns == large.columns == [*left.columns, "a_at", "a_name", "b_seq"]
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    facts = spark.range(1000).selectExpr("CAST(id % 4 AS INT) AS k", "TIMESTAMP_NTZ'2020-01-01' AS t")
    p = plan(asof_series(facts, small_series(right, "k", "at", ["seq"]), "k", "t", ["seq"]))
    before_join = p[p.index("BroadcastHashJoin"):p.index("BroadcastExchange")]
    assert "Exchange" not in before_join and "Window" not in before_join and "Sort" not in before_join


def test_series_of_nothing(spark):
    left, right = series_data(spark, 4, "bigint")
    series = small_series(right.limit(0), "k", "at", ["seq"])
    rows = asof_series(left, series, "k", "t", ["seq"]).collect()
    assert len(rows) == 150 and {r.seq for r in rows} == {None}
    assert small_series(right, "k", "at", ["seq"], max_bytes=100) is None


# ---------------------------------------------------------------- cubes
def cube_rows(n=400, seed=2):
    rng = random.Random(seed)
    return [(rng.choice([None, "a", "b"]), rng.choice(["x", "y", None]), rng.choice([None, *range(40)]),
             rng.choice([None, rng.randrange(1000)])) for _ in range(n)]


def test_cube_with_distinct_counts(spark):
    rows = cube_rows()
    df = spark.createDataFrame(rows, "d1 string, d2 string, who int, amount long")
    got = {(r.d1, r.d2, r.gid): (r.total, r.row_count, r.people) for r in
           cube_report(df, ["d1", "d2"], {"total": "amount"}, distinct={"people": "who"}).collect()}
    want = {}
    for gid in range(4):
        for a, b, who, amount in rows:
            key = (None if gid & 2 else a, None if gid & 1 else b, gid)
            t, n, p = want.get(key, (None, 0, frozenset()))
            want[key] = ((t or 0) + amount if amount is not None else t, n + 1, p | ({who} - {None}))
    assert got == {k: (t, n, len(p)) for k, (t, n, p) in want.items()}
    p = plan(cube_report(df, ["d1", "d2"], {"total": "amount"}, distinct={"people": "who"}))
    expand = p[p.index("Expand"):]
    assert "HashAggregate(keys=[d1" in expand.split("Scan")[0]  # rows are added up below the Expand


def test_bitmaps_merge_and_roll_up(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]),
             rng.choice([None, rng.randrange(100_000), -rng.randrange(70_000), 2 ** 40 + rng.randrange(9)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, h string, v long")
    parts = [distinct_bitmaps(df.where(f"v % 3 = {i}"), ["g", "h"], "v") for i in (-2, -1, 0, 1, 2)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merge_bitmaps(merged.unionByName(p), ["g", "h"])
    cube = {(r.g, r.h, r.gid): r.n_distinct for r in cube_bitmaps(merged, ["g", "h"]).collect()}
    want = {}
    for gid in range(4):
        for a, b, v in rows:
            if v is not None:
                want.setdefault((None if gid & 2 else a, None if gid & 1 else b, gid), set()).add(v)
    assert cube == {k: len(v) for k, v in want.items()}
    by_g = {r.g: r.n_distinct for r in count_bitmaps(merge_bitmaps(merged, "g"), "g").collect()}
    assert by_g == {k[0]: len(v) for k, v in want.items() if k[2] == 1}

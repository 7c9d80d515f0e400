"""Publication, page chains, rejects, serial ids and streamed distinct counts."""

import json
import random
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from martkit.operators.upsert import extend_key_map, with_serial_id
from martkit.session import scratch_path
from martkit.sources.files import csv_scan_rejects
from martkit.sources.json_docs import json_scan_rejects
from martkit.sources.page_chain import chain_findings, follow
from martkit.sources.published import current_version, publish, published
from martkit.streaming.incremental import (bitmap_fold, file_stream, fold_stream_into, land_stream_files,
                                           latest_fold, read_bitmaps, read_sketches, read_target,
                                           sketch_error, sketch_fold, streaming_totals, totals_fold)


# ---------------------------------------------------------------- publication
def numbers(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x int")


def values(df):
    return sorted(r.x for r in df.collect())


def test_sources_of_a_load_are_computed_once(spark, tmp_path):
    from martkit.plans.q_sources import load_sources
    from martkit.sources.tables import Tables
    spark.sql("SELECT id AS o_orderkey, timestamp_ntz'1995-01-01' AS o_orderdate FROM range(4)") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 5, 6, 2.0), (1, 1, 5, 6, 3.0), (2, 1, 5, 6, 4.0), (9, 1, 5, 6, 1.0)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    sources = load_sources(Tables(spark, str(tmp_path)))
    assert [(name, df.count()) for name, df, _ in sources] == [("bookings", 4), ("tickets", 2), ("ticket_flights", 2)]
    assert sorted(r.quantity for r in sources[2][1].collect()) == [4.0, 5.0]
    for _, df, _ in sources:  # a plain scan: no join, JSON or grouping to run again
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and not any(x in plan for x in ("Join", "json", "Aggregate")), plan


def test_readers_see_whole_loads_only(spark):
    root = scratch_path(spark, "catalog")
    assert current_version(spark, root) == 0 and published(spark, root, "a") is None
    assert publish(spark, root, {"a": lambda now: numbers(spark, 1), "b": lambda now: numbers(spark, 2)}) == 1
    held = published(spark, root, "a")

    def fails(now):
        return now.select(F.raise_error(F.lit("no")).cast("int").alias("x"))

    with pytest.raises(PySparkException):
        publish(spark, root, {"a": lambda now: now.union(numbers(spark, 7)), "b": fails})
    assert current_version(spark, root) == 1 and values(published(spark, root, "a")) == [1]
    publish(spark, root, {"a": lambda now: now.union(numbers(spark, 7))})
    assert values(published(spark, root, "a")) == [1, 7] and values(published(spark, root, "b")) == [2]
    assert values(published(spark, root, "a", 1)) == values(held) == [1]
    publish(spark, root, {"a": lambda now: now.limit(0)})
    assert published(spark, root, "a").collect() == [] and published(spark, root, "a").columns == ["x"]


def test_of_two_racing_loads_one_wins(spark):
    root = scratch_path(spark, "catalog")
    publish(spark, root, {"a": lambda now: numbers(spark, 1)})

    def slow(now):
        publish(spark, root, {"a": lambda x: numbers(spark, 2)})
        return numbers(spark, 3)

    with pytest.raises(RuntimeError):
        publish(spark, root, {"a": slow})
    assert values(published(spark, root, "a")) == [2] and current_version(spark, root) == 2


# ---------------------------------------------------------------- page chain
def brute_chain(links, start):
    urls = {u for u, _ in links}
    nxt, copies, nexts = {}, {}, {}
    for u, n in links:
        copies[u] = copies.get(u, 0) + 1
        if n is not None:
            nxt[u] = min(n, nxt.get(u, n))
            nexts.setdefault(u, set()).add(n)
    wanted = {n for _, n in links if n is not None} | {start}
    out = {("missing", u) for u in wanted - urls} | {("unreferenced", u) for u in urls - wanted}
    out |= {("doubled", u) for u in urls if copies[u] > 1} | {("differing", u) for u in urls if len(nexts.get(u, ())) > 1}
    ends = {}
    for u in urls:
        at, seen = u, [u]
        while nxt.get(at) in urls and len(seen) <= len(urls):
            at = nxt[at]
            seen.append(at)
        ends[u] = (None, None) if len(seen) > len(urls) else (len(seen), at)
        if len(seen) > len(urls):
            out.add(("endless", u))
    return out, ends


@pytest.mark.parametrize("seed", range(4))
def test_chain_against_walking(spark, seed):
    rng = random.Random(seed)
    n = [1, 2, 17, 40][seed]
    links = [(f"p{i}", f"p{i + 1}" if i + 1 < n else None) for i in range(n)]
    if seed > 1:
        links = [x for x in links if rng.random() > 0.1] + rng.choices(links, k=3)
        links += [("p3", "p9"), ("loop", "loop"), ("c1", "c2"), ("c2", "c1"), ("lead", "c1")]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "url string, next string")
    want, ends = brute_chain(links, "p0")
    assert {(r.finding, r.url) for r in chain_findings(df, "p0").collect()} == want
    assert {r.url: (r.to_end, r.last) for r in follow(df).collect()} == ends
    assert want or seed < 2


def test_chain_of_nothing(spark):
    none = spark.createDataFrame([], "url string, next string")
    assert [tuple(r) for r in chain_findings(none, "p1").collect()] == [("missing", "p1")]


# ---------------------------------------------------------------- rejects
SCHEMA = StructType([StructField("k", LongType()), StructField("name", StringType()), StructField("v", DoubleType())])


def test_csv_rejects_add_up(spark, tmp_path):
    good = [(1, "a", 1.5), (2, 'say "x"', None), (3, None, 2.0)]
    (tmp_path / "a.csv").write_text('k,name,v\n1,a,1.5\n2,"say ""x""",\nx,b,1\n')
    (tmp_path / "b.csv").write_text("k,name,v\n3,,2.0\n4,c\n5,d,1,2\n6,e,zz\n")
    ok, bad = csv_scan_rejects(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, ok.collect())) == good
    rows = sorted((r.file.rsplit("/", 1)[1], r.raw) for r in bad.collect())
    assert rows == [("a.csv", "x,b,1"), ("b.csv", "4,c"), ("b.csv", "5,d,1,2"), ("b.csv", "6,e,zz")]
    assert ok.count() + bad.count() == 7


def test_json_rejects_add_up(spark, tmp_path):
    lines = [json.dumps({"k": 1, "name": "a", "v": 1.5}), '{"k": 2, "na', "[1", json.dumps({"k": "no", "v": 2}),
             json.dumps({"other": 1}), "not json"]
    (tmp_path / "x.json").write_text("\n".join(lines))
    ok, bad = json_scan_rejects(spark, str(tmp_path), SCHEMA)
    assert sorted(map(str, ok.collect())) == sorted(["Row(k=1, name='a', v=1.5)", "Row(k=None, name=None, v=None)"])
    assert sorted(r.raw for r in bad.collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])


# ---------------------------------------------------------------- serial ids
def test_serial_ids_go_on(spark):
    def load(*keys):
        return spark.createDataFrame([(k,) for k in keys], "key string")

    ids = spark.createDataFrame([], "key string, id long")
    ids = extend_key_map(ids, load("m", "c", None, "m"), "key")
    assert {r.key: r.id for r in ids.collect()} == {"c": 1, "m": 2}
    more = extend_key_map(ids, load("a", "m", "z", "a", None), "key")
    assert {r.key: r.id for r in more.collect()} == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert extend_key_map(more, load(None), "key").count() == extend_key_map(more, load(), "key").count() == 4
    rows = with_serial_id(load("z", None, "z", "new"), more, "key").collect()
    assert sorted((r.key or "", r.id or 0) for r in rows) == [("", 0), ("new", 0), ("z", 4), ("z", 4)]


# ---------------------------------------------------------------- streamed distinct counts
def test_streamed_distinct_counts(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(20_000)])) for i in range(30_000)]
    df = spark.createDataFrame(rows, "i int, g string, u int")
    path = land_stream_files(df, scratch_path(spark, "log"), "i", rows_per_file=3_000)
    sketches, bitmaps, ckpt = (scratch_path(spark, n) for n in ("s", "b", "c"))

    def run():
        fold_stream_into(file_stream(spark, path, df.schema, bytes_per_trigger=40_000),
                         {sketches: sketch_fold("g", "u"), bitmaps: bitmap_fold("g", "u")}, ckpt)

    run()
    want = {}
    for _, g, u in rows:
        if u is not None:
            want.setdefault(g, set()).add(u)
    exact = {r.g: r.n_distinct for r in read_bitmaps(spark, bitmaps, "g").collect()}
    near = {r.g: r.estimate for r in read_sketches(spark, sketches, "g").collect()}
    assert exact == {g: len(s) for g, s in want.items()}
    assert all(abs(near[g] - n) <= sketch_error() * n for g, n in exact.items())
    batches = spark.read.parquet(sketches).select("batch").distinct().count()
    assert batches > 1
    run()  # nothing new
    assert spark.read.parquet(sketches).select("batch").distinct().count() == batches
    shutil.rmtree(ckpt + "/commits")  # the log is read again: every part is written again
    run()
    assert {r.g: r.n_distinct for r in read_bitmaps(spark, bitmaps, "g").collect()} == exact
    assert {r.g: r.estimate for r in read_sketches(spark, sketches, "g").collect()} == near


def test_totals_of_two_streams_add_up(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], i) for i in range(40)], "i int, g string, v long")
    target = scratch_path(spark, "totals")
    for name in ("one", "two"):
        path = land_stream_files(df, scratch_path(spark, name), "i", rows_per_file=5)
        streaming_totals(file_stream(spark, path, df.schema, bytes_per_trigger=1), target, "g",
                         {"n": F.count(F.lit(1)), "v": F.sum("v")}, scratch_path(spark, "c"))
    got = {r.g: (r.n, r.v) for r in read_target(spark, target, totals_fold("g", ["n", "v"])).collect()}
    assert got == {"a": (40, 2 * sum(range(0, 40, 2))), "b": (40, 2 * sum(range(1, 40, 2)))}
    one = read_target(spark, target, latest_fold(["stream", "g"], "batch"))
    assert one.count() == 4

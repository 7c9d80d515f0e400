"""Hot keys, NULLs and dirty input: the split paths give what plain ones give."""

import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from martkit.functions.scalar import ratio_half_up
from martkit.operators import aggs, joins, ordered, quality, upsert
from martkit.session import checkpoint_root
from martkit.sources import files, json_docs, tables_io
from martkit.streaming import incremental

T0 = datetime(2024, 1, 1)
LIMITS = [None, 2, 50]


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def series(spark):
    """A hot key with NULL runs, shared instants and an outlier; ordinary keys; a NULL key."""
    rnd = random.Random(8)
    rows = []
    for i in range(150):
        k = rnd.choice([0, 0, 0, 1, 2, None])
        ts = T0 if i % 3 == 0 else T0 + timedelta(minutes=i) if i % 50 else datetime(9999, 12, 31)
        rows.append((k, ts, i, f"s{rnd.randint(0, 10**6):07d}-{i}", None if 20 < i < 60 or i % 7 == 0 else rnd.choice([1, 1, 2, 10])))
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, i int, s string, v int").cache()


@pytest.mark.parametrize("order", [["ts", "i"], ["s"]])
@pytest.mark.parametrize("limit", LIMITS)
def test_series_operators_equal_plain_windows(series, limit, order):
    w = Window.partitionBy("k").orderBy(*order)
    want = series.withColumn("r", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(ordered.running_sum(series, "k", order, "v", "r", limit)) == rows_of(want)
    near = (series.withColumn("_prev", F.lag("v").over(w)).withColumn("_prev_exists", F.row_number().over(w) > 1)
            .withColumn("_next", F.lead("v").over(w))
            .withColumn("_next_exists", F.lead(F.lit(1)).over(w).isNotNull()))
    got = ordered.neighbours(series, "k", order, "v", rows_per_bucket=limit)
    assert rows_of(got.select(*near.columns)) == rows_of(near)
    low = near.where("v is not null and (not _prev_exists or v < _prev) and (not _next_exists or v < _next)")
    assert rows_of(ordered.local_minima(series, "k", order, "v", False, limit)) == rows_of(low.select(*series.columns))
    hits = near.where("v = _prev and v = _next").select("k", "v").distinct()
    assert rows_of(ordered.runs(series, "k", order, "v", 3, limit)) == rows_of(hits)


def test_running_sum_carries_over_null_buckets(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([10, 10, 10, 10, None, None, 10])], "k int, i int, v int")
    got = [r.r for r in ordered.running_sum(df, "k", ["i"], "v", "r", rows_per_bucket=2).orderBy("i").collect()]
    assert got == [10, 20, 30, 40, 40, 40, 50]


@pytest.mark.parametrize("limit", LIMITS)
def test_gaps_stay_in_their_range(spark, limit):
    df = spark.createDataFrame([(1, 1), (1, 10), (2, 10), (3, 6), (3, 6), (4, None), (5, 3)] + [(9, i) for i in range(0, 120, 2)],
                               "k int, id int")
    have = {}
    for k, i in [(r.k, r.id) for r in df.collect() if r.id is not None]:
        have.setdefault(k, set()).add(i)
    for lo, hi in ((5, 8), (None, 8), (5, None), (None, None), (8, 5)):
        want = sorted((k, x) for k, s in have.items()
                      for x in range(min(s) if lo is None else lo, (max(s) if hi is None else hi) + 1) if x not in s)
        got = sorted((r.k, r.missing) for r in ordered.gaps(df, "k", "id", lo, hi, rows_per_bucket=limit).collect())
        assert got == want, (lo, hi)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_with_shared_instants_and_big_longs(spark, direction, limit):
    rnd = random.Random(3)
    base = 1_700_000_000_000_000_000  # nanoseconds: doubles cannot tell these apart
    left = [(i, rnd.choice([0, 0, 1, None]), base + rnd.choice([0, 0, 0, 1, 50, 51, 99])) for i in range(40)]
    right = [(100 + j, rnd.choice([0, 0, 1]), base + rnd.choice([0, 0, 0, 40, 52, 100])) for j in range(40)]
    lf = spark.createDataFrame(left + left[:3], "lid int, k int, t long")
    rt = spark.createDataFrame(right, "rid int, k int, rts long")
    got = joins.asof_left(lf, rt, "k", "t", "rts", ["rid"], tie="rid", rows_per_bucket=limit, direction=direction)
    want = []
    for i, k, t in left + left[:3]:
        near = [(r, x) for r, rk, x in right if k is not None and rk == k]
        back = max(((x, r) for r, x in near if x <= t), default=None)
        fwd = min(((x, -r) for r, x in near if x >= t), default=None)
        b, f = back and (t - back[0], back[1]), fwd and (fwd[0] - t, -fwd[1])
        pick = b if direction == "backward" else f if direction == "forward" else (
            (b if b[0] <= f[0] else f) if b and f else b or f)
        want.append((i, k, t, pick[1] if pick else None))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_probes_have_their_own_key_and_time_and_keep_duplicates(spark):
    lf = spark.createDataFrame([(1, "a", "b", 5, 9), (1, "a", "b", 5, 9), (None, "b", None, 5, 9)],
                               "id int, dep string, arr string, t1 int, t2 int")
    rt = spark.createDataFrame([("a", 1, 10), ("a", 7, 11), ("b", 4, 20), ("b", 9, 21)], "place string, ts int, temp int")
    got = joins.asof_probes(lf, rt, {"d_": ("dep", "t1", None, ["temp"]), "a_": ("arr", "t2", None, ["temp"])},
                            right_by="place", right_ts="ts")
    assert rows_of(got.select("id", "d_temp", "a_temp")) == sorted(
        ["Row(id=1, d_temp=10, a_temp=21)"] * 2 + ["Row(id=None, d_temp=20, a_temp=None)"])


def test_insert_select_does_not_swallow_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    tables_io.insert_select(spark.createDataFrame([(1, "a")], "x int, y string"), path)
    tables_io.insert_select(spark.createDataFrame([("b", 2)], "y string, x int"), path)
    for bad in ("x int, z string", "x int, y string, z int"):
        with pytest.raises(ValueError):
            tables_io.insert_select(spark.createDataFrame([], bad), path)
    assert rows_of(spark.read.parquet(path)) == ["Row(x=1, y='a')", "Row(x=2, y='b')"]


def test_insert_if_absent_keeps_one_of_a_batch(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (2, "a"), (None, "n")], "k int, v string")
    assert rows_of(upsert.insert_if_absent(target, batch, "k")) == sorted(
        ["Row(k=1, v='old')", "Row(k=2, v='a')", "Row(k=None, v='n')"])


def test_merge_adds_the_stamp_and_refuses_unknown_columns(spark):
    target = spark.createDataFrame([(1, "old"), (3, "stays")], "k int, v string")
    src = spark.createDataFrame([(1, "new"), (2, "in")], "k int, v string")
    got = {r.k: r for r in upsert.merge_upsert(target, src, "k", stamp="at").collect()}
    assert got[1].v == "new" and got[1].at and got[2].at and got[3].at is None
    with pytest.raises(ValueError):
        upsert.merge_upsert(target, src, "k", update_cols=["w"])


def test_prices(spark):
    df = spark.createDataFrame([(1, 7, 10.0), (1, 7, None), (1, 8, 20.0)], "u int, p int, price double")
    r = aggs.user_price_report(df, "u", "p", "price").first()
    assert (r.min_price, r.max_price, r.avg_price, r.best_product) == (10.0, 20.0, 15.0, 8)
    cents = [(i, 10**17 + i, 7) for i in range(3)] + [(9, 2 * 8_999_999 + 1, 2)]
    for n, a, b, q in spark.createDataFrame(cents, "n int, a long, b long").select(
            "n", "a", "b", ratio_half_up("a", "b")).collect():
        assert q == float(Decimal((a * 200 + b) // (2 * b)) / 100), n
    small = spark.createDataFrame([("a", 0.004)] * 1000, "g string, x double")
    assert round(aggs.cube_report(small, ["g"], {"s": "x"}).where("gid = 1").first().s, 9) == 4.0
    money = spark.createDataFrame([("a", 1, Decimal("0.10"))] * 3 + [("b", 1, Decimal("0.20"))], "g string, f int, x decimal(18,2)")
    total = aggs.cube_report(money, ["g"], {"s": "x"}, distinct={"n": "f"}).where("gid = 1").first()
    assert (total.s, total.row_count, total.n) == (Decimal("0.50"), 4, 1)


def test_unique_allows_nulls_and_primary_key_does_not(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, i int")
    good, bad = quality.validate(df, [quality.unique("u", "k")])
    assert sorted(r.i for r in good.collect()) == [1, 2, 5] and sorted(r.i for r in bad.collect()) == [3, 4]
    good, bad = quality.validate(df, [quality.primary_key("pk", "k"), quality.check("small", F.col("i") < 5)])
    assert good.count() == 0
    assert sorted((r.i, r.rule) for r in bad.collect()) == [(1, "pk"), (2, "pk"), (3, "pk"), (4, "pk"), (5, "small")]


def test_csv_keeps_newlines_and_checks_its_header(spark, tmp_path):
    path, schema = str(tmp_path / "c"), "a string, b string"
    df = spark.createDataFrame([("x\ny", 'he said "no"'), ("1,2", None)], schema)
    files.csv_sink(df, path)
    assert rows_of(files.csv_scan(spark, path, schema, multi_line=True)) == rows_of(df)
    with pytest.raises((PySparkException, Py4JJavaError)):  # line by line, such a row is malformed
        files.csv_scan(spark, path, schema).collect()
    swapped = tmp_path / "s.csv"
    swapped.write_text("b,a\n1,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.csv_scan(spark, str(swapped), schema).collect()


def test_malformed_json_is_an_error(spark, tmp_path):
    item = json_docs.StructType([json_docs.StructField("id", json_docs.LongType()), json_docs.StructField("v", json_docs.StringType())])
    page = {"info": {"count": 2, "next": None}, "results": [{"id": 1, "v": "b"}, {"id": 1, "v": "a"}]}
    good, cut = tmp_path / "good", tmp_path / "cut"
    good.write_text(json.dumps(page) + "\n")
    got = json_docs.ingest_pages(spark, str(good), item, ["id", "v"], key="id").collect()
    assert [tuple(r) for r in got] == [(1, "b")]  # the first item of the page
    cut.write_text(json.dumps(page) + "\n" + json.dumps(page)[:30] + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        json_docs.ingest_pages(spark, str(cut), item, ["id", "v"]).collect()
    bad = spark.createDataFrame([(1, '{"tickets": [')], "id int, j string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        json_docs.unnest_json(bad, "j", "tickets", keep=["id"]).collect()


def test_two_streams_into_one_target(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, 1) for i in range(30)], "k int, n int")
    target, fold = str(tmp_path / "t"), incremental.sum_fold("k", ["n"])
    for name in ("one", "two"):
        df.write.parquet(str(tmp_path / name))
        for _ in range(2):  # a restart adds nothing
            incremental.fold_stream(incremental.file_stream(spark, str(tmp_path / name), df.schema, 1), target,
                                    str(tmp_path / f"ck-{name}"), fold)
    assert {r.k: r.n for r in incremental.read_target(spark, target, fold).collect()} == {0: 20, 1: 20, 2: 20}


def test_month_range_reads_no_month_too_many(spark):
    df = spark.createDataFrame([(datetime(1997, 4, 1), 199704)], "ts timestamp_ntz, ym int")
    plan = tables_io.month_range(df, "ts", "1997-01-01", "1997-04-01")._jdf.queryExecution().toString()
    assert "199703" in plan and "199704" not in plan.split("Optimized")[0].replace("[ts", "")


def test_rewrite_narrows_and_refuses_what_does_not_fit(spark):
    raw = spark.createDataFrame([("1", "2024-02-03", '{"e": "x@y"}')], "a string, d string, j string")
    out = tables_io.typed_compact_rewrite(spark, raw, {"a": "tinyint", "d": "date"}, ["a"], month_of="d",
                                          json_fields={"mail": ("j", "$.e")})
    assert [tuple(map(str, r)) for r in out.collect()] == [("1", "2024-02-03", "x@y", "202402")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables_io.typed_compact_rewrite(spark, raw.withColumn("a", F.lit("300")), {"a": "tinyint"}, ["a"])


def test_no_private_folder_on_a_cluster():
    class Unset:
        """A context of a cluster without a shared folder."""
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        @property
        def _jsc(self):
            class J:
                sc = lambda s: s
                getCheckpointDir = lambda s: s
                isDefined = lambda s: False
            return J()

    class Session:
        sparkContext = Unset()
        conf = {}

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())

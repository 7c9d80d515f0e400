"""Operators against brute-force answers, with a hot key (a third of all
rows on one key), NULLs, ties and many order buckets."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from martkit.operators.aggs import latest_by_key, summing_fold
from martkit.operators.joins import asof_left, cutoff_left, or_join
from martkit.operators.ordered import (dense_id, dense_rank_global, neighbours, running_sum,
                                       top_n_by_group)
from martkit.operators.quality import check, domain, not_null, unique, validate
from martkit.operators.upsert import insert_if_absent, merge_upsert

T0 = datetime(2024, 1, 1)


def series_rows(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 12)  # key 0 holds a third
        if i % 97 == 5:
            key = None
        rows.append((i, key, T0 + timedelta(minutes=rnd.randint(0, 50_000)), rnd.randint(-5, 20)))
    return rows


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame(series_rows(), "id long, k int, ts timestamp_ntz, v long")


def test_running_sum_matches_window(spark, series):
    for rpb in (10**9, 50, 7):
        got = {r.id: r.r for r in running_sum(series, "k", ["ts", "id"], "v", "r",
                                              rows_per_bucket=rpb).collect()}
        pdf = series.toPandas().sort_values(["ts", "id"])
        pdf["r"] = pdf.groupby(pdf.k.fillna(-1), sort=False)["v"].cumsum()
        assert got == dict(zip(pdf.id, pdf.r))


def test_neighbours_match_lag_lead(spark, series):
    pdf = series.toPandas().sort_values(["ts", "id"])
    g = pdf.groupby(pdf.k.fillna(-1), sort=False)["v"]
    want_prev = dict(zip(pdf.id, g.shift(1)))
    want_next = dict(zip(pdf.id, g.shift(-1)))
    for rpb in (60, 5):
        for r in neighbours(series, "k", ["ts", "id"], "v", rows_per_bucket=rpb).collect():
            wp, wn = want_prev[r.id], want_next[r.id]
            assert (r._prev if r._prev is not None else None) == (None if pd.isna(wp) else wp)
            assert (r._next if r._next is not None else None) == (None if pd.isna(wn) else wn)
            assert r._prev_exists == (not pd.isna(wp))


def brute_asof(left, right):
    out = {}
    for lid, lk, lts in left:
        best = None
        for rid, rk, rts in right:
            if lk is not None and rk == lk and rts <= lts:
                if best is None or (rts, rid) > (best[2], best[0]):
                    best = (rid, rk, rts)
        out[lid] = None if best is None else best[0]
    return out


@pytest.mark.parametrize("rpb", [10**9, 40, 6])
def test_asof_matches_nested_loop(spark, rpb):
    rnd = random.Random(rpb)
    left = [(i, 0 if i % 3 == 0 else rnd.randint(1, 6) if i % 11 else None,
             T0 + timedelta(minutes=rnd.randint(0, 5000))) for i in range(300)]
    right = [(1000 + j, 0 if j % 2 == 0 else rnd.randint(1, 6),
              T0 + timedelta(minutes=rnd.randint(0, 5000))) for j in range(200)]
    right.append((5000, 0, left[0][2]))  # exact tie with a left timestamp: included
    right.append((5001, 0, left[0][2]))  # same instant, higher tie wins
    L = spark.createDataFrame(left, "lid long, k int, ts timestamp_ntz")
    R = spark.createDataFrame(right, "rid long, k int, rts timestamp_ntz")
    got = {r.lid: r.rid for r in asof_left(L, R, "k", "ts", "rts", ["rid"], tie="rid",
                                             rows_per_bucket=rpb).collect()}
    assert got == brute_asof(left, right)
    assert len(got) == len(left)


def test_dense_id_and_rank(spark, series):
    ids = dense_id(series, ["ts", "id"], "sid").toPandas().sort_values(["ts", "id"])
    assert list(ids.sid) == list(range(1, len(ids) + 1))
    r = dense_rank_global(series, "v", "rk").toPandas()
    want = r.v.rank(method="dense", ascending=False).astype(int)
    assert list(r.rk) == list(want)


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
def test_top_n_keeps_ties(spark, method):
    rows = [(g, i, v) for i, (g, v) in enumerate(
        [(1, 10), (1, 10), (1, 9), (1, 8), (1, 8), (1, 7), (2, 5), (2, None), (3, 1)] +
        [(0, random.Random(i).randint(0, 40)) for i in range(200)])]
    df = spark.createDataFrame(rows, "g int, i int, v int")
    got = sorted((r.g, r.i, r.rnk) for r in top_n_by_group(df, "g", "v", 3, method).collect())
    pdf = df.toPandas()
    pdf["rnk"] = pdf.groupby("g")["v"].rank(method="min" if method == "rank" else "dense",
                                            ascending=False, na_option="bottom")
    want = sorted((int(a), int(b), int(c)) for a, b, c in pdf[pdf.rnk <= 3][["g", "i", "rnk"]].values)
    assert got == want


def test_or_join_and_cutoff(spark):
    L = spark.createDataFrame([(1, 1, 2), (2, 3, 3), (3, None, 4)], "id int, a int, b int")
    R = spark.createDataFrame([(1,), (3,), (4,)], "x int")
    got = sorted(tuple(r) for r in or_join(L, R, [("a", "x"), ("b", "x")], ["id", "x"]).collect())
    assert got == [(1, 1), (2, 3), (3, 4)]
    ev = spark.createDataFrame([(1, T0), (1, T0 + timedelta(days=2)), (2, T0)], "u int, ts timestamp_ntz")
    cut = spark.createDataFrame([(1, T0 + timedelta(days=1)), (1, T0 + timedelta(days=3))],
                                "u int, c timestamp_ntz")
    got = sorted((r.u, r.ts) for r in cutoff_left(ev, cut, "u", "ts", "c").collect())
    assert got == [(1, T0), (2, T0)]


def test_merge_twice_equals_once_and_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    src = spark.createDataFrame([(2, "B", 21), (3, "c", 30)], "k int, s string, n int")
    once = merge_upsert(tgt, src, "k", update_cols=["s"])
    twice = merge_upsert(once, src, "k", update_cols=["s"])
    a = sorted(map(tuple, once.collect()), key=str)
    assert a == sorted(map(tuple, twice.collect()), key=str)
    assert (2, "B", 20) in a and (3, "c", 30) in a
    # as in SQL MERGE, a NULL key never matches: the row is inserted (every time)
    nul = spark.createDataFrame([(None, "z", 0)], "k int, s string, n int")
    got = merge_upsert(merge_upsert(tgt, nul, "k"), nul, "k").collect()
    assert sum(1 for r in got if r.k is None) == 2
    two_nulls = spark.createDataFrame([(None, "y", 1), (None, "z", 0)], "k int, s string, n int")
    assert sum(1 for r in merge_upsert(tgt, two_nulls, "k").collect() if r.k is None) == 2
    dup = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, s string, n int")
    with pytest.raises(Exception):
        merge_upsert(tgt, dup, "k").collect()


def test_insert_if_absent(spark):
    tgt = spark.createDataFrame([(1, 10)], "k int, v int")
    src = spark.createDataFrame([(1, 99), (2, 5), (2, 3), (None, 7)], "k int, v int")
    got = sorted(map(tuple, insert_if_absent(tgt, src, "k", tie="v").collect()), key=str)
    assert got == sorted([(1, 10), (2, 3), (None, 7)], key=str)


def test_fold_of_parts_is_whole(spark, series):
    whole = series.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    a = series.where(F.col("id") < 300).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    b = series.where(F.col("id") >= 300).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    folded = summing_fold(a, b, ["k"], ["n", "s"])
    assert sorted(map(tuple, folded.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    latest = latest_by_key(series, ["k"], ["ts"], ["id"]).collect()
    pdf = series.toPandas().sort_values(["ts", "id"]).groupby(series.toPandas().k.fillna(-1)).tail(1)
    assert sorted(r.id for r in latest) == sorted(pdf.id)


def test_validate_rules(spark):
    df = spark.createDataFrame([(1, "O", 5), (1, "X", None), (2, None, -1), (3, "F", 2)],
                               "k int, s string, n int")
    good, bad = validate(df, [not_null("s_nn", "s"), check("n_pos", F.col("n") >= 0),
                              unique("k_pk", "k"), domain("s_dom", "s", ["O", "F"])])
    assert sorted(r.k for r in good.collect()) == [3]
    assert sorted((r.k, r.rule) for r in bad.collect()) == sorted(
        [(2, "s_nn"), (2, "n_pos"), (1, "k_pk"), (1, "k_pk"), (1, "s_dom")])


def test_split_hot_cuts_only_hot_keys(spark, series):
    from martkit.operators.common import split_hot
    cold, hot = split_hot(series.withColumn("_key", F.struct("k")), ["ts"], rows_per_bucket=60)
    assert hot.select("k").distinct().count() == 1 and cold.where("k = 0").count() == 0
    assert cold.count() + hot.count() == series.count()
    assert hot.select("_chunk").distinct().count() >= 3
    pdf = hot.select("ts", "_chunk").toPandas().sort_values("ts")
    assert pdf["_chunk"].is_monotonic_increasing


def test_asof_probes_outside_right_range(spark):
    L = spark.createDataFrame([(1, 0, T0 - timedelta(days=1)), (2, 0, T0 + timedelta(days=9)),
                               (3, 0, T0 + timedelta(hours=1))], "lid long, k int, ts timestamp_ntz")
    R = spark.createDataFrame([(10 + i, 0, T0 + timedelta(hours=i)) for i in range(50)],
                              "rid long, k int, rts timestamp_ntz")
    got = {r.lid: r.rid for r in asof_left(L, R, "k", "ts", "rts", ["rid"], tie="rid",
                                             rows_per_bucket=5).collect()}
    assert got == {1: None, 2: 59, 3: 11}


def test_jdbc_scan_needs_complete_partitioning(spark):
    """The partitioned JDBC reader refuses half-specified strides before
    touching any database (no database is started in tests)."""
    from martkit.sources.files import jdbc_scan
    with pytest.raises(ValueError):
        jdbc_scan(spark, "jdbc:none://nowhere", "t", partition_column="id", lower_bound=0)


def test_parent_left_join_equals_left_join(spark):
    from martkit.operators.joins import parent_left_join
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "pk int, pv string")
    child = spark.createDataFrame([(1, 10)] * 50 + [(2, 20), (None, 0), (9, 90)], "ck int, cv int")
    got = sorted(map(repr, parent_left_join(parent, child, "pk", "ck").collect()))
    want = sorted(map(repr, parent.join(child, parent.pk == child.ck, "left").collect()))
    assert got == want


def test_parents_without_children_keep_their_partitions(spark):
    """AQE sees few bytes of bare keys and would merge them into one task."""
    from martkit.operators.joins import parent_left_join
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parent = spark.range(2000).withColumnRenamed("id", "pk")
        child = spark.range(1000).select(F.col("id").alias("ck"))
        joined = parent_left_join(parent, child, "pk", "ck").where(F.col("ck").isNull())
        got = joined.select("pk", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(r.pk for r in got) == list(range(1000, 2000))
    assert len({r.p for r in got}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_parent_left_join_deals_more_rows_over_more_partitions(spark):
    """The session's count of partitions stays the same when the tables grow."""
    from martkit.operators.joins import parent_left_join
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parent = spark.range(500_000).withColumnRenamed("id", "pk")
        child = spark.range(2_400_000).select((F.col("id") % 400_000).alias("ck"))
        joined = parent_left_join(parent, child, "pk", "ck").withColumn("p", F.spark_partition_id())
        got = joined.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ck").isNull()).alias("lonely")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 2_500_000 and sum(r.lonely for r in got) == 100_000
    assert max(r.n for r in got) < 1_200_000


def test_parent_left_join_of_hot_null_and_repeated_keys(spark):
    """Hot keys with and without a parent, parents that repeat, NULL keys on both sides."""
    from martkit.operators.joins import _hot_keys, parent_left_join
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (4, "d"), (None, "n"), (None, "n")],
                                   "pk int, v string")
    child = spark.createDataFrame([(1, i) for i in range(300)] + [(2, i) for i in range(40)] + [(9, i) for i in range(200)]
                                  + [(None, i) for i in range(100)] + [(3, 1), (3, 1)], "ck int, cv int").repartition(6)
    got = parent_left_join(parent, child, "pk", "ck", part_rows=50, hot_rows=30)
    want = parent.join(child, parent.pk == child.ck, "left")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    total, hot = _hot_keys(child, "ck", 30)
    assert total == 542 and sorted(r[0] for r in hot.collect()) == [1, 2, 9]
    placed = got.where("pk = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in placed) == 300 and len(placed) > 1


def test_nest_children_gathers_all_children_of_a_parent(spark):
    """Hot keys with and without a parent, parents that repeat, NULL keys and values, long arrays in runs."""
    from collections import Counter

    from martkit.operators.joins import nest_children
    parent = [(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (3, "c"), (4, "d"), (5, "e"), (None, "n"), (None, "n")]
    child = ([(1, i % 7) for i in range(300)] + [(2, i) for i in range(40)] + [(9, i) for i in range(200)]
             + [(None, i) for i in range(100)] + [(3, 1), (3, 1), (3, None)] + [(5, i) for i in range(25)])
    got = nest_children(spark.createDataFrame(parent, "pk int, v string"),
                        spark.createDataFrame(child, "ck int, cv int").repartition(6), "pk", "ck",
                        F.struct("cv"), "nested", nest_rows=20, part_rows=50, hot_rows=30)
    assert got.columns == ["pk", "v", "nested"]
    rows = [(r.pk, r.v, [x.cv for x in r.nested]) for r in got.collect()]
    assert max(len(a) for _, _, a in rows) == 20
    values = {k: [v for c, v in child if c == k and k is not None] for k, _ in parent}
    assert Counter((k, v, x) for k, v, a in rows for x in a) == Counter((k, v, x) for k, v in parent for x in values[k])
    assert sorted((repr(r) for r in rows if r[0] in (None, 3, 4))) == sorted(map(repr, [
        (None, "n", []), (None, "n", []), (3, "c", [None, 1, 1]), (3, "c", [None, 1, 1]), (4, "d", [])]))
    assert sorted(len(a) for k, _, a in rows if k == 5) == [5, 20]  # no hot key, yet a long array


def test_null_keys_pass_a_left_join_by(spark, tmp_path):
    from martkit.plans import registry
    registry.load_all()
    spark.createDataFrame([(i, i % 3, i, i) for i in range(600)] + [(None, 2, 1, 1), (5, None, 1, 1)] + [(7, 2, 1, 1)] * 2,
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long") \
        .repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, "F") for i in range(300)] + [(7, "O"), (None, "N")], "o_orderkey long, o_orderstatus string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task a file
    try:
        rows = registry.QUERIES["safe_cast_key_join"](spark, str(tmp_path)).withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = []
    for i, n, p, s in [(i, i % 3, i, i) for i in range(600)] + [(None, 2, 1, 1), (5, None, 1, 1)] + [(7, 2, 1, 1)] * 2:
        text = None if i is None else f"x{i}" if n == 1 else str(i)
        states = [None] if text is None or n == 1 or i >= 300 else ["F", "O"] if i == 7 else ["F"]
        want += [(i, n, p, s, text, x) for x in states]
    assert sorted(map(repr, (tuple(r)[:-1] for r in rows))) == sorted(map(repr, want))
    assert len({r.p for r in rows if r.l_linenumber == 1}) > 1


@pytest.mark.parametrize("length", [2, 3, 4, 5])
def test_runs_of_any_length(spark, length):
    from martkit.operators.ordered import runs
    rnd = random.Random(length)
    rows = []
    for i in range(400):
        k = 0 if i % 3 == 0 else rnd.randint(1, 5)
        rows.append((k, i, rnd.choice([1, 1, 1, 2, 2, None])))
    df = spark.createDataFrame(rows, "k int, i int, v int")
    got = sorted((r.k, r.v) for r in runs(df, "k", ["i"], "v", length=length,
                                          rows_per_bucket=30).collect())
    want = set()
    by_key = {}
    for k, i, v in rows:
        by_key.setdefault(k, []).append((i, v))
    for k, seq in by_key.items():
        seq.sort()
        cur, n = object(), 0
        for _, v in seq:
            n = n + 1 if (v is not None and v == cur) else 1
            cur = v
            if v is not None and n >= length:
                want.add((k, v))
    assert got == sorted(want)


def brute_asof_dir(left, right, direction):
    out = {}
    for lid, lk, lts in left:
        cands = [(rid, rts) for rid, rk, rts in right if lk is not None and rk == lk]
        back = max(((rts, rid) for rid, rts in cands if rts <= lts), default=None)
        fwd = min(((rts, -rid) for rid, rts in cands if rts >= lts), default=None)
        b = None if back is None else (back[1], (lts - back[0]).total_seconds())
        f = None if fwd is None else (-fwd[1], (fwd[0] - lts).total_seconds())
        if direction == "forward":
            out[lid] = None if f is None else f[0]
        elif b is None or f is None:
            out[lid] = (b or f or (None,))[0]
        else:
            out[lid] = b[0] if b[1] <= f[1] else f[0]
    return out


@pytest.mark.parametrize("direction", ["forward", "nearest"])
@pytest.mark.parametrize("rpb", [10**9, 25])
def test_asof_forward_and_nearest(spark, direction, rpb):
    rnd = random.Random(hash((direction, rpb)) % 1000)
    left = [(i, 0 if i % 3 == 0 else rnd.randint(1, 5) if i % 13 else None,
             T0 + timedelta(minutes=rnd.randint(0, 3000))) for i in range(240)]
    right = [(1000 + j, 0 if j % 2 == 0 else rnd.randint(1, 5),
              T0 + timedelta(minutes=rnd.randint(0, 3000))) for j in range(160)]
    right += [(5000, 0, left[0][2]), (5001, 0, left[0][2])]  # tie at a probe instant
    L = spark.createDataFrame(left, "lid long, k int, ts timestamp_ntz")
    R = spark.createDataFrame(right, "rid long, k int, rts timestamp_ntz")
    got = {r.lid: r.rid for r in asof_left(L, R, "k", "ts", "rts", ["rid"], tie="rid",
                                             rows_per_bucket=rpb, direction=direction).collect()}
    assert got == brute_asof_dir(left, right, direction)


def test_asof_probes_equal_separate_probes(spark):
    from martkit.operators.joins import asof_probes
    rnd = random.Random(5)
    left = [(i, 0 if i % 3 == 0 else rnd.randint(1, 4), T0 + timedelta(minutes=rnd.randint(0, 2000)))
            for i in range(150)]
    right = [(1000 + j, 0 if j % 2 else rnd.randint(1, 4), T0 + timedelta(minutes=rnd.randint(0, 2000)))
             for j in range(120)]
    L = spark.createDataFrame(left, "lid long, k int, ts timestamp_ntz")
    R = spark.createDataFrame(right, "rid long, k int, rts timestamp_ntz")
    shift = F.expr("INTERVAL 1 HOUR")
    both = asof_probes(L, R, {"a_": ("k", "ts", None, ["rid"]), "b_": ("k", "ts", shift, ["rid", "rts"])},
                       right_by="k", right_ts="rts", tie="rid", rows_per_bucket=20)
    a = asof_left(L, R, "k", "ts", "rts", ["rid"], tie="rid", prefix_="a_")
    b = asof_left(a, R, "k", "ts", "rts", ["rid", "rts"], tie="rid", prefix_="b_", shift=shift)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, b.select(*both.columns).collect()))


def test_gaps_and_minima_with_hot_key_buckets(spark):
    from martkit.operators.ordered import gaps, local_minima
    rnd = random.Random(11)
    ids = [(0, i) for i in range(0, 600) if rnd.random() < 0.7] + \
          [(k, i) for k in range(1, 4) for i in range(0, 40, 3)]
    df = spark.createDataFrame(ids, "k int, id long")
    got = sorted((r.k, r.missing) for r in gaps(df, "k", "id", lo=0, rows_per_bucket=25).collect())
    present = {}
    for k, i in ids:
        present.setdefault(k, set()).add(i)
    want = sorted((k, i) for k, s in present.items() for i in range(0, max(s) + 1) if i not in s)
    assert got == want
    vals = spark.createDataFrame([(0, i, (i * 7919) % 101) for i in range(300)], "k int, i int, v int")
    got = sorted(r.i for r in local_minima(vals, "k", ["i"], "v", first=False,
                                           rows_per_bucket=20).collect())
    seq = [(i * 7919) % 101 for i in range(300)]
    want = [i for i in range(300) if (i == 0 or seq[i] < seq[i - 1]) and (i == 299 or seq[i] < seq[i + 1])]
    assert got == want


@pytest.mark.parametrize("shape", ["one instant", "outlier", "strings"])
def test_split_hot_is_equal_depth(spark, shape):
    """Shared instants, far outliers and text do not end up in one chunk."""
    from martkit.operators.common import split_hot
    n = 3000
    rows = [(0, "one" if shape == "strings" else T0, i if shape != "outlier" or i else 10**12, f"s{i:05d}")
            for i in range(n)]
    df = spark.createDataFrame(rows, "k int, ts string, id long, s string" if shape == "strings"
                               else "k int, ts timestamp_ntz, id long, s string").withColumn("_key", F.struct("k"))
    order = {"one instant": ["ts", "id"], "outlier": ["id"], "strings": ["ts", "s"]}[shape]
    _, hot = split_hot(df, order, rows_per_bucket=300)
    sizes = [r.n for r in hot.groupBy("_chunk").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == n and max(sizes) < 900

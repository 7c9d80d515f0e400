"""Small airline-domain and exercise fixtures (FIXTURES.md §2-§4) run
through the operators, one assertion per listed edge case."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martkit.functions.scalar import seconds_between
from martkit.operators.aggs import entity_rollup
from martkit.operators.joins import asof_left, role_playing
from martkit.operators.ordered import runs, top_n_by_group
from martkit.sources.json_docs import unnest_json

D = datetime(2016, 3, 1, 10, 0, 0)


@pytest.fixture(scope="module")
def flights(spark):
    rows = [
        # id, no, sched_dep, dep, arr, status, act_dep, act_arr
        (1, "PG0001", D, "SVO", "LED", "Arrived", D + timedelta(seconds=10_800), D + timedelta(hours=5)),
        (2, "PG0002", D, "SVO", "KZN", "Arrived", D + timedelta(seconds=10_801), D + timedelta(hours=6)),
        (3, "PG0003", D, "VKO", "LED", "Scheduled", None, None),
        (4, "PG0004", datetime(2015, 12, 31, 9), "LED", "SVO", "Arrived",
         datetime(2015, 12, 31, 9, 5), datetime(2015, 12, 31, 11)),
    ]
    return spark.createDataFrame(rows, "flight_id long, flight_no string, scheduled_departure "
                                       "timestamp_ntz, departure_airport string, arrival_airport "
                                       "string, status string, actual_departure timestamp_ntz, "
                                       "actual_arrival timestamp_ntz")


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame([("SVO", "Moscow"), ("VKO", "Moscow"), ("LED", "St Petersburg"),
                                  ("KZN", "Kazan")], "airport_code string, city string")


def test_delay_threshold_and_null_actuals(spark, flights):
    late = seconds_between("scheduled_departure", "actual_departure")
    per_airport = flights.groupBy("departure_airport").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(late > 10_800, 1).otherwise(0)).alias("delayed")).collect()
    got = {r.departure_airport: (r.total, r.delayed) for r in per_airport}
    assert got == {"SVO": (2, 1), "VKO": (1, 0), "LED": (1, 0)}  # exactly 3 h is not late
    assert all(d <= t for t, d in got.values())


def test_weather_asof_unmatched_and_tie(spark, flights):
    weather = spark.createDataFrame([
        ("SVO", D, -3.0),                        # exactly at departure: included
        ("SVO", D - timedelta(hours=1), -5.0),
        ("LED", datetime(2016, 1, 1), 1.0),      # later than flight 4: never used by it
    ], "airport string, ts timestamp_ntz, temperature double")
    # the as-of key has the same name on both sides
    out = asof_left(flights, weather.withColumnRenamed("airport", "departure_airport"),
                    "departure_airport", "scheduled_departure", "ts", ["ts", "temperature"],
                    prefix_="w_")
    got = {r.flight_id: r.w_temperature for r in out.collect()}
    assert got == {1: -3.0, 2: -3.0, 3: None, 4: None}


def test_role_playing_airports_and_city_rollup(spark, flights, airports):
    f = role_playing(flights, airports, "airport_code",
                     {"departure_": "departure_airport", "arrival_": "arrival_airport"})
    r = {x.flight_id: (x.departure_city, x.arrival_city) for x in f.collect()}
    assert r[1] == ("Moscow", "St Petersburg") and r[3] == ("Moscow", "St Petersburg")
    cities = airports.select("city").distinct()
    roll = entity_rollup(cities, "city", {"n_airports": (airports, "city")})
    assert {x.city: x.n_airports for x in roll.collect()}["Moscow"] == 2


def test_bookings_json_unnest(spark):
    from martkit.sources.json_docs import BOOKING_JSON
    docs = spark.createDataFrame([
        ("B1", '{"tickets":[{"linenumber":1,"flights":[{"partkey":7,"suppkey":1,"quantity":1.0}]},'
               '{"linenumber":2,"flights":[]}]}'),
        ("B1", '{"tickets":[{"linenumber":1,"flights":[{"partkey":7,"suppkey":1,"quantity":1.0}]}]}'),
        ("B2", '{"tickets":[]}'),
        ("B3", None),
    ], "book_ref string, json_data string")
    t = unnest_json(docs, "json_data", "tickets", keep=["book_ref"], schema=BOOKING_JSON)
    assert sorted((r.book_ref, r.linenumber) for r in t.collect()) == [("B1", 1), ("B1", 1), ("B1", 2)]
    fl = t.select("book_ref", F.explode("flights").alias("f"))
    assert fl.count() == 2  # the empty flights array drops its ticket


@pytest.mark.parametrize("name", ["lateral_unnest", "nested_unnest"])
def test_lines_of_an_order_are_unnested_from_one_document(spark, tmp_path, monkeypatch, name):
    import json

    from martkit.plans import q_joins, registry
    lines = [(1, 1, 10, 100, 1.0), (1, 2, 11, 101, 2.0), (1, 2, 11, 101, 2.0), (1, None, None, 102, None), (2, 1, 12, 100, 3.0),
             (8, 1, 13, 100, 4.0), (None, 1, 14, 100, 5.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double") \
        .repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (3,), (None,)], "o_orderkey long").withColumn(
        "o_orderdate", F.lit("1997-01-01").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    unnest = q_joins.unnest_json
    monkeypatch.setattr(q_joins, "unnest_json", lambda docs, *a, **kw: seen.append(docs) or unnest(docs, *a, **kw))
    got = registry.QUERIES[name](spark, str(tmp_path)).collect()
    docs = sorted(((r.book_ref, len(json.loads(r.json_data)["tickets"])) for r in seen[0].collect()), key=repr)
    assert docs == [(1, 4), (2, 1), (3, 0), (None, 0)]  # a document per order, with all of its lines
    kept = [x for x in lines if x[0] in (1, 2)]
    want = [(*x[:2], 1) for x in kept] if name == "lateral_unnest" else kept
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_safe_cast_flight_id(spark, flights):
    tf = spark.createDataFrame([("T1", "1"), ("T2", "x9"), ("T3", None)], "ticket_no string, flight_id string")
    j = tf.join(flights, tf.flight_id.try_cast("long") == flights.flight_id, "left")
    got = {r.ticket_no: r.flight_no for r in j.collect()}
    assert got == {"T1": "PG0001", "T2": None, "T3": None}


# ----------------------------------------------------------- exercise cases
def test_second_highest_null_when_single_value(spark):
    e = spark.createDataFrame([(1, 100), (2, 100)], "id int, salary int")
    top = e.select(F.max("salary")).scalar()
    got = e.where(F.col("salary") < top).agg(F.max("salary").alias("s")).first().s
    assert got is None


def test_rank_ties_at_one_and_three(spark):
    s = spark.createDataFrame([(0, i, v) for i, v in enumerate([9, 9, 7, 5, 5, 3])], "g int, i int, v int")
    dense = top_n_by_group(s, "g", "v", 3, "dense_rank").collect()
    assert sorted(r.i for r in dense) == [0, 1, 2, 3, 4]
    rank = top_n_by_group(s, "g", "v", 3, "rank").collect()
    assert sorted((r.i, r.rnk) for r in rank) == [(0, 1), (1, 1), (2, 3)]


def test_run_of_exactly_three(spark):
    logs = spark.createDataFrame([(0, i, v) for i, v in enumerate([1, 1, 1, 2, 1, 2, 2])],
                                 "k int, id int, num int")
    assert [r.num for r in runs(logs, "k", ["id"], "num").collect()] == [1]


def test_null_in_not_in_set_empties_result(spark):
    from martkit.operators.joins import not_in
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,)], "y int")
    sql = "SELECT x FROM {a} WHERE x NOT IN (SELECT y FROM {b})"
    assert spark.sql(sql, a=a, b=b).collect() == []
    assert not_in(a, "x", b, "y").collect() == []
    # without the NULL: 2 survives, the NULL probe does not; empty set keeps all
    b2 = spark.createDataFrame([(1,)], "y int")
    assert sorted(r.x for r in not_in(a, "x", b2, "y").collect()) == [2]
    empty = b2.where("y > 5")
    assert len(not_in(a, "x", empty, "y").collect()) == 3
    assert sorted(map(repr, spark.sql(sql, a=a, b=b2).collect())) == \
        sorted(map(repr, not_in(a, "x", b2, "y").collect()))


def test_one_day_gap_is_not_yesterday(spark):
    w = spark.createDataFrame([(1, date(2024, 1, 1), 10), (2, date(2024, 1, 2), 25),
                               (3, date(2024, 1, 4), 30)], "id int, d date, t int")
    prev = w.select(F.date_add("d", 1).alias("d"), F.col("t").alias("pt"))
    got = w.join(prev, "d").where(F.col("t") > F.col("pt")).select("id").collect()
    assert [r.id for r in got] == [2]  # 2024-01-04 has no yesterday row


def test_namesakes_kept_apart(spark):
    p = spark.createDataFrame([(1, "Ann"), (2, "Ann")], "id int, name string")
    o = spark.createDataFrame([(1,), (1,), (2,)], "cid int")
    cnt = o.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).join(p, F.col("cid") == F.col("id"))
    assert sorted((r.id, r.n) for r in cnt.collect()) == [(1, 2), (2, 1)]

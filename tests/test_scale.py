"""Steps that shuffle keys or narrow rows where they shuffled whole rows."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from snapstar.operators import audit as A
from snapstar.operators import dedup as D
from snapstar.operators import quality as Q
from snapstar.plans import gold_model as G
from snapstar.plans import jobs as J
from snapstar.plans import model as M
from snapstar.plans import transit as TR
from snapstar.session import ensure_checkpoint_dir
from snapstar.sources import flatten as FL
from snapstar.sources import versions as V

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list:
    return sorted(map(str, df.collect()))


def keyed(spark):
    rows = [(f"k{i}", i % 3 or None, i, f"v{i}") for i in range(200)]
    rows += [("k7", 1, 3, "less"), ("k7", 1, 3, "least"), (None, None, 5, "a"), (None, None, 4, "b"), (None, 1, 6, "c")]
    return spark.createDataFrame(rows, "k string, part int, n int, v string")


def test_rows_that_are_alone_are_picked_without_a_shuffle(spark, monkeypatch):
    df = keyed(spark)
    want = rows_of(D.pick_per_key(df, ["k", "part"], ["n"], pick="min"))
    assert rows_of(D.pick_where_repeated(df, ["k", "part"], ["n"], pick="min")) == want
    assert "Row(k='k7', part=1, n=3, v='least')" in want and "Row(k=None, part=None, n=4, v='b')" in want
    alone = df.dropDuplicates(["k", "part"]).localCheckpoint()
    assert "Exchange" not in plan_of(D.pick_where_repeated(alone, ["k", "part"], ["n"]))
    monkeypatch.setattr(D, "REPEATED_BROADCAST", 1)  # many keys repeat
    assert rows_of(D.pick_where_repeated(df, ["k", "part"], ["n"], pick="min")) == want


def test_keys_that_hashes_do_not_tell_apart_are_grouped(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D, 1), (-0.0D, 2), (1.0D, 3) AS t(k, n)")
    assert D.pick_where_repeated(df, ["k"], ["n"]).count() == 2


def test_stored_duplicates_count_as_the_plain_check_does(spark):
    df = keyed(spark)
    for keys in (["k"], ["k", "part"], ["part"], ["v"]):
        assert A.duplicate_keys_stored("x", df, keys).collect() == A.duplicate_keys("x", df, keys).collect()


def test_lines_travel_as_columns_and_not_as_elements(spark):
    for bronze in (M.line_status_bronze, M.arrivals_bronze):
        df = bronze(spark, SF)
        below = plan_of(df).split("Exchange", 1)[1]
        assert "tube" not in below and "Station " not in below


def test_a_merge_of_new_keys_shuffles_no_rows(spark, monkeypatch):
    source = spark.range(50).select(F.concat(F.lit("r"), "id").alias("k"), F.lit("body").alias("v")).localCheckpoint()
    assert "Exchange hashpartitioning" not in plan_of(V._rows_of_new_keys(source, None, ["k"], []))
    for few in (V.FEW_KEYS, 0):
        monkeypatch.setattr(V, "FEW_KEYS", few)
        base = f"{ensure_checkpoint_dir(spark)}/merge-{uuid.uuid4().hex}"
        twice = source.unionByName(source.where("k < 'r2'"))
        assert V.entry(spark, base, V.merge_insert_only(spark, twice, base, ["k"]))["rows_written"] == 50
        assert V.entry(spark, base, V.merge_insert_only(spark, twice, base, ["k"]))["rows_written"] == 0
        more = twice.unionByName(spark.createDataFrame([("x", "1"), ("x", "1"), ("y", "2"), (None, "3"), (None, "3")], "k string, v string"))
        assert V.entry(spark, base, V.merge_insert_only(spark, more, base, ["k"]))["rows_written"] == 3
        assert rows_of(V.read(spark, base).where("k is null or k in ('x', 'y')")) == ["Row(k='x', v='1')", "Row(k='y', v='2')", "Row(k=None, v='3')"]


def test_overlaps_do_not_depend_on_the_order_of_repeated_rows(spark):
    day = dt.datetime(2020, 1, 2)
    rows = [("a", day, None, "v"), ("a", day, None, "v"), ("a", day, dt.datetime(2020, 1, 1), "v")]
    for order in (rows, rows[::-1]):
        dim = spark.createDataFrame(order, "id string, effective_from timestamp, effective_to timestamp, version_key string").coalesce(1)
        assert A.overlapping_versions("x", dim, ["id"]).first()["actual_value"] == 1


def test_faults_are_added_to_the_tables_where_they_lie(spark):
    t = G.gold_tables(spark, SF)
    twice = G.with_faults(t)
    files = lambda df: set(df.inputFiles())
    assert all(files(t[n]) <= files(twice[n]) for n in t)
    assert twice["fact_arrival_observation"].count() == t["fact_arrival_observation"].count() + 2


def test_a_payload_is_made_and_parsed_once(spark):
    for bronze, contract in ((M.weather_bronze, TR.weather_contract), (M.line_status_bronze, TR.line_status_contract)):
        plan = G._good(bronze(spark, SF), contract)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and plan.count("StructsToJson") == 1


def arrivals_of(spark, responses) -> list:
    at = dt.datetime(2024, 8, 23, 21)
    element = lambda i, vehicle, eta: {"id": i, "vehicleId": vehicle, "stationName": "x", "lineId": "L1", "timestamp": "2024-08-23T21:00:00Z",
                                       "timeToStation": eta, "expectedArrival": "2024-08-23T21:00:00Z"}
    rows = [(r, "/StopPoint/S1/Arrivals", at, at.date(), "tfl", json.dumps([element(*e) for e in elements])) for r, elements in responses]
    return spark.createDataFrame(rows, "request_id string, source_endpoint string, ingested_at timestamp, ingestion_date date, source string, payload string")


def test_equal_arrivals_of_a_response_meet_where_it_lies(spark, monkeypatch):
    within = [(f"r{i}", [("x1", "v2", 5), ("x1", "v1", 7), ("x1", "v0", -1), ("x1", "v0", -1), ("x2", "v9", 1)]) for i in range(9)]
    across = [("r1", [("x1", "v3", 5), ("x3", "v1", 4)]), ("r0||x", [("1", "v1", 1)]), ("r0", [("x||1", "v0", 1)])]
    want = {("x1", "v1"), ("x2", "v9")}
    for few in (D.REPEATED_BROADCAST, 0):  # whether repeated keys are few or many
        monkeypatch.setattr(D, "REPEATED_BROADCAST", few)
        silver, invalid = J.silver_arrivals(arrivals_of(spark, within))
        assert sorted((r["request_id"], r["arrival_id"], r["vehicle_id"]) for r in silver.collect()) == sorted((f"r{i}", *w) for i in range(9) for w in want)
        assert invalid.count() == 18 and "Exchange" not in plan_of(silver)
        silver, invalid = J.silver_arrivals(arrivals_of(spark, within + across))
        got = sorted((r["request_id"], r["arrival_id"], r["vehicle_id"]) for r in silver.collect())
        assert got == sorted([(f"r{i}", *w) for i in range(9) for w in want] + [("r1", "x3", "v1"), ("r0", "x||1", "v0")]) and invalid.count() == 18


def test_folded_keys_come_back(spark):
    rows = [("r", "a", None), ("r", "a", "="), ("r", "a", ""), ("r", "a", "!x"), ("r", "a", "ab"), (None, None, "k")]
    df = spark.createDataFrame(rows, "request_id string, arrival_id string, arrival_observation_key string")
    df = df.unionByName(TR.with_arrival_key(df))
    key = "arrival_observation_key"
    assert rows_of(TR.unfolded(TR.folded(df, key), key)) == rows_of(df)


def test_stored_facts_hold_no_hash_that_their_columns_give(spark):
    silver = G.silver_arrivals(spark, SF)
    fact = J.fact_arrivals(silver, G.dim_station(spark, SF), G.dim_line(spark, SF), G._plain_calendar(spark))
    stored = spark.read.parquet(*fact.inputFiles())
    assert {r[0] for r in stored.select("arrival_observation_key").distinct().collect()} == {"="}
    assert fact.select("arrival_observation_key").exceptAll(silver.select("arrival_observation_key")).count() == 0
    assert "arrival_observation_key" not in spark.read.parquet(*silver.inputFiles()).columns


def test_weather_is_parsed_once_for_all_its_rules(spark):
    valid = Q.split(FL.weather(G._good(M.weather_bronze(spark, SF), TR.weather_contract)), TR.weather_rules())[0]
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_a_table_marked_and_split_is_split_as_ever(spark):
    rules = [Q.Rule("positive", F.col("n") > 0), *Q.not_null("k")]
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 2), ("c", -1), (None, None)], "k string, n int")
    marked = Q.split_marked(Q.mark(df, rules, "_valid"), rules, "_valid")
    assert [rows_of(x) for x in marked] == [rows_of(x) for x in Q.split(df, rules)]


def test_valid_arrivals_are_counted_from_one_column(spark):
    plan = plan_of(G.silver_arrivals(spark, SF).groupBy().count())
    assert "ReadSchema: struct<_valid:boolean>" in plan


def test_rows_of_repeated_keys_are_picked_once(spark):
    df = keyed(spark)
    got = D.pick_where_repeated(df, ["k", "part"], ["n"], pick="min")
    assert "Aggregate" not in plan_of(got)
    assert rows_of(got) == rows_of(D.pick_per_key(df, ["k", "part"], ["n"], pick="min"))
    alone = df.dropDuplicates(["k", "part"]).localCheckpoint()
    assert D.pick_where_repeated(alone, ["k", "part"], ["n"]) is alone


def test_newest_rows_of_few_keys_are_not_shuffled(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") % 50).alias("t"), F.lit("text").alias("v")).union(
        spark.createDataFrame([(None, 4, "x"), (3, None, "y")], "k long, t long, v string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = D.rows_at_latest_per_key(df, ["k"], "t")
        assert "Exchange hashpartitioning" not in plan_of(got)
        assert got.count() == sum(1 for i in range(5000) if i % 50 == 49) and got.where("k is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_of_a_large_parent_are_counted_before_they_are_shuffled(spark, monkeypatch):
    child = spark.createDataFrame([("a",)] * 5 + [("x",)] * 3 + [("y",), (None,)], "k string")
    parent = spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), (NULL) AS t(p)")
    few = A.orphans("o", child, parent, ["k"], ["p"])
    monkeypatch.setattr(A, "small_enough", lambda df: False)
    many = A.orphans("o", child, parent, ["k"], ["p"])
    assert few.first()["actual_value"] == many.first()["actual_value"] == 4
    assert A.orphans("o", child.where("k = 'a'"), parent, ["k"], ["p"]).first()["actual_value"] == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(few.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_bridge_shuffles_no_keys_and_stores_no_hash_of_them(spark):
    t = G.gold_tables(spark, SF)
    bridge = t["bridge_station_line"]
    stored = spark.read.parquet(*[f for f in bridge.inputFiles() if "/bridge-" in f])
    assert {r[0] for r in stored.select("station_line_key").distinct().collect()} == {"="}
    assert bridge.select("station_line_key").distinct().count() == bridge.count()
    assert {r[0].isoformat(" ") for r in bridge.select("source_snapshot_at").distinct().collect()} == {G.SECOND}


def test_keys_out_of_scope_are_not_missing(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a")], "n int, k string")
    right = spark.createDataFrame([(1, "a")], "n int, k string")
    within = [("n", spark.createDataFrame([(1,), (2,), (2,)], "n int")), ("k", spark.createDataFrame([("b",)], "k string"))]
    in_scope = left.where("n < 3 and k = 'b'")
    got = A.set_difference("x", left, right, ["n", "k"], within=within)
    assert got.collect() == A.set_difference("x", in_scope, right, ["n", "k"]).collect() and got.first()["actual_value"] == 2


def test_stations_of_a_day_are_counted_without_a_row_for_each_pair(spark):
    rows = [(f"s{i % 40}" if i % 11 else None, 20240101 + i % 9, f"v{i % 5}", i) for i in range(900)]
    ar = spark.createDataFrame(rows, "station_key string, prediction_date_key int, vehicle_id string, time_to_station_seconds int")
    ls = spark.createDataFrame([], "snapshot_date_key int, line_id string, snapshot_at timestamp, is_disrupted boolean")
    wx = spark.createDataFrame([], "observation_date_key int, temperature_c double, relative_humidity_pct int, precipitation_mm double, wind_gusts_kmh double")
    dates = J.D.calendar(spark, "2024-01-01", "2024-01-31").withColumns({"is_bank_holiday": F.lit(False), "holiday_name": F.lit(None).cast("string")})
    kpis = TR.build_daily_network_kpis(ls, ar, wx, dates)
    want = {d: (len({s for s, e, _, _ in rows if e == d and s}), len({v for _, e, v, _ in rows if e == d})) for d in {r[1] for r in rows}}
    assert {r["date_key"]: (r["stations_observed"], r["distinct_vehicles"]) for r in kpis.collect()} == want
    assert kpis.columns.index("stations_observed") == kpis.columns.index("distinct_vehicles") + 1
    assert "Expand" not in plan_of(kpis)

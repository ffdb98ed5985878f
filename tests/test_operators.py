"""Generic operators on small literal frames, including the edge cases the
snapshot model depends on."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from snapstar.functions import json as J
from snapstar.functions import labels as L
from snapstar.functions.keys import hash_key
from snapstar.functions.time import local_date, local_to_utc, to_local, try_timestamp
from snapstar.operators import audit as A
from snapstar.operators import quality as Q
from snapstar.operators.asof import as_of_join
from snapstar.operators.dedup import canonical_per_key, latest_per_key, rows_at_latest, rows_at_latest_per_key
from snapstar.operators.scd2 import apply_changes, classify, initial_versions, prepare_source, versions_from_snapshots
from snapstar.operators.segmented import next_within_key, prev_within_key
from snapstar.plans import dims as D
from snapstar.plans import serving as S
from snapstar.sources import tables as T

TS = dt.datetime


# --- time -------------------------------------------------------------------


def test_late_evening_utc_in_august_is_next_london_day(spark):
    df = spark.createDataFrame([(TS(2024, 8, 23, 23, 30), TS(2024, 8, 23, 22, 30))], "a timestamp, b timestamp")
    assert tuple(df.select(local_date("a"), local_date("b")).first()) == (dt.date(2024, 8, 24), dt.date(2024, 8, 23))


def test_winter_london_equals_utc(spark):
    df = spark.createDataFrame([(TS(2024, 1, 23, 22, 30),)], "ts timestamp")
    assert df.select(local_date("ts")).first()[0] == dt.date(2024, 1, 23)


def test_clock_change_nights(spark):
    # Autumn: repeated local 01:30 resolves to the earlier instant (00:30Z).
    # Spring: non-existent local 01:30 maps to 01:30Z.
    df = spark.createDataFrame([(TS(2024, 10, 27, 1, 30), TS(2024, 3, 31, 1, 30))], "a timestamp, s timestamp")
    a, s = df.select(local_to_utc("a"), local_to_utc("s")).first()
    assert a == TS(2024, 10, 27, 0, 30)
    assert s == TS(2024, 3, 31, 1, 30)


def test_bad_timestamp_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("2024-08-23T22:30:00Z",), ("not a time",), (None,)], "t string")
    got = [r[0] for r in df.select(try_timestamp("t")).collect()]
    assert got[0] == TS(2024, 8, 23, 22, 30) and got[1] is None and got[2] is None


def test_to_local_round_trip(spark):
    df = spark.createDataFrame([(TS(2024, 7, 1, 12, 0),)], "ts timestamp")
    assert df.select(to_local("ts")).first()[0] == TS(2024, 7, 1, 13, 0)


# --- labels and text ----------------------------------------------------------


def test_severity_flags_and_service_state(spark):
    rows = [(10, None), (20, None), (None, None), (8, None), (3, None),
            (None, " Good Service "), (0, "Minor Delays and severe delays"), (11, "Part Closure"), (None, "odd")]
    df = spark.createDataFrame(rows, "sev int, d string")
    out = df.select(L.is_good_service("sev"), L.is_disrupted("sev"), L.service_state("sev", "d")).collect()
    assert [tuple(r) for r in out] == [
        (True, False, "Healthy"), (False, True, "Unknown"), (False, True, "Unknown"), (False, True, "Degraded"),
        (False, True, "Disrupted"), (False, True, "Healthy"), (False, True, "Degraded"), (False, True, "Disrupted"),
        (False, True, "Unknown"),
    ]


def test_weather_code_labels(spark):
    df = spark.createDataFrame([(0,), (2,), (48,), (57,), (77,), (99,), (4,), (None,)], "c int")
    assert [r[0] for r in df.select(L.code_label("c")).collect()] == [
        "Clear sky", "Cloudy", "Fog", "Freezing drizzle", "Snow", "Thunderstorm", "Unknown", "Unknown"]


def test_clean_reason_and_sentences(spark):
    rows = [
        ("PICCADILLY LINE: Minor delays. Due to a fault!  Good service elsewhere?", "Piccadilly"),
        ("piccadilly: no line word. Next", "Piccadilly"),
        ("DISTRICT LINE: generic prefix. Two", None),
        ("   ", "X"),
        ("A+B (line): special. x", "A+B (line)"),
    ]
    df = spark.createDataFrame(rows, "r string, n string")
    out = df.select(L.clean_reason("r", "n").alias("c")).select("c", L.sentences("c").alias("s")).collect()
    assert out[0]["c"] == "Minor delays. Due to a fault!  Good service elsewhere?"
    assert out[0]["s"] == ["Minor delays.", "Due to a fault!", "Good service elsewhere?"]
    assert out[1]["c"] == "no line word. Next"
    assert out[2]["c"] == "generic prefix. Two"
    assert out[3]["c"] is None and out[3]["s"] is None
    assert out[4]["c"] == "special. x"


def test_eta_text(spark):
    df = spark.createDataFrame([(90,), (None,)], "s int")
    assert [r[0] for r in df.select(L.eta_text("s")).collect()] == ["1.5 min", "No data"]


# --- keys -----------------------------------------------------------------------


def test_null_safe_key_differs_from_concat_ws_collapse(spark):
    df = spark.createDataFrame([("r1", "l", None), ("r1", "l", "NULL"), ("r2", "l", None)], "a string, b string, c string")
    keys = [r[0] for r in df.select(hash_key("a", "b", "c")).collect()]
    assert keys[0] != keys[2]  # null status twice in different requests -> two keys
    raw = [r[0] for r in df.select(hash_key("a", "b", "c", null_marker=None)).collect()]
    assert raw[0] == df.select(F.sha2(F.lit("r1||l"), 256)).first()[0]


# --- JSON contracts ---------------------------------------------------------------


def test_payload_contracts(spark):
    rows = [('[{"id": "a", "name": "x"}]',), ("[]",), ('{"id": "a"}',), ("not json",), ('[{"id": "a"}]',)]
    df = spark.createDataFrame(rows, "p string")
    out = df.select(
        J.root_kind("p"),
        J.array_contract("p", ["id", "name"]),
        J.array_contract("p", ["id"], allow_empty=True),
        J.has_keys("p", ["id"]),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("array", True, True, False),
        ("array", False, True, False),
        ("object", False, False, True),
        ("invalid", False, False, False),
        ("array", False, True, False),
    ]


# --- quality ----------------------------------------------------------------------


def test_valid_and_invalid_partition_the_input(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (None, 2)], "id int, eta int")
    rules = [*Q.not_null("id"), Q.non_negative("eta")]
    valid, invalid = Q.split(df, rules)
    assert valid.count() + invalid.count() == df.count()
    assert {r["id"] for r in valid.collect()} == {1}
    bad = {r["id"]: r["failed_rules"] for r in invalid.collect()}
    assert bad[2] == ["eta_non_negative"] and bad[None] == ["id_not_null"]
    with pytest.raises(Q.QualityGateError):
        Q.gate(df, rules)
    assert Q.gate(df, rules, max_invalid=3).count() == 1


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    r = Q.null_profile(df).first()
    assert (r["rows"], r["a_nulls"], r["b_nulls"]) == (2, 1, 2)


# --- dedup --------------------------------------------------------------------------


def test_latest_per_key_newest_with_tiebreak(spark):
    rows = [("k", TS(2024, 1, 1), "r1", 1.0), ("k", TS(2024, 1, 2), "r2", 2.0), ("k", TS(2024, 1, 2), "r3", 3.0),
            ("j", TS(2024, 1, 1), "r9", 9.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, req string, v double")
    got = {r["k"]: r["req"] for r in latest_per_key(df, ["k"], "ts", ["req"]).collect()}
    assert got == {"k": "r3", "j": "r9"}


def test_canonical_pick_exact_match_then_smallest(spark):
    rows = [("S1", "S1", "exact"), ("S1", "A0", "smaller"), ("S2", "B2", "b"), ("S2", "B1", "a")]
    df = spark.createDataFrame(rows, "station string, stop string, name string")
    got = {r["station"]: r["stop"] for r in canonical_per_key(df, ["station"], F.col("stop") == F.col("station"), ["stop"]).collect()}
    assert got == {"S1": "S1", "S2": "B1"}


def test_rows_at_latest_and_per_key(spark):
    rows = [("a", TS(2024, 1, 1)), ("a", TS(2024, 1, 2)), ("a", TS(2024, 1, 2)), ("b", TS(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    assert rows_at_latest(df, "ts").count() == 2
    per = rows_at_latest_per_key(df, ["k"], "ts")
    assert sorted((r["k"], r["ts"]) for r in per.collect()) == [("a", TS(2024, 1, 2)), ("a", TS(2024, 1, 2)), ("b", TS(2024, 1, 1))]


# --- segmented neighbours equal plain windows, with a hot key -----------------------


def test_segmented_prev_next_match_window(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 40)}"
        rows.append((key, TS(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20)), i, rnd.choice("abc")))
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v string")
    bucket = F.date_trunc("day", F.col("ts"))
    seg = next_within_key(prev_within_key(df, ["k"], ["ts", "id"], ["v", "id"], bucket), ["k"], ["ts", "id"], ["v"], bucket)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = df.select("id", F.lag("v").over(w).alias("pv"), F.lag("id").over(w).alias("pid"), F.lead("v").over(w).alias("nv"))
    a = {r["id"]: (r["prev_v"], r["prev_id"], r["next_v"]) for r in seg.collect()}
    b = {r["id"]: (r["pv"], r["pid"], r["nv"]) for r in ref.collect()}
    assert a == b


def test_heavy_keys_are_sliced_and_results_unchanged(spark):
    from snapstar.operators.segmented import hot_key_buckets
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 40)}"
        rows.append((key, TS(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 86400 * 3)), i, rnd.choice("abc")))
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v string")
    sizes = hot_key_buckets(df, ["k"], "ts", max_rows=100).groupBy("k", "_seg_bucket").count()
    per_key = {r["k"]: r for r in sizes.groupBy("k").agg(F.count(F.lit(1)).alias("nb"), F.max("count").alias("mx")).collect()}
    assert per_key["hot"]["nb"] >= 10  # ~1200 rows cut into ~12 slices
    assert all(r["nb"] == 1 for k, r in per_key.items() if k != "hot")
    seg = next_within_key(prev_within_key(df, ["k"], ["ts", "id"], ["v", "id"], max_rows=100),
                          ["k"], ["ts", "id"], ["v"], max_rows=100)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = df.select("id", F.lag("v").over(w).alias("pv"), F.lag("id").over(w).alias("pid"), F.lead("v").over(w).alias("nv"))
    a = {r["id"]: (r["prev_v"], r["prev_id"], r["next_v"]) for r in seg.collect()}
    b = {r["id"]: (r["pv"], r["pid"], r["nv"]) for r in ref.collect()}
    assert a == b


# --- as-of join -----------------------------------------------------------------------


def _versions(spark):
    rows = [("L1", "k1", TS(2024, 1, 1), TS(2024, 1, 5)), ("L1", "k2", TS(2024, 1, 5), None),
            ("L2", "k3", TS(2024, 1, 3), None)]
    return spark.createDataFrame(rows, "line_id string, line_key string, effective_from timestamp, effective_to timestamp")


@pytest.mark.parametrize("strategy", ["broadcast", "sorted"])
def test_as_of_join_boundaries(spark, strategy):
    facts = spark.createDataFrame(
        [(1, "L1", TS(2023, 12, 31)), (2, "L1", TS(2024, 1, 1)), (3, "L1", TS(2024, 1, 4, 23)),
         (4, "L1", TS(2024, 1, 5)), (5, "L1", TS(2024, 3, 1)), (6, "L2", TS(2024, 1, 2)), (7, "L3", TS(2024, 1, 9)),
         (8, "L2", TS(2024, 2, 9)), (9, None, TS(2024, 2, 9))],
        "id int, line_id string, ts timestamp",
    )
    versions = _versions(spark).unionByName(spark.createDataFrame(
        [(None, "knull", TS(2020, 1, 1), None)], "line_id string, line_key string, effective_from timestamp, effective_to timestamp"))
    got = {r["id"]: r["line_key"] for r in as_of_join(facts, versions, ["line_id"], "ts", strategy=strategy).collect()}
    # before the first version and unknown keys drop (inner); a fact exactly
    # at effective_to belongs to the newer version
    assert got == {2: "k1", 3: "k1", 4: "k2", 5: "k2", 8: "k3"}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "sorted"])
def test_as_of_refuses_overlaps_and_skips_versions_without_time(spark, strategy):
    from snapstar.operators.asof import OverlappingVersions
    schema = "line_id string, line_key string, effective_from timestamp, effective_to timestamp"
    facts = spark.createDataFrame([(1, "L1", TS(2024, 1, 5))], "id int, line_id string, ts timestamp")
    inside = [("L1", "v1", TS(2024, 1, 1), TS(2024, 1, 10)), ("L1", "v2", TS(2024, 1, 3), TS(2024, 1, 4))]
    equal = [("L1", "v1", TS(2024, 1, 1), TS(2024, 1, 10)), ("L1", "v2", TS(2024, 1, 1), TS(2024, 1, 2))]
    for rows in (inside, equal):
        with pytest.raises(OverlappingVersions):
            as_of_join(facts, spark.createDataFrame(rows, schema), ["line_id"], "ts", strategy=strategy)
    empty = [("L1", "v1", TS(2024, 1, 1), TS(2024, 1, 10)), ("L1", "v0", TS(2024, 1, 5), TS(2024, 1, 5)), ("L1", "v9", TS(2024, 1, 4), TS(2024, 1, 2))]
    got = as_of_join(facts, spark.createDataFrame(empty, schema), ["line_id"], "ts", strategy=strategy).collect()
    assert [(r["id"], r["line_key"]) for r in got] == [(1, "v1")]


def test_bursts_and_missing_keys_are_sliced(spark):
    from snapstar.operators.segmented import hot_key_buckets
    rows = [("hot", TS(2024, 1, 1) + dt.timedelta(microseconds=i), i) for i in range(1990)] + [("hot", TS(2025, 1, 1) + dt.timedelta(days=i), 5000 + i) for i in range(10)]
    rows += [(None, TS(2024, 1, 1) + dt.timedelta(seconds=i), 9000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int")
    sizes = [r["count"] for r in hot_key_buckets(df, ["k"], "ts", max_rows=200).groupBy("k", "_seg_bucket").count().collect()]
    assert max(sizes) <= 400 and sum(sizes) == 2600 and len(sizes) >= 12
    w = Window.partitionBy("k").orderBy("ts", "id")
    a = {r["id"]: r["prev_id"] for r in prev_within_key(df, ["k"], ["ts", "id"], ["id"], max_rows=200).collect()}
    assert a == {r["id"]: r["p"] for r in df.select("id", F.lag("id").over(w).alias("p")).collect()}


def test_eta_ties_go_to_the_even_digit(spark):
    df = spark.createDataFrame([(15,), (75,), (45,), (9,), (120,), (90000,), (None,)], "s int")
    assert [r[0] for r in df.select(L.eta_text("s")).collect()] == ["0.2 min", "1.2 min", "0.8 min", "0.1 min", "2.0 min", "1500.0 min", "No data"]


def test_upsert_keeps_partitions_and_refuses_repeated_keys(spark):
    spark.sql("DROP TABLE IF EXISTS ups")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "x")], "id int, p string, v string")
    assert T.merge_upsert(spark, first, "ups", ["id", "p"], partition_by=["p"]) == "created"
    assert T.merge_upsert(spark, spark.createDataFrame([(3, "b", "y"), (4, "b", "z")], "id int, p string, v string"), "ups", ["id", "p"]) == "upserted"
    assert T.partition_columns(spark, "ups") == ["p"]
    assert sorted((r["id"], r["p"], r["v"]) for r in spark.table("ups").collect()) == [(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (4, "b", "z")]
    with pytest.raises(T.DuplicateSourceKeys):
        T.merge_upsert(spark, spark.createDataFrame([(1, "a", "b"), (1, "a", "c")], "id int, p string, v string"), "ups", ["id", "p"])
    spark.sql("DROP TABLE ups")


def test_one_large_partition_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).select("id", F.lit("2024-01-01").alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        T.laid_out(df, ["d"]).write.parquet(str(tmp_path / "out"))
        assert len(list((tmp_path / "out").glob("part-*"))) > 1
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_version_history_numbers_versions(spark):
    from snapstar.operators.scd2 import version_history
    got = [(r["line_id"], r["line_key"], r["version_no"], r["valid_days"]) for r in
           version_history(_versions(spark).withColumn("version_key", F.col("line_key")), ["line_id"]).orderBy("line_id", "version_no").collect()]
    assert got == [("L1", "k1", 1, 4), ("L1", "k2", 2, None), ("L2", "k3", 1, None)]


def test_a_day_outside_the_calendar_is_an_error(spark):
    day = spark.createDataFrame([(20240101, 1), (20250101, 2)], "date_key int, n long")
    cal = spark.createDataFrame([(20240101, "x")], "date_key int, name string")
    with pytest.raises(Exception, match="outside the calendar"):
        S.combine_daily([day], cal, ["date_key", "name"], ["n"]).collect()


def test_as_of_strategies_agree_with_range_join_under_skew(spark):
    rnd = random.Random(3)
    ev = []
    for i in range(4000):
        u = 0 if rnd.random() < 0.35 else rnd.randint(1, 30)
        ev.append((i, u, TS(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 86400 * 25)), rnd.choice(["a", "b", "c"])))
    events = spark.createDataFrame(ev, "event_id long, user_id long, ts timestamp, t string")
    v = versions_from_snapshots(events.select("user_id", "ts", "t"), ["user_id"], ["t"], "ts").select(
        "user_id", "version_key", "effective_from", "effective_to")
    f = events.select("event_id", "user_id", "ts")
    a = {tuple(r) for r in as_of_join(f, v, ["user_id"], "ts", strategy="sorted").select("event_id", "version_key").collect()}
    a2 = {tuple(r) for r in as_of_join(f, v, ["user_id"], "ts", strategy="sorted", max_rows=50).select("event_id", "version_key").collect()}
    a3 = {tuple(r) for r in as_of_join(f, v, ["user_id"], "ts", strategy="sorted",
                                       bucket=F.date_trunc("day", F.col("_t"))).select("event_id", "version_key").collect()}
    assert a == a2 == a3
    b = {tuple(r) for r in as_of_join(f, v, ["user_id"], "ts", strategy="broadcast").select("event_id", "version_key").collect()}
    cond = (f.user_id == v.user_id) & (f.ts >= v.effective_from) & (v.effective_to.isNull() | (f.ts < v.effective_to))
    c = {tuple(r) for r in f.join(v, cond).select("event_id", "version_key").collect()}
    assert a == b == c and len(a) == 4000


# --- SCD2 -------------------------------------------------------------------------------


def _line_snapshots(spark):
    rows = [
        ("L1", "Piccadilly", "tube", TS(2024, 1, 1)), ("L2", "District", "tube", TS(2024, 1, 1)),
        ("L1", "Piccadilly", "tube", TS(2024, 1, 2)), ("L2", "District", "tube", TS(2024, 1, 2)),
        ("L1", "Piccadilly Line", "tube", TS(2024, 1, 3)), ("L2", "District", "tube", TS(2024, 1, 3)),
        ("L3", "Elizabeth", "rail", TS(2024, 1, 3)),
    ]
    return spark.createDataFrame(rows, "line_id string, line_name string, mode_name string, snapshot_at timestamp")


def _incremental(spark, states, keys, attrs):
    snaps = sorted({r[0] for r in states.select("snapshot_at").distinct().collect()})
    dim = None
    for s in snaps:
        src = prepare_source(states.filter(F.col("snapshot_at") <= F.lit(s)), keys, attrs, "snapshot_at")
        dim = initial_versions(src, keys, attrs) if dim is None else apply_changes(dim, src, keys, attrs, "snapshot_at")
        dim = dim.checkpoint()
    return dim


def test_scd2_rename_closes_and_opens_without_gap(spark):
    states = _line_snapshots(spark)
    dim = _incremental(spark, states, ["line_id"], ["line_name", "mode_name"])
    l1 = sorted((r["line_name"], r["effective_from"], r["effective_to"], r["is_current"]) for r in dim.filter("line_id = 'L1'").collect())
    assert l1 == [("Piccadilly", TS(2024, 1, 1), TS(2024, 1, 3), False), ("Piccadilly Line", TS(2024, 1, 3), None, True)]
    l3 = dim.filter("line_id = 'L3'").first()
    assert l3["effective_from"] == TS(2024, 1, 3) and l3["is_current"]


def test_scd2_incremental_equals_bulk(spark):
    states = _line_snapshots(spark)
    inc = _incremental(spark, states, ["line_id"], ["line_name", "mode_name"])
    bulk = versions_from_snapshots(states, ["line_id"], ["line_name", "mode_name"], "snapshot_at")
    cols = ["line_id", "line_name", "mode_name", "attribute_hash", "version_key", "effective_from", "effective_to", "is_current"]
    assert inc.select(*cols).exceptAll(bulk.select(*cols)).count() == 0
    assert bulk.select(*cols).exceptAll(inc.select(*cols)).count() == 0


def test_scd2_classify_and_missing_policy(spark):
    states = _line_snapshots(spark)
    first = prepare_source(states.filter(F.col("snapshot_at") <= F.lit(TS(2024, 1, 1))), ["line_id"], ["line_name", "mode_name"], "snapshot_at")
    dim = initial_versions(first, ["line_id"], ["line_name", "mode_name"])
    later = states.filter((F.col("snapshot_at") == F.lit(TS(2024, 1, 3))) & (F.col("line_id") != "L2"))
    src = prepare_source(later, ["line_id"], ["line_name", "mode_name"], "snapshot_at")
    got = {r["line_id"]: r["change_type"] for r in classify(src, dim, ["line_id"]).collect()}
    assert got == {"L1": "changed", "L2": "missing", "L3": "new"}
    kept = apply_changes(dim, src, ["line_id"], ["line_name", "mode_name"], "snapshot_at", missing="keep")
    assert kept.filter("line_id = 'L2' AND is_current").count() == 1
    closed = apply_changes(dim, src, ["line_id"], ["line_name", "mode_name"], "snapshot_at", missing="close")
    l2 = closed.filter("line_id = 'L2'").first()
    assert not l2["is_current"] and l2["effective_to"] == TS(2024, 1, 3)


def test_modes_order_does_not_change_hash(spark):
    from snapstar.functions.keys import array_text, attribute_hash
    df = spark.createDataFrame([(["tube", "bus"],), (["bus", "tube"],)], "modes array<string>")
    h = [r[0] for r in df.select(attribute_hash(array_text("modes"))).collect()]
    assert h[0] == h[1]


# --- tables (merges) ---------------------------------------------------------------------


def test_insert_only_is_idempotent_and_null_safe(spark):
    target = spark.createDataFrame([("r1", "l", None, 1)], "req string, line string, status int, v int")
    source = spark.createDataFrame([("r1", "l", None, 2), ("r2", "l", None, 3), ("r2", "l", None, 3)],
                                   "req string, line string, status int, v int")
    once = T.insert_only_frame(target, source, ["req", "line", "status"], null_safe=["status"])
    assert sorted(r["req"] for r in once.collect()) == ["r1", "r2"]
    twice = T.insert_only_frame(once, source, ["req", "line", "status"], null_safe=["status"])
    assert twice.count() == once.count()


def test_upsert_and_expire(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in T.upsert_frame(target, source, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    dim = spark.createDataFrame([(1, TS(2024, 1, 1), None, True), (2, TS(2024, 1, 1), None, True)],
                                "k int, effective_from timestamp, effective_to timestamp, is_current boolean")
    out = {r["k"]: (r["effective_to"], r["is_current"]) for r in
           T.expire_frame(dim, spark.createDataFrame([(2,)], "k int"), ["k"], F.lit(TS(2024, 2, 1))).collect()}
    assert out == {1: (None, True), 2: (TS(2024, 2, 1), False)}


def test_catalog_merges_and_staged_replace(spark):
    spark.sql("DROP TABLE IF EXISTS t_merge")
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert T.merge_insert_only(spark, src, "t_merge", ["k"]) == "created"
    assert T.merge_insert_only(spark, src, "t_merge", ["k"]) == "merged"
    assert spark.table("t_merge").count() == 2
    assert T.merge_upsert(spark, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "t_merge", ["k"]) == "upserted"
    assert sorted(tuple(r) for r in spark.table("t_merge").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    # replace a table from a plan that reads it
    T.replace(spark, spark.table("t_merge").filter("k > 1"), "t_merge")
    assert spark.table("t_merge").count() == 2


# --- dims and serving --------------------------------------------------------------------


def test_calendar_attributes(spark):
    cal = D.calendar(spark, "2019-01-01", "2035-12-31")
    assert cal.count() == 6209
    r = cal.filter("calendar_date = DATE'2021-01-03'").first()
    assert (r["date_key"], r["day_of_week"], r["day_name"], r["is_weekend"], r["week_of_year"]) == (20210103, 7, "Sunday", True, 53)


def test_two_holidays_on_one_date_sorted_and_joined(spark):
    cal = D.calendar(spark, "2024-12-24", "2024-12-26")
    hol = spark.createDataFrame([(dt.date(2024, 12, 25), "Z day"), (dt.date(2024, 12, 25), "Christmas Day"),
                                 (dt.date(2024, 12, 25), "Z day")], "holiday_date date, holiday_name string")
    got = {r["calendar_date"]: (r["is_bank_holiday"], r["holiday_name"]) for r in D.enrich_with_holidays(cal, hol).collect()}
    assert got[dt.date(2024, 12, 25)] == (True, "Christmas Day | Z day")
    assert got[dt.date(2024, 12, 24)] == (False, None)


def test_name_resolution(spark):
    names = spark.createDataFrame([("Bank",), ("Angel",), ("Nowhere",)], "name string")
    cand = spark.createDataFrame([("Bank", "940B"), ("Bank", "940C"), ("Angel", "940A")], "name string, id string")
    got = {r["name"]: (r["status"], r["resolved_id"]) for r in D.resolve_names(names, cand, "name", "id").collect()}
    assert got == {"Bank": ("ambiguous", None), "Angel": ("resolved", "940A"), "Nowhere": ("missing", None)}
    with pytest.raises(ValueError):
        D.gate_resolution(D.resolve_names(names, cand, "name", "id"))


def test_latest_state_two_statuses_and_never_observed(spark):
    rows = [("L1", TS(2024, 8, 1, 8), 10, "Good Service", None, "r1"),
            ("L1", TS(2024, 8, 1, 9), 10, "Good Service", None, "r2"),
            ("L1", TS(2024, 8, 1, 9), 6, "Severe Delays", "Signal failure.", "r2"),
            ("L2", TS(2024, 8, 1, 9), 20, "Odd", None, "r2")]
    facts = spark.createDataFrame(rows, "line_id string, snapshot_at timestamp, sev int, d string, reason string, req string")
    state = S.latest_state(facts, "line_id", "snapshot_at", "sev", "d", "reason", L.is_disrupted("sev"), "req")
    members = spark.createDataFrame([("L1",), ("L2",), ("L3",)], "line_id string")
    got = {r["line_id"]: r for r in S.current_state_for_members(members, state, "line_id").collect()}
    l1 = got["L1"]
    assert (l1["status_severity"], l1["status_description"], l1["is_disrupted"], l1["status_record_count"]) == (
        6, "Good Service | Severe Delays", True, 2)
    assert l1["status_reason"] == "Signal failure." and l1["status_snapshot_at_local"] == TS(2024, 8, 1, 10)
    assert got["L2"]["is_disrupted"] and got["L2"]["status_severity"] == 20
    assert got["L3"]["status_severity"] is None and got["L3"]["is_disrupted"] is None


def test_combine_daily_zero_fills_counts_only(spark):
    cal = D.calendar(spark, "2024-01-01", "2024-01-03").withColumn("is_bank_holiday", F.lit(False)).withColumn(
        "holiday_name", F.lit(None).cast("string"))
    line = spark.createDataFrame([(20240101, 4, 1.5)], "date_key int, line_snapshots long, rate double")
    wx = spark.createDataFrame([(20240102, 3, 7.0)], "date_key int, weather_observations long, temp double")
    out = {r["date_key"]: r for r in S.combine_daily([line, wx], cal, ["date_key", "calendar_date"],
                                                      ["line_snapshots", "weather_observations"]).collect()}
    assert set(out) == {20240101, 20240102}
    assert out[20240102]["line_snapshots"] == 0 and out[20240102]["rate"] is None
    assert out[20240101]["weather_observations"] == 0 and out[20240101]["temp"] is None


# --- audit ---------------------------------------------------------------------------------


def test_audit_checks_find_planted_problems(spark):
    dim = spark.createDataFrame(
        [("a", "v1", TS(2024, 1, 1), TS(2024, 1, 5), False), ("a", "v2", TS(2024, 1, 4), None, True),
         ("b", "v3", TS(2024, 1, 1), None, True), ("b", "v4", TS(2024, 1, 2), None, True),
         ("c", "v5", TS(2024, 1, 3), TS(2024, 1, 2), True)],
        "id string, version_key string, effective_from timestamp, effective_to timestamp, is_current boolean",
    )
    child = spark.createDataFrame([("a",), ("z",), (None,)], "id string")
    res = A.suite([
        A.not_one_current("one_current", dim, ["id"]),
        A.overlapping_versions("overlap", dim, ["id"]),
        A.inverted_dates("inverted", dim),
        A.current_with_end("current_end", dim),
        A.orphans("orphans", child, dim, ["id"]),
        A.duplicate_keys("dups", dim, ["id"]),
        A.reconcile("reconcile", child, dim),
        A.non_empty("non_empty", dim),
        A.row_count("rows", dim),
    ])
    got = {r["check_name"]: (r["status"], r["actual_value"]) for r in res.collect()}
    assert got["one_current"] == ("FAIL", 1)  # b has two current rows; a and c have one
    assert got["overlap"] == ("FAIL", 2)  # a: v2 starts before v1 ends; b: previous open
    assert got["inverted"] == ("FAIL", 1) and got["current_end"] == ("FAIL", 1)
    assert got["orphans"] == ("FAIL", 1) and got["dups"] == ("FAIL", 2)
    assert got["reconcile"] == ("FAIL", 3) and got["non_empty"] == ("PASS", 1) and got["rows"] == ("INFO", 5)
    stored = []
    with pytest.raises(A.AuditFailed):
        A.persist_then_gate(res, stored.append)
    assert stored and stored[0].count() == 9


def test_bridge_pairs_restrict_to_current_members(spark):
    rel = spark.createDataFrame([("S1", "L1"), ("S1", "L1"), ("S1", "BUS9"), ("S2", "L1"), (None, "L1")], "sid string, lid string")
    st = spark.createDataFrame([("S1", "ks1"), ("S2", "ks2")], "sid string, skey string")
    ln = spark.createDataFrame([("L1", "kl1")], "lid string, lkey string")
    out = D.bridge_pairs(rel, st, ln, "sid", "lid", "skey", "lkey")
    assert sorted((r["sid"], r["lid"]) for r in out.collect()) == [("S1", "L1"), ("S2", "L1")]


def test_rows_via_row_objects(spark):
    # createDataFrame from Row objects keeps names (sanity for fixtures)
    df = spark.createDataFrame([Row(a=1)])
    assert df.columns == ["a"]


def test_namespaces_inventory_and_load_log(spark):
    T.ensure_database(spark, "meta_t")
    spark.sql("DROP TABLE IF EXISTS meta_t.load_log")
    T.log_load(spark, "meta_t.load_log", "silver.line_status", "merged", 12)
    T.log_load(spark, "meta_t.load_log", "silver.line_status", "merged", 0)
    assert "load_log" in T.list_tables(spark, "meta_t")
    rows = spark.table("meta_t.load_log").orderBy("rows_written").collect()
    assert [r["rows_written"] for r in rows] == [0, 12] and rows[0]["logged_at"] is not None


def test_audit_history_latest_run_failures(spark):
    hist = spark.createDataFrame(
        [("run1", "a", "FAIL", TS(2024, 1, 1)), ("run2", "a", "PASS", TS(2024, 1, 2)), ("run2", "b", "FAIL", TS(2024, 1, 2))],
        "validation_run_id string, check_name string, status string, checked_at timestamp")
    assert [r["check_name"] for r in A.latest_run_failures(hist).collect()] == ["b"]
    summary = {(r["validation_run_id"], r["status"]): r["checks"] for r in A.run_summary(hist).collect()}
    assert summary == {("run1", "FAIL"): 1, ("run2", "PASS"): 1, ("run2", "FAIL"): 1}


def test_partitioned_insert_only_and_layout(spark):
    spark.sql("DROP TABLE IF EXISTS t_part")
    src = spark.createDataFrame([("r1", dt.date(2024, 1, 1), TS(2024, 1, 1, 9)), ("r2", dt.date(2024, 1, 2), TS(2024, 1, 2, 9))],
                                "request_id string, ingestion_date date, snapshot_at timestamp")
    keys = ["request_id", "ingestion_date"]
    assert T.merge_insert_only(spark, src, "t_part", keys, partition_by=["ingestion_date"], sort_by=["snapshot_at"]) == "created"
    more = spark.createDataFrame([("r2", dt.date(2024, 1, 2), TS(2024, 1, 2, 9)), ("r3", dt.date(2024, 1, 3), TS(2024, 1, 3, 9))],
                                 "request_id string, ingestion_date date, snapshot_at timestamp")
    assert T.merge_insert_only(spark, more, "t_part", keys, partition_by=["ingestion_date"], sort_by=["snapshot_at"]) == "merged"
    assert sorted(r["request_id"] for r in spark.table("t_part").collect()) == ["r1", "r2", "r3"]
    assert "ingestion_date" in [c.name for c in spark.catalog.listColumns("t_part") if c.isPartition]


def test_shared_names_box_exists_and_calendar_rules(spark):
    from snapstar.plans import transit as TR
    dim = spark.createDataFrame([("Bank", "S1", 51.5, -0.1), ("Bank", "S2", 51.5, -0.1), ("Angel", "S3", 91.0, 0.0),
                                 ("Nil", "S4", None, None)], "name string, id string, lat double, lon double")
    shared = D.shared_names(dim, "name", "id").collect()
    assert [(r["name"], r["ids"], r["id_list"]) for r in shared] == [("Bank", 2, ["S1", "S2"])]
    assert sorted(r["id"] for r in D.outside_box(dim, "lat", "lon", (51.2, 51.8), (-0.6, 0.4)).collect()) == ["S3", "S4"]
    spark.sql("DROP TABLE IF EXISTS t_exists")
    spark.range(1).write.saveAsTable("t_exists")
    res = {r["check_name"]: r["status"] for r in A.suite([A.table_exists(spark, "a", "t_exists"), A.table_exists(spark, "b", "t_missing")]).collect()}
    assert res == {"a": "PASS", "b": "FAIL"}
    cal = D.calendar(spark, "2024-01-01", "2024-12-31")
    assert Q.split(cal, TR.dim_date_rules())[1].count() == 0
    bad = cal.withColumn("is_weekend", F.lit(False))
    assert Q.split(bad, TR.dim_date_rules())[1].count() == 104

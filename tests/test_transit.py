"""Golden pipeline over small JSON payload fixtures: landing -> bronze ->
silver -> dimensions -> facts -> serving, plus the stream form of the load."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from snapstar.operators import quality as Q
from snapstar.operators.scd2 import apply_changes, initial_versions
from snapstar.plans import dims as D
from snapstar.plans import transit as TR
from snapstar.sources import flatten as FL
from snapstar.sources.landing import BRONZE_SCHEMA, landing_path, read_landing
from snapstar.streaming.merge import stream_bronze_to_silver, stream_landing_to_bronze

TS = dt.datetime


def _bronze(spark, rows):
    """rows: (request_id, dataset, endpoint, ingested_at, payload)."""
    data = [(r, "tfl" if ds != "weather" else "open_meteo", ds, ep, ts, ts.date(), 200, p) for r, ds, ep, ts, p in rows]
    return spark.createDataFrame(data, BRONZE_SCHEMA)


def _line_payload(lines):
    return json.dumps([
        {"id": lid, "name": name, "modeName": "tube",
         "lineStatuses": [{"id": sid, "statusSeverity": sev, "statusSeverityDescription": d, "reason": rsn,
                           "created": "2024-08-23T20:00:00Z"} for sid, sev, d, rsn in statuses]}
        for lid, name, statuses in lines
    ])


def test_line_status_flatten_keeps_lines_without_statuses(spark):
    payload = json.dumps([{"id": "victoria", "name": "Victoria", "modeName": "tube", "lineStatuses": []},
                          {"id": "bakerloo", "name": "Bakerloo", "modeName": "tube"}])
    out = FL.line_status(_bronze(spark, [("r1", "line_status", "/Line/Mode/tube/Status", TS(2024, 8, 23, 21), payload)]))
    rows = out.collect()
    assert len(rows) == 2 and all(r["status_severity"] is None for r in rows)
    valid, invalid = Q.split(out, TR.line_status_rules())
    assert valid.count() == 0 and invalid.count() == 2


def test_arrivals_empty_list_and_malformed_give_no_rows(spark):
    b = _bronze(spark, [
        ("r1", "arrivals", "/StopPoint/940GZZLUKSX/Arrivals", TS(2024, 8, 23, 21), "[]"),
        ("r2", "arrivals", "/StopPoint/940GZZLUKSX/Arrivals", TS(2024, 8, 23, 21), "{oops"),
    ])
    assert FL.arrivals(b).count() == 0
    from snapstar.functions import json as J
    checks = {r["request_id"]: r["ok"] for r in b.select("request_id", J.array_contract("payload", ["id"], allow_empty=True).alias("ok")).collect()}
    assert checks == {"r1": True, "r2": False}


def test_weather_and_holidays(spark):
    weather = json.dumps({"latitude": 51.5, "longitude": -0.12, "utc_offset_seconds": 3600, "timezone": "Europe/London",
                          "current": {"time": "2024-08-24T00:15", "interval": 900, "temperature_2m": 17.5,
                                      "relative_humidity_2m": 80, "precipitation": 0.0, "rain": None,
                                      "weather_code": 61, "cloud_cover": 90, "wind_speed_10m": 10.0,
                                      "wind_gusts_10m": 20.0}})
    w = FL.weather(_bronze(spark, [("w1", "weather", "/forecast?x", TS(2024, 8, 23, 23, 20), weather)])).first()
    assert w["weather_observed_at"] == TS(2024, 8, 23, 23, 15) and w["weather_description"] == "Rain"
    hol = json.dumps({"england-and-wales": {"division": "england-and-wales", "events": [
        {"title": "Christmas Day", "date": "2024-12-25", "notes": "", "bunting": True},
        {"title": "Bad", "date": "2024-13-45", "notes": "", "bunting": False}]}})
    h = FL.bank_holidays(_bronze(spark, [("h1", "bank_holidays", "/bank-holidays.json", TS(2024, 8, 1), hol)]))
    rows = {r["holiday_name"]: r["holiday_date"] for r in h.collect()}
    assert rows == {"Christmas Day": dt.date(2024, 12, 25), "Bad": None}
    valid, invalid = Q.split(h, TR.holiday_rules())
    assert valid.count() == 1 and invalid.count() == 1


def test_stop_points_station_pick_and_lines(spark):
    sp = json.dumps({"stopPoints": [
        {"id": "940GZZLUKSX", "stationNaptan": "940GZZLUKSX", "commonName": "King's Cross", "stopType": "NaptanMetroStation",
         "lat": 51.53, "lon": -0.12, "modes": ["tube", "bus"], "lines": [{"id": "victoria", "name": "Victoria"}, {"id": "73", "name": "73"}]},
        {"id": "9400ZZLUKSX1", "stationNaptan": "940GZZLUKSX", "commonName": "King's Cross Platform", "stopType": "x",
         "lat": 51.53, "lon": -0.12, "modes": ["tube"], "lines": [{"id": "victoria", "name": "Victoria"}]},
        {"id": "B2", "stationNaptan": "940GZZLUBNK", "commonName": "Bank B2", "stopType": "x", "lat": 51.51, "lon": -0.09,
         "modes": ["bus", "tube"], "lines": []},
        {"id": "B1", "stationNaptan": "940GZZLUBNK", "commonName": "Bank B1", "stopType": "x", "lat": 51.51, "lon": -0.09,
         "modes": ["tube", "bus"], "lines": []},
    ]})
    parsed = FL.parse_stop_points(_bronze(spark, [("s1", "stop_points", "/StopPoint/Mode/tube", TS(2024, 8, 1), sp)]))
    stops = FL.stop_points(parsed)
    src = {r["station_id"]: r for r in TR.prepare_station_source(stops).collect()}
    assert src["940GZZLUKSX"]["representative_stop_point_id"] == "940GZZLUKSX"
    assert src["940GZZLUBNK"]["representative_stop_point_id"] == "B1"
    assert src["940GZZLUBNK"]["modes"] == ["bus", "tube"]
    lines = FL.stop_point_lines(parsed)
    assert lines.count() == 3  # null lines dropped, pairs kept per stop point


@pytest.fixture(scope="module")
def model(spark):
    """Two line-status polls (Piccadilly renamed in between), arrivals and a
    calendar; returns the built tables."""
    p1 = _line_payload([("piccadilly", "Piccadilly", [(0, 10, "Good Service", None)]),
                        ("district", "District", [(None, 6, "Severe Delays", "DISTRICT LINE: Signal failure. Expect delays.")])])
    p2 = _line_payload([("piccadilly", "Piccadilly Line", [(0, 10, "Good Service", None), (1, 6, "Severe Delays", "x")]),
                        ("district", "District", [(None, 20, "Odd", None)])])
    bronze = _bronze(spark, [("r1", "line_status", "/Line/Mode/tube/Status", TS(2024, 8, 23, 21), p1),
                             ("r2", "line_status", "/Line/Mode/tube/Status", TS(2024, 8, 23, 23, 30), p2)])
    silver = Q.gate(FL.line_status(bronze), TR.line_status_rules())
    s1 = TR.prepare_line_source(silver.filter(F.col("snapshot_at") <= F.lit(TS(2024, 8, 23, 21))))
    dim = initial_versions(s1, ["line_id"], TR.LINE_ATTRS)
    s2 = TR.prepare_line_source(silver)
    dim = apply_changes(dim, s2, ["line_id"], TR.LINE_ATTRS, "snapshot_at").withColumn(
        "line_key", F.col("version_key")).checkpoint()
    cal = D.enrich_with_holidays(D.calendar(spark, "2024-01-01", "2024-12-31"),
                                 spark.createDataFrame([], "holiday_date date, holiday_name string"))
    return {"silver": silver, "dim_line": dim, "dim_date": cal}


@pytest.mark.parametrize("strategy", ["broadcast", "sorted"])
def test_fact_line_status_versions_and_dates(spark, model, strategy):
    fact = TR.build_fact_line_status(model["silver"], model["dim_line"], model["dim_date"], strategy=strategy)
    rows = fact.collect()
    assert len(rows) == model["silver"].count()  # row preservation
    pic = {r["snapshot_at"]: r for r in rows if r["line_id"] == "piccadilly"}
    dim = {r["version_key"]: r["line_name"] for r in model["dim_line"].collect()}
    assert dim[pic[TS(2024, 8, 23, 21)]["line_key"]] == "Piccadilly"
    assert dim[pic[TS(2024, 8, 23, 23, 30)]["line_key"]] == "Piccadilly Line"
    assert pic[TS(2024, 8, 23, 23, 30)]["snapshot_date_key"] == 20240824  # 23:30Z in August is the next London day
    district = [r for r in rows if r["line_id"] == "district"]
    assert len({r["line_status_key"] for r in district}) == 2  # null status id in two requests -> two keys
    assert all(r["is_disrupted"] for r in district)  # severity 6 and 20


def test_current_status_and_daily_kpis(spark, model):
    fact = TR.build_fact_line_status(model["silver"], model["dim_line"], model["dim_date"])
    cur = {r["line_id"]: r for r in TR.build_current_line_status(fact, model["dim_line"]).collect()}
    assert set(cur) == {"piccadilly", "district"}
    p = cur["piccadilly"]
    assert (p["line_name"], p["status_severity"], p["status_description"], p["is_disrupted"], p["status_record_count"]) == (
        "Piccadilly Line", 6, "Good Service | Severe Delays", True, 2)
    assert cur["district"]["status_severity"] == 20 and cur["district"]["is_disrupted"]
    empty_arr = spark.createDataFrame([], "prediction_date_key int, vehicle_id string, station_key string, time_to_station_seconds int")
    empty_wx = spark.createDataFrame([], "observation_date_key int, temperature_c double, relative_humidity_pct int, precipitation_mm double, wind_gusts_kmh double")
    k = {r["date_key"]: r for r in TR.build_daily_network_kpis(fact, empty_arr, empty_wx, model["dim_date"]).collect()}
    assert k[20240823]["line_snapshots"] == 2 and k[20240823]["disrupted_line_snapshots"] == 1
    assert k[20240823]["disruption_rate_pct"] == 50.0
    assert k[20240824]["arrival_observations"] == 0 and k[20240824]["avg_eta_seconds"] is None
    assert Q.split(TR.build_daily_network_kpis(fact, empty_arr, empty_wx, model["dim_date"]), TR.daily_kpi_rules())[1].count() == 0


def _write_landing(base, items):
    for source, dataset, ts, rid, payload in items:
        path = landing_path(base, source, dataset, ts, rid)
        import os
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(payload)


def test_landing_batch_equals_stream(spark, tmp_path):
    base = str(tmp_path / "landing")
    _write_landing(base, [
        ("tfl", "arrivals", TS(2024, 8, 23, 21), "req-1", "[]"),
        ("tfl", "line_status", TS(2024, 8, 23, 21), "req-2", _line_payload([("victoria", "Victoria", [(0, 10, "Good Service", None)])])),
    ])
    batch = read_landing(spark, base)
    got = {r["request_id"]: (r["source"], r["dataset"]) for r in batch.collect()}
    assert got == {"req-1": ("tfl", "arrivals"), "req-2": ("tfl", "line_status")}
    target, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    stream_landing_to_bronze(spark, base, target, ckpt)
    _write_landing(base, [("tfl", "arrivals", TS(2024, 8, 23, 22), "req-3", "[]")])
    stream_landing_to_bronze(spark, base, target, ckpt)
    stream_landing_to_bronze(spark, base, target, ckpt)  # rerun: nothing new
    streamed = spark.read.parquet(target).select(*batch.columns)
    assert sorted(r["request_id"] for r in streamed.collect()) == ["req-1", "req-2", "req-3"]
    cols = ["request_id", "source", "dataset", "payload"]
    assert read_landing(spark, base).select(*cols).exceptAll(streamed.select(*cols)).count() == 0


def test_landed_arrivals_keep_their_station_and_replays_add_nothing(spark, tmp_path):
    from snapstar.sources.landing import envelope
    at = TS(2024, 8, 23, 21, 5)
    payload = json.dumps([{"id": "x1", "vehicleId": "v", "stationName": "Alpha", "lineId": "L1", "timestamp": "2024-08-23T21:05:00Z",
                           "timeToStation": 60, "expectedArrival": "2024-08-23T21:06:00Z"}, {"id": "x2", "stationName": "Alpha"}])
    base, target, bad, bronze = (str(tmp_path / n) for n in ("landing", "silver", "bad", "bronze"))
    _write_landing(base, [("tfl", "arrivals", at, "req-1", envelope(payload, "/StopPoint/S1/Arrivals", 200, at))])
    row = read_landing(spark, base).first()
    assert (row["source_endpoint"], row["http_status"], row["ingested_at"], row["payload"]) == ("/StopPoint/S1/Arrivals", 200, at, payload)
    stream_landing_to_bronze(spark, base, bronze, str(tmp_path / "c1"))
    # The same request lands again under another day: the request id is known.
    later = at + dt.timedelta(days=1)
    _write_landing(base, [("tfl", "arrivals", later, "req-1", envelope(payload, "/StopPoint/S1/Arrivals", 200, later))])
    stream_landing_to_bronze(spark, base, bronze, str(tmp_path / "c1"))
    assert spark.read.parquet(bronze).count() == 1
    for checkpoint in ("c2", "c3"):  # the second start replays all of bronze
        stream_bronze_to_silver(spark, bronze, lambda b: TR.with_arrival_key(FL.arrivals(b)), TR.arrival_rules, ["arrival_observation_key"], target, bad, str(tmp_path / checkpoint))
    good = spark.read.parquet(target).collect()
    assert [(r["requested_stop_point_id"], r["arrival_id"]) for r in good] == [("S1", "x1")]
    assert spark.read.parquet(bad).count() == 1


def test_weather_without_measures_is_invalid(spark):
    bare = json.dumps({"latitude": 51.5, "longitude": -0.1, "timezone": "Europe/London", "current": {"time": "2024-08-24T00:15"}})
    rows = FL.weather(_bronze(spark, [("r1", "weather", "/v1/forecast", TS(2024, 8, 23, 21), bare)]))
    assert Q.split(rows, TR.weather_rules())[0].count() == 0


def test_bronze_to_silver_stream_equals_batch(spark, tmp_path):
    p1 = _line_payload([("victoria", "Victoria", [(0, 10, "Good Service", None)]),
                        ("central", "Central", [(None, 6, "Severe Delays", "x")])])
    p2 = _line_payload([("victoria", "Victoria", [(0, 9, "Minor Delays", "y")]), ("empty", "Empty", [])])
    b1 = _bronze(spark, [("r1", "line_status", "/Line/Mode/tube/Status", TS(2024, 8, 23, 21), p1)])
    b2 = _bronze(spark, [("r2", "line_status", "/Line/Mode/tube/Status", TS(2024, 8, 23, 22), p2)])
    bronze, silver, bad, ckpt = (str(tmp_path / n) for n in ("bronze", "silver", "bad", "ckpt"))
    keys = ["request_id", "line_id", "status_id"]
    b1.write.mode("append").parquet(bronze)
    stream_bronze_to_silver(spark, bronze, FL.line_status, TR.line_status_rules, keys, silver, bad, ckpt, null_safe=["status_id"])
    b2.write.mode("append").parquet(bronze)
    stream_bronze_to_silver(spark, bronze, FL.line_status, TR.line_status_rules, keys, silver, bad, ckpt, null_safe=["status_id"])
    stream_bronze_to_silver(spark, bronze, FL.line_status, TR.line_status_rules, keys, silver, bad, ckpt, null_safe=["status_id"])
    batch_valid, batch_invalid = Q.split(FL.line_status(b1.unionByName(b2)), TR.line_status_rules())
    got = spark.read.parquet(silver).select(*batch_valid.columns)  # partition column is read back last
    assert got.count() == 3 and got.exceptAll(batch_valid).count() == 0 and batch_valid.exceptAll(got).count() == 0
    assert spark.read.parquet(bad).count() == batch_invalid.count() == 1


def test_source_contracts(spark):
    good_ls = _line_payload([("victoria", "Victoria", [(0, 10, "Good Service", None)])])
    good_sp = json.dumps({"stopPoints": [{"id": "S1"}]})
    good_wx = json.dumps({"latitude": 1, "longitude": 2, "timezone": "Europe/London",
                          "current": {v: 1 for v in TR.WEATHER_CURRENT}})
    good_hol = json.dumps({"england-and-wales": {"division": "x", "events": [{"title": "t", "date": "2024-01-01"}]}})
    cases = [
        (TR.line_status_contract, good_ls, True), (TR.line_status_contract, "[]", False),
        (TR.line_status_contract, json.dumps([{"id": "a", "name": "b", "modeName": "tube"}]), False),
        (TR.stop_points_contract, good_sp, True), (TR.stop_points_contract, json.dumps({"stopPoints": []}), False),
        (TR.stop_points_contract, "[]", False),
        (TR.arrivals_contract, "[]", True), (TR.arrivals_contract, "{oops", False),
        (TR.weather_contract, good_wx, True),
        (TR.weather_contract, json.dumps({"latitude": 1, "longitude": 2, "timezone": "x", "current": {"time": "t"}}), False),
        (TR.holidays_contract, good_hol, True),
        (TR.holidays_contract, json.dumps({"england-and-wales": {"events": [{"title": "t"}]}}), False),
        (TR.holidays_contract, json.dumps({"scotland": {"events": []}}), False),
    ]
    for i, (contract, payload, ok) in enumerate(cases):
        b = _bronze(spark, [(f"r{i}", "x", "/x", TS(2024, 1, 1), payload)])
        valid, invalid = Q.split(b, contract())
        assert (valid.count() == 1) == ok, (contract.__name__, payload)
    bad_status = _bronze(spark, [("r", "x", "/x", TS(2024, 1, 1), "[]")]).withColumn("http_status", F.lit(500))
    assert Q.split(bad_status, TR.arrivals_contract())[0].count() == 0


def test_short_station_name(spark):
    df = spark.createDataFrame([("King's Cross St. Pancras Underground Station",), ("Bank Underground",), ("Stratford",)], "n string")
    assert [r[0] for r in df.select(TR.short_station_name("n")).collect()] == ["King's Cross St. Pancras", "Bank", "Stratford"]

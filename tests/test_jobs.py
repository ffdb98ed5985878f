"""All stages end to end over payload fixtures (two polls), then the gold
audit: every check passes, and the stage gates fire on bad input."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from snapstar.operators import quality as Q
from snapstar.plans import bronze as B
from snapstar.plans import jobs as J
from snapstar.sources import flatten as FL
from snapstar.sources import versions as V
from snapstar.sources.landing import BRONZE_SCHEMA

TS = dt.datetime


def _b(spark, rows):
    return spark.createDataFrame(
        [(r, src, ds, ep, ts, ts.date(), 200, p) for r, src, ds, ep, ts, p in rows], BRONZE_SCHEMA)


def _lines(names):
    return json.dumps([{"id": i, "name": n, "modeName": "tube",
                        "lineStatuses": [{"id": 0, "statusSeverity": sev, "statusSeverityDescription": d,
                                          "reason": None, "created": "2024-08-23T20:00:00Z"}]}
                       for i, n, sev, d in names])


STOPS = json.dumps({"stopPoints": [
    {"id": "S1", "stationNaptan": "S1", "commonName": "Alpha", "stopType": "x", "lat": 51.5, "lon": -0.1,
     "modes": ["tube"], "lines": [{"id": "L1", "name": "One"}, {"id": "L2", "name": "Two"}]},
    {"id": "S2a", "stationNaptan": "S2", "commonName": "Beta", "stopType": "x", "lat": 51.6, "lon": -0.2,
     "modes": ["tube"], "lines": [{"id": "L2", "name": "Two"}, {"id": "99", "name": "Bus"}]},
]})


def _arrivals(station, items):
    return json.dumps([{"id": aid, "vehicleId": v, "naptanId": station, "stationName": "x", "lineId": line,
                        "lineName": line, "timestamp": ts, "timeToStation": eta, "expectedArrival": exp,
                        "timeToLive": exp} for aid, v, line, ts, eta, exp in items])


WEATHER = json.dumps({"latitude": 51.5, "longitude": -0.1, "utc_offset_seconds": 3600, "timezone": "Europe/London",
                      "current": {"time": "2024-08-23T22:00", "interval": 900, "temperature_2m": 18.0,
                                  "relative_humidity_2m": 70, "precipitation": 0.2, "rain": 0.2, "weather_code": 61,
                                  "cloud_cover": 80, "wind_speed_10m": 9.0, "wind_gusts_10m": 21.0}})
HOLIDAYS = json.dumps({"england-and-wales": {"division": "england-and-wales", "events": [
    {"title": "Summer bank holiday", "date": "2024-08-26", "notes": "", "bunting": True}]}})


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    t1, t2 = TS(2024, 8, 23, 20), TS(2024, 8, 23, 21, 30)
    ls_bronze = _b(spark, [
        ("l1", "tfl", "line_status", "/Line/Mode/tube/Status", t1, _lines([("L1", "One", 10, "Good Service"), ("L2", "Two", 6, "Severe Delays")])),
        ("l2", "tfl", "line_status", "/Line/Mode/tube/Status", t2, _lines([("L1", "One Renamed", 10, "Good Service"), ("L2", "Two", 10, "Good Service")])),
    ])
    sp_bronze = _b(spark, [("s1", "tfl", "stop_points", "/StopPoint/Mode/tube", t1, STOPS)])
    arr_bronze = _b(spark, [
        ("a1", "tfl", "arrivals", "/StopPoint/S1/Arrivals", t2, _arrivals("S1", [
            ("x1", "v1", "L1", "2024-08-23T21:30:00Z", 120, "2024-08-23T21:32:00Z"),
            ("x2", "v2", "L2", "2024-08-23T21:30:00Z", 300, "2024-08-23T21:35:00Z")])),
        ("a2", "tfl", "arrivals", "/StopPoint/S2/Arrivals", t2, "[]"),
        ("a3", "tfl", "arrivals", "/StopPoint/S2/Arrivals", t2, _arrivals("S2", [
            ("x3", "v3", "L2", "2024-08-23T21:31:00Z", -5, "2024-08-23T21:31:00Z")])),
    ])
    wx_bronze = _b(spark, [("w1", "open_meteo", "weather", "/forecast", t2, WEATHER),
                           ("w2", "open_meteo", "weather", "/forecast", t2 + dt.timedelta(minutes=5), WEATHER)])
    hol_bronze = _b(spark, [("h1", "gov_uk", "bank_holidays", "/bank-holidays.json", t1, HOLIDAYS)])

    # Through the bronze stages, twice: the replay adds nothing.
    base = f"file://{tmp_path_factory.mktemp('bronze')}"
    stations = spark.createDataFrame([("Alpha",), ("Beta",)], "station_name string")
    points = FL.stop_points(FL.parse_stop_points(sp_bronze)).select(F.col("common_name").alias("station_name"), F.col("station_naptan").alias("station_id"))
    asked = B.arrival_requests(stations, points)
    batches = {"line_status": (B.bronze_line_status, ls_bronze, None), "stop_points": (B.bronze_stop_points, sp_bronze, None), "arrivals": (B.bronze_arrivals, arr_bronze, asked),
               "weather": (B.bronze_weather, wx_bronze, None), "bank_holidays": (B.bronze_holidays, hol_bronze, None)}
    for run, batch, requests in batches.values():
        first, again = [run(spark, batch, base, requests) for _ in range(2)]
        assert (first.committed, first.quarantined, again.committed, again.replayed) == (batch.count(), 0, 0, batch.count())
    ls_bronze, sp_bronze, arr_bronze, wx_bronze, hol_bronze = [V.read(spark, f"{base}/{name}") for name in batches]

    s_ls = J.silver_line_status(ls_bronze)
    s_arr, s_arr_bad = J.silver_arrivals(arr_bronze)
    stops, stop_lines = J.silver_stop_points(sp_bronze)
    s_wx = J.silver_weather(wx_bronze)
    s_hol = J.silver_holidays(hol_bronze)
    dd = J.dim_date(spark, "2024-01-01", "2024-12-31", s_hol)
    dl1 = J.dim_line(s_ls.filter(F.col("snapshot_at") <= F.lit(t1)))
    dl = J.dim_line(s_ls, current=dl1)
    ds = J.dim_station(stops)
    br = J.bridge(stop_lines, stops, ds, dl)
    f_ls = J.fact_line_status(s_ls, dl, dd)
    f_arr = J.fact_arrivals(s_arr, ds, dl, dd)
    f_wx = J.fact_weather(s_wx, dd)
    return dict(silver_line_status=s_ls, silver_arrivals=s_arr, arrivals_invalid=s_arr_bad, silver_weather=s_wx,
                dim_date=dd, dim_line=dl, dim_station=ds, bridge=br, fact_line_status=f_ls,
                fact_arrival_observation=f_arr, fact_weather=f_wx, stops=stops)


def test_silver_and_dimensions(gold):
    assert gold["silver_line_status"].count() == 4
    assert gold["silver_arrivals"].count() == 2 and gold["arrivals_invalid"].count() == 1  # negative ETA dropped
    assert gold["silver_weather"].count() == 1  # same observation twice -> newest request kept
    assert gold["silver_weather"].first()["request_id"] == "w2"
    dl = {(r["line_id"], r["line_name"]): r["is_current"] for r in gold["dim_line"].collect()}
    assert dl == {("L1", "One"): False, ("L1", "One Renamed"): True, ("L2", "Two"): True}
    assert gold["dim_date"].filter("is_bank_holiday").first()["holiday_name"] == "Summer bank holiday"
    pairs = sorted((r["station_id"], r["line_id"]) for r in gold["bridge"].collect())
    assert pairs == [("S1", "L1"), ("S1", "L2"), ("S2", "L2")]  # bus route 99 out of scope


def test_serving_and_audit(spark, gold):
    cur = {r["line_id"]: r for r in J.current_line_status(gold["fact_line_status"], gold["dim_line"]).collect()}
    assert cur["L1"]["line_name"] == "One Renamed" and cur["L2"]["is_good_service"]
    summ = J.station_arrival_summary(gold["fact_arrival_observation"], gold["dim_station"], gold["dim_line"]).collect()
    assert {(r["station_id"], r["line_id"], r["arrival_observations"]) for r in summ} == {("S1", "L1", 1), ("S1", "L2", 1)}
    kpis = J.daily_network_kpis(gold["fact_line_status"], gold["fact_arrival_observation"], gold["fact_weather"], gold["dim_date"])
    k = {r["date_key"]: r for r in kpis.collect()}
    assert k[20240823]["line_snapshots"] == 4 and k[20240823]["disrupted_line_snapshots"] == 1
    assert k[20240823]["arrival_observations"] == 2 and k[20240823]["weather_observations"] == 1
    tables = {n: gold[n] for n in ["dim_date", "dim_line", "dim_station", "fact_line_status", "fact_arrival_observation", "fact_weather",
                                   "silver_line_status", "silver_arrivals", "silver_weather"]}
    tables |= {"bridge_station_line": gold["bridge"], "daily_network_kpis": kpis,
               "current_line_status": J.current_line_status(gold["fact_line_status"], gold["dim_line"]),
               "station_arrival_summary": J.station_arrival_summary(gold["fact_arrival_observation"], gold["dim_station"], gold["dim_line"])}
    res = {r["check_name"]: r["status"] for r in J.gold_audit(tables, "run-1").collect()}
    assert len(res) == 53 and all(s == "PASS" for s in res.values()), {k: v for k, v in res.items() if v != "PASS"}
    assert {r["source_snapshot_at"] for r in gold["bridge"].collect()} == {TS(2024, 8, 23, 20)}


def test_absent_tables_fail_the_audit(gold):
    res = {r["check_name"]: (r["status"], r["details"]) for r in J.gold_audit({"dim_date": gold["dim_date"], "dim_line": gold["dim_line"]}, "run-2").collect()}
    assert len(res) == 53
    assert res["table_exists::dim_date"][0] == "PASS" and res["table_exists::fact_weather"] == ("FAIL", "found 0 expected 1")
    assert res["fact_weather_row_reconciliation"][0] == res["bridge_orphan_line_keys"][0] == "FAIL"


def test_gates_fire(spark, gold):
    bad = _b(spark, [("l9", "tfl", "line_status", "/x", TS(2024, 8, 24), json.dumps([{"id": "L1", "name": "One"}]))])
    with pytest.raises(Q.QualityGateError):
        J.silver_line_status(bad)
    only_l1 = gold["silver_line_status"].filter("line_id = 'L1'")
    with pytest.raises(J.StageError):  # L2 vanished from the newest snapshot
        J.dim_line(only_l1.withColumn("snapshot_at", F.lit(TS(2024, 8, 24)).cast("timestamp")), current=gold["dim_line"])


def test_summary_by_business_key_keeps_observations_of_older_versions(spark, gold):
    from snapstar.plans import transit as TR
    fact = gold["fact_arrival_observation"]
    # Pretend line L1 changed after the facts were built: its facts carry an
    # expired version key, the current version has a new key.
    dl = gold["dim_line"].withColumn("line_key", F.when(F.col("line_id") == "L1", F.concat(F.col("line_key"), F.lit("-new")))
                                     .otherwise(F.col("line_key")))
    default = {(r["station_id"], r["line_id"]) for r in TR.build_station_arrival_summary(fact, gold["dim_station"], dl).collect()}
    by_id = {(r["station_id"], r["line_id"]) for r in
             TR.build_station_arrival_summary(fact, gold["dim_station"], dl, by_business_key=True).collect()}
    assert default == {("S1", "L2")} and by_id == {("S1", "L1"), ("S1", "L2")}

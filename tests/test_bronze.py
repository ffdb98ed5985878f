"""Bronze stages: good responses are committed before anything fails."""

import datetime as dt
import json

import pytest

from snapstar.plans import bronze as B
from snapstar.sources import versions as V
from snapstar.sources.landing import BRONZE_SCHEMA, envelope, landing_path, read_landing

AT = dt.datetime(2024, 8, 23, 21, 30)


def responses(spark, rows, dataset="arrivals"):
    return spark.createDataFrame([(i, "tfl", dataset, ep, at, at.date(), status, p) for i, ep, at, status, p in rows], BRONZE_SCHEMA)


def requests(spark, *stations):
    return spark.createDataFrame([(f"/StopPoint/{s}/Arrivals",) for s in stations], "source_endpoint string")


def ids(spark, base):
    return sorted(r["request_id"] for r in V.read(spark, base).collect())


def test_arrivals_commit_the_good_then_fail(spark, tmp_path):
    base = f"file://{tmp_path}"
    batch = responses(spark, [
        ("a1", "/StopPoint/S1/Arrivals", AT, 200, "[]"), ("a2", "/StopPoint/S2/Arrivals", AT, 500, "[]"), ("a3", "/StopPoint/S3/Arrivals", AT, 200, "{oops"),
        ("a4", "/StopPoint/S3/Arrivals", AT, 200, '[{"id": "x"}]'), ("a5", "/StopPoint/S5/Arrivals", AT, 200, '{"not": "a list"}')])
    asked = requests(spark, "S1", "S2", "S3", "S4")
    for _ in range(2):
        with pytest.raises(B.IncompleteIngestion) as e:
            B.bronze_arrivals(spark, batch, base, asked)
        assert ids(spark, f"{base}/arrivals") == ["a1", "a4"] and ids(spark, f"{base}/arrivals_quarantine") == ["a2", "a3", "a5"]
    told = str(e.value)
    assert "a2 (http_status_200)" in told and "a3 (array_root)" in told and "/StopPoint/S4/Arrivals (unanswered)" in told and "/StopPoint/S2/Arrivals (failed)" in told
    assert "S3/Arrivals" not in told and "S1/Arrivals" not in told

    # The missing ones are asked again on another day: nothing is added twice.
    late = AT + dt.timedelta(days=1)
    more = batch.where("http_status = 200 AND request_id IN ('a1', 'a4')").unionByName(
        responses(spark, [("b2", "/StopPoint/S2/Arrivals", late, 200, "[]"), ("b4", "/StopPoint/S4/Arrivals", late, 200, "[]")]))
    done = B.bronze_arrivals(spark, more, base, asked)
    assert (done.committed, done.replayed, done.unanswered) == (2, 2, 0)
    assert ids(spark, f"{base}/arrivals") == ["a1", "a4", "b2", "b4"]
    log = V.history(spark, f"{base}/arrivals").orderBy("version").collect()
    assert [(r["operation"], r["rows_written"], r["total_rows"]) for r in log] == [("create", 2, 2), ("merge", 0, 2), ("merge", 2, 4)]


def test_a_commit_survives_what_follows(spark, tmp_path, monkeypatch):
    """A run that dies between bronze and quarantine, and is started again."""
    base = f"file://{tmp_path}"
    batch = responses(spark, [("w1", "/f", AT, 200, "[]"), ("w2", "/f", AT, 404, "[]")])
    merge, seen = V.merge_insert_only, []

    def dying(*a, **k):
        if seen:
            raise RuntimeError("died")
        seen.append(1)
        return merge(*a, **k)

    monkeypatch.setattr(V, "merge_insert_only", dying)
    with pytest.raises(RuntimeError, match="died"):
        B.bronze_arrivals(spark, batch, base, requests(spark), strict=False)
    monkeypatch.setattr(V, "merge_insert_only", merge)
    assert ids(spark, f"{base}/arrivals") == ["w1"]
    done = B.bronze_arrivals(spark, batch, base, requests(spark), strict=False)
    assert (done.committed, done.quarantined, done.replayed) == (0, 1, 1) and ids(spark, f"{base}/arrivals_quarantine") == ["w2"]


def test_landed_files_to_bronze(spark, tmp_path):
    for k, status in enumerate([200, 200, 503]):
        path = tmp_path / landing_path("landing", "tfl", "line_status", AT, f"r{k}")
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = json.dumps([{"id": "L1", "name": "One", "modeName": "tube", "lineStatuses": []}]) if k else "[]"
        path.write_text(envelope(lines, "/Line/Mode/tube/Status", status, AT))
    done = B.bronze_line_status(spark, read_landing(spark, f"file://{tmp_path}/landing"), f"file://{tmp_path}/bronze", strict=False)
    assert (done.responses, done.committed, done.quarantined) == (3, 1, 2)
    assert [f.split(" ")[0] for f in done.failures] == ["r0", "r2"]
    with pytest.raises(B.IncompleteIngestion):
        done.gate()


def test_station_names_must_resolve(spark):
    points = spark.createDataFrame([("Alpha", "S1"), ("Beta", "S2"), ("Beta", "S3")], "station_name string, station_id string")
    named = lambda *n: spark.createDataFrame([(x,) for x in n], "station_name string")
    assert [tuple(r) for r in B.arrival_requests(named("Alpha"), points).collect()] == [("Alpha", "S1", "/StopPoint/S1/Arrivals")]
    for bad in ("Beta", "Gamma"):
        with pytest.raises(ValueError, match=bad):
            B.arrival_requests(named("Alpha", bad), points)


def test_contracts_over_parsed_payloads(spark):
    """The rules say of a parsed payload what they say of its text, and what a plain
    parse says."""
    from pyspark.sql import functions as F

    from snapstar.functions import json as JS
    from snapstar.operators import quality as Q
    from snapstar.plans import transit as TR

    line = {k: None for k in TR.LINE_STATUS_FIELDS}
    payloads = [json.dumps(x) for x in (
        [line], [line, {"id": 1}], [], [{}], [1], [None], {"a": [line]}, None, "text", 3, {"stopPoints": [1]}, {"stopPoints": []}, {"stopPoints": None}, {"stopPoints": {"a": 1}},
        {**dict.fromkeys(TR.WEATHER_FIELDS), "current": dict.fromkeys(TR.WEATHER_CURRENT)}, {**dict.fromkeys(TR.WEATHER_FIELDS), "current": {"time": "x"}},
        dict.fromkeys(TR.WEATHER_FIELDS), {TR.HOLIDAY_REGION: {"events": [{"title": "a", "date": "b"}]}}, {TR.HOLIDAY_REGION: {"events": [{"title": "a"}]}},
        {TR.HOLIDAY_REGION: {"events": []}}, {TR.HOLIDAY_REGION: None}, {"wales": {"events": [{"title": "a", "date": "b"}]}})] + ["{oops", ""]

    def plain(text):
        try:
            x = json.loads(text)
        except ValueError:
            x = None
        has = lambda o, keys: isinstance(o, dict) and set(keys) <= set(o)
        every = lambda rows, keys: isinstance(rows, list) and bool(rows) and all(has(r, keys) for r in rows)
        get = lambda o, k: o.get(k) if isinstance(o, dict) else None
        return {"line_status": every(x, TR.LINE_STATUS_FIELDS), "stop_points": isinstance(get(x, "stopPoints"), list) and bool(x["stopPoints"]), "arrivals": isinstance(x, list),
                "weather": has(x, TR.WEATHER_FIELDS) and has(x["current"], TR.WEATHER_CURRENT), "holidays": every(get(get(x, TR.HOLIDAY_REGION), "events"), TR.HOLIDAY_EVENT_FIELDS)}

    batch = responses(spark, [(f"r{k:02d}", "/x", AT, 200, p) for k, p in enumerate(payloads)])
    for name in ("line_status", "stop_points", "arrivals", "weather", "holidays"):
        contract = getattr(TR, f"{name}_contract")
        want = [f"r{k:02d}" for k, p in enumerate(payloads) if plain(p)[name]]
        kept = lambda df, rules: sorted(r["request_id"] for r in Q.split(df, rules)[0].collect())
        assert kept(JS.with_body(batch), contract(F.col("body"))) == kept(batch, contract()) == want and want, name

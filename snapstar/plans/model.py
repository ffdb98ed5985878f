"""The transit model over payloads built from the driver tables.

Each source's JSON responses are made from driver rows (multi-element and empty
arrays, two levels, a few malformed and contract-breaking payloads), then go
through the library's own flatteners, contracts and rule sets.  An order's lines
are the elements of a response: a handful by the table's key.

Fixed values of the mapping: every 97th order's payload is malformed, every 31st
has HTTP status 500, every 89th arrivals response has another endpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.functions import json as JS
from snapstar.functions.labels import first_sentence, remaining_sentences
from snapstar.operators import quality as Q
from snapstar.operators.asof import as_of_join
from snapstar.operators.scd2 import version_history, versions_from_snapshots
from snapstar.plans import bronze as B
from snapstar.plans import transit as TR
from snapstar.plans.contracts import register as register_contracts
from snapstar.session import ensure_checkpoint_dir, stage
from snapstar.sources import flatten as FL
from snapstar.sources import versions as V

MALFORMED, SERVER_ERROR, OTHER_ENDPOINT = 97, 31, 89
#: Day names of a customer's number modulo seven; the first two are called a weekend.
DAY_NAMES = ["Saturday", "Monday", "Tuesday", "Wednesday", "Sunday", "Thursday", "Friday"]


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ntz(df: DataFrame) -> DataFrame:
    from snapstar.plans.catalog import finish

    return finish(df)


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) and not p.startswith("@") else F.col(p[1:]).cast("string") if isinstance(p, str) else p for p in parts])


def _iso(ts) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def _bronze(df: DataFrame, source: str, dataset: str, endpoint: Column, payload: Column) -> DataFrame:
    """Envelope columns from (key, at) and the payload."""
    broken = F.when(F.col("key") % MALFORMED == 0, F.lit("{oops")).otherwise(payload)
    at = F.col("at").cast("timestamp")
    return df.select(
        F.concat(F.lit(f"{dataset}-"), F.col("key").cast("string")).alias("request_id"), F.lit(source).alias("source"), F.lit(dataset).alias("dataset"),
        endpoint.alias("source_endpoint"), at.alias("ingested_at"), F.to_date(at).alias("ingestion_date"),
        F.when(F.col("key") % SERVER_ERROR == 0, 500).otherwise(200).alias("http_status"), broken.alias("payload"))


def _orders_with_lines(spark, sf, columns: list[str], element: Callable[[Column], Column]) -> DataFrame:
    """(key, at, o_custkey, elements): an order's lines as elements, an empty
    array for orders without lines.  The lines' columns are shuffled; elements,
    which are several times as long, are made of them behind it."""
    li = _t(spark, sf, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(*columns)).alias("lines"))
    od = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("at"), "o_custkey")
    joined = od.join(lines, od["key"] == lines["l_orderkey"], "left")
    empty = F.array().cast(lines.schema["lines"].dataType)
    return joined.select("key", "at", "o_custkey", F.transform(F.coalesce("lines", empty), element).alias("elements"))


def line_status_bronze(spark, sf) -> DataFrame:
    def line(of: Column) -> Column:
        part, supplier = of["l_partkey"], of["l_suppkey"].cast("string")
        severity = lambda j: ((part + j) % 12).cast("int")
        status = lambda j: F.struct(
            j.cast("int").alias("id"), severity(j).alias("statusSeverity"), F.concat(F.lit("S"), severity(j).cast("string")).alias("statusSeverityDescription"),
            F.when(severity(j) != 10, _text("R", part.cast("string"))).alias("reason"),
            F.when(part % 50 == 0, F.lit("no time")).otherwise(_iso(of["l_shipdate"])).alias("created"))
        n = (of["l_linenumber"] % 3).cast("int")
        statuses = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), status)).otherwise(
            F.filter(F.transform(F.array(F.lit(0)), status), lambda _: F.lit(False)))
        return F.struct(_text("L", supplier).alias("id"), _text("Line ", supplier).alias("name"), F.lit("tube").alias("modeName"), statuses.alias("lineStatuses"))

    rows = _orders_with_lines(spark, sf, ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"], line)
    return _bronze(rows, "tfl", "line_status", F.lit("/Line/Mode/tube/Status"), F.to_json("elements"))


def arrivals_bronze(spark, sf) -> DataFrame:
    def arrival(of: Column) -> Column:
        order, number, supplier = (of[c].cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey"))
        return F.struct(
            _text("A", order, "-", number).alias("id"), F.concat(F.lit("V"), (of["l_partkey"] % 100).cast("string")).alias("vehicleId"),
            F.when(of["l_partkey"] % 40 != 0, _text("Station ", supplier)).alias("stationName"), _text("L", supplier).alias("lineId"),
            _iso(of["l_shipdate"]).alias("timestamp"), (of["l_quantity"] * 30 - 60).cast("int").alias("timeToStation"), _iso(of["l_shipdate"]).alias("expectedArrival"))

    rows = _orders_with_lines(spark, sf, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"], arrival)
    endpoint = F.when(F.col("key") % OTHER_ENDPOINT == 0, F.lit("/Line/Mode/tube/Arrivals")).otherwise(
        F.concat(F.lit("/StopPoint/ST"), F.col("o_custkey").cast("string"), F.lit("/Arrivals")))
    return _bronze(rows, "tfl", "arrivals", endpoint, F.to_json("elements"))


def stop_points_bronze(spark, sf) -> DataFrame:
    su = _t(spark, sf, "supplier").withColumns({"key": F.col("s_suppkey"), "at": F.lit("2024-01-01").cast("timestamp")})
    line = lambda j: F.struct(F.concat(F.lit("L"), ((F.col("s_suppkey") + j % 2) % 7).cast("string")).alias("id"), F.lit("x").alias("name"))
    n = (F.col("s_suppkey") % 4).cast("int")
    lines = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), line))
    stop = lambda name, of: F.struct(
        _text(name, "@s_suppkey").alias("id"), _text("ST", "@s_suppkey").alias("stationNaptan"), F.col("s_name").alias("commonName"), F.lit("station").alias("stopType"),
        (F.col("s_acctbal") / 100).alias("lat"), (F.col("s_acctbal") / 50).alias("lon"), F.array(F.lit("tube")).alias("modes"), of.alias("lines"))
    payload = F.to_json(F.struct(F.array(stop("ST", lines), stop("SP", F.lit(None).cast("array<struct<id:string,name:string>>"))).alias("stopPoints")))
    return _bronze(su, "tfl", "stop_points", F.lit("/StopPoint/Mode/tube"), payload)


def weather_bronze(spark, sf) -> DataFrame:
    od = _t(spark, sf, "orders").withColumns({"key": F.col("o_orderkey"), "at": F.col("o_orderdate")})
    wet = F.when(F.col("o_orderkey") % 13 != 0, (F.col("o_custkey") % 5 - 1).cast("double"))
    current = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("time"), F.lit(900).alias("interval"), (F.col("o_custkey") % 30).cast("double").alias("temperature_2m"),
        (F.col("o_custkey") % 110).cast("int").alias("relative_humidity_2m"), wet.alias("precipitation"), wet.alias("rain"),
        (F.col("o_custkey") % 100).cast("int").alias("weather_code"), (F.col("o_orderkey") % 104).cast("int").alias("cloud_cover"),
        (F.col("o_custkey") % 40).cast("double").alias("wind_speed_10m"), (F.col("o_custkey") % 70).cast("double").alias("wind_gusts_10m"))
    payload = F.to_json(F.struct(F.lit(51.5).alias("latitude"), F.lit(-0.1).alias("longitude"), F.lit("Europe/London").alias("timezone"), F.lit(0).alias("utc_offset_seconds"), current.alias("current")))
    return _bronze(od, "open_meteo", "weather", F.lit("/v1/forecast"), payload)


def holidays_bronze(spark, sf) -> DataFrame:
    """One response for each day with orders; an event for each priority."""
    od = _t(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    event = F.struct(F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("day", "yyyy-MM-dd")).otherwise("soon").alias("date"))
    days = (od.select(day.alias("day"), "o_orderpriority").distinct().groupBy("day").agg(F.collect_list(event).alias("events"))
            .withColumns({"key": F.datediff("day", F.lit("1990-01-01").cast("date")).cast("long"), "at": F.col("day").cast("timestamp")}))
    region = F.struct(F.lit("england-and-wales").alias("division"), F.col("events"))
    return _bronze(days, "gov_uk", "bank_holidays", F.lit("/bank-holidays.json"), F.to_json(F.struct(region.alias("england-and-wales"))))


def _failed(df: DataFrame, rules) -> DataFrame:
    return Q.with_failures(df, rules).withColumn("failed", F.array_join(Q.FAILED, ",")).drop(Q.FAILED)


def model_line_status(spark, sf):
    rows = FL.line_status(line_status_bronze(spark, sf))
    return _ntz(_failed(rows, TR.line_status_rules()).select(
        "request_id", "line_id", "line_name", "status_id", "status_severity", "status_description", "status_reason", "status_created_at", "failed"))


def model_arrivals(spark, sf):
    rows = FL.arrivals(arrivals_bronze(spark, sf))
    return _ntz(_failed(rows, TR.arrival_rules()).select(
        "request_id", "requested_stop_point_id", "arrival_id", "vehicle_id", "station_name", "line_id", "time_to_station_seconds", "prediction_timestamp", "failed"))


def model_stop_points(spark, sf):
    rows = FL.stop_points(FL.parse_stop_points(stop_points_bronze(spark, sf)))
    return _failed(rows, TR.stop_point_rules()).select("request_id", "stop_point_id", "station_naptan", "latitude", "longitude", "failed")


def model_stop_lines(spark, sf):
    return FL.stop_point_lines(FL.parse_stop_points(stop_points_bronze(spark, sf))).select("request_id", "stop_point_id", "line_id")


def model_weather(spark, sf):
    rows = FL.weather(weather_bronze(spark, sf))
    return _ntz(_failed(rows, TR.weather_rules()).select(
        "request_id", "relative_humidity_pct", "precipitation_mm", "weather_description", "weather_observed_at", "failed"))


def model_holidays(spark, sf):
    rows = FL.bank_holidays(holidays_bronze(spark, sf))
    return _failed(rows, TR.holiday_rules()).select("request_id", "division", "holiday_name", "holiday_date", "failed")


def _counts(name: str, df: DataFrame, rules) -> DataFrame:
    """(rule_set, rule, failures): one aggregate over the rows."""
    one = Q.rule_counts(df, rules)
    pairs = [F.struct(F.lit(name).alias("rule_set"), F.lit(c).alias("rule"), F.col(c).cast("long").alias("failures")) for c in one.columns]
    return one.select(F.inline(F.array(*pairs)))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def model_contracts(spark, sf):
    """Rows, invalid rows and failures of each rule of the five contracts."""
    body = F.col(JS.BODY)
    return _union([
        _counts("line_status", JS.with_body(line_status_bronze(spark, sf)), TR.line_status_contract(body)),
        _counts("stop_points", JS.with_body(stop_points_bronze(spark, sf)), TR.stop_points_contract(body)),
        _counts("arrivals", JS.with_body(arrivals_bronze(spark, sf)), TR.arrivals_contract(body)),
        _counts("weather", JS.with_body(weather_bronze(spark, sf)), TR.weather_contract(body)),
        _counts("holidays", JS.with_body(holidays_bronze(spark, sf)), TR.holidays_contract(body)),
    ])


def _published(spark, sf):
    """The publications of all five sources, twice, and the arrival requests."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex}"
    requests = _t(spark, sf, "customer").select(F.concat(F.lit("/StopPoint/ST"), F.col("c_custkey").cast("string"), F.lit("/Arrivals")).alias("source_endpoint"))
    stages = [(B.bronze_line_status, line_status_bronze, None), (B.bronze_stop_points, stop_points_bronze, None), (B.bronze_arrivals, arrivals_bronze, requests),
              (B.bronze_weather, weather_bronze, None), (B.bronze_holidays, holidays_bronze, None)]
    for run, responses, asked in stages:
        batch = stage(responses(spark, sf), "responses", "zstd")
        # The payloads span years with few responses a day.
        yield base, *[run(spark, batch, base, asked, strict=False, partition_by=()) for _ in range(2)]


def bronze_publication(spark, sf):
    """All five bronze stages over payloads of which some are bad, and a replay of
    each: responses, what was committed and set apart, requests without a good
    response, the bronze table's rows, and what the replay added."""
    rows = []
    for base, first, again in _published(spark, sf):
        rows.append((first.dataset, first.responses, first.committed, first.quarantined, first.unanswered, V.read(spark, f"{base}/{first.dataset}").count(),
                     again.committed + again.quarantined))
    return spark.createDataFrame(rows, "dataset string, responses long, committed long, quarantined long, unanswered long, bronze_rows long, replay_added long")


def bronze_station_outcomes(spark, sf):
    """What became of the arrivals request of each station (customer)."""
    requests = _t(spark, sf, "customer").select(F.concat(F.lit("/StopPoint/ST"), F.col("c_custkey").cast("string"), F.lit("/Arrivals")).alias("source_endpoint"), "c_custkey")
    judged = B.judge(arrivals_bronze(spark, sf), TR.arrivals_contract)
    return B.outcomes(judged, requests).select(F.col("c_custkey").alias("station"), "responses", "good", "outcome")


def table_history(spark, sf):
    """Versions of a table of orders: created from early ones, appended to, merged
    with rows of which some are known, upserted; each version is read again."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orders-{uuid.uuid4().hex}"
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    part = F.col("o_orderkey") % 10
    V.replace(spark, od.where(part < 4), base)
    V.append(spark, od.where(part == 4), base)
    V.merge_insert_only(spark, od.where(part.between(3, 6)), base, ["o_orderkey"])
    V.merge_upsert(spark, od.where(part >= 6).withColumn("o_orderstatus", F.lit("X")), base, ["o_orderkey"])
    log = V.history(spark, base).select("version", "operation", "rows_written", "total_rows")
    counted = _union([V.read(spark, base, v).agg(F.lit(v).cast("long").alias("version"), F.count("*").alias("rows_read"), F.sum("o_orderkey").cast("long").alias("key_sum"),
                                                  F.count_if(F.col("o_orderstatus") == "X").alias("updated")) for v in V.versions(spark, base)])
    return log.join(counted, "version")


def read_contracts(spark, sf):
    """The serving contracts called with and without their parameters: the lines to
    choose from, all and at one station, and the summary of one station and line."""
    li, od = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    station, line = (F.col("o_custkey") % 50).cast("string"), (F.col("l_suppkey") % 20).cast("string")
    seen = li.join(od, li["l_orderkey"] == od["o_orderkey"]).where(F.col("l_linenumber") % 3 == 0)
    summary = seen.groupBy(F.concat(F.lit("ST"), station).alias("station_id"), F.concat(F.lit("Station "), station).alias("station_name"),
                           F.concat(F.lit("L"), line).alias("line_id"), F.concat(F.lit("Line "), line).alias("line_name")).agg(F.count("*").alias("arrival_observations"))
    register_contracts(spark, station_arrival_summary=summary)
    calls = ["line_options()", "line_options(for_station => 'ST7')", "station_options()", "station_summary(for_station => 'ST7')", "station_summary(for_line => 'L3', for_station => 'ST7')"]
    parts = []
    for call in calls:
        got = spark.sql(f"SELECT * FROM {call}")
        has = lambda c: F.col(c) if c in got.columns else F.lit(None).cast("bigint" if c == "arrival_observations" else "string")
        parts.append(got.select(F.lit(call).alias("call"), *[has(c).alias(c) for c in ("station_id", "station_name", "line_id", "line_name", "arrival_observations")]))
    return _union(parts)


def reason_parts(spark, sf):
    """First sentence of each document's text, and the number of its others."""
    d = _t(spark, sf, "documents").select("doc_id", F.regexp_replace("text", r"[^A-Za-z0-9 .!?]+", " ").alias("t"))
    return d.select("doc_id", first_sentence("t").alias("first"), F.size(remaining_sentences("t")).alias("others"))


def _holes(df: DataFrame, key: str, columns: list[str], step: int) -> DataFrame:
    """Nulls planted in each column, at other rows for each."""
    return df.withColumns({c: F.when(F.col(key) % step != k + 1, F.col(c)) for k, c in enumerate(columns)})


def model_rules(spark, sf):
    """Failures of each rule of the gold rule sets over orders whose columns
    stand for those of the tables, with planted nulls and values out of range."""
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    odd = (c % 9 - 1).cast("int")  # -1 in every ninth customer
    weather = _holes(od.select(
        "o_orderkey", k.alias("weather_observation_key"), k.alias("observation_date_key"), k.alias("weather_observed_at"), (c % 200 - 100).alias("latitude"),
        (c % 400 - 200).alias("longitude"), c.alias("temperature_c"), (c % 120 - 10).alias("relative_humidity_pct"), k.alias("snapshot_at"), (c % 120 - 10).alias("cloud_cover_pct"),
        odd.alias("precipitation_mm"), odd.alias("rain_mm"), odd.alias("wind_speed_kmh"), odd.alias("wind_gusts_kmh")), "o_orderkey",
        ["weather_observation_key", "observation_date_key", "weather_observed_at", "latitude", "longitude", "temperature_c", "relative_humidity_pct", "snapshot_at", "cloud_cover_pct", "rain_mm"], 23)
    status = _holes(od.select("o_orderkey", *[k.alias(x) for x in ("line_key", "line_id", "line_name", "status_severity", "status_snapshot_at_utc", "is_good_service", "is_disrupted")]),
                    "o_orderkey", ["line_key", "line_id", "line_name", "status_severity", "status_snapshot_at_utc", "is_good_service", "is_disrupted"], 17)
    summary = _holes(od.select(
        "o_orderkey", *[k.alias(x) for x in ("station_key", "line_key", "station_id", "station_name", "line_id", "line_name", "latest_prediction_timestamp_utc")],
        odd.alias("arrival_observations"), odd.alias("distinct_vehicles"), odd.alias("avg_eta_seconds"), odd.alias("min_eta_seconds"), odd.alias("max_eta_seconds")), "o_orderkey",
        ["station_key", "line_key", "station_id", "station_name", "line_id", "line_name", "latest_prediction_timestamp_utc", "arrival_observations"], 19)
    kpis = _holes(od.select(
        "o_orderkey", k.alias("date_key"), k.alias("calendar_date"), odd.alias("line_snapshots"), (c % 7).cast("int").alias("disrupted_line_snapshots"),
        (c % 6).cast("int").alias("good_service_line_snapshots"), (c % 130 - 10).cast("double").alias("disruption_rate_pct"),
        *[odd.alias(x) for x in ("arrival_observations", "distinct_vehicles", "stations_observed", "avg_eta_seconds", "total_precipitation_mm", "max_wind_gust_kmh")]),
        "o_orderkey", ["date_key", "calendar_date", "line_snapshots", "disruption_rate_pct", "avg_eta_seconds"], 11)
    line_columns = ["line_status_key", "line_key", "line_id", "snapshot_date_key", "request_id", "snapshot_at", "status_severity"]
    lines = _holes(od.select("o_orderkey", *[k.alias(x) for x in line_columns], (c % 5 == 0).alias("is_good_service"), (c % 6 != 0).alias("is_disrupted")),
                   "o_orderkey", [*line_columns, "is_good_service"], 29)
    arrival_columns = ["arrival_observation_key", "station_key", "line_key", "requested_station_id", "line_id", "prediction_date_key", "request_id", "arrival_id",
                       "prediction_timestamp", "expected_arrival", "snapshot_at"]
    arrivals = _holes(od.select("o_orderkey", *[k.alias(x) for x in arrival_columns], odd.alias("time_to_station_seconds")), "o_orderkey",
                      [*arrival_columns, "time_to_station_seconds"], 31)
    days = _holes(od.select("o_orderkey", k.alias("date_key"), k.alias("calendar_date"), (c % 7 < 2).alias("is_weekend"), F.element_at(F.array(*map(F.lit, DAY_NAMES)), (c % 7 + 1).cast("int")).alias("day_name")),
                  "o_orderkey", ["date_key", "calendar_date", "is_weekend"], 13)
    return _union([
        _counts("fact_line_status", lines, TR.fact_line_status_rules()),
        _counts("fact_arrival_observation", arrivals, TR.fact_arrival_rules()),
        _counts("dim_date", days, TR.dim_date_rules()),
        _counts("fact_weather", weather, TR.fact_weather_rules()),
        _counts("current_line_status", status, TR.current_status_rules()),
        _counts("station_arrival_summary", summary, TR.arrival_summary_rules()),
        _counts("daily_network_kpis", kpis, TR.daily_kpi_rules()),
    ])


def as_of_weekly(spark, sf):
    """Events joined to the versions of weekly snapshots, another source than the
    events' own changes; events before a user's first snapshot have no version."""
    from snapstar.plans.catalog import weekly_states

    versions = versions_from_snapshots(weekly_states(spark, sf), ["user_id"], ["event_type"], "snapshot_at").select(
        "user_id", F.col("event_type").alias("version_event_type"), "effective_from", "effective_to")
    facts = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return _ntz(as_of_join(facts, versions, ["user_id"], "ts"))


def version_list(spark, sf):
    """Numbered version history of each user."""
    from snapstar.plans.catalog import weekly_states

    dim = versions_from_snapshots(weekly_states(spark, sf), ["user_id"], ["event_type"], "snapshot_at")
    return _ntz(version_history(dim, ["user_id"]).select("user_id", "version_no", "event_type", "effective_from", "valid_days"))


def queries() -> dict:
    return {f.__name__: f for f in (model_line_status, model_arrivals, model_stop_points, model_stop_lines, model_weather, model_holidays,
                                    model_contracts, model_rules, as_of_weekly, version_list,
                                    bronze_publication, bronze_station_outcomes, table_history, read_contracts, reason_parts)}

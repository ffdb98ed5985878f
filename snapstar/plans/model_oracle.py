"""DuckDB SQL for :mod:`snapstar.plans.model`, from the base tables alone."""

from __future__ import annotations

from snapstar.plans.oracle import SCD2_VERSIONS, code_case

LINE_STATUS = """
    WITH good AS (
      SELECT 'line_status-' || o_orderkey AS request_id, l_suppkey, l_partkey, l_shipdate,
             unnest(CASE WHEN l_linenumber % 3 = 0 THEN [NULL] ELSE range(0, l_linenumber % 3) END) AS j
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 97 <> 0),
    s AS (SELECT *, CAST((l_partkey + j) % 12 AS INTEGER) AS sev FROM good)
    SELECT request_id, 'L' || l_suppkey AS line_id, 'Line ' || l_suppkey AS line_name, CAST(j AS INTEGER) AS status_id, sev AS status_severity,
           'S' || sev AS status_description, CASE WHEN sev <> 10 THEN 'R' || l_partkey END AS status_reason,
           CASE WHEN j IS NOT NULL AND l_partkey % 50 <> 0 THEN date_trunc('second', CAST(l_shipdate AS TIMESTAMP)) END AS status_created_at,
           CASE WHEN sev IS NULL THEN 'status_severity_not_null' ELSE '' END AS failed
    FROM s
    UNION ALL
    SELECT 'line_status-' || o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'line_id_not_null,line_name_not_null,status_severity_not_null'
    FROM orders WHERE o_orderkey % 97 = 0 OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""

ARRIVALS = """
    SELECT 'arrivals-' || o_orderkey AS request_id, CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE 'ST' || o_custkey END AS requested_stop_point_id,
           'A' || l_orderkey || '-' || l_linenumber AS arrival_id, 'V' || (l_partkey % 100) AS vehicle_id,
           CASE WHEN l_partkey % 40 <> 0 THEN 'Station ' || l_suppkey END AS station_name, 'L' || l_suppkey AS line_id,
           CAST(trunc(l_quantity * 30 - 60) AS INTEGER) AS time_to_station_seconds, date_trunc('second', CAST(l_shipdate AS TIMESTAMP)) AS prediction_timestamp,
           concat_ws(',', CASE WHEN l_partkey % 40 = 0 THEN 'station_name_not_null' END, CASE WHEN l_shipdate IS NULL THEN 'prediction_timestamp_not_null' END,
                     CASE WHEN l_shipdate IS NULL THEN 'expected_arrival_not_null' END, CASE WHEN l_quantity IS NULL THEN 'time_to_station_seconds_not_null' END,
                     CASE WHEN o_orderkey % 89 = 0 THEN 'requested_stop_point_id_not_blank' END,
                     CASE WHEN l_quantity IS NULL OR trunc(l_quantity * 30 - 60) < 0 THEN 'time_to_station_seconds_non_negative' END) AS failed
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 97 <> 0"""

STOP_POINTS = """
    SELECT 'stop_points-' || s_suppkey AS request_id, kind || s_suppkey AS stop_point_id, 'ST' || s_suppkey AS station_naptan,
           s_acctbal / 100 AS latitude, s_acctbal / 50 AS longitude,
           concat_ws(',', CASE WHEN coalesce(s_acctbal / 100 NOT BETWEEN -90 AND 90, true) THEN 'latitude_valid' END,
                     CASE WHEN coalesce(s_acctbal / 50 NOT BETWEEN -180 AND 180, true) THEN 'longitude_valid' END) AS failed
    FROM supplier CROSS JOIN (VALUES ('ST'), ('SP')) k(kind) WHERE s_suppkey % 97 <> 0
    UNION ALL
    SELECT 'stop_points-' || s_suppkey, NULL, NULL, NULL, NULL, 'stop_point_id_not_null,common_name_not_null,latitude_valid,longitude_valid'
    FROM supplier WHERE s_suppkey % 97 = 0"""

STOP_LINES = """
    SELECT DISTINCT 'stop_points-' || s_suppkey AS request_id, 'ST' || s_suppkey AS stop_point_id, 'L' || ((s_suppkey + j % 2) % 7) AS line_id
    FROM (SELECT s_suppkey, unnest(range(1, s_suppkey % 4 + 1)) AS j FROM supplier WHERE s_suppkey % 97 <> 0)"""

WEATHER = f"""
    WITH w AS (SELECT *, o_orderkey % 97 = 0 AS bad, CAST(o_custkey % 110 AS INTEGER) AS hum, CAST(o_orderkey % 104 AS INTEGER) AS cloud,
                      CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_custkey % 5 - 1 AS DOUBLE) END AS wet FROM orders)
    SELECT 'weather-' || o_orderkey AS request_id, CASE WHEN NOT bad THEN hum END AS relative_humidity_pct, CASE WHEN NOT bad THEN wet END AS precipitation_mm,
           CASE WHEN bad THEN 'Unknown' ELSE {code_case('o_custkey % 100')} END AS weather_description,
           CASE WHEN NOT bad THEN ((date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)) AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC') END AS weather_observed_at,
           CASE WHEN bad THEN 'weather_observed_at_not_null,latitude_valid,longitude_valid,humidity_valid,cloud_cover_valid,precipitation_mm_non_negative,rain_mm_non_negative,wind_speed_kmh_non_negative,wind_gusts_kmh_non_negative'
                ELSE concat_ws(',', CASE WHEN o_orderdate IS NULL THEN 'weather_observed_at_not_null' END, CASE WHEN hum > 100 THEN 'humidity_valid' END, CASE WHEN cloud > 100 THEN 'cloud_cover_valid' END,
                               CASE WHEN coalesce(wet < 0, true) THEN 'precipitation_mm_non_negative' END, CASE WHEN coalesce(wet < 0, true) THEN 'rain_mm_non_negative' END) END AS failed
    FROM w"""

HOLIDAYS = """
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders),
    n AS (SELECT *, date_diff('day', DATE '1990-01-01', day) AS key FROM d)
    SELECT 'bank_holidays-' || key AS request_id, 'england-and-wales' AS division, o_orderpriority AS holiday_name,
           CASE WHEN o_orderpriority <> '5-LOW' THEN day END AS holiday_date,
           CASE WHEN o_orderpriority <> '5-LOW' THEN '' ELSE 'holiday_date_not_null' END AS failed
    FROM n WHERE key % 97 <> 0"""


def _counted(name: str, table: str, rules: list[tuple[str, str]]) -> str:
    """Counts of rows, of rows that break a rule, and of each rule's failures;
    a rule is a predicate of a good row, and null counts as broken."""
    bad = {rule: f"NOT coalesce(({good}), false)" for rule, good in rules}
    rows = [("rows", "true"), ("invalid_rows", " OR ".join(bad.values())), *bad.items()]
    return "\nUNION ALL ".join(f"SELECT '{name}' AS rule_set, '{rule}' AS rule, count(*) FILTER (WHERE {cond}) AS failures FROM {table}" for rule, cond in rows)


def _contracts() -> str:
    ok, whole = ("http_status_200", "key % 31 <> 0"), "key % 97 <> 0"
    with_lines = "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = key)"
    parts = [
        _counted("line_status", "ord", [ok, ("line_array_with_fields", f"{whole} AND has_lines")]),
        _counted("stop_points", "(SELECT s_suppkey AS key FROM supplier)", [ok, ("object_root", whole), ("stop_points_non_empty", whole)]),
        _counted("arrivals", "ord", [ok, ("array_root", whole)]),
        _counted("weather", "ord", [ok, ("weather_fields", whole), ("current_variables", f"{whole} AND key % 13 <> 0")]),
        _counted("holidays", "(SELECT DISTINCT date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS key FROM orders)",
                 [ok, ("region_present", whole), ("events_with_fields", whole)]),
    ]
    return f"WITH ord AS (SELECT key, {with_lines} AS has_lines FROM (SELECT o_orderkey AS key FROM orders))\n" + "\nUNION ALL ".join(parts)


def _rules() -> str:
    def holes(names: list[str], step: int, value: dict[str, str]) -> dict[str, str]:
        return {n: f"CASE WHEN k % {step} <> {i + 1} THEN {value.get(n, 'k')} END" for i, n in enumerate(names)}

    odd = "(c % 9 - 1)"
    not_null = lambda cols, v: [(f"{x}_not_null", f"({v[x]}) IS NOT NULL") for x in cols]
    least = lambda x, v: (f"{x}_non_negative", f"({v}) IS NULL OR ({v}) >= 0")

    need = ["weather_observation_key", "observation_date_key", "weather_observed_at", "latitude", "longitude", "temperature_c", "relative_humidity_pct", "snapshot_at"]
    w = holes([*need, "cloud_cover_pct", "rain_mm"], 23, {"latitude": "c % 200 - 100", "longitude": "c % 400 - 200", "temperature_c": "c", "relative_humidity_pct": "c % 120 - 10",
                                                         "cloud_cover_pct": "c % 120 - 10", "rain_mm": odd})
    weather = [*not_null(need, w), ("latitude_valid", f"({w['latitude']}) BETWEEN -90 AND 90"), ("longitude_valid", f"({w['longitude']}) BETWEEN -180 AND 180"),
               ("humidity_valid", f"({w['relative_humidity_pct']}) BETWEEN 0 AND 100"), ("cloud_cover_valid", f"coalesce(({w['cloud_cover_pct']}) BETWEEN 0 AND 100, true)"),
               least("precipitation_mm", odd), least("rain_mm", w["rain_mm"]), least("wind_speed_kmh", odd), least("wind_gusts_kmh", odd)]
    need = ["line_key", "line_id", "line_name", "status_severity", "status_snapshot_at_utc", "is_good_service", "is_disrupted"]
    status = not_null(need, holes(need, 17, {}))
    need = ["station_key", "line_key", "station_id", "station_name", "line_id", "line_name", "latest_prediction_timestamp_utc"]
    s = holes([*need, "arrival_observations"], 19, {"arrival_observations": odd})
    summary = [*not_null(need, s), ("arrival_observations_positive", f"coalesce(({s['arrival_observations']}) > 0, true)"),
               *[least(x, odd) for x in ("distinct_vehicles", "avg_eta_seconds", "min_eta_seconds", "max_eta_seconds")]]
    d = holes(["date_key", "calendar_date", "line_snapshots", "disruption_rate_pct", "avg_eta_seconds"], 11, {"line_snapshots": odd, "disruption_rate_pct": "c % 130 - 10", "avg_eta_seconds": odd})
    kpis = [*not_null(["date_key", "calendar_date"], d),
            ("disrupted_line_snapshots_at_most_line_snapshots", f"coalesce(c % 7 <= ({d['line_snapshots']}), true)"),
            ("good_service_line_snapshots_at_most_line_snapshots", f"coalesce(c % 6 <= ({d['line_snapshots']}), true)"),
            ("rate_in_range", f"coalesce(({d['disruption_rate_pct']}) BETWEEN 0 AND 100, true)"), least("line_snapshots", d["line_snapshots"]),
            least("arrival_observations", odd), least("distinct_vehicles", odd), least("stations_observed", odd), least("avg_eta_seconds", d["avg_eta_seconds"]),
            least("total_precipitation_mm", odd), least("max_wind_gust_kmh", odd)]
    need = ["line_status_key", "line_key", "line_id", "snapshot_date_key", "request_id", "snapshot_at", "status_severity"]
    h = holes([*need, "is_good_service"], 29, {"is_good_service": "(c % 5 = 0)"})
    lines = [*not_null(need, h), ("flags_differ", f"({h['is_good_service']}) <> (c % 6 <> 0)")]
    need = ["arrival_observation_key", "station_key", "line_key", "requested_station_id", "line_id", "prediction_date_key", "request_id", "arrival_id",
            "prediction_timestamp", "expected_arrival", "snapshot_at", "time_to_station_seconds"]
    h = holes(need, 31, {"time_to_station_seconds": odd})
    arrivals = [*not_null(need, h), ("time_to_station_seconds_non_negative", f"({h['time_to_station_seconds']}) >= 0")]
    h = holes(["date_key", "calendar_date", "is_weekend"], 13, {"is_weekend": "(c % 7 < 2)"})
    days = [*not_null(["date_key", "calendar_date"], h), ("weekend_matches_day_name", f"({h['is_weekend']}) = (c % 7 IN (0, 4))")]
    parts = [_counted(n, "o", rules) for n, rules in (("fact_line_status", lines), ("fact_arrival_observation", arrivals), ("dim_date", days), ("fact_weather", weather), ("current_line_status", status), ("station_arrival_summary", summary), ("daily_network_kpis", kpis))]
    return "WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)\n" + "\nUNION ALL ".join(parts)


def _publication() -> str:
    whole = "key % 97 <> 0 AND key % 31 <> 0"
    asked = "(SELECT count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 97 <> 0 AND o_orderkey % 31 <> 0 AND o_orderkey % 89 <> 0))"
    days = "(SELECT DISTINCT date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS key FROM orders)"
    parts = [("line_status", "ord", f"{whole} AND has_lines", "0"), ("stop_points", "(SELECT s_suppkey AS key FROM supplier)", whole, "0"), ("arrivals", "ord", whole, asked),
             ("weather", "ord", f"{whole} AND key % 13 <> 0", "0"), ("bank_holidays", days, whole, "0")]
    return ("WITH ord AS (SELECT o_orderkey AS key, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_lines FROM orders)\n" + "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS responses, count(*) FILTER (WHERE {good}) AS committed, count(*) FILTER (WHERE NOT ({good})) AS quarantined, "
        f"{open_} AS unanswered, count(*) FILTER (WHERE {good}) AS bronze_rows, CAST(0 AS BIGINT) AS replay_added FROM {table}" for name, table, good, open_ in parts))


STATION_OUTCOMES = """
    SELECT c_custkey AS station, count(o_orderkey) AS responses, count(o_orderkey) FILTER (WHERE o_orderkey % 97 <> 0 AND o_orderkey % 31 <> 0) AS good,
           CASE WHEN count(o_orderkey) FILTER (WHERE o_orderkey % 97 <> 0 AND o_orderkey % 31 <> 0) > 0 THEN 'succeeded' WHEN count(o_orderkey) > 0 THEN 'failed' ELSE 'unanswered' END AS outcome
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 89 <> 0 GROUP BY 1"""

HISTORY = """
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 10 AS p FROM orders),
    v AS (
      SELECT 1 AS version, 'replace' AS operation, count(*) FILTER (WHERE p < 4) AS rows_written, count(*) FILTER (WHERE p < 4) AS rows_read, sum(k) FILTER (WHERE p < 4) AS key_sum, 0 AS updated FROM o
      UNION ALL SELECT 2, 'append', count(*) FILTER (WHERE p = 4), count(*) FILTER (WHERE p <= 4), sum(k) FILTER (WHERE p <= 4), 0 FROM o
      UNION ALL SELECT 3, 'merge', count(*) FILTER (WHERE p IN (5, 6)), count(*) FILTER (WHERE p <= 6), sum(k) FILTER (WHERE p <= 6), 0 FROM o
      UNION ALL SELECT 4, 'upsert', count(*), count(*), sum(k), count(*) FILTER (WHERE p >= 6) FROM o)
    SELECT CAST(version AS BIGINT) AS version, operation, rows_written, rows_read AS total_rows, rows_read, CAST(key_sum AS BIGINT) AS key_sum, CAST(updated AS BIGINT) AS updated FROM v"""


READ_CONTRACTS = """
    WITH s AS (SELECT 'ST' || (o_custkey % 50) AS station_id, 'Station ' || (o_custkey % 50) AS station_name, 'L' || (l_suppkey % 20) AS line_id, 'Line ' || (l_suppkey % 20) AS line_name,
                      count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber % 3 = 0 GROUP BY ALL)
    SELECT DISTINCT 'line_options()' AS call, CAST(NULL AS VARCHAR) AS station_id, CAST(NULL AS VARCHAR) AS station_name, line_id, line_name, CAST(NULL AS BIGINT) AS arrival_observations FROM s
    UNION ALL SELECT DISTINCT 'line_options(for_station => ''ST7'')', NULL, NULL, line_id, line_name, NULL FROM s WHERE station_id = 'ST7'
    UNION ALL SELECT DISTINCT 'station_options()', station_id, station_name, NULL, NULL, NULL FROM s
    UNION ALL SELECT 'station_summary(for_station => ''ST7'')', * FROM s WHERE station_id = 'ST7'
    UNION ALL SELECT 'station_summary(for_line => ''L3'', for_station => ''ST7'')', * FROM s WHERE station_id = 'ST7' AND line_id = 'L3'"""

REASON_PARTS = r"""
    WITH d AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9 .!?]+', ' ', 'g') AS t FROM documents),
    p AS (SELECT doc_id, t, list_filter([trim(x) for x in string_split(regexp_replace(t, '([.!?]) +', '\1' || chr(1), 'g'), chr(1))], lambda x: x <> '') AS parts FROM d)
    SELECT doc_id, parts[1] AS first, CAST(greatest(len(parts) - 1, 0) AS INTEGER) AS others FROM p"""


def oracle_sql() -> dict[str, str]:
    return {
        "model_line_status": LINE_STATUS, "model_arrivals": ARRIVALS, "model_stop_points": STOP_POINTS, "model_stop_lines": STOP_LINES,
        "model_weather": WEATHER, "model_holidays": HOLIDAYS, "model_contracts": _contracts(), "bronze_publication": _publication(), "bronze_station_outcomes": STATION_OUTCOMES, "table_history": HISTORY, "read_contracts": READ_CONTRACTS, "reason_parts": REASON_PARTS, "model_rules": _rules(),
        "as_of_weekly": f"""WITH {SCD2_VERSIONS}
            SELECT f.event_id, f.user_id, f.ts, f.event_type, v.event_type AS version_event_type, v.effective_from, v.effective_to
            FROM events f JOIN v ON f.user_id = v.user_id AND f.ts >= v.effective_from AND (v.effective_to IS NULL OR f.ts < v.effective_to)""",
        "version_list": f"""WITH {SCD2_VERSIONS}
            SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY effective_from, version_key) AS INTEGER) AS version_no, event_type, effective_from,
                   CAST(date_diff('day', CAST(effective_from AS DATE), CAST(effective_to AS DATE)) AS INTEGER) AS valid_days FROM v""",
    }

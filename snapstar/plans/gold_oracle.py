"""DuckDB SQL for :mod:`snapstar.plans.gold_model`, from the base tables alone."""

from __future__ import annotations

from snapstar.plans import gold_model as G
from snapstar.plans.model_oracle import ARRIVALS, HOLIDAYS, LINE_STATUS, WEATHER


def _hash(*parts: str) -> str:
    return "sha256(" + " || '||' || ".join(parts) + ")"


_OK = "CAST(split_part(request_id, '-', 2) AS BIGINT) % 31 <> 0"
_DATE = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"

SILVER = f"""
    ls AS (SELECT request_id, line_id, status_id, min(status_severity) AS status_severity, any_value(o_orderdate) AS snapshot_at
           FROM ({LINE_STATUS}) JOIN orders ON o_orderkey = CAST(split_part(request_id, '-', 2) AS BIGINT) WHERE failed = '' AND {_OK} GROUP BY 1, 2, 3),
    ar AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id, arrival_id ORDER BY vehicle_id, line_id, time_to_station_seconds, prediction_timestamp) AS n
                          FROM ({ARRIVALS}) WHERE failed = '' AND {_OK}) WHERE n = 1),
    wx AS (SELECT * FROM (SELECT w.*, o_custkey % 30 AS temperature, row_number() OVER (PARTITION BY weather_observed_at ORDER BY request_id DESC) AS n
                          FROM ({WEATHER}) w JOIN orders ON o_orderkey = CAST(split_part(request_id, '-', 2) AS BIGINT) WHERE failed = '' AND {_OK}) WHERE n = 1)"""


def _versions(table: str, key: str, prefix: str, first: str, step: int, attributes) -> str:
    """(id, name, attribute_hash, effective_from, effective_to, is_current) of an entity with one or two versions."""
    changed, ident = f"{key} % {step} = 0", f"'{prefix}' || {key}"
    rows = []
    for name, since, until, cond in ((first, G.FIRST, f"CASE WHEN {changed} THEN TIMESTAMP '{G.SECOND}' END", "true"), (f"{first} || ' renamed'", G.SECOND, "NULL", changed)):
        rows.append(f"SELECT {ident} AS id, {name} AS name, {_hash(*attributes(name))} AS attribute_hash, TIMESTAMP '{since}' AS effective_from, "
                    f"CAST({until} AS TIMESTAMP) AS effective_to FROM {table} WHERE {cond}")
    key_text = _hash("id", "attribute_hash", "strftime(effective_from, '%Y-%m-%d %H:%M:%S')")
    return f"SELECT *, effective_to IS NULL AS is_current, {key_text} AS version FROM ({' UNION ALL '.join(rows)})"


LINES = _versions("supplier", "s_suppkey", "L", "'Line ' || s_suppkey", G.LINES_RENAMED, lambda name: [name, "'tube'", "'true'"])
STATIONS = _versions("customer", "c_custkey", "ST", "c_name", G.STATIONS_RENAMED,
                     lambda name: [name, "CAST(floor(c_acctbal / 200) * 0.5 AS VARCHAR)", "CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR)", "'station'", "'bus,tube'", "'true'"])
DIMS = f"ln AS ({LINES}), st AS ({STATIONS})"


def _during(version: str, at: str) -> str:
    return f"{at} >= {version}.effective_from AND ({version}.effective_to IS NULL OR {at} < {version}.effective_to)"


#: Checks and what the planted faults give; those of the first list look into no row.
_TABLES = ["dim_date", "dim_line", "dim_station", "bridge_station_line", "fact_line_status", "fact_arrival_observation", "fact_weather",
           "current_line_status", "station_arrival_summary", "daily_network_kpis"]
_ZERO = ["dim_date_duplicate_date_keys", "dim_date_duplicate_calendar_dates", "dim_line_duplicate_line_keys", "dim_line_invalid_current_versions", "dim_line_invalid_effective_dates",
         "dim_line_current_rows_with_end_date", "dim_line_overlapping_versions", "dim_station_duplicate_station_keys", "dim_station_invalid_current_versions",
         "dim_station_invalid_effective_dates", "dim_station_overlapping_versions", "bridge_duplicate_keys", "bridge_duplicate_relationships", "bridge_orphan_station_keys",
         "bridge_orphan_line_keys", "fact_line_status_duplicate_keys", "fact_line_status_orphan_line_keys", "fact_line_status_orphan_date_keys", "fact_arrival_duplicate_keys",
         "fact_arrival_orphan_station_keys", "fact_arrival_orphan_line_keys", "fact_weather_duplicate_keys", "current_line_status_duplicate_lines", "station_summary_duplicate_grain",
         "station_summary_invalid_eta_ranges", "daily_kpi_duplicate_dates", "daily_kpi_line_totals", "daily_kpi_missing_dates", "daily_kpi_unexpected_dates"]


def _audit() -> str:
    exists = [f"table_{kind}::{t}" for kind in ("exists", "non_empty") for t in _TABLES]
    values = lambda names: "(VALUES " + ", ".join(f"('{n}')" for n in names) + ") x(name)"
    counts = [("fact_line_status_row_reconciliation", "n.ls", 2, 0), ("fact_arrival_row_reconciliation", "n.ar", 2, 0), ("fact_weather_row_reconciliation", "n.wx", 1, 0),
              ("current_line_status_line_coverage", "n.seen", 1, 2)]
    rows = [f"SELECT 'as_built', name, 1, 1 FROM {values(exists)}", f"SELECT 'with_faults', name, 1, 1 FROM {values(exists)}",
            f"SELECT 'as_built', name, 0, 0 FROM {values(_ZERO)}", f"SELECT 'with_faults', name, 1, 0 FROM {values(_ZERO)}",
            f"SELECT 'absent', name, 0, 1 FROM {values(exists + _ZERO + [c[0] for c in counts])}"]
    for name, value, more, expected in counts:
        there = "n.lines" if name.startswith("current") else value
        rows += [f"SELECT 'as_built', '{name}', {value}, {there} FROM n", f"SELECT 'with_faults', '{name}', {value} + {more}, {there} + {expected} FROM n"]
    return f"""WITH {SILVER},
    n AS (SELECT (SELECT count(*) FROM ls) AS ls, (SELECT count(*) FROM ar) AS ar, (SELECT count(*) FROM wx) AS wx,
                 (SELECT count(DISTINCT line_id) FROM ls) AS seen, (SELECT count(*) FROM supplier) AS lines),
    r(run, check_name, actual_value, expected_value) AS ({' UNION ALL '.join(rows)})
    SELECT run, check_name, CASE WHEN actual_value = expected_value THEN 'PASS' ELSE 'FAIL' END AS status,
           CAST(actual_value AS BIGINT) AS actual_value, CAST(expected_value AS BIGINT) AS expected_value FROM r"""


def oracle_sql() -> dict[str, str]:
    return {
        "gold_dim_line": f"WITH {DIMS} SELECT id AS line_id, version AS line_key, name AS line_name, true AS is_active, attribute_hash, effective_from, effective_to, is_current FROM ln",
        "gold_dim_station": f"WITH {DIMS} SELECT id AS station_id, version AS station_key, name AS station_name, 'bus,tube' AS modes_text, effective_from, effective_to, is_current FROM st",
        "gold_fact_line_status": f"""WITH {SILVER}, {DIMS}
            SELECT {_hash('request_id', 'line_id', 'CAST(status_id AS VARCHAR)')} AS line_status_key, ln.version AS line_key, line_id, {_DATE.format('snapshot_at')} AS snapshot_date_key,
                   request_id, status_id, status_severity, status_severity = 10 AS is_good_service, status_severity <> 10 AS is_disrupted, snapshot_at
            FROM ls JOIN ln ON ln.id = line_id AND {_during('ln', 'snapshot_at')}""",
        "gold_fact_arrivals": f"""WITH {SILVER}, {DIMS}
            SELECT {_hash('request_id', 'arrival_id')} AS arrival_observation_key, st.version AS station_key, ln.version AS line_key, requested_stop_point_id AS requested_station_id, line_id,
                   {_DATE.format('prediction_timestamp')} AS prediction_date_key, vehicle_id, time_to_station_seconds, prediction_timestamp
            FROM ar JOIN st ON st.id = requested_stop_point_id AND {_during('st', 'prediction_timestamp')} JOIN ln ON ln.id = line_id AND {_during('ln', 'prediction_timestamp')}
            WHERE prediction_timestamp < TIMESTAMP '2002-01-01'""",
        "gold_fact_weather": f"""WITH {SILVER}
            SELECT {_hash("'51.5'", "'-0.1'", "strftime(weather_observed_at, '%Y-%m-%d %H:%M:%S')")} AS weather_observation_key,
                   {_DATE.format("((weather_observed_at AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London')")} AS observation_date_key, weather_observed_at,
                   CAST(temperature AS DOUBLE) AS temperature_c, relative_humidity_pct FROM wx""",
        "gold_holidays": f"""SELECT {_hash('division', "strftime(holiday_date, '%Y-%m-%d')", 'holiday_name')} AS holiday_key, request_id, holiday_name, holiday_date
            FROM ({HOLIDAYS}) WHERE failed = '' AND {_OK}""",
        "gold_audit": _audit(),
    }

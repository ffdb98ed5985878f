"""Read contracts of the serving tables: SQL table functions with named,
defaulted parameters.

A reader (a dashboard) calls ``station_summary(for_station => 'S1')`` and gets the
columns of the contract in their order; a parameter that is left out, or null (the
"all" choice), filters nothing.  The picker of lines is limited by the chosen
station.  Filters on the parameters reach the serving table's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (view, parameters, columns, body)
CONTRACTS = {
    "line_status": (
        "for_line STRING DEFAULT NULL",
        "line_id STRING, line_name STRING, status_severity INT, status_description STRING, is_disrupted BOOLEAN",
        "SELECT line_id, line_name, status_severity, status_description, is_disrupted FROM {current_line_status} "
        "WHERE for_line IS NULL OR line_id = for_line ORDER BY line_name, line_id"),
    "station_summary": (
        "for_station STRING DEFAULT NULL, for_line STRING DEFAULT NULL",
        "station_id STRING, station_name STRING, line_id STRING, line_name STRING, arrival_observations BIGINT",
        "SELECT station_id, station_name, line_id, line_name, arrival_observations FROM {station_arrival_summary} "
        "WHERE (for_station IS NULL OR station_id = for_station) AND (for_line IS NULL OR line_id = for_line) ORDER BY station_name, line_name, station_id, line_id"),
    "station_options": (
        "", "station_id STRING, station_name STRING",
        "SELECT DISTINCT station_id, station_name FROM {station_arrival_summary} ORDER BY station_name, station_id"),
    "line_options": (
        "for_station STRING DEFAULT NULL", "line_id STRING, line_name STRING",
        "SELECT DISTINCT line_id, line_name FROM {station_arrival_summary} WHERE for_station IS NULL OR station_id = for_station ORDER BY line_name, line_id"),
}


def register(spark: SparkSession, **tables: DataFrame) -> list[str]:
    """Make the table functions whose serving tables are given; their names.  They
    hold for the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"serving_{name}")
    views = {name: f"serving_{name}" for name in tables}
    made = []
    for name, (parameters, columns, body) in CONTRACTS.items():
        if any(f"{{{v}}}" in body for v in views):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body.format(**views)}")
            made.append(name)
    return made

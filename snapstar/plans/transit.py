"""The transit snapshot model: rule sets, keys, dimensions, facts, serving.

This is one configuration of the generic operators for the polled transport
sources (line status, stop points, arrivals, weather, bank holidays).  Column
names follow the silver/gold layouts in ``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.functions import json as J
from snapstar.functions.keys import NULL_MARKER, array_text, fold_key, hash_key, unfold_key
from snapstar.functions.labels import is_disrupted, is_good_service
from snapstar.functions.time import LOCAL_TZ, local_date_key, to_local
from snapstar.operators import quality as Q
from snapstar.operators.asof import as_of_join
from snapstar.operators.dedup import canonical_per_key, latest_per_key, rows_at_latest
from snapstar.operators.scd2 import with_attribute_hash
from snapstar.plans import serving as S

# ---------------------------------------------------------------------------
# Row rules (true = good row)
# ---------------------------------------------------------------------------

# ---------------------------------------------------------------------------
# Fixed values of the source contracts (must equal the source APIs' layout):
#   line status elements: id, name, modeName, lineStatuses
#   weather top level: latitude, longitude, timezone, current
#   weather current variables: time, temperature_2m, relative_humidity_2m,
#     precipitation, rain, weather_code, cloud_cover, wind_speed_10m,
#     wind_gusts_10m
#   holidays region: england-and-wales; each event: title, date
# ---------------------------------------------------------------------------
LINE_STATUS_FIELDS = ["id", "name", "modeName", "lineStatuses"]
WEATHER_FIELDS = ["latitude", "longitude", "timezone", "current"]
WEATHER_CURRENT = ["time", "temperature_2m", "relative_humidity_2m", "precipitation", "rain",
                   "weather_code", "cloud_cover", "wind_speed_10m", "wind_gusts_10m"]
HOLIDAY_REGION = "england-and-wales"
HOLIDAY_EVENT_FIELDS = ["title", "date"]
# Display-name suffixes removed, in this order: " Underground Station", " Underground"
STATION_NAME_SUFFIXES = [" Underground Station", " Underground"]


def short_station_name(name):
    """Display name without the suffixes above (literal replacement)."""
    c = F.col(name) if isinstance(name, str) else name
    for suffix in STATION_NAME_SUFFIXES:
        c = F.replace(c, F.lit(suffix), F.lit(""))
    return c


def _http_ok() -> Q.Rule:
    return Q.Rule("http_status_200", F.col("http_status") == 200)


def _body(body: Column | None) -> Column:
    """The parsed payload: a column that holds it, or parsed here."""
    return F.try_parse_json("payload") if body is None else body


def line_status_contract(body: Column | None = None) -> list[Q.Rule]:
    """Non-empty array; every element carries the line fields."""
    return [_http_ok(), Q.Rule("line_array_with_fields", J.array_of(_body(body), LINE_STATUS_FIELDS))]


def stop_points_contract(body: Column | None = None) -> list[Q.Rule]:
    """Object root holding a non-empty ``stopPoints`` array."""
    return [_http_ok(),
            Q.Rule("object_root", J.is_object(_body(body))),
            Q.Rule("stop_points_non_empty", F.size(J.elements(_body(body), "$.stopPoints")) > 0)]


def arrivals_contract(body: Column | None = None) -> list[Q.Rule]:
    """Array root; an empty list is a valid answer."""
    return [_http_ok(), Q.Rule("array_root", J.elements(_body(body)).isNotNull())]


def weather_contract(body: Column | None = None) -> list[Q.Rule]:
    """Object root with the top-level fields; ``current`` an object holding
    a time and every requested variable."""
    return [_http_ok(),
            Q.Rule("weather_fields", J.holds(_body(body), WEATHER_FIELDS)),
            Q.Rule("current_variables", J.holds(_body(body), WEATHER_CURRENT, "$.current"))]


def holidays_contract(body: Column | None = None, region: str = HOLIDAY_REGION) -> list[Q.Rule]:
    """Region object present with a non-empty ``events`` array whose every
    event has a title and a date."""
    return [_http_ok(),
            Q.Rule("region_present", J.holds(_body(body), [region])),
            Q.Rule("events_with_fields", J.array_of(_body(body), HOLIDAY_EVENT_FIELDS, f"$['{region}'].events"))]


def line_status_rules() -> list[Q.Rule]:
    return Q.not_null("request_id", "line_id", "line_name", "snapshot_at", "status_severity")


def stop_point_rules() -> list[Q.Rule]:
    return [
        *Q.not_null("request_id", "stop_point_id", "common_name", "snapshot_at"),
        Q.Rule("latitude_valid", F.col("latitude").between(-90, 90)),
        Q.Rule("longitude_valid", F.col("longitude").between(-180, 180)),
    ]


def arrival_rules() -> list[Q.Rule]:
    return [
        *Q.not_null("request_id", "arrival_id", "line_id", "station_name", "prediction_timestamp",
                    "expected_arrival", "time_to_station_seconds", "snapshot_at"),
        Q.Rule("requested_stop_point_id_not_blank", F.col("requested_stop_point_id") != ""),
        Q.non_negative("time_to_station_seconds"),
    ]


def weather_rules() -> list[Q.Rule]:
    """Request, times and place are needed, and every measure with a range must
    have a value in it (a null measure fails)."""
    return [
        *Q.not_null("request_id", "weather_observed_at", "snapshot_at"),
        Q.Rule("latitude_valid", F.col("latitude").between(-90, 90)),
        Q.Rule("longitude_valid", F.col("longitude").between(-180, 180)),
        Q.Rule("humidity_valid", F.col("relative_humidity_pct").between(0, 100)),
        Q.Rule("cloud_cover_valid", F.col("cloud_cover_pct").between(0, 100)),
        *[Q.non_negative(c) for c in ("precipitation_mm", "rain_mm", "wind_speed_kmh", "wind_gusts_kmh")],
    ]


def holiday_rules() -> list[Q.Rule]:
    return Q.not_null("request_id", "division", "holiday_name", "holiday_date", "snapshot_at")


def fact_line_status_rules() -> list[Q.Rule]:
    return Q.not_null(
        "line_status_key", "line_key", "line_id", "snapshot_date_key", "request_id", "snapshot_at", "status_severity"
    ) + [Q.Rule("flags_differ", F.col("is_good_service") != F.col("is_disrupted"))]


def fact_arrival_rules() -> list[Q.Rule]:
    return [
        *Q.not_null("arrival_observation_key", "station_key", "line_key", "requested_station_id", "line_id",
                    "prediction_date_key", "request_id", "arrival_id", "prediction_timestamp", "expected_arrival",
                    "time_to_station_seconds", "snapshot_at"),
        Q.non_negative("time_to_station_seconds"),
    ]


def fact_weather_rules() -> list[Q.Rule]:
    """Place, temperature and humidity are needed; the other measures may be
    missing but not out of range."""
    return [
        *Q.not_null("weather_observation_key", "observation_date_key", "weather_observed_at", "latitude", "longitude",
                    "temperature_c", "relative_humidity_pct", "snapshot_at"),
        Q.Rule("latitude_valid", F.col("latitude").between(-90, 90)),
        Q.Rule("longitude_valid", F.col("longitude").between(-180, 180)),
        Q.Rule("humidity_valid", F.col("relative_humidity_pct").between(0, 100)),
        Q.Rule("cloud_cover_valid", F.col("cloud_cover_pct").isNull() | F.col("cloud_cover_pct").between(0, 100)),
        *[Q.non_negative(c, allow_null=True) for c in ("precipitation_mm", "rain_mm", "wind_speed_kmh", "wind_gusts_kmh")],
    ]


def current_status_rules() -> list[Q.Rule]:
    return Q.not_null("line_key", "line_id", "line_name", "status_severity", "status_snapshot_at_utc", "is_good_service", "is_disrupted")


def arrival_summary_rules() -> list[Q.Rule]:
    return [
        *Q.not_null("station_key", "line_key", "station_id", "station_name", "line_id", "line_name", "latest_prediction_timestamp_utc"),
        Q.Rule("arrival_observations_positive", F.col("arrival_observations").isNull() | (F.col("arrival_observations") > 0)),
        *[Q.non_negative(c, allow_null=True) for c in ("distinct_vehicles", "avg_eta_seconds", "min_eta_seconds", "max_eta_seconds")],
    ]


def dim_date_rules() -> list[Q.Rule]:
    """Calendar cross-field checks: keys present, weekend flag agrees with
    the day name."""
    return [
        *Q.not_null("date_key", "calendar_date"),
        Q.Rule("weekend_matches_day_name", F.col("is_weekend") == F.col("day_name").isin("Saturday", "Sunday")),
    ]


def daily_kpi_rules() -> list[Q.Rule]:
    """Counts and rates within their bounds; a missing measure passes."""
    def at_most(part: str, whole: str) -> Q.Rule:
        return Q.Rule(f"{part}_at_most_{whole}", F.coalesce(F.col(part) <= F.col(whole), F.lit(True)))

    return [
        *Q.not_null("date_key", "calendar_date"),
        at_most("disrupted_line_snapshots", "line_snapshots"),
        at_most("good_service_line_snapshots", "line_snapshots"),
        Q.Rule("rate_in_range", F.col("disruption_rate_pct").isNull() | F.col("disruption_rate_pct").between(0, 100)),
        *[Q.non_negative(c, allow_null=True) for c in ("line_snapshots", "arrival_observations", "distinct_vehicles", "stations_observed",
                                                       "avg_eta_seconds", "total_precipitation_mm", "max_wind_gust_kmh")],
    ]


# ---------------------------------------------------------------------------
# Silver keys
# ---------------------------------------------------------------------------


#: Keys that are hashes of other columns of their table.
KEY_PARTS = {"line_status_key": (["request_id", "line_id", "status_id"], NULL_MARKER), "arrival_observation_key": (["request_id", "arrival_id"], None),
             "station_line_key": (["station_key", "line_key"], NULL_MARKER)}


def _derived(key: str) -> Column:
    parts, null_marker = KEY_PARTS[key]
    return hash_key(*parts, null_marker=null_marker)


def folded(df: DataFrame, key: str) -> DataFrame:
    """A table as it is stored and shuffled: without the hashes that its columns give."""
    return df.withColumn(key, fold_key(key, _derived(key)))


def unfolded(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, unfold_key(key, _derived(key)))


def with_line_status_key(df: DataFrame) -> DataFrame:
    """request || line || status id, a null status id as 'NULL'."""
    return df.withColumn("line_status_key", _derived("line_status_key"))


def with_arrival_key(df: DataFrame) -> DataFrame:
    return df.withColumn("arrival_observation_key", _derived("arrival_observation_key"))


def with_weather_key(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "weather_observation_key", hash_key("latitude", "longitude", "weather_observed_at", null_marker=None)
    )


def with_holiday_key(df: DataFrame) -> DataFrame:
    return df.withColumn("holiday_key", hash_key("division", "holiday_date", "holiday_name", null_marker=None))


def latest_holidays(df: DataFrame) -> DataFrame:
    """Newest snapshot's version of each holiday (tie-broken by request)."""
    return latest_per_key(with_holiday_key(df), ["holiday_key"], "snapshot_at", ["request_id"])


def latest_weather(df: DataFrame) -> DataFrame:
    """Newest request's reading per observation key (the reference sorts and
    then drops duplicates, which keeps an arbitrary one)."""
    return latest_per_key(with_weather_key(df), ["weather_observation_key"], "snapshot_at", ["request_id"])


# ---------------------------------------------------------------------------
# Dimension sources
# ---------------------------------------------------------------------------

LINE_ATTRS = ["line_name", "mode_name", "is_active"]
STATION_ATTRS = ["station_name", "latitude", "longitude", "stop_type", "modes_text", "is_active"]


def prepare_line_source(silver: DataFrame) -> DataFrame:
    """Lines at the latest snapshot, one row each, with first_seen_at."""
    latest = rows_at_latest(silver.select("line_id", "line_name", "mode_name", "snapshot_at"), "snapshot_at")
    one = latest.filter(F.col("line_id").isNotNull()).withColumn("is_active", F.lit(True))
    one = canonical_per_key(one, ["line_id"], F.lit(True), ["line_name", "mode_name"])
    first = silver.filter(F.col("line_id").isNotNull()).groupBy("line_id").agg(F.min("snapshot_at").alias("first_seen_at"))
    return with_attribute_hash(one.join(first, on="line_id", how="left"), LINE_ATTRS)


def prepare_station_source(silver_stops: DataFrame) -> DataFrame:
    """Stations (station NaPTAN) at the latest snapshot: the stop point whose
    id equals the station id, else the smallest stop point id; modes sorted
    so their order never creates a version."""
    latest = rows_at_latest(silver_stops, "snapshot_at").filter(
        F.col("station_naptan").isNotNull() & (F.trim("station_naptan") != "")
    )
    latest = latest.withColumn("modes", F.sort_array("modes"))
    pick = canonical_per_key(
        latest.select("station_naptan", "stop_point_id", "common_name", "latitude", "longitude", "stop_type", "modes", "snapshot_at"),
        ["station_naptan"],
        F.col("stop_point_id") == F.col("station_naptan"),
        ["stop_point_id"],
    )
    out = pick.select(
        F.col("station_naptan").alias("station_id"),
        F.col("stop_point_id").alias("representative_stop_point_id"),
        F.col("common_name").alias("station_name"),
        "latitude", "longitude", "stop_type", "modes", "snapshot_at",
        F.lit(True).alias("is_active"),
        array_text("modes").alias("modes_text"),
    )
    first = (
        silver_stops.filter(F.col("station_naptan").isNotNull())
        .groupBy(F.col("station_naptan").alias("station_id"))
        .agg(F.min("snapshot_at").alias("first_seen_at"))
    )
    return with_attribute_hash(out.join(first, on="station_id", how="left"), STATION_ATTRS)


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------


def build_fact_line_status(silver: DataFrame, dim_line: DataFrame, dim_date: DataFrame, strategy: str = "auto", stored=lambda df: df) -> DataFrame:
    """Status observations joined to the line version valid at the snapshot
    time and to the London calendar day.  ``stored``: writes the table, its key
    folded, and reads it."""
    src = folded(with_line_status_key(silver), "line_status_key").withColumn("snapshot_date_key", local_date_key("snapshot_at"))
    versions = dim_line.select("line_id", "line_key", "effective_from", "effective_to")
    j = as_of_join(src, versions, ["line_id"], "snapshot_at", strategy=strategy)
    j = j.join(F.broadcast(dim_date.select(F.col("date_key").alias("snapshot_date_key"))), on="snapshot_date_key", how="left_semi")
    return unfolded(stored(j.select(
        "line_status_key", "line_key", "line_id", "snapshot_date_key", "request_id", "snapshot_at",
        "status_id", "status_severity", "status_description", "status_reason", "status_created_at",
        is_good_service("status_severity").alias("is_good_service"),
        is_disrupted("status_severity").alias("is_disrupted"),
        "source",
    )), "line_status_key")


#: Columns of a silver arrival that its fact has too.
ARRIVAL_COLUMNS = ["request_id", "arrival_id", "vehicle_id", "naptan_id", "station_name", "line_name", "platform_name", "direction", "destination_naptan_id",
                   "destination_name", "prediction_timestamp", "expected_arrival", "time_to_station_seconds", "current_location", "towards", "mode_name",
                   "snapshot_at", "source"]


def build_fact_arrival(silver: DataFrame, dim_station: DataFrame, dim_line: DataFrame, dim_date: DataFrame,
                       strategy: str = "auto", stored=lambda df: df) -> DataFrame:
    """Arrival predictions joined to the station and line versions valid at
    the prediction time, then to the London calendar day.  Rows travel with what the
    fact needs and their key folded; ``stored`` writes the table so, and reads it."""
    src = folded(silver.select("arrival_observation_key", "requested_stop_point_id", "line_id", *ARRIVAL_COLUMNS), "arrival_observation_key")
    src = src.withColumn("prediction_date_key", local_date_key("prediction_timestamp"))
    st = dim_station.select(
        F.col("station_id").alias("requested_stop_point_id"), "station_key",
        F.col("effective_from").alias("st_from"), F.col("effective_to").alias("st_to"),
    )
    j = as_of_join(src, st, ["requested_stop_point_id"], "prediction_timestamp", "st_from", "st_to", strategy=strategy)
    ln = dim_line.select("line_id", "line_key", F.col("effective_from").alias("ln_from"), F.col("effective_to").alias("ln_to"))
    j = as_of_join(j.drop("st_from", "st_to"), ln, ["line_id"], "prediction_timestamp", "ln_from", "ln_to", strategy=strategy)
    j = j.join(F.broadcast(dim_date.select(F.col("date_key").alias("prediction_date_key"))), on="prediction_date_key", how="left_semi")
    return unfolded(stored(j.select(
        "arrival_observation_key", "station_key", "line_key",
        F.col("requested_stop_point_id").alias("requested_station_id"), "line_id", "prediction_date_key", *ARRIVAL_COLUMNS)), "arrival_observation_key")


def build_fact_weather(silver: DataFrame, dim_date: DataFrame) -> DataFrame:
    src = silver.withColumn("observation_date_key", local_date_key("weather_observed_at"))
    j = src.join(F.broadcast(dim_date.select(F.col("date_key").alias("observation_date_key"))), on="observation_date_key", how="left_semi")
    return j.select(
        "weather_observation_key", "observation_date_key", "weather_observed_at", "weather_observed_at_local",
        "latitude", "longitude", "weather_timezone", "utc_offset_seconds", "temperature_c", "relative_humidity_pct",
        "precipitation_mm", "rain_mm", "weather_code", "weather_description", "cloud_cover_pct", "wind_speed_kmh",
        "wind_gusts_kmh", "measurement_interval_seconds", "snapshot_at", "source",
    )


# ---------------------------------------------------------------------------
# Serving
# ---------------------------------------------------------------------------


def build_current_line_status(fact: DataFrame, dim_line: DataFrame) -> DataFrame:
    state = S.latest_state(
        fact, key="line_id", ts="snapshot_at", severity="status_severity", description="status_description",
        reason="status_reason", flag=F.col("is_disrupted"), request="request_id",
    )
    current = dim_line.filter(F.col("is_current")).select("line_key", "line_id", "line_name", "mode_name")
    return S.current_state_for_members(current, state, "line_id").select(
        "line_key", "line_id", "line_name", "mode_name", "status_severity", "status_description", "status_reason",
        "is_good_service", "is_disrupted", "status_record_count", "status_snapshot_at_utc",
        "status_snapshot_at_local", "request_id",
    )


def build_station_arrival_summary(fact: DataFrame, dim_station: DataFrame, dim_line: DataFrame,
                                  tz: str = LOCAL_TZ, by_business_key: bool = False) -> DataFrame:
    """Latest London day per station x line, restricted to current versions.

    Default: grouped by the facts' version keys, so on a day an entity
    changes, its observations of the older version drop out (the reference
    behaviour).  ``by_business_key=True`` groups by station and line ids and
    attaches the current version, keeping every observation of the day.
    """
    day = S.latest_local_day(fact, "prediction_timestamp", tz)
    if by_business_key:
        cur_st = dim_station.filter(F.col("is_current")).select(
            F.col("station_id").alias("requested_station_id"), F.col("station_key").alias("_cur_station_key"))
        cur_ln = dim_line.filter(F.col("is_current")).select("line_id", F.col("line_key").alias("_cur_line_key"))
        day = (day.join(cur_st, on="requested_station_id", how="inner").join(cur_ln, on="line_id", how="inner")
               .withColumn("station_key", F.col("_cur_station_key")).withColumn("line_key", F.col("_cur_line_key"))
               .drop("_cur_station_key", "_cur_line_key"))
    agg = day.groupBy("station_key", "line_key", "requested_station_id", "line_id").agg(
        F.count(F.lit(1)).alias("arrival_observations"),
        F.count_distinct("vehicle_id").alias("distinct_vehicles"),
        S.round_half_up(F.avg("time_to_station_seconds"), 1).alias("avg_eta_seconds"),
        F.min("time_to_station_seconds").alias("min_eta_seconds"),
        F.max("time_to_station_seconds").alias("max_eta_seconds"),
        F.min("expected_arrival").alias("next_expected_arrival_utc"),
        F.max("prediction_timestamp").alias("latest_prediction_timestamp_utc"),
    )
    st = dim_station.filter(F.col("is_current")).select("station_key", "station_id", "station_name", "latitude", "longitude")
    ln = dim_line.filter(F.col("is_current")).select("line_key", F.col("line_id").alias("_lid"), "line_name")
    out = agg.join(st, on="station_key", how="inner").join(ln, on="line_key", how="inner")
    return out.select(
        "station_key", "line_key", "station_id", "station_name", "latitude", "longitude",
        F.col("_lid").alias("line_id"), "line_name", "arrival_observations", "distinct_vehicles",
        "avg_eta_seconds", "min_eta_seconds", "max_eta_seconds",
        "next_expected_arrival_utc", to_local("next_expected_arrival_utc", tz).alias("next_expected_arrival_local"),
        "latest_prediction_timestamp_utc",
        to_local("latest_prediction_timestamp_utc", tz).alias("latest_prediction_timestamp_local"),
    )


DATE_COLS = ["date_key", "calendar_date", "year", "quarter", "month", "month_name", "day_of_week", "day_name",
             "is_weekend", "is_bank_holiday", "holiday_name"]
COUNT_COLS = ["line_snapshots", "distinct_lines_observed", "disrupted_line_snapshots", "good_service_line_snapshots",
              "arrival_observations", "distinct_vehicles", "stations_observed", "weather_observations"]


def build_daily_network_kpis(line_status: DataFrame, arrivals: DataFrame, weather: DataFrame, dim_date: DataFrame) -> DataFrame:
    line_daily = S.snapshot_rollup(line_status, "snapshot_date_key", "line_id", "snapshot_at", F.col("is_disrupted"))
    arrival_daily = arrivals.groupBy(F.col("prediction_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("arrival_observations"),
        F.count_distinct("vehicle_id").alias("distinct_vehicles"),
        S.round_half_up(F.avg("time_to_station_seconds"), 1).alias("avg_eta_seconds"),
    )
    # The days of each station, and not each pair of them, are shuffled with its key.
    days = arrivals.where(F.col("station_key").isNotNull()).groupBy("station_key").agg(F.collect_set("prediction_date_key").alias("_days"))
    stations_daily = days.select(F.explode("_days").alias("date_key")).groupBy("date_key").agg(F.count(F.lit(1)).alias("stations_observed"))
    weather_daily = weather.groupBy(F.col("observation_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("weather_observations"),
        S.round_half_up(F.avg("temperature_c"), 2).alias("avg_temperature_c"),
        S.round_half_up(F.min("temperature_c"), 2).alias("min_temperature_c"),
        S.round_half_up(F.max("temperature_c"), 2).alias("max_temperature_c"),
        S.round_half_up(F.avg("relative_humidity_pct"), 2).alias("avg_relative_humidity_pct"),
        S.round_half_up(F.sum("precipitation_mm"), 2).alias("total_precipitation_mm"),
        S.round_half_up(F.max("wind_gusts_kmh"), 2).alias("max_wind_gust_kmh"),
    )
    out = S.combine_daily([line_daily, arrival_daily, stations_daily, weather_daily], dim_date, DATE_COLS, COUNT_COLS)
    order = [c for c in out.columns if c != "stations_observed"]
    order.insert(order.index("avg_eta_seconds"), "stations_observed")
    return out.select(*order)

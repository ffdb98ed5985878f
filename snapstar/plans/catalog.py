"""Queries over the driver tables, one per operator family.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in :mod:`snapstar.plans.oracle` under the same key with the
same column names.  Every query reads whole tables.

How the driver tables stand in for the snapshot model:

* ``events`` are polled observations of an entity (``user_id``) at ``ts``;
  ``props.k`` carries a status code; hourly buckets are snapshots and weekly
  cut-offs are full-state reference snapshots for SCD2.
* ``customer`` is the entity dimension (``c_custkey`` = ``user_id``).
* ``orders`` / ``lineitem`` are parent / child payloads (explode), merge
  loads (split by order date), and two more daily KPI domains.
* ``supplier`` / ``part`` / ``lineitem`` form the station-line bridge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from snapstar.functions import json as J
from snapstar.functions import labels as L
from snapstar.functions.keys import attribute_hash, hash_key
from snapstar.functions.time import local_date, local_date_key, to_local
from snapstar.operators import audit as A
from snapstar.operators import quality as Q
from snapstar.operators.asof import as_of_join
from snapstar.operators.dedup import canonical_per_key, latest_per_key, rows_at_latest
from snapstar.operators.scd2 import (
    apply_changes,
    classify,
    initial_versions,
    prepare_source,
    versions_from_snapshots,
)
from snapstar.plans import dims as D
from snapstar.plans import reports as R
from snapstar.plans import serving as S
from snapstar.session import ensure_utc
from snapstar.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Fixed values of the driver-table mapping.
#   status code of an event: props.k mod 12 (10 = good service)
#   status text of an event type: view "Good Service", click "Minor Delays",
#     purchase "Part Suspended", signup "Special Service", error "Severe Delays"
#   holidays: order dates with a pending ('P') order of priority
#     '1-URGENT' or '2-HIGH'; the priorities are the holiday names
#   bridge scope: part types STANDARD, PROMO, ECONOMY
#   merge loads: first load orders before 1999-01-01, second load orders from
#     1997-01-01 on, in which open ('O') orders have become 'F'
#   configured calendar of the daily KPI table: 1990-01-01 .. 2035-12-31
# ---------------------------------------------------------------------------
STATUS_MOD = 12
EVENT_TEXT = {
    "view": "Good Service",
    "click": "Minor Delays",
    "purchase": "Part Suspended",
    "signup": "Special Service",
    "error": "Severe Delays",
}
HOLIDAY_STATUS = "P"
HOLIDAY_PRIORITIES = ("1-URGENT", "2-HIGH")
BRIDGE_PART_TYPES = ("STANDARD", "PROMO", "ECONOMY")
FIRST_LOAD_BEFORE = "1999-01-01"
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2035-12-31"
SECOND_LOAD_FROM = "1997-01-01"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def finish(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (UTC wall clock) so collected values do not
    depend on the client's zone."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _k() -> Column:
    return F.from_json(F.col("props"), "k INT").getField("k")


def _status_code() -> Column:
    return (_k() % STATUS_MOD).cast("int")


def _event_text() -> Column:
    expr = None
    for et, text in EVENT_TEXT.items():
        expr = F.when(F.col("event_type") == et, text) if expr is None else expr.when(F.col("event_type") == et, text)
    return expr


def _snapshot_hour() -> Column:
    return F.date_trunc("hour", F.col("ts")).cast("timestamp")


# ---------------------------------------------------------------------------
# Parse and flatten
# ---------------------------------------------------------------------------


def parse_json_props(spark, sf):
    ev = _t(spark, sf, "events")
    return finish(ev.select("event_id", "user_id", "event_type", _k().alias("k")))


LINE_SCHEMA = (
    "order_id BIGINT, status STRING, lines ARRAY<STRUCT<line_number: INT, part_id: BIGINT, "
    "supplier_id: BIGINT, quantity: DOUBLE, extended_price: DOUBLE>>"
)


def order_payloads(spark, sf) -> DataFrame:
    """Bronze-like rows: one JSON document per order.

    Each document nests all lines of the order in a ``lines`` array (the key of
    the child table bounds it); an order without children gets a document with no
    ``lines`` member.
    """
    li = _t(spark, sf, "lineitem")
    od = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    child = F.struct(
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extended_price"),
    )
    lines = li.groupBy("l_orderkey").agg(F.collect_list(child).alias("lines"))
    docs = od.join(lines, od["o_orderkey"] == lines["l_orderkey"], "left")
    return docs.select(
        F.to_json(
            F.struct(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), "lines")
        ).alias("payload")
    )


def _flatten(spark, sf, outer: bool) -> DataFrame:
    parsed = order_payloads(spark, sf).select(F.from_json("payload", LINE_SCHEMA).alias("p"))
    gen = F.explode_outer if outer else F.explode
    rows = parsed.select(F.col("p.order_id").alias("order_id"), F.col("p.status").alias("status"), gen("p.lines").alias("l"))
    return rows.select(
        "order_id", "status",
        F.col("l.line_number").alias("line_number"),
        F.col("l.part_id").alias("part_id"),
        F.col("l.supplier_id").alias("supplier_id"),
        F.col("l.quantity").alias("quantity"),
        F.col("l.extended_price").alias("extended_price"),
    )


def explode_children(spark, sf):
    return _flatten(spark, sf, outer=False)


def explode_outer_children(spark, sf):
    return _flatten(spark, sf, outer=True)


def payload_contract(spark, sf):
    ev = J.with_body(_t(spark, sf, "events").select("event_type", "props"), "props")
    # One look at each payload: keyed objects, and the value of the key.
    seen = ev.select("event_type", J.is_object(J.BODY).alias("object"), J.holds(J.BODY, ["k"]).alias("with_k"),
                     F.try_variant_get(J.BODY, "$.k", "int").isNotNull().alias("number"))
    return seen.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("payloads"),
        F.count_if("object").alias("object_roots"),
        F.count_if("with_k").alias("with_k"),
        F.count_if(F.col("object") & F.col("with_k") & F.col("number")).alias("valid_payloads"),
    )


URL_HOST = r"^https?://([^/?#]+)"
URL_LANG = r"^https?://[^/?#]+/([a-z]{2})/"
URL_ID = r"^https?://[^/?#]+/[a-z]{2}/([0-9]+)"


def endpoint_id_extract(spark, sf):
    pg = _t(spark, sf, "pages")
    return pg.select(
        "page_id",
        F.regexp_extract("url", URL_HOST, 1).alias("host"),
        F.regexp_extract("url", URL_LANG, 1).alias("lang"),
        F.nullif(F.regexp_extract("url", URL_ID, 1), F.lit("")).cast("bigint").alias("item_id"),
    )


# ---------------------------------------------------------------------------
# Expressions
# ---------------------------------------------------------------------------


def local_date_dst(spark, sf):
    od = _t(spark, sf, "orders")
    utc = (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(30))).cast("timestamp")
    t = od.select("o_orderkey", utc.alias("event_at_utc"))
    return finish(
        t.select(
            "o_orderkey",
            "event_at_utc",
            to_local("event_at_utc").alias("event_at_local"),
            local_date("event_at_utc").alias("local_date"),
            local_date_key("event_at_utc").alias("local_date_key"),
            (local_date("event_at_utc") != F.to_date("event_at_utc")).alias("next_day"),
        )
    )


def code_labels(spark, sf):
    pt = _t(spark, sf, "part")
    price_code = F.floor("p_retailprice").cast("bigint") % 100
    return pt.select(
        "p_partkey",
        "p_size",
        L.code_label("p_size").alias("size_label"),
        price_code.alias("price_code"),
        L.code_label(price_code).alias("price_label"),
    )


def severity_label(spark, sf):
    ev = _t(spark, sf, "events")
    t = ev.select("event_id", _status_code().alias("severity"), _event_text().alias("description"))
    return t.select(
        "event_id", "severity", "description",
        L.is_good_service("severity").alias("is_good_service"),
        L.is_disrupted("severity").alias("is_disrupted"),
        L.service_state("severity", "description").alias("service_state"),
    )


def reason_sentences(spark, sf):
    docs = _t(spark, sf, "documents")
    cleaned = docs.select("doc_id", L.clean_reason("text").alias("reason"))
    parts = cleaned.select("doc_id", F.posexplode(L.sentences("reason")).alias("pos", "sentence"))
    return parts.select("doc_id", (F.col("pos") + 1).cast("int").alias("sentence_no"), "sentence")


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------


def lineitem_rules() -> list[Q.Rule]:
    return [
        *Q.not_null("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"),
        Q.between("l_quantity", 1, 50, "l_quantity_in_range"),
        Q.between("l_discount", 0.0, 0.1, "l_discount_in_range"),
        Q.between("l_tax", 0.0, 0.08, "l_tax_in_range"),
        Q.Rule("l_extendedprice_positive", F.col("l_extendedprice") > 0),
        Q.Rule("l_returnflag_known", F.col("l_returnflag").isin("A", "N", "R")),
        Q.Rule("l_linestatus_known", F.col("l_linestatus").isin("O", "F")),
        Q.Rule("returned_line_closed", (F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F")),
    ]


_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def quality_valid(spark, sf):
    valid, _ = Q.split(_t(spark, sf, "lineitem"), lineitem_rules())
    return valid.select(*_LI_COLS)


def quality_invalid(spark, sf):
    _, invalid = Q.split(_t(spark, sf, "lineitem"), lineitem_rules())
    return invalid.select(*_LI_COLS, F.array_join(Q.FAILED, ",").alias("failed_rules"))


def quality_profile(spark, sf):
    """Rule failures and null counts in one aggregate (one scan)."""
    li = _t(spark, sf, "lineitem")
    return Q.rule_counts(li, lineitem_rules(), extra_null_cols=["l_quantity", "l_discount", "l_shipdate", "l_returnflag"])


# ---------------------------------------------------------------------------
# Keys and dedup
# ---------------------------------------------------------------------------


def hash_keys(spark, sf):
    od = _t(spark, sf, "orders")
    return od.select(
        "o_orderkey",
        hash_key("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("order_hash"),
        attribute_hash("o_orderstatus", "o_orderpriority").alias("attribute_hash"),
    )


def latest_per_key_q(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return finish(latest_per_key(ev, ["user_id"], "ts", ["event_id"]))


def canonical_per_key_q(spark, sf):
    su = _t(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_name", "s_acctbal")
    return canonical_per_key(su, ["s_nationkey"], F.col("s_suppkey") == F.col("s_nationkey"), ["s_suppkey"])


def latest_snapshot_rows(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", _snapshot_hour().alias("snapshot_at"))
    return finish(rows_at_latest(ev, "snapshot_at"))


def _status_facts(spark, sf) -> DataFrame:
    ev = _t(spark, sf, "events")
    return ev.select(
        "user_id", "event_id", "event_type",
        _snapshot_hour().alias("snapshot_at"),
        _status_code().alias("severity"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("code "), _k().cast("string"))).alias("reason"),
    )


def latest_state_rollup(spark, sf):
    facts = _status_facts(spark, sf)
    state = S.latest_state(
        facts, key="user_id", ts="snapshot_at", severity="severity", description="event_type",
        reason="reason", flag=L.is_disrupted("severity"), request="event_id",
    )
    members = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return finish(S.current_state_for_members(members, state, "user_id"))


# ---------------------------------------------------------------------------
# Calendar
# ---------------------------------------------------------------------------


def _order_bounds(spark, sf) -> DataFrame:
    return _t(spark, sf, "orders").agg(F.min("o_orderdate").alias("start_date"), F.max("o_orderdate").alias("end_date"))


def _holidays(spark, sf) -> DataFrame:
    od = _t(spark, sf, "orders")
    h = od.filter((F.col("o_orderstatus") == HOLIDAY_STATUS) & F.col("o_orderpriority").isin(*HOLIDAY_PRIORITIES))
    return h.select(F.col("o_orderdate").cast("date").alias("holiday_date"), F.col("o_orderpriority").alias("holiday_name"))


def dim_date_q(spark, sf):
    return D.calendar_from_bounds(_order_bounds(spark, sf))


def dim_date_holidays(spark, sf):
    cal = D.enrich_with_holidays(D.calendar_from_bounds(_order_bounds(spark, sf)), _holidays(spark, sf))
    return cal.select("date_key", "calendar_date", "day_name", "is_weekend", "is_bank_holiday", "holiday_name")


# ---------------------------------------------------------------------------
# SCD2 over weekly full-state snapshots of events
# ---------------------------------------------------------------------------


def weekly_states(spark, sf) -> DataFrame:
    """State of every user at each weekly cut-off: its last event type so far.

    Week ``w`` holds events in ``[start + 7(w-1), start + 7w)``; the state at
    cut-off ``i`` is the newest event with ``w <= i``.

    * newest event per (user, week): a combining aggregate (a hot user is
      reduced map-side);
    * each active week is valid until the user's next active week: ``lead``
      over the user's active weeks - at most one row per week, so bounded by
      the time span, not by the data;
    * the row is repeated for the cut-offs it covers, so every (user, cut-off)
      of the full-state output is produced exactly once.
    """
    ev = _t(spark, sf, "events")
    start = ev.select(F.date_trunc("week", F.min("ts"))).scalar()
    w = (F.floor(F.datediff(F.col("ts"), start) / 7) + 1).cast("int")
    weekly = ev.select("user_id", "ts", "event_id", "event_type", w.alias("w"))
    n = weekly.select(F.max("w")).scalar()
    per_week = latest_per_key(weekly, ["user_id", "w"], "ts", ["event_id"])
    nxt = F.lead("w").over(Window.partitionBy("user_id").orderBy("w"))
    until = F.coalesce(nxt - 1, n)
    spans = per_week.select("user_id", "event_type", "w", until.alias("until"))
    state = spans.select("user_id", "event_type", F.explode(F.sequence("w", "until")).alias("i"))
    snap_at = (start.cast("timestamp") + F.make_dt_interval(F.col("i") * 7)).cast("timestamp")
    return state.select("user_id", "i", "event_type", snap_at.alias("snapshot_at"))


def scd2_bulk(spark, sf):
    st = weekly_states(spark, sf)
    v = versions_from_snapshots(st, ["user_id"], ["event_type"], "snapshot_at")
    return finish(v)


def scd2_incremental(spark, sf):
    """Incremental build, one step per weekly cut-off; each step writes the
    complete next state (staged in the shared folder), as the dimension
    table is rewritten once per run."""
    st = T.stage(weekly_states(spark, sf), "weekly_states")
    n = st.agg(F.max("i")).first()[0]
    dim = None
    for i in range(1, n + 1):
        upto = st.filter(F.col("i") <= i)
        src = prepare_source(upto, ["user_id"], ["event_type"], "snapshot_at")
        if dim is None:
            dim = initial_versions(src, ["user_id"], ["event_type"])
        else:
            dim = apply_changes(dim, src, ["user_id"], ["event_type"], "snapshot_at", missing="keep", new_from="first_seen")
        dim = T.stage(dim, f"dim_step_{i}")
    return finish(dim)


def scd2_classify(spark, sf):
    st = weekly_states(spark, sf)
    n = st.select(F.max("i")).scalar()
    before = st.filter(F.col("i") == n - 1)
    after = st.filter(F.col("i") == n)
    dim = initial_versions(prepare_source(before, ["user_id"], ["event_type"], "snapshot_at"), ["user_id"], ["event_type"])
    src = prepare_source(after, ["user_id"], ["event_type"], "snapshot_at")
    return classify(src, dim, ["user_id"]).groupBy("change_type").agg(F.count(F.lit(1)).alias("keys"))


def event_versions(spark, sf) -> DataFrame:
    """Versions of each user's event type at event level (a version starts
    whenever the type differs from the user's previous event)."""
    ev = _t(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return versions_from_snapshots(ev, ["user_id"], ["event_type"], "ts")


def as_of_join_q(spark, sf, strategy: str = "auto"):
    versions = event_versions(spark, sf).select(
        "user_id", "version_key", F.col("event_type").alias("version_event_type"), "effective_from", "effective_to"
    )
    facts = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    j = as_of_join(facts, versions, ["user_id"], "ts", strategy=strategy)
    return finish(j.drop("effective_to"))


# ---------------------------------------------------------------------------
# Bridge and name resolution
# ---------------------------------------------------------------------------


def _bridge(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    stations = _t(spark, sf, "supplier").select("s_suppkey").withColumn("station_key", hash_key("s_suppkey"))
    lines = D.in_scope(_t(spark, sf, "part"), "p_type", BRIDGE_PART_TYPES).select("p_partkey").withColumn(
        "line_key", hash_key("p_partkey")
    )
    rel = li.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    return D.bridge_pairs(rel, stations, lines, "s_suppkey", "p_partkey", "station_key", "line_key", "station_line_key")


def bridge_pairs_q(spark, sf):
    return _bridge(spark, sf)


def bridge_coverage(spark, sf):
    li = _t(spark, sf, "lineitem")
    scope = D.in_scope(_t(spark, sf, "part"), "p_type", BRIDGE_PART_TYPES).select(F.col("p_partkey").alias("l_partkey"))
    pairs = li.select("l_suppkey", "l_partkey").distinct().join(scope, on="l_partkey", how="left_semi")
    bridge = _bridge(spark, sf).select(F.col("s_suppkey").alias("l_suppkey"), F.col("p_partkey").alias("l_partkey"))
    checks = [
        A.row_count("in_scope_pairs", pairs),
        A.row_count("bridged_pairs", bridge),
        A.set_difference("missing_pairs", pairs, bridge, ["l_suppkey", "l_partkey"]),
        A.duplicate_keys("duplicate_pairs", bridge, ["l_suppkey", "l_partkey"]),
    ]
    return A.suite(checks)


def name_resolution(spark, sf):
    names = _t(spark, sf, "nation").select("n_name", "n_nationkey")
    su = _t(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    cand = su.join(names, on="n_nationkey", how="inner").select("n_name", "s_suppkey")
    return D.resolve_names(names, cand, "n_name", "s_suppkey")


# ---------------------------------------------------------------------------
# Facts and serving
# ---------------------------------------------------------------------------


def fact_star(spark, sf):
    li = _t(spark, sf, "lineitem")
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # customer grows with the data, so no broadcast hint: AQE switches to a
    # broadcast join only when the runtime size of that side is small.
    f = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner").join(
        cu, F.col("o_custkey") == F.col("c_custkey"), "inner"
    )
    return f.select(
        hash_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("fact_key"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "c_nationkey",
        local_date_key("l_shipdate").alias("ship_date_key"),
        local_date_key("o_orderdate").alias("order_date_key"),
        "l_extendedprice",
    )


def latest_day_summary_q(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "event_type", "ts", "value", _k().alias("k"))
    summary = S.latest_day_summary(ev, ["user_id", "event_type"], "ts", entity="k", measure="value", expected="ts")
    members = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return finish(summary.join(members, on="user_id", how="inner"))


DAILY_CALENDAR_COLS = [
    "date_key", "calendar_date", "year", "quarter", "month", "month_name",
    "day_of_week", "day_name", "is_weekend", "is_bank_holiday", "holiday_name",
]
DAILY_COUNT_COLS = [
    "line_snapshots", "distinct_lines_observed", "disrupted_line_snapshots", "good_service_line_snapshots",
    "arrival_observations", "distinct_vehicles", "stations_observed", "weather_observations",
]


def daily_kpis(spark, sf):
    """Three domains aggregated apart (events = status snapshots, lineitem =
    arrivals, orders = weather-like readings), joined on the union of their
    active dates, with selective zero-fill."""
    ev = _t(spark, sf, "events")
    status = ev.select(
        "user_id",
        _snapshot_hour().alias("snapshot_at"),
        local_date_key(_snapshot_hour()).alias("snapshot_date_key"),
        L.is_disrupted(_status_code()).alias("is_disrupted"),
    )
    line_daily = S.snapshot_rollup(status, "snapshot_date_key", "user_id", "snapshot_at", F.col("is_disrupted"))

    li = _t(spark, sf, "lineitem")
    arrival_daily = li.groupBy(local_date_key("l_shipdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("arrival_observations"),
        F.count_distinct("l_partkey").alias("distinct_vehicles"),
        F.count_distinct("l_suppkey").alias("stations_observed"),
        S.round_half_up(F.avg("l_quantity"), 1).alias("avg_eta_seconds"),
    )

    od = _t(spark, sf, "orders")
    temp = F.col("o_totalprice") / 10000.0
    weather_daily = od.groupBy(local_date_key("o_orderdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("weather_observations"),
        S.round_half_up(F.avg(temp), 2).alias("avg_temperature_c"),
        S.round_half_up(F.min(temp), 2).alias("min_temperature_c"),
        S.round_half_up(F.max(temp), 2).alias("max_temperature_c"),
        S.round_half_up(F.avg(F.col("o_custkey") % 100), 2).alias("avg_relative_humidity_pct"),
        S.round_half_up(F.sum(F.col("o_totalprice") / 100000.0), 2).alias("total_precipitation_mm"),
        S.round_half_up(F.max(temp), 2).alias("max_wind_gust_kmh"),
    )

    cal = D.enrich_with_holidays(D.calendar(spark, CALENDAR_START, CALENDAR_END), _holidays(spark, sf))
    return S.combine_daily([line_daily, arrival_daily, weather_daily], cal, DAILY_CALENDAR_COLS, DAILY_COUNT_COLS)


# ---------------------------------------------------------------------------
# Merges
# ---------------------------------------------------------------------------


def _loads(spark, sf) -> tuple[DataFrame, DataFrame]:
    od = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    first = od.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    second = od.filter(F.col("o_orderdate") >= F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", F.lit("F")).otherwise(F.col("o_orderstatus"))
    )
    return first, second


def merge_insert_only(spark, sf):
    first, second = _loads(spark, sf)
    return finish(T.insert_only_frame(first, second, ["o_orderkey"]))


def merge_upsert(spark, sf):
    first, second = _loads(spark, sf)
    return finish(T.upsert_frame(first, second, ["o_orderkey"]))


def expire_rows(spark, sf):
    first, second = _loads(spark, sf)
    dim = first.select(
        "o_orderkey", "o_orderstatus",
        F.col("o_orderdate").cast("timestamp").alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    changed = second.alias("s").join(
        first.alias("f"), "o_orderkey", "inner"
    ).filter(F.col("s.o_orderstatus") != F.col("f.o_orderstatus")).select("o_orderkey")
    at = second.select(F.max("o_orderdate")).scalar()
    return finish(T.expire_frame(dim, changed, ["o_orderkey"], at))


# ---------------------------------------------------------------------------
# Audit checks
# ---------------------------------------------------------------------------


def _checks(spark, sf, only: str | None = None) -> dict[str, list[DataFrame]]:
    """Audit check groups over the driver tables.  Groups are built lazily:
    a ``chk_*`` query builds only its own group (the SCD2 group stages its
    change points, which the other groups must not pay for)."""
    li = _t(spark, sf, "lineitem")
    od = _t(spark, sf, "orders")
    cu = _t(spark, sf, "customer")
    pt = _t(spark, sf, "part")
    su = _t(spark, sf, "supplier")
    cal = D.calendar_from_bounds(_order_bounds(spark, sf))

    def versions():
        return versions_from_snapshots(weekly_states(spark, sf), ["user_id"], ["event_type"], "snapshot_at")

    def dup():
        return [
            A.duplicate_keys("lineitem_duplicate_order_line", li, ["l_orderkey", "l_linenumber"]),
            A.duplicate_keys("orders_duplicate_keys", od, ["o_orderkey"]),
            A.duplicate_keys("dim_date_duplicate_keys", cal, ["date_key"]),
        ]

    def orphans():
        return [
            A.orphans("lineitem_orphan_part", li, pt, ["l_partkey"], ["p_partkey"]),
            A.orphans("lineitem_orphan_supplier", li, su, ["l_suppkey"], ["s_suppkey"]),
            A.orphans("lineitem_orphan_order", li, od, ["l_orderkey"], ["o_orderkey"]),
            A.orphans("orders_orphan_customer", od, cu, ["o_custkey"], ["c_custkey"]),
        ]

    def scd2():
        v = versions()
        return [
            A.duplicate_keys("versions_duplicate_keys", v, ["version_key"]),
            A.not_one_current("versions_not_one_current", v, ["user_id"]),
            A.version_flags(v, "versions"),
            A.overlapping_versions("versions_overlapping", v, ["user_id"]),
        ]

    def reconcile():
        fact = fact_star(spark, sf)
        return [
            A.reconcile("fact_rows_equal_lineitem", fact, li),
            A.duplicate_keys("fact_duplicate_keys", fact, ["fact_key"]),
            A.orphans("fact_orphan_order_date", fact, cal, ["order_date_key"], ["date_key"]),
        ]

    def date_sets():
        order_days = od.select(local_date_key("o_orderdate").alias("date_key"))
        return [
            A.set_difference("order_dates_missing_from_calendar", order_days, cal, ["date_key"]),
            A.set_difference("calendar_dates_without_orders", cal.select("date_key"), order_days, ["date_key"]),
            A.non_empty("dim_date_non_empty", cal),
        ]

    groups = {
        "chk_duplicate_keys": dup,
        "chk_orphans": orphans,
        "chk_scd2_integrity": scd2,
        "chk_reconcile": reconcile,
        "chk_date_sets": date_sets,
    }
    return {k: f() for k, f in groups.items() if only is None or k == only}


def _check_query(name: str) -> Query:
    def run(spark, sf):
        return A.suite(_checks(spark, sf, only=name)[name])

    run.__name__ = name
    return run


def audit_suite(spark, sf):
    return A.suite([c for group in _checks(spark, sf).values() for c in group])


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------


def _daily_orders(spark, sf) -> DataFrame:
    od = _t(spark, sf, "orders")
    return od.groupBy(F.col("o_orderdate").cast("date").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("fulfilled"),
        S.round_half_up(F.sum("o_totalprice"), 2).alias("revenue"),
    )


def network_summary(spark, sf):
    od = _t(spark, sf, "orders")
    return od.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("fulfilled_orders"),
        F.count_if(F.col("o_orderstatus") != "F").alias("open_orders"),
    ).withColumn(
        "fulfilled_pct", S.round_half_up(F.lit(100.0) * F.col("fulfilled_orders") / F.col("total_orders"), 2)
    )


def latest_kpi_row(spark, sf):
    d = _daily_orders(spark, sf)
    return d.filter(F.col("fulfilled") > 0).orderBy(F.col("order_date").desc()).limit(1)


def trend_30(spark, sf):
    d = _daily_orders(spark, sf)
    return d.orderBy(F.col("order_date").desc()).limit(30).orderBy("order_date")


def top_days(spark, sf):
    d = _daily_orders(spark, sf)
    return d.orderBy(F.col("revenue").desc(), F.col("order_date")).limit(10)


def bucket_compare(spark, sf):
    d = _daily_orders(spark, sf)
    bucket = F.when(F.col("revenue") > 1_000_000, "High").otherwise("Low")
    return d.groupBy(bucket.alias("revenue_bucket")).agg(
        F.count(F.lit(1)).alias("days"),
        S.round_half_up(F.avg("orders"), 2).alias("avg_orders"),
        F.sum("fulfilled").alias("fulfilled"),
    )


def weekend_compare(spark, sf):
    d = _daily_orders(spark, sf)
    cal = D.enrich_with_holidays(D.calendar_from_bounds(_order_bounds(spark, sf)), _holidays(spark, sf))
    j = cal.join(d, cal["calendar_date"] == d["order_date"], "left")
    kind = F.when(F.col("is_bank_holiday"), "Holiday").when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return j.groupBy(kind.alias("day_kind")).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum(F.coalesce("orders", F.lit(0))).alias("orders"),
        S.round_half_up(F.avg(F.coalesce("orders", F.lit(0))), 2).alias("avg_orders_per_day"),
    )


def cond_distinct(spark, sf):
    od = _t(spark, sf, "orders")
    return od.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("customers_fulfilled"),
        F.count_distinct(F.when(F.col("o_orderstatus") == "O", F.col("o_custkey"))).alias("customers_open"),
        F.min("o_orderdate").alias("first_order_at"),
        F.max("o_orderdate").alias("last_order_at"),
    )


def weighted_avg(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(
        S.round_half_up(R.weighted_average("l_discount", "l_quantity"), 6).alias("weighted_discount"),
        F.count(F.lit(1)).alias("lines"),
    )


def selection_kpis(spark, sf):
    li = _t(spark, sf, "lineitem")
    sel = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    return sel.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(S.round_half_up(F.sum("l_quantity"), 2), F.lit(0.0)).alias("total_quantity"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


def picker_options(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_suppkey").distinct()
    su = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("label"))
    return li.join(su, on="l_suppkey", how="inner").select(F.col("l_suppkey").alias("value"), "label").orderBy("label")


INVENTORY_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def inventory_union(spark, sf):
    parts = [_t(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t in INVENTORY_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stream_insert_only(spark, sf):
    from snapstar.streaming.merge import stream_events_insert_only

    return finish(stream_events_insert_only(spark, sf))


def disrupted_list(spark, sf):
    return R.flagged_list(latest_state_rollup(spark, sf), "is_disrupted", ["user_id"]).select(
        "user_id", "c_name", "status_severity", "status_description"
    )


def rate_series(spark, sf):
    return R.series(daily_kpis(spark, sf), "calendar_date", "disruption_rate_pct")


def station_rollup(spark, sf):
    li = _t(spark, sf, "lineitem")
    return R.sightings_rollup(li, "l_suppkey", "l_returnflag", "l_partkey")


def distinct_profile(spark, sf):
    ev = _t(spark, sf, "events")
    return R.distinct_profile(ev, ["user_id", "event_type"], {"distinct_days": F.to_date("ts")})


def freshness(spark, sf):
    return finish(R.freshness({
        "events": (_t(spark, sf, "events"), "ts"),
        "lineitem": (_t(spark, sf, "lineitem"), "l_shipdate"),
        "orders": (_t(spark, sf, "orders"), "o_orderdate"),
    }))


def orders_by_year(spark, sf):
    od = _t(spark, sf, "orders")
    return R.by_expression(od, F.year("o_orderdate"), "order_year", [
        F.count(F.lit(1)).alias("orders"),
        R.rounded(F.sum("o_totalprice"), 2).alias("revenue"),
        R.rounded(F.avg("o_totalprice"), 2).alias("avg_order_value"),
    ])


SUPPLIER_PREFIX = r"^Supplier#0*"


def display_text(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
    su = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    j = li.join(su, on="l_suppkey", how="left")
    return j.select(
        "l_orderkey", "l_linenumber",
        R.short_name("s_name", SUPPLIER_PREFIX, "S").alias("supplier_label"),
        L.eta_text(F.col("l_quantity") * 15).alias("eta_text"),
        R.timestamp_text("l_shipdate").alias("ship_text"),
        R.timestamp_text("l_shipdate", "dd MMM yyyy").alias("ship_date_text"),
    )


def status_mix(spark, sf):
    return R.mix(severity_label(spark, sf), "service_state")


def bridge_degree(spark, sf):
    pairs = _bridge(spark, sf)
    per_station = R.degree(pairs, "s_suppkey", "p_partkey", "lines").select(
        F.lit("station").alias("node_kind"), F.col("s_suppkey").alias("node_id"), F.col("lines").alias("partners"))
    per_line = R.degree(pairs, "p_partkey", "s_suppkey", "stations").select(
        F.lit("line").alias("node_kind"), F.col("p_partkey").alias("node_id"), F.col("stations").alias("partners"))
    return per_station.unionByName(per_line)


def _temporal_checks(spark, sf) -> list[DataFrame]:
    versions = event_versions(spark, sf).select(
        "user_id", "version_key", "effective_from", "effective_to"
    )
    facts = _t(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    joined = as_of_join(facts, versions, ["user_id"], "ts")
    # Joined back on the fact's keys, as a reader of the stored fact would: keys
    # that are not unique in the source show up here as mismatches.
    fact = fact_star(spark, sf).join(
        _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
        on=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], how="inner",
    )
    first, second = _loads(spark, sf)
    once = T.insert_only_frame(first, second, ["o_orderkey"])
    twice = T.insert_only_frame(once, second, ["o_orderkey"])
    dim = versions_from_snapshots(weekly_states(spark, sf), ["user_id"], ["event_type"], "snapshot_at")
    latest_versions = latest_per_key(dim.select("user_id", "version_key", "effective_from"), ["user_id"], "effective_from")
    # One pass over the join result serves both of its checks.
    bad = (F.col("ts") < F.col("effective_from")) | (
        F.col("effective_to").isNotNull() & (F.col("ts") >= F.col("effective_to")))
    sides = joined.select(F.lit(1).alias("_side"), bad.alias("_bad")).unionByName(
        facts.select(F.lit(2).alias("_side"), F.lit(False).alias("_bad")))
    return [
        A.aggregate_checks(sides, [
            ("as_of_rows_equal_facts", F.count_if(F.col("_side") == 1), F.count_if(F.col("_side") == 2)),
            ("as_of_outside_interval", F.count_if("_bad"), 0),
        ]),
        A.mismatched("fact_ship_date_key_mismatch", fact, "ship_date_key", local_date_key("l_shipdate")),
        A.rerun_adds_nothing("merge_rerun_adds_rows", once, twice),
        A.pointing_at_expired("latest_version_not_current", latest_versions, dim, "version_key"),
    ]


def chk_temporal(spark, sf):
    return A.suite(_temporal_checks(spark, sf))


def chk_planted_faults(spark, sf):
    """The checks of stored date keys and of pointers to current versions over
    tables that break them: keys by UTC days instead of London's, and versions of
    every seventh user closed although they are the latest."""
    facts = _t(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    utc_key = F.date_format("ts", "yyyyMMdd").cast("int")
    dim = event_versions(spark, sf).select("user_id", "version_key", "effective_from", "is_current")
    latest = latest_per_key(dim, ["user_id"], "effective_from").select("user_id", "version_key")
    closed = dim.withColumn("is_current", F.col("is_current") & (F.col("user_id") % 7 != 0))
    return A.suite([
        A.mismatched("utc_date_key_mismatch", facts, utc_key, local_date_key("ts")),
        A.pointing_at_expired("latest_version_closed", latest, closed, "version_key"),
    ])


# ---------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "daily_kpis": daily_kpis,
        "parse_json_props": parse_json_props,
        "explode_children": explode_children,
        "explode_outer_children": explode_outer_children,
        "payload_contract": payload_contract,
        "endpoint_id_extract": endpoint_id_extract,
        "local_date_dst": local_date_dst,
        "code_labels": code_labels,
        "severity_label": severity_label,
        "reason_sentences": reason_sentences,
        "quality_valid": quality_valid,
        "quality_invalid": quality_invalid,
        "quality_profile": quality_profile,
        "hash_keys": hash_keys,
        "latest_per_key": latest_per_key_q,
        "canonical_per_key": canonical_per_key_q,
        "latest_snapshot_rows": latest_snapshot_rows,
        "latest_state_rollup": latest_state_rollup,
        "dim_date": dim_date_q,
        "dim_date_holidays": dim_date_holidays,
        "scd2_bulk": scd2_bulk,
        "scd2_incremental": scd2_incremental,
        "scd2_classify": scd2_classify,
        "as_of_join": as_of_join_q,
        "bridge_pairs": bridge_pairs_q,
        "bridge_coverage": bridge_coverage,
        "name_resolution": name_resolution,
        "fact_star": fact_star,
        "latest_day_summary": latest_day_summary_q,
        "merge_insert_only": merge_insert_only,
        "merge_upsert": merge_upsert,
        "expire_rows": expire_rows,
        "audit_suite": audit_suite,
        "network_summary": network_summary,
        "latest_kpi_row": latest_kpi_row,
        "trend_30": trend_30,
        "top_days": top_days,
        "bucket_compare": bucket_compare,
        "weekend_compare": weekend_compare,
        "cond_distinct": cond_distinct,
        "weighted_avg": weighted_avg,
        "selection_kpis": selection_kpis,
        "picker_options": picker_options,
        "inventory_union": inventory_union,
        "stream_insert_only": stream_insert_only,
        "disrupted_list": disrupted_list,
        "rate_series": rate_series,
        "station_rollup": station_rollup,
        "distinct_profile": distinct_profile,
        "freshness": freshness,
        "orders_by_year": orders_by_year,
        "display_text": display_text,
        "chk_temporal": chk_temporal,
        "chk_planted_faults": chk_planted_faults,
        "status_mix": status_mix,
        "bridge_degree": bridge_degree,
    }
    from snapstar.plans import gold_model, model

    q |= model.queries() | gold_model.queries()
    for name in ("chk_duplicate_keys", "chk_orphans", "chk_scd2_integrity", "chk_reconcile", "chk_date_sets"):
        q[name] = _check_query(name)

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf)

        run.__name__ = getattr(fn, "__name__", "query")
        return run

    return {k: wrap(v) for k, v in q.items()}

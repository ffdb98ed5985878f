"""DuckDB SQL oracles for :mod:`snapstar.plans.catalog`.

Each entry is written independently in plain SQL over the driver's views and
must return the same columns (names and types) and rows as the Spark query of
the same key.  Rounded doubles pass through DECIMAL(38,10) in both engines so
summation order cannot move the last digit.
"""

from __future__ import annotations

from snapstar.functions.labels import WEATHER_CODE_GROUPS, WEATHER_UNKNOWN

WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(12))"


def r(expr: str, n: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def local(expr: str) -> str:
    return f"((({expr}) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London')"


def ldk(expr: str) -> str:
    return f"CAST(strftime(CAST({local(expr)} AS DATE), '%Y%m%d') AS INTEGER)"


def k() -> str:
    return "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"


def code_case(expr: str) -> str:
    whens = " ".join(
        f"WHEN ({expr}) IN ({', '.join(str(c) for c in codes)}) THEN '{label}'" for codes, label in WEATHER_CODE_GROUPS
    )
    return f"CASE {whens} ELSE '{WEATHER_UNKNOWN}' END"


def calendar_sql(bounds: str) -> str:
    """Calendar rows from a relation with start_date / end_date."""
    return f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
           CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
           isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(CAST(start_date AS DATE), CAST(end_date AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
          FROM {bounds})"""


HOLIDAYS = """
    SELECT CAST(o_orderdate AS DATE) AS holiday_date,
           string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS holiday_name
    FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    GROUP BY 1"""

ORDER_BOUNDS = "(SELECT min(o_orderdate) AS start_date, max(o_orderdate) AS end_date FROM orders)"


def suite(rows: list[tuple[str, str, str | None]], ctes: str = "") -> str:
    """Audit rows (name, actual SQL, expected SQL or None) -> status table."""
    parts = []
    for name, actual, expected in rows:
        exp = "CAST(NULL AS BIGINT)" if expected is None else f"CAST(({expected}) AS BIGINT)"
        parts.append(f"SELECT '{name}' AS check_name, CAST(({actual}) AS BIGINT) AS actual_value, {exp} AS expected_value")
    body = "\nUNION ALL ".join(parts)
    return f"""{ctes}
    SELECT check_name,
           CASE WHEN expected_value IS NULL THEN 'INFO' WHEN actual_value = expected_value THEN 'PASS' ELSE 'FAIL' END AS status,
           actual_value, expected_value
    FROM ({body}) AS checks"""


# ---------------------------------------------------------------------------

EXPLODE = """
    SELECT o.o_orderkey AS order_id, o.o_orderstatus AS status, l.l_linenumber AS line_number,
           l.l_partkey AS part_id, l.l_suppkey AS supplier_id, l.l_quantity AS quantity,
           l.l_extendedprice AS extended_price
    FROM orders o {join} lineitem l ON l.l_orderkey = o.o_orderkey"""

SEVERITY = f"""
    WITH t AS (
      SELECT event_id, CAST({k()} % 12 AS INTEGER) AS severity,
             CASE event_type WHEN 'view' THEN 'Good Service' WHEN 'click' THEN 'Minor Delays'
                             WHEN 'purchase' THEN 'Part Suspended' WHEN 'signup' THEN 'Special Service'
                             WHEN 'error' THEN 'Severe Delays' END AS description
      FROM events),
    u AS (SELECT *, lower(trim(coalesce(description, ''))) AS d FROM t)
    SELECT event_id, severity, description,
           coalesce(severity = 10, false) AS is_good_service,
           NOT coalesce(severity = 10, false) AS is_disrupted,
           CASE WHEN severity = 10 THEN 'Healthy'
                WHEN severity IN (7, 8, 9) THEN 'Degraded'
                WHEN severity IN (1, 2, 3, 4, 5, 6) THEN 'Disrupted'
                WHEN d = 'good service' THEN 'Healthy'
                WHEN contains(d, 'minor delays') OR contains(d, 'reduced service')
                  OR contains(d, 'bus service') OR contains(d, 'special service') THEN 'Degraded'
                WHEN contains(d, 'severe delays') OR contains(d, 'suspended')
                  OR contains(d, 'closure') OR contains(d, 'closed') THEN 'Disrupted'
                ELSE 'Unknown' END AS service_state
    FROM u"""

REASONS = rf"""
    WITH c AS (SELECT doc_id, trim(text, {WS}) AS t0 FROM documents),
    c2 AS (SELECT doc_id,
                  CASE WHEN t0 IS NULL OR t0 = '' THEN NULL
                       ELSE trim(regexp_replace(t0, '^[A-Z ''&-]+\s+LINE:\s*', ''), {WS}) END AS reason
           FROM c),
    m AS (SELECT doc_id,
                 list_filter(list_transform(string_split(regexp_replace(reason, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
                                            lambda x: trim(x, {WS})), lambda x: x <> '') AS arr
          FROM c2 WHERE reason IS NOT NULL)
    SELECT doc_id, CAST(unnest(generate_series(1, len(arr))) AS INTEGER) AS sentence_no, unnest(arr) AS sentence
    FROM m"""

# Rule predicates, true for a good row (same names and order as the Spark set).
LINEITEM_RULES = [
    ("l_orderkey_not_null", "l_orderkey IS NOT NULL"),
    ("l_partkey_not_null", "l_partkey IS NOT NULL"),
    ("l_suppkey_not_null", "l_suppkey IS NOT NULL"),
    ("l_shipdate_not_null", "l_shipdate IS NOT NULL"),
    ("l_quantity_in_range", "l_quantity BETWEEN 1 AND 50"),
    ("l_discount_in_range", "l_discount BETWEEN 0.0 AND 0.1"),
    ("l_tax_in_range", "l_tax BETWEEN 0.0 AND 0.08"),
    ("l_extendedprice_positive", "l_extendedprice > 0"),
    ("l_returnflag_known", "l_returnflag IN ('A', 'N', 'R')"),
    ("l_linestatus_known", "l_linestatus IN ('O', 'F')"),
    ("returned_line_closed", "(l_returnflag <> 'R') OR (l_linestatus = 'F')"),
]
_ALL_OK = " AND ".join(f"coalesce({p}, false)" for _, p in LINEITEM_RULES)
_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, p in LINEITEM_RULES) + ")"
_PROFILE = ", ".join(
    ["count(*) AS rows", f"count(*) FILTER (WHERE NOT ({_ALL_OK})) AS invalid_rows"]
    + [f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS {n}" for n, p in LINEITEM_RULES]
    + [f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in ["l_quantity", "l_discount", "l_shipdate", "l_returnflag"]]
)

EVENT_STATUS = f"""
    f AS (SELECT user_id, event_id, event_type, date_trunc('hour', ts) AS snapshot_at,
                 CAST({k()} % 12 AS INTEGER) AS severity,
                 CASE WHEN event_type = 'error' THEN 'code ' || CAST({k()} AS VARCHAR) END AS reason
          FROM events)"""

LATEST_STATE = f"""
    WITH {EVENT_STATUS},
    latest AS (SELECT f.* FROM f JOIN (SELECT user_id, max(snapshot_at) AS m FROM f GROUP BY user_id) x
               ON f.user_id = x.user_id AND f.snapshot_at = x.m),
    st AS (SELECT user_id, snapshot_at, min(severity) AS status_severity,
                  string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS status_description,
                  string_agg(DISTINCT reason, ' | ' ORDER BY reason) AS status_reason,
                  bool_or(NOT coalesce(severity = 10, false)) AS is_disrupted,
                  min(event_id) AS request_id, count(*) AS status_record_count
           FROM latest GROUP BY user_id, snapshot_at)
    SELECT c.c_custkey AS user_id, c.c_name, c.c_mktsegment, st.status_severity, st.status_description,
           st.status_reason, st.is_disrupted, NOT st.is_disrupted AS is_good_service, st.status_record_count,
           st.snapshot_at AS status_snapshot_at_utc, {local('st.snapshot_at')} AS status_snapshot_at_local,
           st.request_id
    FROM customer c LEFT JOIN st ON st.user_id = c.c_custkey"""

WEEKLY = """
    b AS (SELECT date_trunc('week', min(ts)) AS start FROM events),
    e AS (SELECT user_id, event_id, ts, event_type,
                 CAST(date_diff('day', CAST(b.start AS DATE), CAST(ts AS DATE)) // 7 + 1 AS INTEGER) AS w
          FROM events, b),
    nn AS (SELECT max(w) AS n FROM e),
    snaps AS (SELECT CAST(unnest(generate_series(1, n)) AS INTEGER) AS i FROM nn),
    st AS (SELECT i, user_id, event_type FROM (
             SELECT s.i, e.user_id, e.event_type,
                    row_number() OVER (PARTITION BY s.i, e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
             FROM snaps s JOIN e ON e.w <= s.i) WHERE rn = 1)"""

SCD2_VERSIONS = f"""
    {WEEKLY},
    sn AS (SELECT st.user_id, st.event_type, b.start + to_days(CAST(7 * st.i AS INTEGER)) AS snapshot_at FROM st, b),
    h AS (SELECT user_id, event_type, snapshot_at, sha256(coalesce(event_type, '')) AS attribute_hash FROM sn),
    p AS (SELECT *, lag(attribute_hash) OVER (PARTITION BY user_id ORDER BY snapshot_at) AS prev FROM h),
    starts AS (SELECT * FROM p WHERE prev IS NULL OR prev <> attribute_hash),
    v0 AS (SELECT user_id, event_type, attribute_hash, snapshot_at AS effective_from,
                  lead(snapshot_at) OVER (PARTITION BY user_id ORDER BY snapshot_at) AS effective_to
           FROM starts),
    v AS (SELECT user_id, event_type, attribute_hash,
                 sha256(concat_ws('||', CAST(user_id AS VARCHAR), attribute_hash, CAST(effective_from AS VARCHAR))) AS version_key,
                 effective_from, effective_to, effective_to IS NULL AS is_current
          FROM v0)"""

SCD2 = f"WITH {SCD2_VERSIONS} SELECT * FROM v"

SCD2_CLASSIFY = f"""
    WITH {WEEKLY},
    a AS (SELECT user_id, sha256(coalesce(event_type, '')) AS h FROM st WHERE i = (SELECT n FROM nn) - 1),
    bb AS (SELECT user_id, sha256(coalesce(event_type, '')) AS h FROM st WHERE i = (SELECT n FROM nn)),
    j AS (SELECT CASE WHEN a.user_id IS NULL THEN 'new' WHEN bb.user_id IS NULL THEN 'missing'
                      WHEN a.h <> bb.h THEN 'changed' ELSE 'unchanged' END AS change_type
          FROM a FULL OUTER JOIN bb ON a.user_id = bb.user_id)
    SELECT change_type, count(*) AS keys FROM j GROUP BY change_type"""

AS_OF = """
    WITH e AS (SELECT user_id, ts, event_type,
                      lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
    s AS (SELECT user_id, ts AS effective_from, event_type FROM e WHERE prev IS NULL OR prev <> event_type),
    v AS (SELECT user_id, event_type AS version_event_type, effective_from,
                 lead(effective_from) OVER (PARTITION BY user_id ORDER BY effective_from) AS effective_to,
                 sha256(coalesce(event_type, '')) AS attribute_hash
          FROM s),
    v2 AS (SELECT *, sha256(concat_ws('||', CAST(user_id AS VARCHAR), attribute_hash, CAST(effective_from AS VARCHAR))) AS version_key
           FROM v)
    SELECT f.event_id, f.user_id, f.ts, f.event_type, v2.version_key, v2.version_event_type, v2.effective_from
    FROM events f JOIN v2 ON f.user_id = v2.user_id AND f.ts >= v2.effective_from
                          AND (v2.effective_to IS NULL OR f.ts < v2.effective_to)"""

BRIDGE_CTES = """
    pairs AS (SELECT DISTINCT l_suppkey AS s_suppkey, l_partkey AS p_partkey FROM lineitem
              WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL),
    stn AS (SELECT s_suppkey, sha256(coalesce(CAST(s_suppkey AS VARCHAR), 'NULL')) AS station_key FROM supplier),
    ln AS (SELECT p_partkey, sha256(coalesce(CAST(p_partkey AS VARCHAR), 'NULL')) AS line_key FROM part
           WHERE p_type IN ('STANDARD', 'PROMO', 'ECONOMY')),
    bridge AS (SELECT sha256(concat_ws('||', stn.station_key, ln.line_key)) AS station_line_key,
                      stn.station_key, ln.line_key, pairs.s_suppkey, pairs.p_partkey
               FROM pairs JOIN stn ON pairs.s_suppkey = stn.s_suppkey JOIN ln ON pairs.p_partkey = ln.p_partkey)"""

BRIDGE_COVERAGE = suite(
    [
        ("in_scope_pairs", "SELECT count(*) FROM scope_pairs", None),
        ("bridged_pairs", "SELECT count(*) FROM bridge", None),
        ("missing_pairs", "SELECT count(*) FROM (SELECT l_suppkey, l_partkey FROM scope_pairs EXCEPT SELECT s_suppkey, p_partkey FROM bridge)", "0"),
        ("duplicate_pairs", "SELECT count(*) FROM (SELECT s_suppkey, p_partkey FROM bridge GROUP BY ALL HAVING count(*) > 1)", "0"),
    ],
    ctes=f"""WITH {BRIDGE_CTES},
    scope_pairs AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem
                    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type IN ('STANDARD', 'PROMO', 'ECONOMY')))""",
)

NAME_RESOLUTION = """
    WITH per AS (SELECT n.n_name, count(DISTINCT s.s_suppkey) AS c, min(s.s_suppkey) AS any_id
                 FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name),
    names AS (SELECT DISTINCT n_name FROM nation)
    SELECT names.n_name,
           CASE WHEN coalesce(c, 0) = 0 THEN 'missing' WHEN c = 1 THEN 'resolved' ELSE 'ambiguous' END AS status,
           CAST(coalesce(c, 0) AS BIGINT) AS candidates,
           CASE WHEN c = 1 THEN any_id END AS resolved_id
    FROM names LEFT JOIN per ON names.n_name = per.n_name"""

FACT_STAR_SELECT = f"""
    SELECT sha256(concat_ws('||', coalesce(CAST(l_orderkey AS VARCHAR), 'NULL'), coalesce(CAST(l_linenumber AS VARCHAR), 'NULL'),
                  coalesce(CAST(l_partkey AS VARCHAR), 'NULL'), coalesce(CAST(l_suppkey AS VARCHAR), 'NULL'))) AS fact_key,
           l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, c_nationkey,
           {ldk('l_shipdate')} AS ship_date_key, {ldk('o_orderdate')} AS order_date_key, l_extendedprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

LATEST_DAY = f"""
    WITH ev AS (SELECT user_id, event_type, ts, value, {k()} AS k FROM events),
    d AS (SELECT * FROM ev WHERE CAST({local('ts')} AS DATE) = (SELECT CAST({local('max(ts)')} AS DATE) FROM ev)),
    g AS (SELECT user_id, event_type, count(*) AS observations, count(DISTINCT k) AS distinct_entities,
                 {r('avg(value)', 1)} AS avg_measure, min(value) AS min_measure, max(value) AS max_measure,
                 min(ts) AS next_expected_utc, max(ts) AS latest_utc
          FROM d GROUP BY user_id, event_type)
    SELECT g.*, {local('g.next_expected_utc')} AS next_expected_local, {local('g.latest_utc')} AS latest_local, c.c_name
    FROM g JOIN customer c ON c.c_custkey = g.user_id"""

DAILY_KPIS = f"""
    WITH ev AS (SELECT user_id, date_trunc('hour', ts) AS snapshot_at, CAST({k()} % 12 AS INTEGER) AS sev FROM events),
    ev2 AS (SELECT user_id, snapshot_at, {ldk('snapshot_at')} AS date_key,
                   NOT coalesce(sev = 10, false) AS is_disrupted FROM ev),
    snap AS (SELECT date_key, user_id, snapshot_at, max(CAST(is_disrupted AS INTEGER)) AS fl FROM ev2 GROUP BY ALL),
    line0 AS (SELECT date_key, count(*) AS line_snapshots, count(DISTINCT user_id) AS distinct_lines_observed,
                     CAST(sum(fl) AS BIGINT) AS disrupted_line_snapshots FROM snap GROUP BY date_key),
    line AS (SELECT *, line_snapshots - disrupted_line_snapshots AS good_service_line_snapshots,
                    {r('100.0::DOUBLE * disrupted_line_snapshots / line_snapshots', 2)} AS disruption_rate_pct FROM line0),
    arr AS (SELECT {ldk('l_shipdate')} AS date_key, count(*) AS arrival_observations,
                   count(DISTINCT l_partkey) AS distinct_vehicles, count(DISTINCT l_suppkey) AS stations_observed,
                   {r('avg(l_quantity)', 1)} AS avg_eta_seconds
            FROM lineitem GROUP BY 1),
    wx AS (SELECT {ldk('o_orderdate')} AS date_key, count(*) AS weather_observations,
                  {r('avg(o_totalprice / 10000.0)', 2)} AS avg_temperature_c,
                  {r('min(o_totalprice / 10000.0)', 2)} AS min_temperature_c,
                  {r('max(o_totalprice / 10000.0)', 2)} AS max_temperature_c,
                  {r('avg(o_custkey % 100)', 2)} AS avg_relative_humidity_pct,
                  {r('sum(o_totalprice / 100000.0)', 2)} AS total_precipitation_mm,
                  {r('max(o_totalprice / 10000.0)', 2)} AS max_wind_gust_kmh
           FROM orders GROUP BY 1),
    active AS (SELECT date_key FROM line UNION SELECT date_key FROM arr UNION SELECT date_key FROM wx),
    cal AS ({calendar_sql("(SELECT DATE '1990-01-01' AS start_date, DATE '2035-12-31' AS end_date)")}),
    hol AS ({HOLIDAYS})
    SELECT cal.date_key, cal.calendar_date, cal.year, cal.quarter, cal.month, cal.month_name, cal.day_of_week,
           cal.day_name, cal.is_weekend, hol.holiday_name IS NOT NULL AS is_bank_holiday, hol.holiday_name,
           coalesce(line.line_snapshots, 0) AS line_snapshots,
           coalesce(line.distinct_lines_observed, 0) AS distinct_lines_observed,
           coalesce(line.disrupted_line_snapshots, 0) AS disrupted_line_snapshots,
           coalesce(line.good_service_line_snapshots, 0) AS good_service_line_snapshots,
           line.disruption_rate_pct,
           coalesce(arr.arrival_observations, 0) AS arrival_observations,
           coalesce(arr.distinct_vehicles, 0) AS distinct_vehicles,
           coalesce(arr.stations_observed, 0) AS stations_observed,
           arr.avg_eta_seconds,
           coalesce(wx.weather_observations, 0) AS weather_observations,
           wx.avg_temperature_c, wx.min_temperature_c, wx.max_temperature_c, wx.avg_relative_humidity_pct,
           wx.total_precipitation_mm, wx.max_wind_gust_kmh
    FROM active JOIN cal ON active.date_key = cal.date_key
    LEFT JOIN hol ON hol.holiday_date = cal.calendar_date
    LEFT JOIN line ON line.date_key = active.date_key
    LEFT JOIN arr ON arr.date_key = active.date_key
    LEFT JOIN wx ON wx.date_key = active.date_key"""

LOADS = """
    f AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
          WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                 o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""

DAILY_ORDERS = f"""
    d AS (SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders,
                 count(*) FILTER (WHERE o_orderstatus = 'F') AS fulfilled,
                 {r('sum(o_totalprice)', 2)} AS revenue
          FROM orders GROUP BY 1)"""

_CHK_LI_DUP = "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)"
_CHK_ROWS = {
    "chk_duplicate_keys": [
        ("lineitem_duplicate_order_line", _CHK_LI_DUP, "0"),
        ("orders_duplicate_keys", "SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1)", "0"),
        ("dim_date_duplicate_keys", "SELECT count(*) FROM (SELECT date_key FROM cal GROUP BY ALL HAVING count(*) > 1)", "0"),
    ],
    "chk_orphans": [
        ("lineitem_orphan_part", "SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)", "0"),
        ("lineitem_orphan_supplier", "SELECT count(*) FROM lineitem WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)", "0"),
        ("lineitem_orphan_order", "SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)", "0"),
        ("orders_orphan_customer", "SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)", "0"),
    ],
    "chk_scd2_integrity": [
        ("versions_duplicate_keys", "SELECT count(*) FROM (SELECT version_key FROM v GROUP BY ALL HAVING count(*) > 1)", "0"),
        ("versions_not_one_current", "SELECT count(*) FROM (SELECT user_id FROM v GROUP BY user_id HAVING count(*) FILTER (WHERE is_current) <> 1)", "0"),
        ("versions_inverted_dates", "SELECT count(*) FROM v WHERE effective_to IS NOT NULL AND effective_to <= effective_from", "0"),
        ("versions_current_with_end", "SELECT count(*) FROM v WHERE is_current AND effective_to IS NOT NULL", "0"),
        ("versions_closed_without_end", "SELECT count(*) FROM v WHERE NOT is_current AND effective_to IS NULL", "0"),
        ("versions_overlapping", """SELECT count(*) FROM (
            SELECT effective_from,
                   lag(effective_to) OVER (PARTITION BY user_id ORDER BY effective_from, version_key) AS pt,
                   lag(1) OVER (PARTITION BY user_id ORDER BY effective_from, version_key) AS hp
            FROM v) WHERE hp IS NOT NULL AND (pt IS NULL OR pt > effective_from)""", "0"),
    ],
    "chk_reconcile": [
        ("fact_rows_equal_lineitem", "SELECT count(*) FROM fact", "SELECT count(*) FROM lineitem"),
        ("fact_duplicate_keys", "SELECT count(*) FROM (SELECT fact_key FROM fact GROUP BY ALL HAVING count(*) > 1)", "0"),
        ("fact_orphan_order_date", "SELECT count(*) FROM fact WHERE order_date_key IS NOT NULL AND order_date_key NOT IN (SELECT date_key FROM cal)", "0"),
    ],
    "chk_date_sets": [
        ("order_dates_missing_from_calendar", "SELECT count(*) FROM (SELECT date_key FROM od EXCEPT SELECT date_key FROM cal)", "0"),
        ("calendar_dates_without_orders", "SELECT count(*) FROM (SELECT date_key FROM cal EXCEPT SELECT date_key FROM od)", "0"),
        ("dim_date_non_empty", "SELECT count(*) FROM (SELECT 1 FROM cal LIMIT 1)", "1"),
    ],
}
_CHK_CTES = f"""WITH {SCD2_VERSIONS},
    cal AS ({calendar_sql(ORDER_BOUNDS)}),
    fact AS ({FACT_STAR_SELECT}),
    od AS (SELECT {ldk('o_orderdate')} AS date_key FROM orders)"""

INVENTORY = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle_sql() -> dict[str, str]:
    q = {
        "daily_kpis": DAILY_KPIS,
        "parse_json_props": f"SELECT event_id, user_id, event_type, {k()} AS k FROM events",
        "explode_children": EXPLODE.format(join="JOIN"),
        "explode_outer_children": EXPLODE.format(join="LEFT JOIN"),
        "payload_contract": f"""
            WITH t AS (SELECT event_type, props,
                              CASE WHEN json_valid(props) THEN json_type(props) END AS root FROM events),
            u AS (SELECT *, root = 'OBJECT' AND list_contains(json_keys(props), 'k') AS with_k FROM t)
            SELECT event_type, count(*) AS payloads,
                   count(*) FILTER (WHERE root = 'OBJECT') AS object_roots,
                   count(*) FILTER (WHERE with_k) AS with_k,
                   count(*) FILTER (WHERE root = 'OBJECT' AND with_k AND {k()} IS NOT NULL) AS valid_payloads
            FROM u GROUP BY event_type""",
        "endpoint_id_extract": r"""
            SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
                   regexp_extract(url, '^https?://[^/?#]+/([a-z]{2})/', 1) AS lang,
                   CAST(NULLIF(regexp_extract(url, '^https?://[^/?#]+/[a-z]{2}/([0-9]+)', 1), '') AS BIGINT) AS item_id
            FROM pages""",
        "local_date_dst": f"""
            WITH t AS (SELECT o_orderkey, o_orderdate + INTERVAL 23 HOUR + INTERVAL 30 MINUTE AS event_at_utc FROM orders)
            SELECT o_orderkey, event_at_utc, {local('event_at_utc')} AS event_at_local,
                   CAST({local('event_at_utc')} AS DATE) AS local_date, {ldk('event_at_utc')} AS local_date_key,
                   CAST({local('event_at_utc')} AS DATE) <> CAST(event_at_utc AS DATE) AS next_day
            FROM t""",
        "code_labels": f"""
            SELECT p_partkey, p_size, {code_case('p_size')} AS size_label,
                   CAST(floor(p_retailprice) AS BIGINT) % 100 AS price_code,
                   {code_case('CAST(floor(p_retailprice) AS BIGINT) % 100')} AS price_label
            FROM part""",
        "severity_label": SEVERITY,
        "reason_sentences": REASONS,
        "quality_valid": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE {_ALL_OK}",
        "quality_invalid": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_FAILED} AS failed_rules
                               FROM lineitem WHERE NOT ({_ALL_OK})""",
        "quality_profile": f"SELECT {_PROFILE} FROM lineitem",
        "hash_keys": """
            SELECT o_orderkey,
                   sha256(concat_ws('||', coalesce(CAST(o_orderkey AS VARCHAR), 'NULL'), coalesce(CAST(o_custkey AS VARCHAR), 'NULL'),
                                    coalesce(o_orderstatus, 'NULL'), coalesce(o_orderpriority, 'NULL'))) AS order_hash,
                   sha256(concat_ws('||', coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''))) AS attribute_hash
            FROM orders""",
        "latest_per_key": """
            SELECT user_id, event_id, ts, event_type, value FROM (
              SELECT user_id, event_id, ts, event_type, value,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
            WHERE rn = 1""",
        "canonical_per_key": """
            SELECT s_nationkey, s_suppkey, s_name, s_acctbal FROM (
              SELECT *, row_number() OVER (PARTITION BY s_nationkey
                        ORDER BY CASE WHEN s_suppkey = s_nationkey THEN 0 ELSE 1 END, s_suppkey) AS rn FROM supplier)
            WHERE rn = 1""",
        "latest_snapshot_rows": """
            SELECT event_id, user_id, event_type, date_trunc('hour', ts) AS snapshot_at FROM events
            WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)""",
        "latest_state_rollup": LATEST_STATE,
        "dim_date": calendar_sql(ORDER_BOUNDS),
        "dim_date_holidays": f"""
            WITH cal AS ({calendar_sql(ORDER_BOUNDS)}), hol AS ({HOLIDAYS})
            SELECT cal.date_key, cal.calendar_date, cal.day_name, cal.is_weekend,
                   hol.holiday_name IS NOT NULL AS is_bank_holiday, hol.holiday_name
            FROM cal LEFT JOIN hol ON hol.holiday_date = cal.calendar_date""",
        "scd2_bulk": SCD2,
        "scd2_incremental": SCD2,
        "scd2_classify": SCD2_CLASSIFY,
        "as_of_join": AS_OF,
        "bridge_pairs": f"WITH {BRIDGE_CTES} SELECT * FROM bridge",
        "bridge_coverage": BRIDGE_COVERAGE,
        "name_resolution": NAME_RESOLUTION,
        "fact_star": FACT_STAR_SELECT,
        "latest_day_summary": LATEST_DAY,
        "merge_insert_only": f"""
            WITH {LOADS}
            SELECT * FROM f UNION ALL
            SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.o_orderkey = s.o_orderkey)""",
        "merge_upsert": f"""
            WITH {LOADS}
            SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE f.o_orderkey = s.o_orderkey)
            UNION ALL SELECT * FROM s""",
        "expire_rows": f"""
            WITH {LOADS},
            chg AS (SELECT s.o_orderkey FROM s JOIN f ON s.o_orderkey = f.o_orderkey WHERE s.o_orderstatus <> f.o_orderstatus),
            load_time AS (SELECT max(o_orderdate) AS load_at FROM s)
            SELECT f.o_orderkey, f.o_orderstatus, f.o_orderdate AS effective_from,
                   CASE WHEN f.o_orderkey IN (SELECT o_orderkey FROM chg) THEN (SELECT load_at FROM load_time) END AS effective_to,
                   f.o_orderkey NOT IN (SELECT o_orderkey FROM chg) AS is_current
            FROM f""",
        "audit_suite": suite([row for rows in _CHK_ROWS.values() for row in rows], ctes=_CHK_CTES),
        "network_summary": f"""
            SELECT count(*) AS total_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS fulfilled_orders,
                   count(*) FILTER (WHERE o_orderstatus <> 'F') AS open_orders,
                   {r("100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*)", 2)} AS fulfilled_pct
            FROM orders""",
        "latest_kpi_row": f"WITH {DAILY_ORDERS} SELECT * FROM d WHERE fulfilled > 0 ORDER BY order_date DESC LIMIT 1",
        "trend_30": f"WITH {DAILY_ORDERS} SELECT * FROM (SELECT * FROM d ORDER BY order_date DESC LIMIT 30) ORDER BY order_date",
        "top_days": f"WITH {DAILY_ORDERS} SELECT * FROM d ORDER BY revenue DESC, order_date LIMIT 10",
        "bucket_compare": f"""
            WITH {DAILY_ORDERS}
            SELECT CASE WHEN revenue > 1000000 THEN 'High' ELSE 'Low' END AS revenue_bucket, count(*) AS days,
                   {r('avg(orders)', 2)} AS avg_orders, CAST(sum(fulfilled) AS BIGINT) AS fulfilled
            FROM d GROUP BY 1""",
        "weekend_compare": f"""
            WITH {DAILY_ORDERS}, cal AS ({calendar_sql(ORDER_BOUNDS)}), hol AS ({HOLIDAYS}),
            j AS (SELECT cal.is_weekend, hol.holiday_name IS NOT NULL AS is_bank_holiday, d.orders
                  FROM cal LEFT JOIN hol ON hol.holiday_date = cal.calendar_date
                  LEFT JOIN d ON d.order_date = cal.calendar_date)
            SELECT CASE WHEN is_bank_holiday THEN 'Holiday' WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_kind,
                   count(*) AS days, CAST(sum(coalesce(orders, 0)) AS BIGINT) AS orders,
                   {r('avg(coalesce(orders, 0))', 2)} AS avg_orders_per_day
            FROM j GROUP BY 1""",
        "cond_distinct": """
            SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
                   count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS customers_fulfilled,
                   count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS customers_open,
                   min(o_orderdate) AS first_order_at, max(o_orderdate) AS last_order_at
            FROM orders GROUP BY o_orderpriority""",
        "weighted_avg": f"""
            WITH t AS (SELECT l_suppkey, l_discount, l_quantity,
                              l_quantity IS NOT NULL AND l_quantity > 0 AND l_discount IS NOT NULL AS ok FROM lineitem)
            SELECT l_suppkey,
                   {r('sum(CASE WHEN ok THEN l_discount * l_quantity END) / NULLIF(sum(CASE WHEN ok THEN l_quantity END), 0.0)', 6)} AS weighted_discount,
                   count(*) AS lines
            FROM t GROUP BY l_suppkey""",
        "selection_kpis": f"""
            SELECT l_suppkey, count(*) AS rows, coalesce({r('sum(l_quantity)', 2)}, 0.0) AS total_quantity,
                   min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_suppkey""",
        "picker_options": """
            SELECT DISTINCT l.l_suppkey AS value, s.s_name AS label
            FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey ORDER BY label""",
        "inventory_union": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in INVENTORY
        ),
        "stream_insert_only": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    }
    q.update({
        "status_mix": f"WITH t AS ({SEVERITY}) SELECT service_state, count(*) AS rows FROM t GROUP BY service_state",
        "bridge_degree": f"""
            WITH {BRIDGE_CTES}
            SELECT 'station' AS node_kind, s_suppkey AS node_id, count(DISTINCT p_partkey) AS partners FROM bridge GROUP BY s_suppkey
            UNION ALL
            SELECT 'line', p_partkey, count(DISTINCT s_suppkey) FROM bridge GROUP BY p_partkey""",
        "disrupted_list": f"""
            WITH s AS ({LATEST_STATE})
            SELECT user_id, c_name, status_severity, status_description FROM s WHERE is_disrupted ORDER BY user_id""",
        "rate_series": f"""
            WITH k AS ({DAILY_KPIS})
            SELECT calendar_date, disruption_rate_pct FROM k WHERE disruption_rate_pct IS NOT NULL ORDER BY calendar_date""",
        "station_rollup": """
            WITH pl AS (SELECT l_suppkey, l_returnflag, count(DISTINCT l_partkey) AS dv FROM lineitem GROUP BY ALL),
            s AS (SELECT l_suppkey, CAST(sum(dv) AS BIGINT) AS vehicle_line_sightings, count(*) AS lines FROM pl GROUP BY l_suppkey),
            e AS (SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_vehicles FROM lineitem GROUP BY l_suppkey)
            SELECT s.l_suppkey, s.vehicle_line_sightings, s.lines, e.distinct_vehicles FROM s JOIN e ON s.l_suppkey = e.l_suppkey""",
        "distinct_profile": """
            SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id,
                   count(DISTINCT event_type) AS distinct_event_type, count(DISTINCT CAST(ts AS DATE)) AS distinct_days
            FROM events""",
        "freshness": """
            SELECT 'events' AS source, min(ts) AS oldest, max(ts) AS newest FROM events
            UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate) FROM lineitem
            UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate) FROM orders""",
        "orders_by_year": f"""
            SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders,
                   {r('sum(o_totalprice)', 2)} AS revenue, {r('avg(o_totalprice)', 2)} AS avg_order_value
            FROM orders GROUP BY 1""",
        "display_text": """
            SELECT l.l_orderkey, l.l_linenumber,
                   trim(regexp_replace(s.s_name, '^Supplier#0*', 'S')) AS supplier_label,
                   CASE WHEN l.l_quantity IS NULL THEN 'No data' ELSE printf('%.1f min', l.l_quantity * 15 / 60.0) END AS eta_text,
                   coalesce(strftime(l.l_shipdate, '%d %b %Y, %H:%M'), 'No data') AS ship_text,
                   coalesce(strftime(l.l_shipdate, '%d %b %Y'), 'No data') AS ship_date_text
            FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
        "chk_planted_faults": suite(
            [
                ("utc_date_key_mismatch", f"SELECT count(*) FROM events WHERE CAST(strftime(ts, '%Y%m%d') AS INTEGER) IS DISTINCT FROM {ldk('ts')}", "0"),
                ("latest_version_closed", "SELECT count(DISTINCT user_id) FROM events WHERE user_id % 7 = 0 AND ts IS NOT NULL", "0"),
            ]),
        "chk_temporal": suite(
            [
                ("as_of_rows_equal_facts", "SELECT count(*) FROM asof_rows", "SELECT count(*) FROM events WHERE ts IS NOT NULL"),
                ("as_of_outside_interval", "SELECT count(*) FROM asof_rows WHERE ts < effective_from OR (effective_to IS NOT NULL AND ts >= effective_to)", "0"),
                ("fact_ship_date_key_mismatch", f"SELECT count(*) FROM fact f JOIN lineitem l USING (l_orderkey, l_linenumber, l_partkey, l_suppkey) WHERE f.ship_date_key IS DISTINCT FROM {ldk('l.l_shipdate')}", "0"),
                ("merge_rerun_adds_rows", "(SELECT count(*) FROM twice) - (SELECT count(*) FROM once)", "0"),
                ("latest_version_not_current", "SELECT count(*) FROM (SELECT user_id, arg_max(version_key, effective_from) AS vk FROM v GROUP BY user_id) x WHERE vk NOT IN (SELECT version_key FROM v WHERE is_current)", "0"),
            ],
            ctes=f"""WITH {SCD2_VERSIONS},
    fact AS ({FACT_STAR_SELECT}),
    {LOADS},
    once AS (SELECT * FROM f UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.o_orderkey = s.o_orderkey)),
    twice AS (SELECT * FROM once UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM once WHERE once.o_orderkey = s.o_orderkey)),
    asof_rows AS (
      WITH e AS (SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
      s AS (SELECT user_id, ts AS effective_from FROM e WHERE prev IS NULL OR prev <> event_type),
      vv AS (SELECT user_id, effective_from, lead(effective_from) OVER (PARTITION BY user_id ORDER BY effective_from) AS effective_to FROM s)
      SELECT f.event_id, f.ts, vv.effective_from, vv.effective_to FROM events f JOIN vv ON f.user_id = vv.user_id
        AND f.ts >= vv.effective_from AND (vv.effective_to IS NULL OR f.ts < vv.effective_to))""",
        ),
    })
    for name, rows in _CHK_ROWS.items():
        q[name] = suite(rows, ctes=_CHK_CTES)
    from snapstar.plans import gold_oracle, model_oracle

    return q | model_oracle.oracle_sql() | gold_oracle.oracle_sql()

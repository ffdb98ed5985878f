"""Label, flag and text expressions (code lookups, service state, reasons).

All are column expressions, no Python UDFs: they run JVM-side inside
whole-stage codegen on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference behaviour.
#
# Weather code groups (WMO-style codes) and their labels, default "Unknown":
#   0 Clear sky; 1,2,3 Cloudy; 45,48 Fog; 51,53,55 Drizzle;
#   56,57 Freezing drizzle; 61,63,65 Rain; 66,67 Freezing rain;
#   71,73,75,77 Snow; 80,81,82 Rain showers; 85,86 Snow showers;
#   95,96,99 Thunderstorm
#
# Service state from severity: 10 Healthy; 7,8,9 Degraded; 1-6 Disrupted.
# Otherwise from the lower-cased, trimmed description:
#   "good service" (exact) -> Healthy
#   contains "minor delays", "reduced service", "bus service",
#            "special service" -> Degraded   (tested first)
#   contains "severe delays", "suspended", "closure", "closed" -> Disrupted
#   else Unknown
# Good service means severity == 10; anything else, null included, is
# disrupted.
#
# Reason prefix removed: "<NAME> LINE: " or "<NAME>: " (case-insensitive with a
# known name), else upper-case letters, spaces, apostrophes, ampersands and
# hyphens followed by " LINE: ".  Sentences end at . ! ? and white space.
# ---------------------------------------------------------------------------
WEATHER_CODE_GROUPS = [
    ((0,), "Clear sky"),
    ((1, 2, 3), "Cloudy"),
    ((45, 48), "Fog"),
    ((51, 53, 55), "Drizzle"),
    ((56, 57), "Freezing drizzle"),
    ((61, 63, 65), "Rain"),
    ((66, 67), "Freezing rain"),
    ((71, 73, 75, 77), "Snow"),
    ((80, 81, 82), "Rain showers"),
    ((85, 86), "Snow showers"),
    ((95, 96, 99), "Thunderstorm"),
]
WEATHER_UNKNOWN = "Unknown"
GOOD_SEVERITY = 10
DEGRADED_SEVERITIES = (7, 8, 9)
DISRUPTED_SEVERITIES = (1, 2, 3, 4, 5, 6)
GOOD_DESCRIPTION = "good service"
DEGRADED_TERMS = ("minor delays", "reduced service", "bus service", "special service")
DISRUPTED_TERMS = ("severe delays", "suspended", "closure", "closed")
SEPARATOR = " | "


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def code_label(code: Column | str, groups=WEATHER_CODE_GROUPS, default: str = WEATHER_UNKNOWN) -> Column:
    """CASE lookup of an integer code against (codes, label) groups."""
    code = _c(code)
    expr = None
    for codes, label in groups:
        cond = code.isin(*codes)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def is_good_service(severity: Column | str) -> Column:
    return F.coalesce(_c(severity) == GOOD_SEVERITY, F.lit(False))


def is_disrupted(severity: Column | str) -> Column:
    return ~is_good_service(severity)


def _contains_any(text: Column, terms) -> Column:
    cond = F.lit(False)
    for t in terms:
        cond = cond | text.contains(t)
    return cond


def service_state(severity: Column | str, description: Column | str) -> Column:
    sev = _c(severity)
    desc = F.lower(F.trim(F.coalesce(_c(description), F.lit(""))))
    return (
        F.when(sev == GOOD_SEVERITY, "Healthy")
        .when(sev.isin(*DEGRADED_SEVERITIES), "Degraded")
        .when(sev.isin(*DISRUPTED_SEVERITIES), "Disrupted")
        .when(desc == GOOD_DESCRIPTION, "Healthy")
        .when(_contains_any(desc, DEGRADED_TERMS), "Degraded")
        .when(_contains_any(desc, DISRUPTED_TERMS), "Disrupted")
        .otherwise("Unknown")
    )


_WS = " \t\n\r\f"


def strip_ws(text: Column | str) -> Column:
    return F.trim(_c(text), F.lit(_WS))


def clean_reason(reason: Column | str, name: Column | str | None = None) -> Column:
    """Drop a leading ``"<NAME> LINE: "`` / ``"<NAME>: "`` prefix.

    With a name column the prefix match is case-insensitive and the name is
    quoted literally; without one a generic upper-case prefix is removed.
    Blank or null reasons become null.
    """
    text = strip_ws(reason)
    if name is None:
        stripped = F.regexp_replace(text, F.lit(r"^[A-Z '&-]+\s+LINE:\s*"), F.lit(""))
    else:
        pattern = F.concat(F.lit(r"(?i)^\Q"), _c(name), F.lit(r"\E(?:\s+LINE)?:\s*"))
        stripped = F.when(
            _c(name).isNull() | (_c(name) == ""),
            F.regexp_replace(text, F.lit(r"^[A-Z '&-]+\s+LINE:\s*"), F.lit("")),
        ).otherwise(F.regexp_replace(text, pattern, F.lit("")))
    out = strip_ws(stripped)
    return F.when((text.isNull()) | (text == ""), F.lit(None).cast("string")).otherwise(out)


def sentences(text: Column | str) -> Column:
    """Split after ``. ! ?`` plus whitespace; trimmed, empty parts dropped."""
    parts = F.split(_c(text), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: strip_ws(s)), lambda s: s != "")


def first_sentence(text: Column | str) -> Column:
    return F.element_at(sentences(text), 1)


def remaining_sentences(text: Column | str) -> Column:
    arr = sentences(text)
    return F.when(F.size(arr) > 1, F.slice(arr, 2, F.size(arr) - 1)).otherwise(F.array().cast("array<string>"))


def eta_text(seconds: Column | str) -> Column:
    """``"<minutes, 1 dp> min"``, or ``"No data"`` for null.  Ties of the exact
    value go to the even digit (15 s is 0.2 min), as number_format rounds."""
    s = _c(seconds).cast("double")
    minutes = F.replace(F.format_number(s / 60.0, 1), F.lit(","), F.lit(""))
    return F.when(s.isNull(), "No data").otherwise(F.concat(minutes, F.lit(" min")))


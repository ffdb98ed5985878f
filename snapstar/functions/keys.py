"""Deterministic SHA-256 keys.

``concat_ws`` silently drops nulls (``a, null, b`` -> ``a||b``), so every
nullable part is coalesced to a marker first; otherwise two different rows can
share a key.  Doubles and timestamps are rendered with Spark's string format,
which depends on the session time zone (pinned to UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "||"
NULL_MARKER = "NULL"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash_key(*parts: Column | str, null_marker: str | None = NULL_MARKER) -> Column:
    """sha2(concat_ws('||', parts...), 256) with nulls replaced by a marker.

    ``null_marker=None`` keeps the raw ``concat_ws`` behaviour for parts that
    were validated non-null beforehand.
    """
    cols = []
    for p in parts:
        s = _c(p).cast("string")
        cols.append(s if null_marker is None else F.coalesce(s, F.lit(null_marker)))
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *cols), 256)


def attribute_hash(*parts: Column | str) -> Column:
    """Change-detection hash over descriptive attributes (null -> '')."""
    return hash_key(*parts, null_marker="")


def fold_key(key: Column | str, derived: Column) -> Column:
    """``key`` as one character where it is ``derived``, else marked as itself: what a
    table stores or shuffles whose other columns give the key.  A hash does not compress.
    :func:`unfold_key` gives back any text, and null."""
    c = _c(key)
    return F.when(c.eqNullSafe(derived), F.lit("=")).otherwise(F.concat(F.lit("!"), c))


def unfold_key(folded: Column | str, derived: Column) -> Column:
    c = _c(folded)
    return F.when(c == "=", derived).otherwise(F.substring(c, 2, 2**31 - 1))


def array_text(arr: Column | str, sep: str = ",") -> Column:
    """Order-insensitive text form of an array (sorted, joined)."""
    return F.concat_ws(sep, F.sort_array(_c(arr)))

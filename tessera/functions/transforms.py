"""Typed transforms T01–T09: value → typed value, null on any failure.

All are ``try_*`` / guarded casts, so a malformed value yields null
instead of failing the task under ANSI mode (the reference maps every
transform exception to null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_RE = r"^\s*[+-]?\d+\s*$"
_NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _txt(x) -> Column:
    return _c(x).cast("string")


def timestamp_ms_to_timestamp(x) -> Column:
    """Epoch milliseconds, or ``yyyy-MM-dd HH:mm:ss`` text → timestamp."""
    s = F.trim(_txt(x))
    as_ms = F.when(s.rlike(_INT_RE), F.timestamp_millis(s.try_cast("bigint")))
    as_text = F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(as_ms, as_text)


def timestamp_ms_to_date(x) -> Column:
    """T02."""
    return timestamp_ms_to_timestamp(x).cast("date")


def string_to_date(x) -> Column:
    """Strip a trailing ``.0``; ISO date-time (contains ``T``) keeps its date part."""
    s = F.regexp_replace(F.trim(_txt(x)), r"\.0$", "")
    iso = F.try_to_date(F.substring_index(s, "T", 1), "yyyy-MM-dd")
    return F.when(s.contains("T"), iso).otherwise(
        F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.to_date(F.try_to_timestamp(s))))


def string_to_timestamp(x) -> Column:
    """T04."""
    return F.try_to_timestamp(F.trim(_txt(x)))


def string_to_int(x) -> Column:
    """Whole numbers only (``'1.5'`` → null)."""
    s = _txt(x)
    return F.when(s.rlike(_INT_RE), F.trim(s).try_cast("bigint"))


def string_to_float(x) -> Column:
    """T06."""
    s = _txt(x)
    return F.when(s.rlike(_NUM_RE), F.trim(s).try_cast("double"))


def string_to_timestamp_iso(x) -> Column:
    """ISO text; ``Z`` means UTC; any other zone suffix is dropped
    without conversion (wall clock kept), as the reference parser does."""
    s = F.regexp_replace(F.trim(_txt(x)), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.try_to_timestamp(F.regexp_replace(s, "T", " "))


def string_to_date_flexible(x) -> Column:
    """``YYYY`` → Jan 1, ``YYYY-MM`` → 1st of month, ``YYYY-MM-DD``."""
    s = F.trim(_txt(x))
    n = F.length(s)
    return (
        F.when((n == 4) & s.rlike(r"^\d{4}$"), F.try_to_date(s, "yyyy"))
        .when((n == 7) & s.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(s, "yyyy-MM"))
        .when(n == 10, F.try_to_date(s, "yyyy-MM-dd"))
    )


def cast_value(x, target: str) -> Column:
    """INT64 / FLOAT64 / STRING / BOOL, null on failure.

    BOOL is truthiness, not a parse: JSON ``true``/``false`` keep their value,
    numbers are true when non-zero, any other non-empty text is true.
    """
    c = _c(x)
    t = target.upper()
    if t in ("INT64", "INTEGER", "INT"):
        return string_to_int(c)
    if t in ("FLOAT64", "FLOAT", "DOUBLE"):
        return string_to_float(c)
    if t == "STRING":
        return _txt(c)
    if t in ("BOOL", "BOOLEAN"):
        s = _txt(c)
        numeric = s.rlike(_NUM_RE)
        low = F.lower(F.trim(s))
        # JSON literals arrive as text 'true' / 'false' from the path getter
        return (F.when(c.isNull(), F.lit(None).cast("boolean"))
                .when(low == "false", F.lit(False)).when(low == "true", F.lit(True))
                .when(numeric, F.trim(s).try_cast("double") != 0).otherwise(F.length(s) > 0))
    raise ValueError(f"unsupported target type {target!r}")


TRANSFORMS = {
    "timestamp_ms_to_timestamp": timestamp_ms_to_timestamp,
    "timestamp_ms_to_date": timestamp_ms_to_date,
    "string_to_date": string_to_date,
    "string_to_timestamp": string_to_timestamp,
    "string_to_int": string_to_int,
    "string_to_float": string_to_float,
    "string_to_timestamp_iso": string_to_timestamp_iso,
    "string_to_date_flexible": string_to_date_flexible,
}


def apply_transform(name: str, x) -> Column:
    try:
        return TRANSFORMS[name](x)
    except KeyError:
        raise ValueError(f"unknown transform {name!r}") from None

"""Scalar column helpers (M01–M03, C01–C40 where Spark's built-in differs).

All return ``Column`` expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _int_text(x: Column) -> Column:
    """Whole number as text without a trailing ``.0``."""
    return F.floor(x).cast("bigint").cast("string")


def ms_to_hms(ms: ColumnOrName) -> Column:
    """Milliseconds → ``'{h}h {m}m {s}s'``; null stays null."""
    ms = _c(ms)
    return F.concat(
        _int_text(ms / 3600000), F.lit("h "),
        _int_text(F.pmod(ms, F.lit(3600000)) / 60000), F.lit("m "),
        _int_text(F.pmod(ms, F.lit(60000)) / 1000), F.lit("s"),
    )


def duration_to_hms(seconds: ColumnOrName) -> Column:
    """Seconds → ``'{h}h {m}m {s}s'``."""
    s = _c(seconds)
    return F.concat(
        _int_text(s / 3600), F.lit("h "),
        _int_text(F.pmod(s, F.lit(3600)) / 60), F.lit("m "),
        _int_text(F.pmod(s, F.lit(60))), F.lit("s"),
    )


def ms_to_hm(ms: ColumnOrName) -> Column:
    """``'{h}h {m}m'``, or ``'{m}m'`` under one hour."""
    ms = _c(ms)
    hours = F.floor(ms / 3600000)
    return F.when(
        hours > 0,
        F.concat(_int_text(hours), F.lit("h "), _int_text(F.pmod(ms, F.lit(3600000)) / 60000), F.lit("m")),
    ).otherwise(F.concat(_int_text(ms / 60000), F.lit("m")))


def hm_padded(ms: ColumnOrName) -> Column:
    """``'{h}h{mm}m'`` with zero-padded minutes (daily music time label)."""
    ms = _c(ms)
    return F.concat(
        _int_text(ms / 3600000), F.lit("h"),
        F.lpad(_int_text(F.pmod(ms, F.lit(3600000)) / 60000), 2, "0"), F.lit("m"),
    )


def ellipsis(text: ColumnOrName, width: int = 40) -> Column:
    """Cut text longer than ``width`` to ``width-3`` chars + ``'...'``."""
    t = _c(text)
    return F.when(F.length(t) > width, F.concat(F.substring(t, 1, width - 3), F.lit("..."))).otherwise(t)


def least_strict(*cols: ColumnOrName) -> Column:
    """LEAST that is null when any input is null (Spark's skips nulls)."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def greatest_strict(*cols: ColumnOrName) -> Column:
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def round_to_long(x: ColumnOrName) -> Column:
    """Float → integer rounding half away from zero (Spark's cast truncates), by decimal as :func:`round_half_up`."""
    return F.round(_c(x).cast("decimal(38,9)")).cast("bigint")


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division that yields null on a zero divisor (ANSI-safe)."""
    return F.try_divide(_c(a), _c(b))


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 1) -> Column:
    """``round(100 * part / nullif(whole, 0), digits)``."""
    return F.round(F.lit(100.0) * _c(part) / F.nullif(_c(whole), F.lit(0)), digits)


def regexp_extract_or_null(text: ColumnOrName, pattern: str, idx: int = 0) -> Column:
    """REGEXP_EXTRACT that is null when nothing matches."""
    return F.nullif(F.regexp_extract(_c(text), pattern, idx), F.lit(""))


def time_of_day(ts: ColumnOrName) -> Column:
    """TIME(ts) as ``HH:mm:ss`` text (no TIME type in PySpark 4.1)."""
    return F.date_format(_c(ts), "HH:mm:ss")


def weekday_name(d: ColumnOrName) -> Column:
    """C22 ``%A``: full weekday name."""
    return F.date_format(_c(d), "EEEE")


def weekday_letter(d: ColumnOrName) -> Column:
    return F.substring(weekday_name(d), 1, 1)


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week (``DATE_TRUNC(d, WEEK(MONDAY))``)."""
    return F.to_date(F.date_trunc("week", _c(d)))


def month_start(d: ColumnOrName) -> Column:
    return F.to_date(F.date_trunc("month", _c(d)))


def to_json_keep_nulls(x: ColumnOrName) -> Column:
    """TO_JSON_STRING keeps null fields; Spark's default drops them."""
    return F.to_json(_c(x), {"ignoreNullFields": "false"})


def safe_get(arr: ColumnOrName, index: int | Column) -> Column:
    """``arr[SAFE_OFFSET(i)]`` — 0-based, null when out of range."""
    idx = index if isinstance(index, Column) else F.lit(index)
    return F.get(_c(arr), idx)


def first_elem(arr: ColumnOrName) -> Column:
    """C33 ``arr[OFFSET(0)]``."""
    return F.get(_c(arr), F.lit(0))


def last_elem(arr: ColumnOrName) -> Column:
    """C33 ``arr[OFFSET(len-1)]``; null for empty arrays."""
    a = _c(arr)
    return F.when(F.size(a) > 0, F.element_at(a, -1))


def empty_to_null(arr: ColumnOrName) -> Column:
    """Array aggregates give ``[]`` in Spark where SQL engines give null (§7.4 #3)."""
    a = _c(arr)
    return F.when(F.size(a) > 0, a)


def ordered_array(value: ColumnOrName, *order: ColumnOrName) -> Column:
    """A10/A11 aggregate: values ordered by ``order`` columns (ascending).

    ``array_sort`` over ``collect_list(struct(order..., value))`` — struct
    comparison orders by the leading fields.  Use inside ``agg``.
    """
    fields = [_c(o).alias(f"_o{i}") for i, o in enumerate(order)] + [_c(value).alias("_v")]
    return F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda s: s["_v"])


def ordered_join(value: ColumnOrName, sep: str, *order: ColumnOrName) -> Column:
    """STRING_AGG(value, sep ORDER BY order)."""
    return F.array_join(ordered_array(value, *order), sep)


def round_half_up(x: ColumnOrName, digits: int = 2) -> Column:
    """Decimal half-up rounding of a double, stable at binary midpoints.

    ``round(double)`` on different engines disagrees on values such as
    1.005 whose binary form sits just below the midpoint; going through
    ``decimal(38,9)`` first rounds the decimal value everyone prints.
    """
    return F.round(_c(x).cast("decimal(38,9)"), digits).cast("double")


# Fixed value: the timestamp range a TIMESTAMP_MILLIS value must fall in
# (0001-01-01 … 9999-12-31), outside of which the SAFE form yields null.
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def safe_timestamp_millis(ms: ColumnOrName) -> Column:
    """``SAFE.TIMESTAMP_MILLIS`` — null outside the supported range."""
    m = _c(ms).cast("bigint")
    return F.when((m >= _MIN_MS) & (m <= _MAX_MS), F.timestamp_millis(m))


def datetime_of(x: ColumnOrName) -> Column:
    """C11: DATETIME(text or timestamp) — zone-less timestamp."""
    return F.to_timestamp_ntz(_c(x).cast("string"))

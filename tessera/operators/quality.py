"""Data-quality operators Q01–Q13.

Rules are column expressions that evaluate to an error text or null; the
per-record error list is ``filter(array(rules…), e -> e is not null)`` —
one projection, no extra pass, no UDF.  Splits and rates are plain
aggregates (or ``observe`` metrics collected by the write action itself).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str                    # not_null | positive | range | date_range | max_length | required
    low: object = None
    high: object = None

    def error(self) -> Column:
        c = F.col(self.column)
        name = self.column
        if self.kind in ("not_null", "required"):
            bad, msg = c.isNull(), f"{name}: is null"
        elif self.kind == "positive":
            bad, msg = c <= 0, f"{name}: must be positive"
        elif self.kind == "range":
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | (c < F.lit(self.low))
            if self.high is not None:
                bad = bad | (c > F.lit(self.high))
            msg = f"{name}: outside [{self.low}, {self.high}]"
        elif self.kind == "date_range":
            d = F.to_date(c)
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | (d < F.to_date(F.lit(_iso(self.low))))
            if self.high is not None:
                bad = bad | (d > F.to_date(F.lit(_iso(self.high))))
            msg = f"{name}: date outside [{self.low}, {self.high}]"
        elif self.kind == "max_length":
            bad, msg = F.length(c) > F.lit(self.high), f"{name}: longer than {self.high}"
        else:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        # nulls pass every rule except not_null / required
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(msg))


def _iso(v) -> str:
    return v.isoformat() if isinstance(v, (_dt.date, _dt.datetime)) else str(v)


def not_null(col: str) -> Rule:
    return Rule(col, "not_null")


def positive(col: str) -> Rule:
    return Rule(col, "positive")


def in_range(col: str, low=None, high=None) -> Rule:
    return Rule(col, "range", low, high)


def date_range(col: str, low=None, high=None) -> Rule:
    return Rule(col, "date_range", low, high)


def max_length(col: str, n: int) -> Rule:
    return Rule(col, "max_length", None, n)


def required_fields(cols: Sequence[str]) -> list[Rule]:
    """Q06: record-level presence of each field."""
    return [Rule(c, "required") for c in cols]


def with_errors(df: DataFrame, rules: Sequence[Rule], col: str = "_errors") -> DataFrame:
    """Q07: all rule failures of a record as ``array<string>`` (empty = valid)."""
    return df.withColumn(col, F.filter(F.array(*[r.error() for r in rules]), lambda e: e.isNotNull()))


def split_by_mode(df: DataFrame, rules: Sequence[Rule], mode: str = "strict", col: str = "_errors"):
    """Q08: ``(accepted, quarantined)`` frames.

    strict → invalid rows go to quarantine; warn → all rows accepted, the
    error list kept for logging; skip → rules not evaluated.
    """
    if mode == "skip":
        return df, df.limit(0)
    checked = with_errors(df, rules, col)
    bad = F.size(F.col(col)) > 0
    if mode == "warn":
        return checked, checked.filter(bad)
    if mode == "strict":
        return checked.filter(~bad).drop(col), checked.filter(bad)
    raise ValueError(f"unknown mode {mode!r}")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q09 ``not_null`` test: one row per column with its null count (one scan)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols]))
    return agg.select(stack)


def quality_summary(df: DataFrame, rules: Sequence[Rule], col: str = "_errors") -> DataFrame:
    """Q10: read / valid / rejected counts with success and rejection rates (one row)."""
    checked = with_errors(df, rules, col)
    agg = checked.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.size(F.col(col)) == 0).alias("records_valid"),
        F.count_if(F.size(F.col(col)) > 0).alias("records_rejected"),
    )
    return agg.select(
        "*",
        F.round(F.col("records_valid") / F.nullif(F.col("records_read"), F.lit(0)), 4).alias("success_rate"),
        F.round(F.col("records_rejected") / F.nullif(F.col("records_read"), F.lit(0)), 4).alias("rejection_rate"),
    )


def observed(df: DataFrame, rules: Sequence[Rule], name: str = "quality", col: str = "_errors"):
    """S20/Q10 at write time: ``(frame, Observation)``; the metrics are filled
    by whatever action writes the frame — no extra pass over the data."""
    obs = Observation(name)
    checked = with_errors(df, rules, col)
    out = checked.observe(
        obs,
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.size(F.col(col)) > 0).alias("records_rejected"),
    )
    return out, obs


@dataclass(frozen=True)
class AlertThresholds:
    """Q11 fixed values: rejection rate 0.1, processing time 600 s, no-data alert."""
    max_rejection_rate: float = 0.1
    max_processing_seconds: float = 600.0
    alert_on_no_data: bool = True


def alerts(metrics: dict, seconds: float, t: AlertThresholds = AlertThresholds()) -> list[str]:
    """Q11: alert texts from observed metrics (driver-side, a handful of numbers)."""
    out = []
    read = metrics.get("records_read", 0) or 0
    rejected = metrics.get("records_rejected", 0) or 0
    if t.alert_on_no_data and read == 0:
        out.append("no data")
    if read and rejected / read > t.max_rejection_rate:
        out.append(f"rejection rate {rejected / read:.3f} > {t.max_rejection_rate}")
    if seconds > t.max_processing_seconds:
        out.append(f"processing time {seconds:.0f}s > {t.max_processing_seconds:.0f}s")
    return out


def fill_nulls(df: DataFrame, replacements: dict[str, object]) -> DataFrame:
    """Q12: declared null replacements."""
    return df.fillna(replacements) if replacements else df

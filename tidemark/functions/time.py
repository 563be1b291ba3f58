"""Timestamp parsing, calendar truncation and differences.

All helpers return JVM expressions so they stay inside whole-stage codegen.
The session zone is UTC (see ``tidemark.session``), so ``timestamp -> timestamp_ntz``
casts yield UTC wall-clock values.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_utc(c: Column | str) -> Column:
    """strict cast of ISO text (offset allowed) to a UTC ``timestamp_ntz``; bad text raises (ANSI)."""
    return _as_col(c).cast("timestamp").cast("timestamp_ntz")


def lenient_utc(c: Column | str) -> Column:
    """lenient parse of ISO text to UTC ``timestamp_ntz``; bad text becomes NULL."""
    return F.try_to_timestamp(_as_col(c).cast("string")).cast("timestamp_ntz")


def utc_column(df: DataFrame, name: str, strict: bool = True) -> Column:
    """Column ``name`` as UTC ``timestamp_ntz``: typed input passes through, text is parsed."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return strict_utc(name) if strict else lenient_utc(name)


def week_start(c: Column | str) -> Column:
    """Monday of the ISO week, as a date."""
    return F.date_trunc("week", _as_col(c)).cast("date")


def month_start(c: Column | str) -> Column:
    """first day of the month, as a date."""
    return F.date_trunc("month", _as_col(c)).cast("date")


def period_start(c: Column | str, period: str) -> Column:
    if period == "weekly":
        return week_start(c)
    if period == "monthly":
        return month_start(c)
    raise ValueError(f"period must be 'weekly' or 'monthly', got {period!r}")


def weeks_between(later: Column | str, earlier: Column | str) -> Column:
    """F8: whole weeks between two week starts (exact: both are Mondays)."""
    return F.floor(F.datediff(_as_col(later), _as_col(earlier)) / F.lit(7)).cast("int")


def months_between_starts(later: Column | str, earlier: Column | str) -> Column:
    """calendar months between two month starts."""
    a, c = _as_col(later), _as_col(earlier)
    return ((F.year(a) - F.year(c)) * 12 + F.month(a) - F.month(c)).cast("int")


def periods_between(later: Column | str, earlier: Column | str, period: str) -> Column:
    if period == "weekly":
        return weeks_between(later, earlier)
    if period == "monthly":
        return months_between_starts(later, earlier)
    raise ValueError(f"period must be 'weekly' or 'monthly', got {period!r}")


def as_of_literal(as_of: str | datetime) -> Column:
    """An as-of instant as a UTC ``timestamp_ntz`` literal (zone offsets are converted)."""
    if isinstance(as_of, datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return strict_utc(F.lit(as_of))


def whole_days_between(as_of: Column, ts: Column | str) -> Column:
    """whole days of ``as_of - ts``, truncated toward zero (5d23h -> 5, -5d23h -> -5)."""
    return F.extract(F.lit("DAY"), as_of - _as_col(ts)).cast("long")


def whole_days_clipped(as_of: Column, ts: Column | str) -> Column:
    """whole days since ``ts``, clipped at zero."""
    return F.greatest(whole_days_between(as_of, ts), F.lit(0).cast("long"))

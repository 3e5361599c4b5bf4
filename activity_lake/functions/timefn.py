"""Date and time expressions with the reference's exact semantics.

All are native Catalyst expressions (they stay inside whole-stage codegen).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_iso(text: Column) -> Column:
    """ISO-8601 ``Z`` text -> TIMESTAMP (NULL on bad text, never an error).

    ``try_to_timestamp`` keeps the non-ANSI behaviour the pipeline relies on:
    Spark 4 raises on ``to_timestamp('nope')`` under ANSI mode.
    """
    return F.try_to_timestamp(text)


def to_iso(ts: Column) -> Column:
    """TIMESTAMP(_NTZ) -> ISO-8601 text at second precision with ``Z``."""
    return F.date_format(ts, ISO_Z)


def boundary_hours(start: Column, end: Column) -> Column:
    """Hours between two instants counted as *minute boundaries crossed* / 60.

    00:00:59 -> 00:01:01 is one boundary (1/60 h) although only 2 s elapsed;
    ``timestampdiff(MINUTE)`` would give 0. Truncating both ends to the minute
    and subtracting epoch seconds gives the boundary count exactly.
    """
    a = F.unix_timestamp(F.date_trunc("minute", start))
    b = F.unix_timestamp(F.date_trunc("minute", end))
    return ((b - a) / F.lit(60)) / F.lit(60.0)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def months_between_starts(a: Column, b: Column) -> Column:
    """Whole months from month start ``a`` to month start ``b`` (exact on starts)."""
    return F.months_between(b, a).cast("int")


def weekday_sun0(d: Column) -> Column:
    """Sunday = 0 .. Saturday = 6 (Spark's ``dayofweek`` is Sunday = 1)."""
    return F.dayofweek(d) - F.lit(1)


def ntz(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in the session zone (UTC): wall-clock output."""
    return ts.cast("timestamp_ntz")


def hours_2dp_from_minutes(minutes: Column) -> Column:
    """``round(minutes / 60, 2)`` half-up, computed exactly.

    Latency medians and interpolated percentiles of minute-resolution values
    are multiples of 0.1 minute, so ``t = round(minutes * 10)`` is exact and
    ``hours * 100 = t / 6``; half-up rounding is ``floor((t + 3) / 6)``. This
    removes the float noise of interpolation that would otherwise flip a
    ``.xx5`` to either side depending on the engine.
    """
    t = F.round(minutes * F.lit(10)).cast("long")
    return F.floor((t + F.lit(3)) / F.lit(6)) / F.lit(100.0)


def mean_2dp(values_2dp: Column) -> Column:
    """``round(avg(x), 2)`` half-up, exactly, for x already on a 0.01 grid."""
    s = F.sum(F.round(values_2dp * F.lit(100)).cast("long"))
    c = F.count(values_2dp)
    return F.floor((s * 2 + c) / (c * 2)) / F.lit(100.0)


def pct_1dp(num: Column, den: Column) -> Column:
    """``round(100 * num / den, 1)`` half-up, exactly, for non-negative integers."""
    return F.floor((num * 2000 + den) / (den * 2)) / F.lit(10.0)

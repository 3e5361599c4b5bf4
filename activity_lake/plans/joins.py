"""The one broadcast hint of the library: calendars, bounded by their parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_calendar(df: DataFrame) -> DataFrame:
    """Hints a side with at most one row for each day or hour of a window that the
    caller has clipped it to. Other sides carry no hint: AQE decides at run time."""
    return F.broadcast(df)

"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_instant(df: DataFrame, col: str) -> Column:
    """An event-time instant from ``col``: a wall-clock ``timestamp_ntz`` is
    read as UTC whatever the session time zone (watermarks need an
    instant); an instant is kept as it is."""
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return F.concat(F.col(col).cast("string"), F.lit("Z")).cast("timestamp")
    return F.col(col)

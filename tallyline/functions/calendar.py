"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end."""
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))

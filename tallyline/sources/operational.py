"""Daily operational extracts in long format (entity, metric, value)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import OPERATIONAL


def extract_day(source: DataFrame, day: dt.date) -> DataFrame:
    """The rows of one ``record_date``: a pushed filter, or one partition when the source
    is partitioned by date. ``staging_id`` goes along: rows of one load share their load time,
    and only the id says which of them came first."""
    return source.filter(F.col("record_date") == F.lit(day)).select(
        *OPERATIONAL.fieldNames()
    )

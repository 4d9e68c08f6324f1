"""Commit dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_month(iso_date: Column) -> Column:
    """YYYY-MM in the date's own UTC offset; null for text that is no ISO date."""
    text = F.trim(iso_date)
    valid = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$") & F.try_to_timestamp(text).isNotNull()
    return F.when(valid, F.substring(text, 1, 7))

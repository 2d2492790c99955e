"""Date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(col: str | Column) -> Column:
    """Calendar day of a timestamp in the session time zone; NULL -> NULL."""
    return F.to_date(F.col(col) if isinstance(col, str) else col)

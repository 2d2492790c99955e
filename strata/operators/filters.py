"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL.  A blank string is not NULL
    and passes.  On a file scan Catalyst pushes ``IsNotNull`` to the reader."""
    if not columns:
        return df
    cond = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)

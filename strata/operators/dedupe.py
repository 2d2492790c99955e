"""Keep one row per key.

``dropDuplicates`` keeps an arbitrary row per key, and which one may change
between runs and even between a task and its retry after an executor is
lost.  Here the survivor is the first row under a total order (the
tie-break columns ascending, NULL last), so the result is the same on every
run and every recomputation.

Plan shape: ``row_number() == 1`` over the key lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per key.  A key holding a third of all rows therefore sends at most one
row per map task across the network, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, ArrayType, DataType

_RN = "__strata_rn"


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def default_tie_break(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Every non-key column that has an order (map columns have none)."""
    key_set = set(keys)
    return [f.name for f in df.schema.fields if f.name not in key_set and _orderable(f.dataType)]


def dedupe(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = (),
           order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys``; NULL keys count as equal (one NULL-key row stays).

    The survivor is the first row under ``order_by`` when given (e.g. the
    latest version: ``[F.col("seq").desc()]``), else under ``tie_break``
    ascending with NULL last, else under all other columns."""
    if not keys:
        raise ValueError("dedupe needs at least one key column")
    if order_by:
        ordering = list(order_by)
    else:
        order = list(tie_break) or default_tie_break(df, keys)
        ordering = [F.col(c).asc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return (
        df.withColumn(_RN, F.row_number().over(window))
        .filter(F.col(_RN) == 1)
        .drop(_RN)
    )

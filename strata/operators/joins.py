"""Joins with a checked broadcast.

A side is broadcast only when its size is proven small.  One aggregate
counts the rows and sums their payload bytes (text and binary by
``octet_length``, other types by their fixed width); every task sends two
numbers, no rows move.  Both bounds must hold.  Beyond them
the join is a shuffle join, and AQE (skew-join splitting, broadcast from the
measured size of a finished shuffle stage) takes over.  The planner's own
estimate-based broadcast is switched off in ``strata.session``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

# bytes per value of fixed-width types
_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16, T.NullType: 1,
}


@dataclass(frozen=True)
class BroadcastDecision:
    broadcast: bool
    rows: int
    bytes: int
    reason: str


def value_bytes(name: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    for kind, width in _WIDTH.items():
        if isinstance(dtype, kind):
            return F.lit(width)
    # nested values: size of their JSON text
    return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))


def measure(df: DataFrame) -> tuple[int, int]:
    """``(rows, payload bytes)`` of ``df``: one aggregate, each task sends two numbers."""
    widths = [value_bytes(f.name, f.dataType) for f in df.schema.fields] or [F.lit(0)]
    row_bytes = widths[0]
    for w in widths[1:]:
        row_bytes = row_bytes + w
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def decide_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                     max_bytes: int = DEFAULT_MAX_BYTES) -> BroadcastDecision:
    rows, size = measure(df)
    if rows > max_rows:
        return BroadcastDecision(False, rows, size, "row bound exceeded")
    if size > max_bytes:
        return BroadcastDecision(False, rows, size, "byte bound exceeded")
    return BroadcastDecision(True, rows, size, "rows and bytes within bounds")


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                 max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES,
                 null_safe: bool = False, bound_by: DataFrame | None = None) -> DataFrame:
    """``left.join(right, on, how)`` broadcasting ``right`` only when proven small.

    ``right`` is the side kept whole in memory; for a left outer join that is
    the only side Spark can build from anyway.  With ``null_safe`` NULL keys
    match each other (``<=>``), as in a grouping.  ``bound_by`` is a cheaper
    frame known to be at least as large in rows and bytes (the source of a
    dedupe/filter/trim of the same columns); it is measured instead, so the
    proof is one scan rather than a computation of ``right``."""
    decision = decide_broadcast(right if bound_by is None else bound_by, max_rows, max_bytes)
    side = F.broadcast(right) if decision.broadcast else right
    if not null_safe:
        return left.join(side, on=list(on), how=how)
    return null_safe_join(left, side, on, how)


def null_safe_join(left: DataFrame, side: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """``left.join(side, on, how)`` where NULL keys match each other."""
    renamed = {c: f"__strata_r_{c}" for c in on}
    side = side.withColumnsRenamed(renamed)
    cond = None
    for c in on:
        term = left[c].eqNullSafe(side[renamed[c]])
        cond = term if cond is None else cond & term
    joined = left.join(side, on=cond, how=how)
    if how in ("left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        return joined
    return joined.drop(*renamed.values())

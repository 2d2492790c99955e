"""File layouts that let a filter skip files by their column statistics.

``range_layout`` cuts the rows into files by ranges of the leading column and
sorts within: a filter on it meets few files.  ``z_order`` interleaves the
bits of several columns' ranks, so that a filter on any of them meets few
files.  A rank is the number of quantile bounds at or below the value (one
aggregate gives ``2**bits - 1`` approximate quantiles per column, a bounded
list), found by a binary search; skewed values therefore spread as well as even
ones.  Both are one range exchange and a sort within its partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks.tables import publish

_Z = "__strata_z"


def range_layout(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` ranges of ``columns``, sorted within each."""
    return df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)


def _number(c: Column, dtype: T.DataType) -> Column:
    """A number in the order of the column: text by its first six bytes."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return c.cast("double")


def _rank(c: Column, bounds: Sequence[float]) -> Column:
    """How many of the ascending ``bounds`` lie at or below ``c``; NULL and NaN first."""
    ranks = F.array(*[F.lit(float(b)) for b in bounds])
    steps = [1]
    while steps[-1] * 2 <= len(bounds):
        steps.append(steps[-1] * 2)
    # a binary search: every step goes up where the bound there is not above the value
    at = F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.try_element_at(ranks, at + step) <= c), at + step).otherwise(at))
    return F.when(c.isNull() | F.isnan(c), F.lit(0)).otherwise(at)


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """``df`` with the interleaved ranks of ``columns`` in ``__strata_z``."""
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into one number")
    numbers = {f"{_Z}{i}": _number(F.col(c), df.schema[c].dataType) for i, c in enumerate(columns)}
    out = df.withColumns(numbers)
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    usable = {n: F.when(~F.isnan(F.col(n)), F.col(n)) for n in numbers}
    found = out.agg(*[F.percentile_approx(v, cuts, 10_000).alias(n) for n, v in usable.items()]).first()
    ranks = {}
    for n in numbers:
        bounds = sorted(set(found[n] or ()))
        ranks[f"{n}r"] = _rank(F.col(n), bounds).cast("long") if bounds else F.lit(0).cast("long")
        if bounds:
            # few distinct bounds still use all bits
            ranks[f"{n}r"] = (ranks[f"{n}r"] * F.lit(1 << bits) / F.lit(len(bounds) + 1)).cast("long")
    out = out.withColumns(ranks)
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for i, n in enumerate(numbers):
            one = F.shiftright(F.col(f"{n}r"), bit).bitwiseAND(F.lit(1).cast("long"))
            z = z + F.shiftleft(one, bit * len(columns) + (len(columns) - 1 - i))
    return out.withColumn(_Z, z).drop(*numbers, *ranks)


def z_order(df: DataFrame, columns: Sequence[str], files: int, bits: int = 8) -> DataFrame:
    """``df`` in ``files`` ranges of the interleaved ranks of ``columns``."""
    placed = z_value(df, columns, bits)
    return placed.repartitionByRange(files, _Z, *columns).sortWithinPartitions(_Z, *columns).drop(_Z)


def publish_layout(df: DataFrame, name: str, columns: Sequence[str], files: int, interleave: bool = False,
                   schema_policy: str = "merge") -> str:
    """Publish ``df`` laid out by range of ``columns``, or by all of them interleaved."""
    out = z_order(df, columns, files) if interleave else range_layout(df, columns, files)
    return publish(out, name, schema_policy=schema_policy)


def files_met(df: DataFrame) -> int:
    """How many files hold the rows of ``df``, a filtered table."""
    return df.select(F.col("_metadata.file_path").alias("f")).distinct().count()

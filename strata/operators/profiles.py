"""Column profiles that add up over loads.

One aggregate over a load's rows gives a state per column: exact counts of
rows, NULLs and blanks, the least and largest value, and two sketches of
bounded size, HyperLogLog for the distinct values and KLL for quantiles.
States of any loads are added by one small aggregate, so the profile of a
whole table needs only the new rows of each load.  The stored states are
partitioned by load: a load delivered again replaces its own.

Numbers, dates (days) and timestamps (microseconds) enter the quantiles as
doubles, text by its length in characters; NULL and NaN stay out of them, and of
the least and largest value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks.partitions import overwrite_partitions
from strata.sinks.tables import publish, quote, table_exists

LOAD = "load_id"
#: registers (2 to this power) of a distinct sketch: about 0.8 % standard error
DISTINCT_LG = 14
#: size of a quantile sketch: ranks within about 0.7 % of the rows
QUANTILE_K = 400
QUANTILES = (0.25, 0.5, 0.75)


def measure(col: Column, dtype: T.DataType) -> Column | None:
    """The number that a column's quantiles are taken of; None where it has none."""
    if isinstance(dtype, T.NumericType):
        out = col.cast("double")
        return F.when(~F.isnan(out), out)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(dtype, T.StringType):
        return F.char_length(col).cast("double")
    return None


def _countable(col: Column, dtype: T.DataType) -> Column:
    """The value as the distinct sketch takes it: text, numbers by their printed form."""
    if isinstance(dtype, (T.StringType, T.LongType, T.IntegerType, T.BinaryType)):
        return col
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(col.isNotNull(), F.to_json(F.struct(col)))
    return col.cast("string")


def column_states(df: DataFrame, load_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of state per column of ``df``, by one pass over it."""
    columns = list(columns or df.columns)
    states = []
    for c in columns:
        dtype = df.schema[c].dataType
        col = F.col(quote(c))
        number = measure(col, dtype)
        blank = F.count_if(F.trim(col) == "") if isinstance(dtype, T.StringType) else F.lit(0).cast("long")
        none = F.lit(None)
        states.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(col.isNull()).alias("n_null"),
            blank.alias("n_blank"),
            (none.cast("double") if number is None else F.min(number)).alias("least"),
            (none.cast("double") if number is None else F.max(number)).alias("largest"),
            F.hll_sketch_agg(_countable(col, dtype), DISTINCT_LG).alias("distinct_sketch"),
            (none.cast("binary") if number is None else F.kll_sketch_agg_double(number, QUANTILE_K))
            .alias("quantile_sketch")))
    rows = df.agg(F.array(*states).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    return rows.withColumn(LOAD, F.lit(load_id))


def store_profile(df: DataFrame, name: str, load_id: str, columns: Sequence[str] | None = None) -> str:
    """Add the load's states to table ``name``; a load known there is replaced."""
    states = column_states(df, load_id, columns)
    if not table_exists(df.sparkSession, name):
        return publish(states, name, partition_by=(LOAD,))
    return overwrite_partitions(states, name)


def merge_states(states: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profile of all rows behind ``states``: ``(column, n_rows, n_null, n_blank, least, largest,
    n_distinct, q<percent>...)``; the last ones are estimates."""
    merged = states.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_blank")],
        F.min("least").alias("least"), F.max("largest").alias("largest"),
        F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("quantile_sketch").alias("q"))
    some = F.coalesce(F.kll_sketch_get_n_double("q") > 0, F.lit(False))
    return merged.select(
        "column", "n_rows", "n_null", "n_blank",
        # one zero, whatever its sign
        *[F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in ("least", "largest")],
        F.hll_sketch_estimate("d").alias("n_distinct"),
        *[F.when(some, F.kll_sketch_get_quantile_double("q", F.lit(float(x)))).alias(f"q{x * 100:g}")
          for x in quantiles])


def table_profile(spark: SparkSession, name: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profile of all loads stored in ``name``; reads states only."""
    return merge_states(spark.table(name), quantiles)

"""Data quality: per-column metrics, quarantine of rejected rows, schema
contracts.

* ``column_metrics`` -- rows, NULLs and blanks per column in one pass (one
  aggregate with conditional counts), reshaped to one row per column.
* ``clean_with_rejects`` -- the cleaned rows and, beside them, every raw row
  the rules dropped, with the reason.  Survivors come from the same
  deterministic dedupe as ``clean``; the dropped copies are counted per
  distinct row (an aggregate with map-side combining) and written out again
  in chunks dealt over the tasks, so no task makes all copies of one row.
* ``check_contract`` -- compare a schema with a declared ``StructType``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from strata.operators.clean import normalise_text
from strata.operators.dedupe import dedupe
from strata.specs import CleanSpec

REJECT_REASON = "_reject_reason"
DUPLICATE = "duplicate"
MISSING_PREFIX = "missing:"
# copies of one row that a task writes out at a time
COPIES_PER_CHUNK = 10_000

_COPIES = "__strata_copies"
_CHUNK = "__strata_chunk"
_COPY = "__strata_copy"


def column_metrics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_rows, n_null, n_blank)`` for each column, one scan.

    ``n_blank`` counts strings that are empty after trimming spaces (0 for
    other types)."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        col = F.col("`" + c.replace("`", "``") + "`")
        aggs.append(F.count_if(col.isNull()).alias(f"n{i}"))
        blank = (F.count_if(F.trim(col) == "") if isinstance(types[c], StringType)
                 else F.lit(0).cast("long"))
        aggs.append(blank.alias(f"b{i}"))
    wide = df.agg(*aggs)
    stacked = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}, b{i}" for i, c in enumerate(columns))
    return wide.selectExpr(
        "n_rows", f"stack({len(columns)}, {stacked}) as (column, n_null, n_blank)"
    ).select("column", "n_rows", "n_null", "n_blank")


def _missing_reason(required: Sequence[str]) -> Column:
    """Name of the first required column that is NULL (NULL when none is)."""
    reason = F.lit(None).cast("string")
    for c in reversed(list(required)):
        reason = F.when(F.col(c).isNull(), F.lit(MISSING_PREFIX + c)).otherwise(reason)
    return reason


def surplus_copies(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows EXCEPT ALL kept``, where one row may have any number of copies.

    The copies of a distinct row are counted, cut into chunks and the chunks
    dealt over the tasks before they are expanded."""
    names = [f"`{c.replace('`', '``')}`" for c in rows.columns]
    left = (rows.select(*names, F.lit(1).cast("long").alias(_COPIES))
            .union(kept.select(*names, F.lit(-1).cast("long").alias(_COPIES)))
            .groupBy(*names).agg(F.sum(_COPIES).alias(_COPIES)).filter(F.col(_COPIES) > 0))
    chunks = left.withColumn(_CHUNK, F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(_COPIES) - 1) / COPIES_PER_CHUNK))))
    here = F.least(F.lit(COPIES_PER_CHUNK), F.col(_COPIES) - F.col(_CHUNK) * COPIES_PER_CHUNK)
    # a stated number of tasks: AQE would merge them by the few bytes that the chunks have before they are expanded
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (chunks.repartition(tasks, *names, _CHUNK)
            .withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("long"), here))).select(*names))


def clean_with_rejects(df: DataFrame, spec: CleanSpec) -> tuple[DataFrame, DataFrame]:
    """``(cleaned, rejects)``; ``rejects`` holds raw rows plus ``_reject_reason``.

    ``input = count(cleaned) + count(rejects)`` always holds."""
    if spec.dedupe_after_filter:
        reason = _missing_reason(spec.required)
        missing = df.withColumn(REJECT_REASON, reason).filter(F.col(REJECT_REASON).isNotNull())
        passed = df.filter(reason.isNull()) if spec.required else df
        survivors = dedupe(passed, spec.keys, spec.tie_break)
        copies = surplus_copies(passed, survivors).withColumn(REJECT_REASON, F.lit(DUPLICATE))
        kept = survivors
    else:
        survivors = dedupe(df, spec.keys, spec.tie_break)
        copies = surplus_copies(df, survivors).withColumn(REJECT_REASON, F.lit(DUPLICATE))
        reason = _missing_reason(spec.required)
        missing = survivors.withColumn(REJECT_REASON, reason).filter(F.col(REJECT_REASON).isNotNull())
        kept = survivors.filter(reason.isNull()) if spec.required else survivors
    return normalise_text(kept, spec), copies.unionByName(missing)


@dataclass(frozen=True)
class ContractIssue:
    column: str
    expected: str | None
    actual: str | None


def check_contract(schema: StructType, contract: StructType,
                   allow_extra: bool = True) -> list[ContractIssue]:
    """Columns missing, of another type, or (unless allowed) not declared."""
    actual = {f.name: f.dataType for f in schema.fields}
    issues = []
    for f in contract.fields:
        got = actual.get(f.name)
        if got is None or got != f.dataType:
            issues.append(ContractIssue(f.name, f.dataType.simpleString(),
                                        got.simpleString() if got is not None else None))
    if not allow_extra:
        declared = {f.name for f in contract.fields}
        issues += [ContractIssue(n, None, t.simpleString()) for n, t in actual.items()
                   if n not in declared]
    return issues


class ContractViolation(ValueError):
    pass


def enforce_contract(df: DataFrame, contract: StructType, allow_extra: bool = True) -> DataFrame:
    """Raise before the write when ``df`` breaks ``contract``; else ``df``."""
    issues = check_contract(df.schema, contract, allow_extra)
    if issues:
        raise ContractViolation("; ".join(f"{i.column}: expected {i.expected}, got {i.actual}"
                                          for i in issues))
    return df

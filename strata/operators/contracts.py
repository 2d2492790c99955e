"""Row-level contracts: rules on rows and references between tables.

All row rules of a table are evaluated in one pass: each is a bit of one
number per row (bit set: rule broken; a rule whose condition is NULL is
broken, so a missing value never passes by accident).  The report is one aggregate
over these bits.

A reference check counts the rows per referring value first (an aggregate
with map-side combining, so a value that a third of the rows hold is one row) and
anti-joins these values with the distinct keys of the other table.  NULL
references are counted on their own and are no orphans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import checked_join

BROKEN = "__broken"
#: rules one number can hold
MAX_RULES = 63


class ContractBroken(ValueError):
    """Rows break a rule more often than allowed."""


@dataclass(frozen=True)
class Rule:
    """A named SQL condition that every row must meet."""

    name: str
    condition: str


@dataclass(frozen=True)
class Reference:
    """``columns`` of a row must be found as ``keys`` of another table."""

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]


def _broken(rule: Rule) -> Column:
    return ~F.coalesce(F.expr(rule.condition).cast("boolean"), F.lit(False))


def with_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with one number per row: bit ``i`` is set when rule ``i`` is broken."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; one pass holds {MAX_RULES}")
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("two rules of one name")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits + F.when(_broken(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return df.withColumn(BROKEN, bits)


def broken_names(rules: Sequence[Rule]) -> Column:
    """The names of the broken rules of a row, in their order, from its number."""
    return F.filter(F.array(*[F.when(F.col(BROKEN).bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(r.name))
                              for i, r in enumerate(rules)]), lambda x: x.isNotNull())


def split_rows(df: DataFrame, rules: Sequence[Rule], reasons: str = "broken_rules") -> tuple[DataFrame, DataFrame]:
    """``(rows that meet all rules, the others with the rules they break)``."""
    marked = with_broken(df, rules)
    return (marked.where(F.col(BROKEN) == 0).drop(BROKEN),
            marked.where(F.col(BROKEN) != 0).withColumn(reasons, broken_names(rules)).drop(BROKEN))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, n_rows, n_broken)``, a row per rule, from one aggregate."""
    names = [F.struct(F.lit(r.name).alias("rule"), F.col("n_rows"), F.col(f"b{i}").alias("n_broken"))
             for i, r in enumerate(rules)]
    counts = with_broken(df, rules).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(BROKEN).bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias(f"b{i}") for i in range(len(rules))])
    return counts.select(F.inline(F.array(*names)))


def orphans(df: DataFrame, reference: Reference, other: DataFrame) -> DataFrame:
    """``(columns..., n_rows)``: the referring values that ``other`` does not hold."""
    cols = list(reference.columns)
    full = F.lit(True)
    for c in cols:
        full = full & F.col(c).isNotNull()
    values = df.where(full).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = other.select(*[F.col(k).alias(c) for k, c in zip(reference.keys, cols)]).distinct()
    return checked_join(values, keys, cols, "left_anti", bound_by=other.select(*reference.keys))


def reference_report(df: DataFrame, reference: Reference, other: DataFrame) -> DataFrame:
    """One row ``(rule, n_rows, n_broken)``; a row is broken when its value is an orphan."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    broken = orphans(df, reference, other).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_broken"))
    both = (counted.select("n_rows", F.lit(None).cast("long").alias("n_broken"))
            .unionByName(broken.select(F.lit(None).cast("long").alias("n_rows"), "n_broken")))
    return both.agg(F.max("n_rows").alias("n_rows"), F.max("n_broken").alias("n_broken")).select(
        F.lit(reference.name).alias("rule"), "n_rows", "n_broken")


def enforce_rows(df: DataFrame, rules: Sequence[Rule] = (), references: Sequence[tuple[Reference, DataFrame]] = (),
                 allowed: int = 0) -> DataFrame:
    """``df`` itself when no rule is broken more than ``allowed`` times, else an error that names them."""
    reports = ([rule_report(df, rules)] if rules else []) + [reference_report(df, r, other) for r, other in references]
    bad = [(r["rule"], r["n_broken"]) for report in reports for r in report.collect() if r["n_broken"] > allowed]
    if bad:
        raise ContractBroken(", ".join(f"{name}: {n} rows" for name, n in bad))
    return df

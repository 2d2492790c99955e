"""Aggregates kept up by deltas (counting view maintenance).

A summary's *state* holds, per group, what can be added and taken away: its
rows, and per metric the non-NULL values and their exact sum.  When rows of
a cleaned table change, the old rows of the touched keys enter with minus
and the new ones with plus; added to the state of the touched groups they
give the state of a rebuild.  A sum whose values are all gone is NULL again,
a group without rows vanishes.

With a left join the delta of the main input joins the unchanged side; a
change of the joined side moves the joined keys' own subtotals from the old
row's groups to the new row's.  Only the subtotals of touched keys are
built, by a semi join of the main input.

The state table is cut into parts by a hash of the group.  A batch's delta is
written first (a partition of its own, replaced when it is written again);
then only the parts with touched groups are read and replaced.  Each part
carries the batch it saw last, so applying a delta again after a run that
died half-way skips the parts that have it.

Sums are kept as decimals: integers and decimals are exact.  Floating-point
sums depend on their order and cannot be taken back; such a metric raises, as
does a distinct count of a column that is not unique.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import checked_join
from strata.operators.summarise import _effective_fn, _metric_expr, _prepare
from strata.sinks.partitions import drop_partitions, overwrite_partitions, within
from strata.sinks.tables import ensure_schema, publish, split_name, table_exists
from strata.specs import SummarySpec

PART, SEEN, ROWS = "__part", "__batch", "__rows"
#: parts of a state table
DEFAULT_PARTS = 64
_SIGN = "__sign"

Resolve = Callable[[str], DataFrame]


def _names(spec: SummarySpec) -> list[str]:
    out = [ROWS]
    for i, m in enumerate(spec.metrics):
        out.append(f"__n{i}")
        if _effective_fn(m, spec.unique) in ("sum", "avg"):
            out.append(f"__s{i}")
    return out


def _check(spec: SummarySpec) -> None:
    for m in spec.metrics:
        if _effective_fn(m, spec.unique) == "count_distinct":
            raise ValueError(f"{spec.name}.{m.name}: distinct values of {m.column!r} cannot be kept by counts")
    j = spec.join
    if j is None:
        return
    if j.how != "left" or not j.unique_on_key:
        raise ValueError(f"{spec.name}: only a left join to a table unique on its key can be kept up")
    if j.table == spec.source:
        raise ValueError(f"{spec.name} joins its own source")


def _sum_type(dtype: T.DataType, what: str) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"decimal(38,{dtype.scale})"
    if isinstance(dtype, T.IntegralType):
        return "decimal(38,0)"
    raise ValueError(f"{what}: a sum of {dtype.simpleString()} is not exact and cannot be kept up")


def _contributions(df: DataFrame, spec: SummarySpec, by: Sequence[str]) -> DataFrame:
    """Signed rows of the main input as state columns per ``by``."""
    sign = F.col(_SIGN)
    aggs = [F.sum(sign).cast("long").alias(ROWS)]
    for i, m in enumerate(spec.metrics):
        c = F.col(m.column)
        aggs.append(F.sum(F.when(c.isNotNull(), sign).otherwise(F.lit(0))).cast("long").alias(f"__n{i}"))
        if _effective_fn(m, spec.unique) in ("sum", "avg"):
            kind = _sum_type(df.schema[m.column].dataType, f"{spec.name}.{m.name}")
            v = c.cast(kind)
            aggs.append(F.coalesce(F.sum(F.when(sign < 0, -v).otherwise(v)), F.lit(0)).cast(kind).alias(f"__s{i}"))
    return df.groupBy(*by).agg(*aggs)


def _added(df: DataFrame, spec: SummarySpec, by: Sequence[str]) -> DataFrame:
    """State columns summed up per ``by``."""
    return df.groupBy(*by).agg(*[F.sum(n).cast(df.schema[n].dataType).alias(n) for n in _names(spec)])


def _side(spec: SummarySpec, df: DataFrame) -> DataFrame:
    return df.select(*spec.join.columns)


def _signed(df: DataFrame, sign: int) -> DataFrame:
    return df.withColumn(_SIGN, F.lit(sign).cast("long"))


def build_state(spec: SummarySpec, source: DataFrame, resolve: Resolve | None = None) -> DataFrame:
    """The state of ``spec`` over its whole cleaned input."""
    _check(spec)
    base = _signed(_prepare(source, spec), 1)
    if spec.join is None:
        return _contributions(base, spec, spec.group_by)
    keyed = _contributions(base, spec, spec.join.on)
    return _added(keyed.join(_side(spec, resolve(spec.join.table)), list(spec.join.on), "left"), spec, spec.group_by)


def state_delta(spec: SummarySpec, table: str, old: DataFrame, new: DataFrame, resolve: Resolve) -> DataFrame:
    """What changes in the state when rows ``old`` of cleaned ``table`` become ``new``.

    ``resolve`` gives the other cleaned tables.  Groups whose changes cancel
    out are left out."""
    _check(spec)
    if table == spec.source:
        rows = _signed(_prepare(old, spec), -1).unionByName(_signed(_prepare(new, spec), 1))
        if spec.join is None:
            delta = _contributions(rows, spec, spec.group_by)
        else:
            keyed = _contributions(rows, spec, spec.join.on)
            side = _side(spec, resolve(spec.join.table))
            touched = checked_join(side, keyed.select(*spec.join.on), spec.join.on, "left_semi", bound_by=rows.select(*spec.join.on))
            delta = _added(keyed.join(touched, list(spec.join.on), "left"), spec, spec.group_by)
    elif spec.join is not None and table == spec.join.table:
        on = list(spec.join.on)
        keys = old.select(*on).unionByName(new.select(*on)).distinct()
        base = _prepare(resolve(spec.source), spec)
        keyed = _contributions(_signed(checked_join(base, keys, on, "left_semi"), 1), spec, on)
        minus = keyed.join(_side(spec, old), on, "left").select(
            *spec.group_by, *[(-F.col(n)).cast(keyed.schema[n].dataType).alias(n) for n in _names(spec)])
        plus = keyed.join(_side(spec, new), on, "left").select(*spec.group_by, *_names(spec))
        delta = _added(minus.unionByName(plus), spec, spec.group_by)
    else:
        raise ValueError(f"{spec.name} does not read {table!r}")
    changed = F.lit(False)
    for n in _names(spec):
        changed = changed | (F.col(n) != 0)
    return delta.where(changed)


def finish_state(state: DataFrame, spec: SummarySpec, source: DataFrame, sort: bool = True) -> DataFrame:
    """The published aggregate from its state; ``source`` gives the columns' types."""
    base = _prepare(source, spec)
    out: list[Column] = [F.col(g) for g in spec.group_by]
    for i, m in enumerate(spec.metrics):
        fn = _effective_fn(m, spec.unique)
        kind = base.select(_metric_expr(m, fn, False).alias("x")).schema["x"].dataType
        n, s = F.col(f"__n{i}"), F.col(f"__s{i}")
        if fn == "count":
            value = n
        elif fn == "sum":
            value = F.when(n > 0, s)
        elif isinstance(kind, T.DecimalType):
            # the types an average divides by
            exact = base.select(F.sum(m.column).alias("x")).schema["x"].dataType
            value = F.when(n > 0, s.cast(exact) / n.cast("decimal(20,0)"))
        else:
            value = F.when(n > 0, s.cast("double") / n)
        out.append(value.cast(kind).alias(m.name))
    result = state.where(F.col(ROWS) > 0).select(*out)
    if sort and spec.order_by:
        result = result.orderBy(*[F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in spec.order_by])
    return result


class StateTable:
    """A summary's stored state and the deltas applied to it."""

    def __init__(self, name: str, spec: SummarySpec, parts: int = DEFAULT_PARTS):
        self.name, self.spec, self.parts = name, spec, parts
        own = split_name(name)
        self.deltas = ".".join("`" + p.replace("`", "``") + "`" for p in [*own[:-1], own[-1] + "_deltas"])

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.xxhash64(*[F.col(g) for g in self.spec.group_by]), F.lit(self.parts)).cast("int"))

    def build(self, source: DataFrame, resolve: Resolve | None = None) -> None:
        """Store the state of the whole input; deltas of before are forgotten."""
        spark = source.sparkSession
        own = split_name(self.name)
        ensure_schema(spark, own[0] if len(own) > 2 else None, own[-2])
        state = self._placed(build_state(self.spec, source, resolve)).withColumn(SEEN, F.lit(""))
        publish(state.hint("rebalance", PART), self.name, schema_policy="replace", partition_by=(PART,))
        spark.sql(f"DROP TABLE IF EXISTS {self.deltas}")

    def write_delta(self, delta: DataFrame, batch_id: str) -> None:
        """Keep a batch's delta; written again, it replaces itself."""
        out = self._placed(delta).withColumn(SEEN, F.lit(batch_id))
        spark = delta.sparkSession
        if table_exists(spark, self.deltas):
            drop_partitions(spark, self.deltas, [SEEN], [(batch_id,)])
            overwrite_partitions(out, self.deltas)
        else:
            publish(out.hint("rebalance"), self.deltas, partition_by=(SEEN,))

    def apply_delta(self, spark, batch_id: str) -> int:
        """Add a stored delta to the parts that do not have it; how many were replaced."""
        delta = spark.table(self.deltas).where(F.col(SEEN) == batch_id)
        touched = delta.select(PART).distinct().collect()       # at most ``parts`` numbers
        if not touched:
            return 0
        state = spark.table(self.name).where(within([PART], touched))
        done = {r[0] for r in state.where(F.col(SEEN) == batch_id).select(PART).distinct().collect()}
        todo = [r for r in touched if r[0] not in done]
        if not todo:
            return 0
        columns = [*self.spec.group_by, *_names(self.spec), PART]
        both = (state.where(within([PART], todo)).select(*columns)
                .unionByName(delta.where(within([PART], todo)).select(*columns)))
        # a group without rows stays as zeros: its part must keep the batch's mark
        new = _added(both, self.spec, [*self.spec.group_by, PART]).withColumn(SEEN, F.lit(batch_id))
        overwrite_partitions(new, self.name)
        return len(todo)

    def published(self, spark, source: DataFrame, sort: bool = True) -> DataFrame:
        return finish_state(spark.table(self.name), self.spec, source, sort)

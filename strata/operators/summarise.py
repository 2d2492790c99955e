"""Cleaned -> aggregated table driven by a ``SummarySpec``.

Plan shape, per spec:

* a derived column and a not-null filter are one projection/filter over the
  scan (Catalyst pushes ``IsNotNull`` into the parquet reader);
* every aggregate is one ``groupBy().agg()`` with partial (map-side)
  aggregation, so one group holding a third of the rows is folded inside
  each map task before the shuffle;
* an exact distinct count over a column the input is unique on (its dedupe
  key) is a plain count, which keeps the aggregate a single hash aggregate
  instead of the two-shuffle distinct plan;
* with a left join to a table unique on the join key, the main input is
  aggregated per join key first and only then joined, so the join sees one
  row per key instead of one row per order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.filters import require
from strata.operators.joins import checked_join
from strata.specs import Metric, SummarySpec

_FNS = ("count", "count_distinct", "sum", "avg")


def _effective_fn(m: Metric, unique: tuple[str, ...]) -> str:
    if m.fn not in _FNS:
        raise ValueError(f"unknown metric function {m.fn!r}")
    if m.fn == "count_distinct" and m.column in unique:
        return "count"
    return m.fn


def _metric_expr(m: Metric, fn: str, comparable: bool) -> Column:
    c = F.col(m.column)
    if fn == "count":
        return F.count(c)
    if fn == "count_distinct":
        return F.count_distinct(c)
    if fn == "sum":
        return F.sum(c).cast("double") if comparable else F.sum(c)
    # avg
    if comparable:
        return F.sum(c).cast("double") / F.count(c)
    return F.avg(c)


def _prepare(df: DataFrame, spec: SummarySpec) -> DataFrame:
    if spec.derive:
        df = df.withColumns({name: make() for name, make in spec.derive})
    return require(df, spec.where_not_null)


def _can_preaggregate(spec: SummarySpec, left_cols: list[str]) -> bool:
    j = spec.join
    if j is None or j.how != "left" or not j.unique_on_key:
        return False
    right_only = set(j.columns) - set(j.on)
    # groups must come from the joined table or the key; metrics from the left
    if not all(g in right_only or g in j.on for g in spec.group_by):
        return False
    for m in spec.metrics:
        fn = _effective_fn(m, spec.unique)
        if fn not in ("count", "sum") or m.column not in left_cols or m.column in right_only:
            return False
    return True


def summarise(df: DataFrame, spec: SummarySpec,
              resolve: Callable[[str], DataFrame] | None = None,
              comparable: bool = False, sort: bool = True) -> DataFrame:
    """Build the aggregate table of ``spec`` from its cleaned input ``df``.

    ``resolve`` maps the join's table name to a ``DataFrame``.
    ``comparable`` writes sums as ``double`` and means as
    ``double(sum)/count`` (exact decimal sum, one rounding), the form an
    outside engine computes identically; published tables keep decimals.
    """
    base = _prepare(df, spec)
    names = [m.name for m in spec.metrics]

    if spec.join is not None:
        if resolve is None:
            raise ValueError(f"summary {spec.name} joins {spec.join.table}; pass resolve=")
        right = resolve(spec.join.table).select(*spec.join.columns)

        if _can_preaggregate(spec, base.columns):
            out = _preaggregated_join(base, right, spec, comparable)
        else:
            joined = checked_join(base, right, spec.join.on, spec.join.how)
            out = joined.groupBy(*spec.group_by).agg(
                *[_metric_expr(m, _effective_fn(m, spec.unique), comparable).alias(m.name)
                  for m in spec.metrics])
    else:
        out = base.groupBy(*spec.group_by).agg(
            *[_metric_expr(m, _effective_fn(m, spec.unique), comparable).alias(m.name)
              for m in spec.metrics])

    out = out.select(*spec.group_by, *names)
    if sort and spec.order_by:
        out = out.orderBy(*[F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()
                            for c, desc in spec.order_by])
    return out


def _preaggregated_join(base: DataFrame, right: DataFrame, spec: SummarySpec,
                        comparable: bool) -> DataFrame:
    j = spec.join
    assert j is not None
    # result types of the direct plan: the rewritten plan is cast back to them
    target_types = {}
    for m in spec.metrics:
        fn = _effective_fn(m, spec.unique)
        target_types[m.name] = base.select(_metric_expr(m, fn, comparable).alias("x")).schema["x"].dataType

    partial_names = {m.name: f"__p_{i}" for i, m in enumerate(spec.metrics)}
    partial = base.groupBy(*j.on).agg(
        *[(F.count(m.column) if _effective_fn(m, spec.unique) == "count" else F.sum(m.column))
          .alias(partial_names[m.name]) for m in spec.metrics])
    # Both sides are hash-partitioned on the key already (the partial
    # aggregate's shuffle, and a cleaned table's dedupe), so a shuffle join
    # here adds no exchange; broadcasting would only ship a side that grows
    # with the number of keys to every executor.  AQE still turns the join
    # into a broadcast when the measured size of a side is small.
    joined = partial.join(right, on=list(j.on), how="left")
    finals = []
    for m in spec.metrics:
        p = F.col(partial_names[m.name])
        if _effective_fn(m, spec.unique) == "count":
            expr = F.coalesce(F.sum(p), F.lit(0)).cast("long")
        else:
            expr = F.sum(p).cast(target_types[m.name])
        finals.append(expr.alias(m.name))
    return joined.groupBy(*spec.group_by).agg(*finals)

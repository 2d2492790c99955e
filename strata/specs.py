"""Declarative table specs.

Each layer of a layered-table pipeline is described by data, not code:

* ``LoadSpec``    -- one source relation published as a raw table;
* ``CleanSpec``   -- dedupe -> required filter -> text normalisation;
* ``SummarySpec`` -- optional join, derived columns, filter, group, metrics.

A generic operator turns each spec into a lazy ``DataFrame`` plan, so
Catalyst sees one declarative query per table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession


@dataclass(frozen=True)
class LoadSpec:
    """A source relation and the raw table it is published as.

    ``reader`` builds the source ``DataFrame`` from the session; use
    ``strata.sources.jdbc.jdbc_reader`` for a database table or any other
    callable (a parquet path, a view).
    """

    target: str
    reader: Callable[[SparkSession], DataFrame]
    source_name: str = ""


@dataclass(frozen=True)
class CleanSpec:
    """Raw -> cleaned rules for one table.

    Order of the rules is the reference order: keep one row per ``keys``,
    then drop rows whose ``required`` column is NULL, then rewrite text
    columns in place.  ``tie_break`` names the columns that decide which
    duplicate survives (ascending, NULL last); when empty every non-key
    column is used, so the choice is total and the same on every run and
    every task retry.  ``dedupe_after_filter`` swaps the first two steps.
    """

    name: str
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    lower_trim: tuple[str, ...] = ()
    upper_trim: tuple[str, ...] = ()
    tie_break: tuple[str, ...] = ()
    dedupe_after_filter: bool = False


@dataclass(frozen=True)
class Metric:
    """One aggregate output column.

    ``fn`` is one of ``count``, ``count_distinct``, ``sum``, ``avg``.
    """

    name: str
    fn: str
    column: str


@dataclass(frozen=True)
class JoinSpec:
    """Left side is the summary's main input; ``table`` is joined to it.

    ``columns`` are taken from the joined table (the key included).
    ``unique_on_key`` states that the joined table holds at most one row per
    key (true for a table cleaned with that key), which lets the main input
    be aggregated per key before the join.
    """

    table: str
    on: tuple[str, ...]
    columns: tuple[str, ...]
    how: str = "left"
    unique_on_key: bool = False


@dataclass(frozen=True)
class SummarySpec:
    """Cleaned -> aggregated table.

    ``source`` names the cleaned input; ``unique`` lists columns that are
    known to be unique in it (its dedupe keys), which turns an exact
    distinct count of such a column into a plain count.
    """

    name: str
    source: str
    group_by: tuple[str, ...]
    metrics: tuple[Metric, ...]
    where_not_null: tuple[str, ...] = ()
    derive: tuple[tuple[str, Callable[[], Column]], ...] = ()
    join: JoinSpec | None = None
    order_by: tuple[tuple[str, bool], ...] = ()
    unique: tuple[str, ...] = ()

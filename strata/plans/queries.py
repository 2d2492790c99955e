"""Lazy query builders over the raw fixture views (no table is written).

Each function takes ``(spark, sf_dir)`` and returns a ``DataFrame``; the
cleaned and aggregated shapes are computed straight from the raw views, so
Catalyst plans the whole chain (scan -> dedupe -> filter -> aggregate) as
one query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.clean import clean
from strata.operators.summarise import summarise
from strata.plans import catalogue as cat
from strata.sources.fixtures import RAW_VIEWS


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return RAW_VIEWS[table](spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return clean(raw(spark, sf_dir, table), cat.CLEAN_SPECS[table])


def summary(spark: SparkSession, sf_dir: str, name: str, comparable: bool = True,
            sort: bool = True) -> DataFrame:
    spec = cat.SUMMARY_SPECS[name]
    return summarise(
        cleaned(spark, sf_dir, spec.source), spec,
        resolve=lambda t: cleaned(spark, sf_dir, t),
        comparable=comparable, sort=sort)

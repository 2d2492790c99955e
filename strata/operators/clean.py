"""Raw -> cleaned table transform driven by a ``CleanSpec``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.text import lower_trim, trim_spaces, upper_trim
from strata.operators.dedupe import dedupe
from strata.operators.filters import require
from strata.specs import CleanSpec


def normalise_text(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Rewrite text columns in place (same name, same position), in one
    projection."""
    rules = {}
    for c in spec.trim:
        rules[c] = trim_spaces(c)
    for c in spec.lower_trim:
        rules[c] = lower_trim(c)
    for c in spec.upper_trim:
        rules[c] = upper_trim(c)
    return df.withColumns(rules) if rules else df


class CleanCounts:
    """Rows at three places of a cleaning plan, counted by the job that runs it.

    The plan reads its input once; every task adds up its rows and nothing is
    scanned again.  A map task that runs again after a lost executor may count its
    input twice, so ``account`` takes ``input`` from elsewhere where that matters
    (the number of rows the load wrote)."""

    def __init__(self) -> None:
        self._seen = {place: Observation() for place in ("input", "middle", "output")}
        self._filter_first = False

    def at(self, place: str, df: DataFrame) -> DataFrame:
        return df.observe(self._seen[place], F.count(F.lit(1)).alias("rows"))

    def account(self, input_rows: int | None = None) -> dict[str, int]:
        """``input = duplicates + rejected + output``, once an action has run the plan."""
        n = {place: int(seen.get["rows"]) for place, seen in self._seen.items()}
        first = (n["input"] if input_rows is None else input_rows) - n["middle"]
        second = n["middle"] - n["output"]
        duplicates, rejected = (second, first) if self._filter_first else (first, second)
        return {"input": n["input"] if input_rows is None else input_rows, "duplicates": duplicates,
                "rejected": rejected, "output": n["output"]}


def clean(df: DataFrame, spec: CleanSpec, counts: CleanCounts | None = None) -> DataFrame:
    """dedupe -> required filter -> text rules (reference order).

    With ``dedupe_after_filter`` the filter runs first, so a key whose
    first-ordered row lacks the required value keeps another row instead of
    disappearing.  ``counts`` observes the rows before, between and after."""
    if counts is not None:
        counts._filter_first = spec.dedupe_after_filter

    def seen(place: str, rows: DataFrame) -> DataFrame:
        return rows if counts is None else counts.at(place, rows)

    df = seen("input", df)
    if spec.dedupe_after_filter:
        out = dedupe(seen("middle", require(df, spec.required)), spec.keys, spec.tie_break)
    else:
        out = require(seen("middle", dedupe(df, spec.keys, spec.tie_break)), spec.required)
    return seen("output", normalise_text(out, spec))


def refresh_cleaned(cleaned: DataFrame, raw_all: DataFrame, new_rows: DataFrame,
                    spec: CleanSpec) -> DataFrame:
    """New content of a cleaned table after ``new_rows`` arrived in the raw
    table (``raw_all`` already holds them).

    Only the keys of the new rows are cleaned again, from all their raw rows;
    every other key keeps its cleaned row.  A key's survivor depends only on
    that key's rows, so the result equals cleaning ``raw_all`` from scratch,
    while the dedupe sorts just the touched keys' rows.  The touched keys are
    broadcast when proven small, else joined by shuffle."""
    from strata.operators.joins import checked_join

    touched = new_rows.select(*spec.keys)
    affected = checked_join(raw_all, touched, spec.keys, "left_semi", null_safe=True)
    untouched = checked_join(cleaned, touched, spec.keys, "left_anti", null_safe=True)
    return untouched.unionByName(clean(affected, spec))

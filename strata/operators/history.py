"""Validity ranges for versioned rows (slowly changing dimension, type 2).

Each version of a key is valid from its own version value up to the next
version's value of the same key (``NULL`` for the current one).

A plain ``lead()`` over ``partitionBy(key)`` sends all versions of a key to
one task, so a key holding a third of the rows would be one task.  Here a
key's versions are cut into slices of about ``rows_per_slice`` rows:

1. versions per key are counted (an aggregate with map-side combining);
   keys over the limit are *hot*, and there are at most
   ``rows / rows_per_slice`` of them;
2. for each hot key, approximate quantiles of its version values give the
   slice bounds, as many as the key's own rows need (checkpointed once);
   a row's slice is the number of its key's bounds at or below its version
   (a binary search, about log2(slices) comparisons), a pure function of the
   row, so every recomputation agrees;
3. a version so common that it is a bound more than once, and a common NULL
   version, is dealt further by a hash of the row, in as many groups as the
   bounds it holds;
4. ``lead()`` runs within ``(key, slice, group)``; the last row of each gets
   its successor from a table of one row per hot-key slice and group, where
   the groups of one version follow each other by their last ``tie_break``.

Both small tables are broadcast only when their rows and bytes, known from
the counts, are within the limits of ``checked_join``.  Only rows equal in
every column (map columns aside) cannot be parted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dedupe import default_tie_break
from strata.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, checked_join, null_safe_join, value_bytes
from strata.session import ensure_checkpoint_dir, stored

DEFAULT_ROWS_PER_SLICE = 1_000_000

_N = "__strata_n"
_VALUED = "__strata_valued"
_PIECES = "__strata_pieces"
_NULL_PIECES = "__strata_null_pieces"
_BOUNDS = "__strata_bounds"
_SLICE = "__strata_slice"
_BELOW = "__strata_below"
_GROUP = "__strata_group"
_NEXT = "__strata_next"
_FOLLOWED = "__strata_followed"
_HEAD = "__strata_head"
_LAST = "__strata_last"
_NEXT_HEAD = "__strata_next_head"
_FRESH = "__strata_fresh"


@dataclass(frozen=True)
class _Cuts:
    """``bounds`` holds ``(keys..., bounds array, NULL groups)`` per hot key."""

    bounds: DataFrame
    pieces: int          # of the largest key
    small: bool          # bounds and group heads may be broadcast


def _hot_cuts(df: DataFrame, keys: Sequence[str], version: str, rows_per_slice: int) -> _Cuts | None:
    """The cuts of the hot keys, or ``None`` when none is hot.

    The hot keys and the bounds are written once to the shared checkpoint
    folder: approximate quantiles depend on the order partial sketches are
    merged, and every branch and every retried task must see the same."""
    def needed(rows):
        return F.ceil(rows / F.lit(rows_per_slice))

    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N), F.count(version).alias(_VALUED))
    hot = (counts.filter(F.col(_N) > rows_per_slice)
           .withColumn(_PIECES, needed(F.col(_VALUED)))
           .withColumn(_NULL_PIECES, needed(F.col(_N) - F.col(_VALUED))))
    types = {f.name: f.dataType for f in df.schema.fields}
    key_bytes = reduce(lambda a, b: a + b, [value_bytes(k, types[k]) for k in keys])
    # a key has at most pieces slices, as many groups of common versions, and its NULL groups
    entries = 2 * F.col(_PIECES) + F.col(_NULL_PIECES) + 1
    stats = hot.agg(F.count(F.lit(1)).alias("k"), F.max(_PIECES).alias("m"), F.sum(entries).alias("e"),
                    F.sum(entries * (key_bytes + F.lit(32))).alias("b")).first()
    if not stats["k"]:
        return None          # the common case: one counting pass, nothing written
    # exact counts: recomputing them for the checkpoint gives the same hot keys
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint(eager=True)
    small = stats["e"] <= DEFAULT_MAX_ROWS and stats["b"] <= DEFAULT_MAX_BYTES
    pieces = max(int(stats["m"]), 2)
    cuts = [i / pieces for i in range(1, pieces)]
    hot_rows = _join_small(df.select(*keys, version), hot.select(*keys), keys, "left_semi", small)
    all_bounds = hot_rows.groupBy(*keys).agg(
        F.percentile_approx(version, cuts, max(10_000, 4 * pieces)).alias(_BOUNDS))
    own = F.transform(F.sequence(F.lit(1), (F.col(_PIECES) - 1).cast("int")),
                      lambda i: F.element_at(_BOUNDS, F.floor(i * F.lit(pieces) / F.col(_PIECES)).cast("int")))
    # a bound held more than once stands once, with the bounds below it and up to it
    marks = (_join_small(hot.where(F.col(_PIECES) > 1), all_bounds, keys, "inner", small)
             .select(*keys, F.posexplode(own).alias(_SLICE, "bound"))
             .groupBy(*keys, "bound").agg(F.min(_SLICE).alias("below"), (F.max(_SLICE) + 1).alias("upto"))
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bound", "below", "upto"))).alias(_BOUNDS)))
    bounds = _join_small(hot, marks, keys, "left", small).select(*keys, _BOUNDS, _NULL_PIECES)
    return _Cuts(bounds.checkpoint(eager=True), pieces, small)


def _slice_of(df: DataFrame, version: str, pieces: int, row_hash) -> DataFrame:
    """Add ``_SLICE`` = number of the row's key bounds at or below its version,
    and ``_GROUP`` (0: the only one of its version, or not a common one).

    A binary search over the sorted distinct bounds, folded over its steps
    (about log2 of the slice count): one expression of fixed size.  A column a
    step, each naming the one before several times, is a plan that doubles
    with every step when the optimizer puts the columns into each other."""
    v = F.col(version)
    size = F.coalesce(F.size(_BOUNDS), F.lit(0))
    steps = [1 << k for k in reversed(range(max(pieces, 1).bit_length()))]
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= size) & (F.try_element_at(F.col(_BOUNDS), at + step)["bound"] <= v), at + step).otherwise(at))
    out = df.withColumn(_BELOW, found)
    out = out.withColumn(_BELOW, F.when(F.col(_BELOW) > 0, F.try_element_at(F.col(_BOUNDS), F.col(_BELOW))))
    mark = F.col(_BELOW)
    # bounds the version itself holds
    groups = F.when(v.isNull(), F.col(_NULL_PIECES)).when(mark["bound"] == v, mark["upto"] - mark["below"])
    group = F.when(groups > 1, F.pmod(row_hash, groups) + 1).otherwise(F.lit(0)).cast("long")
    return (out.withColumn(_SLICE, F.coalesce(mark["upto"], F.lit(0))).withColumn(_GROUP, group)
            .drop(_BOUNDS, _BELOW, _NULL_PIECES))


def _join_small(left: DataFrame, side: DataFrame, on: Sequence[str], how: str, small: bool) -> DataFrame:
    """Join a side whose size is bounded by construction; NULL keys match."""
    return null_safe_join(left, F.broadcast(side) if small else side, on, how)


def validity_ranges(df: DataFrame, keys: Sequence[str], version: str,
                    tie_break: Sequence[str] = (), valid_to: str = "valid_to",
                    is_current: str = "is_current",
                    rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, hot: bool = True) -> DataFrame:
    """``df`` plus ``valid_to`` (next version of the same key) and ``is_current``.

    ``hot=False`` says that no key has over ``rows_per_slice`` rows, known from a count
    of these or of more rows: it saves computing ``df`` to count them.  Versions are ordered by ``version`` then ``tie_break``, ascending with
    NULL first; which of several rows equal in both comes last is not
    defined.  ``version`` must be numeric, a date or a timestamp."""
    order = [F.col(c).asc_nulls_first() for c in [version, *tie_break]]
    cuts = _hot_cuts(df, keys, version, rows_per_slice) if hot else None
    if cuts is None:
        out = df.withColumn(valid_to, F.lead(version).over(Window.partitionBy(*keys).orderBy(*order)))
        return out.withColumn(is_current, F.col(valid_to).isNull())

    row_hash = F.xxhash64(*[F.col(c) for c in default_tie_break(df, ())])
    sliced = _slice_of(_join_small(df, cuts.bounds, keys, "left", cuts.small), version, cuts.pieces, row_hash)
    inner = Window.partitionBy(*keys, _SLICE, _GROUP).orderBy(*order)
    with_next = (sliced.withColumn(_NEXT, F.lead(version).over(inner))
                 .withColumn(_FOLLOWED, F.lead(F.lit(True)).over(inner)))
    # first and last row of every slice and group of a hot key, in the key's order:
    # a common version's groups come before the rest of the slice it opens
    ordered = F.struct(*[F.col(c) for c in [version, *tie_break]])
    heads = (_join_small(sliced, cuts.bounds.select(*keys), keys, "left_semi", cuts.small)
             .groupBy(*keys, _SLICE, _GROUP).agg(F.min(ordered).alias(_HEAD), F.max(ordered).alias(_LAST)))
    along = Window.partitionBy(*keys).orderBy(F.col(_SLICE), F.col(_GROUP) == 0, F.col(_LAST), F.col(_GROUP))
    heads = heads.withColumn(_NEXT_HEAD, F.lead(F.col(f"{_HEAD}.{version}")).over(along)).select(
        *keys, _SLICE, _GROUP, _NEXT_HEAD)
    out = _join_small(with_next, heads, [*keys, _SLICE, _GROUP], "left", cuts.small)
    return (out.withColumn(valid_to, F.when(F.col(_FOLLOWED), F.col(_NEXT)).otherwise(F.col(_NEXT_HEAD)))
            .withColumn(is_current, F.col(valid_to).isNull())
            .drop(_SLICE, _GROUP, _NEXT, _FOLLOWED, _NEXT_HEAD))


def fold_unchanged(df: DataFrame, keys: Sequence[str], version: str, attributes: Sequence[str],
                   tie_break: Sequence[str] = (), rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
                   hot: bool = True) -> DataFrame:
    """The versions that change something: the first row of every run of
    versions of a key with equal ``attributes`` (NULLs equal; gaps and islands).

    Of several rows of one version the last by ``tie_break`` (else by all other
    columns) counts; it is found by an aggregate with map-side combining.  Hot
    keys are cut into slices as in ``validity_ranges``: a row is compared with
    the row before it in its slice, the first of a slice with the last row of
    the slices before; ``hot`` is as there."""
    rest = [c for c in df.columns if c not in keys and c != version]
    last = F.max_by(F.struct(*rest), F.struct(*(tie_break or default_tie_break(df.select(*rest), ()))))
    one = df.groupBy(*keys, version).agg(last.alias(_LAST)).select(*keys, version, f"{_LAST}.*").select(*df.columns)
    own = F.struct(*[F.col(a) for a in attributes])
    order = F.col(version).asc_nulls_first()

    def changes(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(_FOLLOWED).isNull() | ~own.eqNullSafe(F.col(_NEXT))).select(*df.columns)

    cuts = _hot_cuts(one, keys, version, rows_per_slice) if hot else None
    if cuts is None:
        before = Window.partitionBy(*keys).orderBy(order)
        return changes(one.withColumn(_NEXT, F.lag(own).over(before)).withColumn(_FOLLOWED, F.lag(F.lit(True)).over(before)))
    # a version stands once a key now, so its group is one row and the slices are in the key's order
    sliced = _slice_of(_join_small(one, cuts.bounds, keys, "left", cuts.small), version, cuts.pieces, F.lit(0))
    inner = Window.partitionBy(*keys, _SLICE, _GROUP).orderBy(order)
    within = sliced.withColumn(_NEXT, F.lag(own).over(inner)).withColumn(_FOLLOWED, F.lag(F.lit(True)).over(inner))
    ends = (_join_small(sliced, cuts.bounds.select(*keys), keys, "left_semi", cuts.small)
            .groupBy(*keys, _SLICE, _GROUP).agg(F.max_by(own, F.struct(version)).alias(_LAST), F.max(F.struct(version)).alias(_HEAD)))
    along = Window.partitionBy(*keys).orderBy(F.col(_HEAD))
    ends = ends.select(*keys, _SLICE, _GROUP, F.lag(_LAST).over(along).alias(_NEXT_HEAD),
                       F.lag(F.lit(True)).over(along).alias(_BELOW))
    out = _join_small(within, ends, [*keys, _SLICE, _GROUP], "left", cuts.small)
    return changes(out.withColumns({_NEXT: F.when(F.col(_FOLLOWED), F.col(_NEXT)).otherwise(F.col(_NEXT_HEAD)),
                                    _FOLLOWED: F.coalesce(_FOLLOWED, _BELOW)}))


def merge_versions(history: DataFrame, late: DataFrame, keys: Sequence[str], version: str,
                   tie_break: Sequence[str] = (), valid_to: str = "valid_to", is_current: str = "is_current",
                   rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> DataFrame:
    """The ranges of the keys of ``late`` after its versions, however old, joined them.

    Only the touched keys' stored ranges are read: a range that a late version
    falls into is closed there and the late version takes over its end.  A row
    that is stored already in every column is not taken twice, so a replay
    changes nothing."""
    versions = _with_late(history.drop(valid_to, is_current), late, late.select(*keys).distinct(), keys).drop(_FRESH)
    return validity_ranges(versions, keys, version, tie_break, valid_to, is_current, rows_per_slice)


def _with_late(history: DataFrame, late: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored versions of the touched keys and the late ones that are not among them (``_FRESH``)."""
    held = checked_join(history, touched, keys, "left_semi", null_safe=True)
    fresh = null_safe_join(late.select(*held.columns).distinct(), held, held.columns, "left_anti")
    return held.withColumn(_FRESH, F.lit(False)).unionByName(fresh.withColumn(_FRESH, F.lit(True)))


def has_hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> bool:
    """Whether a key has over ``rows_per_slice`` rows."""
    return not df.groupBy(*keys).count().where(F.col("count") > rows_per_slice).isEmpty()


def merge_history_table(name: str, late: DataFrame, keys: Sequence[str], version: str,
                        tie_break: Sequence[str] = (), folded: str | None = None, attributes: Sequence[str] = (),
                        rows_per_slice: int = DEFAULT_ROWS_PER_SLICE) -> None:
    """Merge late versions into a published history (``valid_to``, ``is_current``).

    The table is partitioned (by a function of the key, say): only partitions
    that hold a touched key are rewritten.  ``folded`` names a second table with
    the ranges of changes of ``attributes`` only; its touched keys are folded again
    from all their versions, for a late version can bring back one folded away."""
    from strata.sinks.partitions import merge_partitions

    # what several jobs read is written once, in the shared folder: the batch, its keys, the
    # versions, and the ranges, which are read while the tables they come from are replaced
    spark = late.sparkSession
    history = spark.table(name).drop("valid_to", "is_current")
    late = stored(late.select(*history.columns).distinct())
    touched = stored(late.select(*keys).distinct())
    versions = stored(_with_late(history, late, touched, keys))
    if versions.where(_FRESH).isEmpty():
        return          # a batch that came before: the ranges hold all of it
    versions = versions.drop(_FRESH)
    # folding only takes versions away: one count for all that follows
    hot = has_hot_keys(versions, keys, rows_per_slice)
    merged = stored(validity_ranges(versions, keys, version, tie_break, rows_per_slice=rows_per_slice, hot=hot))
    if folded:
        changes = fold_unchanged(versions, keys, version, attributes, tie_break, rows_per_slice, hot)
        ranges = stored(validity_ranges(changes, keys, version, tie_break, rows_per_slice=rows_per_slice, hot=hot))
        merge_partitions(folded, ranges, keys, touched=touched, unique=False)
    merge_partitions(name, merged, keys, touched=touched, unique=False)

"""Merkle manifest of a table by nested-struct rollups.

Every row is a leaf; a group's leaves in order make a tree of ``fanout``
(a level's last run may be shorter, even one node), the groups' roots in order
make the tree above.

1. Leaves are hashed where the table is read and dealt by range of (group,
   order); a row's rank is its place in its part plus the parts before (one
   row per part and group), so a group of any share of the rows is ranked by
   many tasks.
2. A tier cuts the ranks into blocks of ``fanout ** digits``.  The rank's
   digits are columns; grouping them away one after the other, the lowest
   first, hashes one level each and nests the child structs in the parent's.
   The blocks are dealt once, each further grouping keeps that dealing, and no
   row holds more than a block.  The blocks' roots are the leaves of the next
   tier until each group has one.
3. From the top tier down, ``transform`` over the nested structs extends the
   path of siblings and one ``explode`` emits a row per child: no join.  A
   block meets the path above it (one row per block) in a grouping.

Defined results: a null field is ``-``; null groups come first, null order
values first; rows of equal order are taken by their leaf; repeated rows are
leaves of their own; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, stored
from strata.operators.joins import checked_join

FANOUT = 2
#: digits grouped away within a block: 1,024 leaves of the binary tree
DIGITS = 10


def leaf_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the fields, each ``-`` or UTF-8 byte count, ``:``, value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within the struct ``g``, by ``order``) and ``n``, the group's rows."""
    # the last key only spreads rows equal in all others
    keys = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order], F.col("__id")]
    placed = stored(rows.withColumn("__id", F.monotonically_increasing_id())
                    .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__id")
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("at", 33)))
    parts = checkpointed(placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")))
    group = Window.partitionBy("g")
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("rows").over(group).alias("n"))
    return (checked_join(placed, checkpointed(parts), ["g", "part"], "inner")
            .withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift"))


def _levels(n: Column, fanout: int) -> Column:
    """How many levels a tree over ``n`` nodes has."""
    powers, p = [], 1
    while p < 1 << 62:
        powers.append(F.lit(p))
        p *= fanout
    return F.size(F.filter(F.array(*powers), lambda x: x < n))


def _rollup(rows: DataFrame, fanout: int, digits: int) -> DataFrame:
    """``rows`` (g, pos, n, h, leaf) as one nested ``node`` per block: g, block, n, levels, node."""
    size = fanout ** digits
    at = rows.select("g", "n", _levels(F.col("n"), fanout).alias("levels"), F.expr(f"pos div {size}").alias("block"),
                     *[F.expr(f"cast(pos div {fanout ** d} % {fanout} as int)").alias(f"d{d}") for d in range(digits)],
                     F.struct("h", "leaf").alias("node")).repartition("g", "block")
    for d in range(digits):
        above = [f"d{k}" for k in range(d + 1, digits)]
        at = at.groupBy("g", "block", "n", "levels", *above).agg(
            F.array_sort(F.collect_list(F.struct(F.col(f"d{d}").alias("d"), "node"))).alias("kids"))
        h = (F.when(F.col("levels") > d, F.sha2(F.array_join("kids.node.h", ""), 256))
             .otherwise(F.element_at("kids.node.h", 1)))
        at = at.select("g", "block", "n", "levels", *above, F.struct(h.alias("h"), F.col("kids.node").alias("kids")).alias("node"))
    return at


def tree(rows: DataFrame, fanout: int, digits: int) -> list[tuple[DataFrame, int]]:
    """The tiers of the trees over ``rows`` (g, pos, n, h, leaf), lowest first, with the digits each groups
    away: ``digits``, or as many as the largest tree has left; the last has one row per group."""
    tiers = []
    most = rows.agg(F.max("n")).first()[0] or 0
    while True:
        d = 0
        while d < digits and fanout ** d < most:
            d += 1
        size = fanout ** d
        tiers.append((checkpointed(_rollup(rows, fanout, d)), d))
        most = -(-most // size)
        if most <= 1:
            return tiers
        rows = tiers[-1][0].select("g", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
                                   F.col("node.h").alias("h"), F.col("block").alias("leaf"))


PATH = "array<struct<l: string, r: string>>"


def _emit(node: Column, level: int, path: Column) -> Column:
    """The leaves below ``node`` with their paths, nearest siblings first."""
    if level == 0:
        return F.array(F.struct(node["h"].alias("h"), node["leaf"].alias("leaf"), path.alias("path")))

    def child(kid: Column, i: Column) -> Column:
        hashes = node["kids"]["h"]
        others = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("l"),
                          F.array_join(F.slice(hashes, i + 2, F.size(hashes)), "").alias("r"))
        # the path stands in the expression once: twice a level would double it ``digits`` times
        step = F.when(F.col("levels") >= level, F.array(others)).otherwise(F.array().cast(PATH))
        return _emit(kid, level - 1, F.concat(step, path))

    return F.flatten(F.transform(node["kids"], child))


def proofs(tiers: list[tuple[DataFrame, int]], above: DataFrame) -> DataFrame:
    """Leaves of the lowest tier: g, h, leaf, path and the ``top`` that ``above`` (g, block, path, top) gives."""
    for tier, digits in reversed(tiers):
        nodes = tier.select("g", "block", F.struct("levels", "node").alias("own"), F.lit(None).cast(PATH).alias("path"),
                            F.lit(None).cast(above.schema["top"].dataType).alias("top"))
        met = (nodes.unionByName(above.select("g", "block", F.lit(None).cast(nodes.schema["own"].dataType).alias("own"),
                                              "path", "top"))
               .groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("own", "path", "top")]))
        leaves = (met.select("g", "top", "path", "own.levels", "own.node")
                  .select("g", "top", F.explode(_emit(F.col("node"), digits, F.col("path"))).alias("e"))
                  .select("g", "top", "e.h", "e.leaf", "e.path"))
        above = leaves.select("g", F.col("leaf").alias("block"), "path", "top")
    return leaves


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, presented: Column | None = None,
             fanout: int = FANOUT, digits: int = DIGITS) -> DataFrame:
    """Per row of ``docs``: the order column, leaf, subroot, root, ``path`` and ``presented``.

    ``path`` is the proof: per level the hashes of the run's other nodes left
    (``l``) and right (``r``) of the own one, from the leaf up.  ``presented``
    is any column computed beside the leaf, such as the hash of a row to be
    proved (the leaf by default)."""
    leaf = leaf_hash([F.col(c) for c in fields])
    rows = docs.select(F.struct(F.col(group).alias("group")).alias("g"), F.col(order).alias("o"), leaf.alias("h"),
                       (leaf if presented is None else presented).alias("presented"))
    rows = ranked(rows, ["o", "h"])
    tiers = tree(rows.select("g", "pos", "n", "h", F.struct("o", "presented").alias("leaf")), fanout, digits)
    subroots = tiers[-1][0].select(F.struct(F.lit(0).alias("group")).alias("g"), F.col("g").alias("leaf"),
                                F.col("node.h").alias("h"))
    upper = tree(ranked(subroots, ["leaf"]), fanout, digits)
    top = upper[-1][0].select("g", "block", F.array().cast(PATH).alias("path"), F.col("node.h").alias("top"))
    over = proofs(upper, top).select(
        F.col("leaf").alias("g"), F.lit(0).cast("long").alias("block"), "path",
        F.struct(F.col("h").alias("subroot"), F.col("top").alias("root")).alias("top"))
    return proofs(tiers, over).select(
        F.col("leaf.o").alias(order), F.col("h").alias("leaf"), "top.subroot", "top.root", "path", "leaf.presented")


def proof_digest(path: Column) -> Column:
    """SHA-256 of the path's hashes, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def oracle_sql() -> str:
    """The query ``op11_merkle_manifest`` as DuckDB SQL: levels by recursion, siblings by joins."""
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), "
           "lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), "
           "4294967295::bigint)")

    def field(c: str) -> str:
        return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"

    return f"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) t),
leaves as (
  select doc_id, lang, {leaf('n_chars')} leaf, case when {crc} % 7 = 0 then {leaf('(n_chars + 1)')} end tampered
  from documents cross join crc_table),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 pos,
    count(*) over (partition by lang) n
  from leaves),
nodes(lang, lvl, pos, n, h) as (
  select lang, 0, pos, n, leaf from placed
  union all
  select lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos))
  from nodes where n > 1 group by lang, lvl, pos // 2, n),
subroots as (
  select lang, h subroot, row_number() over (order by lang nulls first) - 1 pos, count(*) over () n from nodes where n = 1),
upper(lvl, pos, n, h) as (
  select 0, pos, n, subroot from subroots
  union all
  select lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from upper where n > 1
  group by lvl, pos // 2, n),
up as (
  select s.lang, s.subroot, u.lvl + 1000 lvl,
    case when x.h is null then 'S' when x.pos < u.pos then 'L' || x.h else 'R' || x.h end e
  from subroots s join upper u on u.pos = s.pos // (1::bigint << u.lvl) and u.n > 1
  left join upper x on x.lvl = u.lvl and x.pos = xor(u.pos, 1)),
steps as (
  select p.doc_id, p.leaf, p.lang, p.pos, o.lvl,
    case when x.h is null then 'S' when x.pos < o.pos then 'L' || x.h else 'R' || x.h end e
  from placed p join nodes o on o.lang is not distinct from p.lang and o.pos = p.pos // (1::bigint << o.lvl) and o.n > 1
  left join nodes x on x.lang is not distinct from o.lang and x.lvl = o.lvl and x.pos = xor(o.pos, 1)
  union all
  select p.doc_id, p.leaf, p.lang, p.pos, up.lvl, up.e
  from placed p join up on up.lang is not distinct from p.lang),
paths as (select lang, pos, list(e order by lvl) es from steps group by lang, pos),
proved as (
  select p.doc_id, p.leaf, s.subroot, (select h from upper where n = 1) root, coalesce(q.es, []) es,
    coalesce(p.tampered, p.leaf) presented
  from placed p join subroots s on s.lang is not distinct from p.lang
  left join paths q on q.lang is not distinct from p.lang and q.pos = p.pos),
folds as (
  select *, list_reduce(list_prepend(presented, es), lambda a, e: case e[1] when 'L' then sha256(e[2:] || a)
    when 'R' then sha256(a || e[2:]) else sha256(a) end) folded_root
  from proved)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(es, lambda e: e[2:]), '')) proof_sha256,
  folded_root, folded_root = root verified
from folds"""

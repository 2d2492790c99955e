"""N-gram Jaccard join by T-occurrence search.

Two documents link when their sets of word shingles reach a Jaccard
similarity; the result is each document's component under these links.

1. Sets and classes.  One pass hashes every text's shingles; documents with
   the same set form a class (an aggregate), only classes go on.
2. Shards.  A pair of sizes that can link differs in at most ``e`` shingles.
   Shingles are dealt by hash to more than ``e`` parts, so one part that is
   not empty is the same in both; the hash of each part is a signature.  (A
   set whose empty parts could be the only equal ones is dealt again with
   the next seed.)  The sets with one signature are a star around the least;
   a star's shard is named by the least neighbour of its centre, so every
   pair that links meets in a shard and stars of one group mostly in one.  Signatures move as packed arrays, and within a
   batch only the first set with a signature goes on, so a signature that a
   third of all rows have is a few rows in the shuffle; the sets it stands
   for enter all shards it enters.
3. T-occurrence search in each shard.  An inverted index over its sets; for
   each set the lists of its shingles are divided: all but the ``l`` longest
   are merged and counted, sets with ``t - l`` occurrences are candidates,
   and the long lists are probed by binary search.  The overlap is then
   exact, and those that reach the required overlap link.  Sets already
   connected are passed over, so a shard gives a spanning forest, never all
   pairs.
4. A shard of too many shingles is split in pieces, each with the shard's few
   pivots: its sets are compared with these first, which connects most of a
   large group of near copies at linear cost, and the others are searched for
   in their piece.  The sets still outside the shard's largest group are
   probes, in blocks, against all blocks.

Defined results: a null or empty text has an empty set, links with nothing
and is its own component; a null ``doc_id`` takes no part in links and has a
null component; repeated rows are all returned; rows of one id are one
document; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (checkpointed, checkpointed_alone, connected_components, maybe_member, space_words,
                               split_by_membership, without)
from strata.llm.shingles import U, WordHashes, dealt, fingerprint, in_groups, mix, sequence

#: shingles worked on at once in a task; shingles of a shard that is not split; signatures in a packed group
SLICE, SHARD, PACKED = 400_000, 1_000_000, 1_000_000
PIVOTS = 8
#: the long lists' share of the needed overlap (the usual tuning constant of the method)
MU = 0.0085


def shingle_set(text: str | None, k: int, words: WordHashes) -> np.ndarray:
    return np.unique(sequence(words.of(space_words(text)), k))


@lru_cache(maxsize=None)
def levels(num: int, den: int, upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the size levels, and of each join of levels i and i + 1 the
    largest possible difference and the number of parts."""
    bounds = [1]
    while bounds[-1] <= upto:
        bounds.append(bounds[-1] * den // num + 1)
    bounds += [bounds[-1] * den // num + 1]
    bounds.append(bounds[-1] * den // num + 1)
    b = np.array(bounds, np.int64)
    # a pair sharing (num, den) of its union differs in at most this part of the sizes' sum
    differ = (b[1:-1] - 1 + b[2:] - 1) * (den - num) // (den + num)
    return b, differ, np.where(differ > 0, differ + 2 + differ // 16, 1)


def signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the (not empty) sets and the index of the set of each."""
    sizes = np.array([len(s) for s in sets], np.int64)
    bounds, differ, parts = levels(num, den, 1 << max(int(sizes.max(initial=1)).bit_length(), 20))
    level = np.searchsorted(bounds, sizes, side="right") - 1
    out_s, out_i = [], []
    for join in (-1, 0):                        # the join below, as its larger side, and the own one
        todo = np.flatnonzero(level + join >= 0)
        seed = 0
        while len(todo):
            g = level[todo] + join
            m, n = parts[g], sizes[todo]
            flat = np.concatenate([sets[i] for i in todo])
            owner = np.repeat(np.arange(len(todo)), n)
            base = np.concatenate([[0], np.cumsum(m)])
            dealt = mix(flat + U((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            place = (((dealt >> U(32)) * m[owner].astype(U)) >> U(32)).astype(np.int64) + base[owner]
            total = np.zeros(base[-1], U)
            np.add.at(total, place, dealt)
            filled = np.bincount(place, minlength=base[-1]) > 0
            empty = np.add.reduceat(~filled, base[:-1], dtype=np.int64)
            of = np.repeat(np.arange(len(todo)), m)
            # salted by join, seed and part, so that only like meets like
            salt = (g[of].astype(U) << U(40)) ^ U(seed << 32) ^ (np.arange(base[-1]) - base[of]).astype(U)
            sig = mix(total ^ mix(salt + U(1)))
            again = empty >= m - differ[g]      # then the untouched parts may all be empty ones
            emit = filled | again[of] if seed >= 64 else filled
            out_s.append(sig[emit])
            out_i.append(todo[of[emit]])
            todo = todo[again] if seed < 64 else todo[:0]
            seed += 1
    if not out_s:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(out_s), np.concatenate(out_i)


def measure(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, n, fp1, fp2)`` per row: size and fingerprint of the shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            n, fp1, fp2 = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, k, words)
                a, b = fingerprint(s)
                n.append(len(s)), fp1.append(a), fp2.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, fp1, fp2))], ["doc_id", "n", "fp1", "fp2"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, fp1 long, fp2 long")


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by key and node: which is the first of its key, and the edges
    of the others to that first node (distinct)."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = nodes[np.flatnonzero(first)][np.cumsum(first) - 1] if len(keys) else nodes
    far = nodes != head
    edges = np.unique(np.stack([nodes[far], head[far]], axis=1), axis=0)
    return order[first], edges[:, 0], edges[:, 1]


def candidate_edges(docs: DataFrame, k: int, num: int, den: int, shingles: int) -> DataFrame:
    """``(a, b, inner)``: fingerprints of sets that share a signature, as stars;
    ``inner`` ones are around the first set of a batch, which stands for its
    others in the stars over all."""
    def meet(t: pa.Table) -> pa.Table:
        col = {c: b"".join(t.column(c).to_pylist()) for c in ("sigs", "nodes", "a", "b")}
        _, a, b = _stars(np.frombuffer(col["sigs"], U), np.frombuffer(col["nodes"], np.int64))
        inner = np.arange(len(a) + len(col["a"]) // 8) >= len(a)
        a = np.concatenate([a, np.frombuffer(col["a"], np.int64)])
        b = np.concatenate([b, np.frombuffer(col["b"], np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "inner": pa.array(inner)})
    groups = max(1, -(-int(shingles * 0.4) // PACKED))
    return packed_signatures(docs, k, num, den, groups).groupBy("part").applyInArrow(meet, "a long, b long, inner boolean")


def packed_signatures(docs: DataFrame, k: int, num: int, den: int, groups: int) -> DataFrame:
    """Per batch and group: signatures with their first sets, and edges of the others to these."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in in_groups([len(t or "") // 4 + 1 for t in texts], SLICE):
                sets, seen = [], set()
                for text in texts[lo:hi]:
                    s = shingle_set(text, k, words)
                    if len(s) and (fp := fingerprint(s)[0]) not in seen:
                        seen.add(fp)
                        sets.append((s, fp))
                if not sets:
                    continue
                sig, at = signatures([s for s, _ in sets], num, den)
                node = np.array([fp for _, fp in sets], np.int64)[at]
                first, a, b = _stars(sig, node)
                sig, node = sig[first], node[first]
                group = ((sig >> U(32)) * U(groups) >> U(32)).astype(np.int64)   # already sorted
                cuts = np.flatnonzero(np.diff(group)) + 1
                rows = [(int(group[x[0]]), sig[x].tobytes(), node[x].tobytes(), b"", b"")
                        for x in np.split(np.arange(len(sig)), cuts) if len(x)]
                # a batch's own edges are dealt by themselves over all groups
                rows += [(g, b"", b"", a[x].tobytes(), b[x].tobytes()) for g, x in dealt(groups, a, b)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()),
                     *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5))],
                    ["part", "sigs", "nodes", "a", "b"])

    return docs.select("text").mapInArrow(pack, "part int, sigs binary, nodes binary, a binary, b binary")


def shards_of(edges: DataFrame) -> DataFrame:
    """``(fp1, cell)``: the shards of every set; ``edges`` (a, b, inner) are stars
    around b.  Whoever an inner star's centre stands for enters with it."""
    ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("cell")).withColumnRenamed("a", "centre")
    named = edges.join(least, F.col("b") == F.col("centre"))
    own = named.select(F.col("a").alias("fp1"), "cell").union(named.select(F.col("b").alias("fp1"), "cell"))
    outer = named.where("not inner")
    entered = (outer.select(F.col("a").alias("centre"), "cell").union(outer.select("centre", "cell")).distinct())
    with_it = (edges.where("inner").join(entered, F.col("b") == F.col("centre"))
               .select(F.col("a").alias("fp1"), "cell"))
    return own.union(with_it).distinct()


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def search(sets: list[np.ndarray], num: int, den: int, probes: list[int] | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of the ``sets`` (sorted, not empty).

    With ``probes`` only pairs with one of these are looked for."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")     # owners ascend within a list
    flat, owner = flat[order], owner[order]
    keys, begin, length = np.unique(flat, return_index=True, return_counts=True)
    forest, links = Forest(len(sets)), []
    everyone = probes is None
    for x in range(len(sets)) if everyone else probes:
        need = -(-num * int(n[x]) // den)                     # overlap with any set that links
        at = np.searchsorted(keys, sets[x])
        size = length[at]
        by_size = np.argsort(size, kind="stable")
        longest = int(size[by_size[-1]])
        long_lists = min(int(need / (MU * np.log(max(longest, 2)) + 1)), need - 1)
        # long lists are worth probing only where they are longer than the rest
        long_lists = min(long_lists, int((size > 8).sum()))
        short, long_ = by_size[:len(by_size) - long_lists], by_size[len(by_size) - long_lists:]
        # merge: the short lists put together, occurrences counted by set
        merged = np.concatenate([owner[begin[at[i]]:begin[at[i]] + size[i]] for i in short])
        if everyone:
            merged = merged[merged < x]
        if not len(merged):
            continue
        cand, count = np.unique(merged, return_counts=True)
        keep = (count >= need - long_lists) & (cand != x)
        keep &= (n[cand] * den >= num * n[x]) & (n[x] * den >= num * n[cand])
        cand, count = cand[keep], count[keep]
        if len(cand) > 1:
            far = np.array([forest.root(c) for c in cand]) != forest.root(x)
            cand, count = cand[far], count[far]
        for i in long_:                                       # binary probes of the long lists
            if not len(cand):
                break
            own = owner[begin[at[i]]:begin[at[i]] + size[i]]
            where = np.minimum(np.searchsorted(own, cand), len(own) - 1)
            count = count + (own[where] == cand)
        enough = den * count >= num * (n[cand] + n[x] - count)
        for y in cand[enough]:
            if forest.join(x, int(y)):
                links.append((x, int(y)))
    return links


def stars(n: int, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same components as ``links``, every member tied to its least."""
    forest = Forest(n)
    for a, b in links:
        forest.join(a, b)
    members = {i for pair in links for i in pair}
    return [(i, r) for i in sorted(members) if (r := forest.root(i)) != i]


def _links_of_shards(num: int, den: int):
    """Links within each shard of rows (cell, rep, shingles, probe, pivot), in order of the cells.

    Pairs without a probe are passed over.  Where a shard has pivots, its sets
    are first compared with these; the largest group so found has no probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, reps, sets, probe, pivot = None, [], [], [], []

        def finish() -> pa.RecordBatch:
            links, probes = [], None
            if any(pivot):
                links, probes = near_pivots(sets, [i for i, p in enumerate(pivot) if p], num, den)
            elif not all(probe):
                probes = [i for i, p in enumerate(probe) if p]
            if probes is None or probes:
                links = links + search(sets, num, den, probes)
            links = stars(len(sets), links)
            return pa.RecordBatch.from_arrays(
                [pa.array([reps[a] for a, _ in links], pa.int64()), pa.array([reps[b] for _, b in links], pa.int64())],
                ["a", "b"])

        for batch in batches:
            for s, rep, raw, x, p in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if s != shard:
                    if len(reps) > 1:
                        yield finish()
                    shard, reps, sets, probe, pivot = s, [], [], [], []
                reps.append(rep), sets.append(np.frombuffer(raw, U)), probe.append(x), pivot.append(p)
        if len(reps) > 1:
            yield finish()
    return run


def near_pivots(sets: list[np.ndarray], pivots: list[int], num: int, den: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Links of each set with the first pivot it reaches, and the sets outside the largest group these make."""
    forest, links = Forest(len(sets)), []
    for x, s in enumerate(sets):
        for p in pivots:
            if p == x:
                break
            small, large = sorted((len(s), len(sets[p])))
            if den * small < num * large:
                continue
            both = len(np.intersect1d(s, sets[p], assume_unique=True))
            if den * both >= num * (small + large - both):
                forest.join(x, p)
                links.append((x, p))
                break
    root = np.array([forest.root(i) for i in range(len(sets))])
    main = np.bincount(root, weights=[len(s) for s in sets]).argmax()
    return links, np.flatnonzero(root != main).tolist()


def _sets_of_texts(k: int):
    """Rows (cell, rep, fp1, fp2, probe, pivot, text), in order of the cells, reps and fp1, with the set of each
    for the text: other texts of the id go, equal rows become one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordHashes(), None
        for batch in batches:
            out: list[list] = []
            for cell, rep, fp1, fp2, probe, pivot, text in zip(*(c.to_pylist() for c in batch.columns)):
                s = shingle_set(text, k, words)
                if fingerprint(s) != (fp1, fp2):
                    continue
                if last and last[:3] == [cell, rep, (fp1, fp2)]:
                    last[4:] = [last[4] or probe, last[5] or pivot]
                    continue
                if last:
                    out.append(last)
                last = [cell, rep, (fp1, fp2), s.tobytes(), probe, pivot]
            if out:
                yield _set_rows(out)
        if last:
            yield _set_rows([last])
    return run


def _set_rows(rows: list[list]) -> pa.RecordBatch:
    cell, rep, _, raw, probe, pivot = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(cell, pa.int64()), pa.array(rep, pa.int64()), pa.array(raw, pa.binary()),
         pa.array(probe, pa.bool_()), pa.array(pivot, pa.bool_())], ["cell", "rep", "shingles", "probe", "pivot"])


def _search_shards(texts: DataFrame, members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``(a, b)``: links within the cells of ``members`` (cell, rep, fp1, fp2, probe, pivot).

    The texts move, compressed, and not the sets, which do not compress: a
    set is computed where it is searched."""
    sets_of, links_of = _sets_of_texts(k), _links_of_shards(num, den)
    return (maybe_member(texts, "rep", members.select("rep")).join(members, "rep")
            .select("cell", "rep", "fp1", "fp2", "probe", "pivot", "text")
            .repartition("cell").sortWithinPartitions("cell", "rep", "fp1")
            .mapInArrow(lambda batches: links_of(sets_of(batches)), "a long, b long"))


_MEMBER = ("rep", "fp1", "fp2", "probe", "pivot")


def _pieces(active: DataFrame, big: DataFrame) -> DataFrame:
    """The cells to search first: small ones as they are, of each ``big`` one
    (cell, pieces) its pieces, with the cell's pivots in every piece."""
    def marked(df: DataFrame, probe: bool, pivot: bool) -> DataFrame:
        return df.withColumns({"probe": F.lit(probe), "pivot": F.lit(pivot)}).select("cell", *_MEMBER)

    own = F.struct("rep", "fp1", "fp2")
    laid = active.join(big, "cell")
    picked = (laid.groupBy("cell", "pieces").agg(F.array_distinct(F.array(
        *[F.min_by(own, F.xxhash64("rep", "fp1", F.lit(i))) for i in range(PIVOTS)])).alias("pivots"))
              .select("cell", "pieces", F.explode("pivots").alias("p"))
              .select("cell", "p.*", F.explode(F.expr("sequence(0L, pieces - 1)")).alias("i")))
    piece = F.pmod(F.xxhash64("rep", F.lit(99)), F.col("pieces"))
    key = F.xxhash64("cell", "i").alias("cell")
    return (marked(active.join(big, "cell", "left_anti"), True, False)
            .union(marked(laid.withColumn("i", piece).select(key, "rep", "fp1", "fp2"), True, False))
            .union(marked(picked.select(key, "rep", "fp1", "fp2"), True, True)))


def _blocks(active: DataFrame, big: DataFrame, groups: DataFrame, shard: int) -> DataFrame:
    """Of the ``big`` cells whose sets are not yet of one group (node, root):
    all but those of the largest group are probes, in blocks, against all blocks."""
    grouped = (active.join(big, "cell").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
               .withColumn("grp", F.coalesce("root", "rep")))
    largest = (grouped.groupBy("cell", "grp").agg(F.sum("n").alias("c"))
               .groupBy("cell").agg(F.max_by("grp", F.struct("c", "grp")).alias("main")))
    marked = grouped.join(largest, "cell").withColumn("probe", F.col("grp") != F.col("main"))
    blocks = marked.groupBy("cell").agg(
        F.ceil(F.sum("n") / (shard / 2)).alias("kb"),
        F.ceil(F.sum(F.when(F.col("probe"), F.col("n")).otherwise(0)) / (shard / 2)).alias("pb")).where("pb > 0")
    laid = marked.join(blocks, "cell").withColumn("pivot", F.lit(False))
    as_member = (laid.withColumn("probe", F.lit(False)).withColumns({
        "i": F.pmod(F.xxhash64("rep", F.lit(99)), F.col("kb")), "j": F.explode(F.expr("sequence(0L, pb - 1)"))}))
    as_probe = laid.where("probe").withColumns({
        "j": F.pmod(F.xxhash64("rep", F.lit(98)), F.col("pb")), "i": F.explode(F.expr("sequence(0L, kb - 1)"))})
    return as_member.unionByName(as_probe).select(F.xxhash64("cell", "i", "j").alias("cell"), *_MEMBER)


def components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, shard: int = SHARD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Documents link when ``den * |A & B| >= num * |A | B|`` of their sets of
    ``k``-word shingles; the component is the least ``doc_id`` reachable."""
    rows = checkpointed(measure(docs, k))
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    classes = (rows.where("n > 0 and doc_id is not null").groupBy("fp1", "fp2", "n")
               .agg(F.min("doc_id").alias("rep")))
    edges = checkpointed_alone(
        candidate_edges(docs.where(F.col("doc_id").isNotNull()), k, num, den, shingles).distinct())
    active = checkpointed(classes.join(shards_of(edges), "fp1"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    repeated = checkpointed(rows.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("fp1", "fp2", "n")).alias("x"), F.max(F.struct("fp1", "fp2", "n")).alias("y"),
        F.count(F.lit(1)).alias("c")).where("c > 1"))
    if not repeated.isEmpty():
        # rows equal in id and text are moved once
        once, several = split_by_membership(texts, "rep", repeated.select("doc_id"))
        texts = once.union(several.distinct())
    big = checkpointed(active.groupBy("cell").agg(F.sum("n").alias("load")).where(F.col("load") > shard)
                       .select("cell", F.ceil(F.col("load") / (shard / 2)).alias("pieces")))
    if big.isEmpty():
        links = checkpointed_alone(_search_shards(texts, active.withColumns(
            {"probe": F.lit(True), "pivot": F.lit(False)}).select("cell", *_MEMBER), k, num, den))
    else:
        links = checkpointed_alone(_search_shards(texts, checkpointed(_pieces(active, big)), k, num, den))
        groups = connected_components(links.where("a <> b"))
        blocks = checkpointed(_blocks(active, big, groups, shard))
        if not blocks.isEmpty():
            links = links.union(checkpointed_alone(_search_shards(texts, blocks, k, num, den)))
    # rows that share an id are one document: the sets of an id are tied to it
    several = repeated.where("x <> y").select("doc_id")
    tied = not several.isEmpty()
    if tied:
        links = links.union(rows.join(several, "doc_id").join(classes, ["fp1", "fp2", "n"])
                            .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = connected_components(links.where("a <> b"))
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    of_rep = found.join(least, "root").select(F.col("node").alias("rep"), "component")
    named = classes.join(of_rep, "rep", "left").select(
        "fp1", "fp2", "n", F.coalesce("component", "rep").alias("component"))
    out = rows.join(named, ["fp1", "fp2", "n"], "left")
    if tied:                                # an empty row of such an id has no class
        of_id = of_rep.join(several, F.col("rep") == F.col("doc_id")).select("doc_id", F.col("component").alias("by_id"))
        out = out.join(of_id, "doc_id", "left").withColumn("component", F.coalesce("component", "by_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component: that of the least id.

    Rows with a null id stay.  Of rows that share an id the one with the
    least text stays (null first)."""
    found = checkpointed(components(docs, k, num, den))
    gone = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id")
    kept = without(docs, "doc_id", gone)
    repeated = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if repeated.isEmpty():
        return kept
    one, several = split_by_membership(kept, "doc_id", repeated.select("doc_id"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first()))
    return one.union(several.withColumn("__rank", rank).where("__rank = 1").drop("__rank"))

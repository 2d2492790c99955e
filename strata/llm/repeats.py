"""Substring dedup by compact windows.

A text is its sequence of 5-word shingles.  For a hash function, the
sub-sequences of at least ``t`` shingles whose least hash stands at place c
form one compact window (l, c, r): the node of the Cartesian tree over the
hashes that c is, with the range it is the minimum of.  Only places that are
the minimum of some ``t`` consecutive shingles have such windows, about
``2 / t`` of all; the tree is built over these.

1. Windows of ``HASHES`` functions are grouped by their least shingle (the
   signature).  They move as packed arrays; within a batch, of the windows
   with the same signature and surroundings only the first goes on.
2. Within a signature every window is paired with the first document's, and
   with the first of those with the same neighbouring shingles - stars,
   never all pairs.
   A signature of three windows or more may have holders of one passage
   that share less with these.  There every ``t`` consecutive shingles
   around the place (one function is enough) are a key of their own, whose
   holders are a star: equal passages always meet.
3. The intervals that both windows of a pair span around c are joined on
   their diagonal, then over all functions and tree nodes.  One function
   hitting is enough for a candidate: a passage of similarity 0.8 has all
   functions miss with a chance of 0.2 ** HASHES for each of its windows.
4. Verification: the slice of the earlier document (cut at multiples of
   ``ALIGN``, each distinct slice made once) is sent to the later document,
   whose shingles found in it are marked; maximal runs of at least ``t``
   shingles with at least ``8/9`` marked (similarity 0.8 of equal lengths)
   are repeats.

The smallest ``doc_id`` with a passage keeps it.  Defined results: a null or
empty text, or one of fewer than ``min_words`` words, has no repeats; rows
with a null ``doc_id`` take no part; rows of one id are one document; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, maybe_member, space_words, split_by_membership
from strata.llm.shingles import U, WordHashes, dealt, in_groups, mix, sequence

HASHES = 4
WORDS = 5                   # words in a shingle
ALIGN = 64
#: words worked on at once in a task; windows in a packed group
SLICE, PACKED = 300_000, 250_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def compact_windows(h: np.ndarray, first: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places c, l, r (ends included) of all compact windows of at least ``t``
    places of the texts put together in ``h``; ``first`` (texts + 1) bounds them."""
    n = len(h)
    none = np.zeros(0, np.int64)
    if n < t:
        return none, none, none
    # the place in the low bits: minima are unique, ties go to the left
    bits = max(int(n - 1).bit_length(), 1)
    key = (h >> U(bits) << U(bits)) | np.arange(n, dtype=U)
    # minima of all t consecutive places from running minima of blocks of t
    padded = np.full(-(-n // t) * t, ~U(0), U)
    padded[:n] = key
    blocks = padded.reshape(-1, t)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - t + 1], ahead[t - 1:n])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    least = least[owner[:n - t + 1] == owner[t - 1:]]
    if not len(least):
        return none, none, none
    c = np.sort((least[np.concatenate([[True], least[1:] != least[:-1]])] & U((1 << bits) - 1)).astype(np.int64))
    c = c[np.concatenate([[True], c[1:] != c[:-1]])]
    # the tree over these places, text by text, by a stack of rising keys
    left = first[owner[c]].tolist()
    right = (first[owner[c] + 1] - 1).tolist()
    keys, places, of = key[c].tolist(), c.tolist(), owner[c].tolist()
    stack: list[int] = []
    for i, k in enumerate(keys):
        if stack and of[stack[-1]] != of[i]:
            stack.clear()
        while stack and keys[stack[-1]] > k:
            right[stack.pop()] = places[i] - 1
        if stack:
            left[i] = places[stack[-1]] + 1
        stack.append(i)
    return c, np.array(left, np.int64), np.array(right, np.int64)


_FIELDS = (("sig", U), ("ctx", U), ("doc", np.int64), ("c", np.int32), ("l", np.int32), ("r", np.int32), ("n", np.int32))
#: words of the map of signatures that go the exact way; fixed at every size
MAP_WORDS = 1 << 17
#: keys of passages in a packed group
KEYS = 1_000_000


def _surroundings(s: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of the shingles a shingle's length to either side of each place."""
    return s[np.maximum(c - WORDS, 0)] * U(3) + s[np.minimum(c + WORDS, len(s) - 1)] * U(5)


def windows_of(docs: list[int], texts: list[np.ndarray], t: int) -> dict[str, np.ndarray]:
    """All windows of the texts (shingle arrays) as columns."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    s = np.concatenate(texts)
    ids = np.array(docs, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    out: dict[str, list[np.ndarray]] = {name: [] for name, _ in _FIELDS}
    for f in range(HASHES):
        salt = U((f + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        h = mix(s + salt)
        c, left, right = compact_windows(h, first, t)
        at = owner[c]
        # least hashes lie near zero: scrambled, signatures spread over all groups
        for name, values in zip(out, (mix(h[c]), _surroundings(s, c), ids[at], c - first[at], left - first[at],
                                      right - first[at], np.full(len(c), f == 0))):    # n: windows of one function
            out[name].append(values)
    return {name: np.concatenate(out[name]).astype(kind) for name, kind in _FIELDS}


def _leaders(w: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Rows in order of (sig, ctx, doc, c); mask of the first of each (sig, ctx);
    and pairs of all with that first and with the first document of the signature."""
    order = np.lexsort((w["c"], w["doc"], w["ctx"], w["sig"]))
    v = {k: x[order] for k, x in w.items()}
    n = len(order)
    new_sig = np.ones(n, bool)
    new_sig[1:] = v["sig"][1:] != v["sig"][:-1]
    new_ctx = new_sig.copy()
    new_ctx[1:] |= v["ctx"][1:] != v["ctx"][:-1]
    sig_of, ctx_of = np.cumsum(new_sig) - 1, np.cumsum(new_ctx) - 1
    ctx_head = np.flatnonzero(new_ctx)[ctx_of] if n else np.zeros(0, np.int64)
    # the first document of a signature: least (doc, c) of its rows
    by_doc = np.lexsort((v["c"], v["doc"], v["sig"]))
    sig_head = by_doc[np.flatnonzero(new_sig)][sig_of] if n else np.zeros(0, np.int64)
    pairs = []
    for head, rows in ((ctx_head, np.arange(n)), (sig_head, np.flatnonzero(new_ctx))):
        far = head[rows] if len(rows) else rows
        a, b = np.where(v["doc"][far] <= v["doc"][rows], far, rows), np.where(v["doc"][far] <= v["doc"][rows], rows, far)
        keep = v["doc"][a] != v["doc"][b]
        pairs.append((a[keep], b[keep]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    reach_l = np.minimum(v["c"][a] - v["l"][a], v["c"][b] - v["l"][b])
    reach_r = np.minimum(v["r"][a] - v["c"][a], v["r"][b] - v["c"][b])
    # the first of each (sig, ctx) stands for the windows of all
    v["n"] = np.add.reduceat(v["n"], np.flatnonzero(new_ctx)) if n else v["n"]
    return order[new_ctx], v["n"].astype(np.int32), interval_join({
        "b": v["doc"][b], "a": v["doc"][a], "diag": v["c"][b].astype(np.int64) - v["c"][a],
        "lo": v["c"][b].astype(np.int64) - reach_l, "hi": v["c"][b].astype(np.int64) + reach_r})


def interval_join(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Overlapping or touching intervals of the same documents and diagonal become one."""
    if not len(p["b"]):
        return p
    order = np.lexsort((p["lo"], p["diag"], p["a"], p["b"]))
    p = {k: x[order] for k, x in p.items()}
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum((p["b"][1:] != p["b"][:-1]) | (p["a"][1:] != p["a"][:-1]) | (p["diag"][1:] != p["diag"][:-1]))
    # running maximum of the ends within a group, by a shift no end can pass
    span = int(p["hi"].max()) + 2
    reach = np.maximum.accumulate(p["hi"] + group * span) - group * span
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (p["lo"][1:] > reach[:-1] + 1)
    at = np.flatnonzero(new)
    return {**{k: p[k][at] for k in ("b", "a", "diag", "lo")}, "hi": np.maximum.reduceat(p["hi"], at)}


def _pairs_batch(p: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {f"p_{k}": p[k].astype(np.int64).tobytes() for k in ("b", "a", "diag", "lo", "hi")}


_PACK_SCHEMA = "part int, " + ", ".join(f"{n} binary" for n, _ in _FIELDS) + \
    ", p_b binary, p_a binary, p_diag binary, p_lo binary, p_hi binary"
_PAIR = "b long, a long, diag long, lo long, hi long"


def candidates(docs: DataFrame, min_words: int, words_total: int) -> DataFrame:
    """``(b, a, lo, hi, alo, ahi)``: of shingles lo..hi of document b some may
    repeat those of alo..ahi of the smaller document a."""
    t = min_words - WORDS + 1
    parts = max(1, -(-int(words_total * HASHES * 2 / t) // PACKED))

    def meet(table: pa.Table) -> pa.Table:
        w = {n: np.frombuffer(b"".join(table.column(n).to_pylist()), kind) for n, kind in _FIELDS}
        _, _, pairs = _leaders(w)
        sigs, of = np.unique(w["sig"], return_inverse=True)
        held = np.bincount(of, w["n"], len(sigs)).astype(np.int64)
        more = held >= 3
        own = {k: np.frombuffer(b"".join(table.column(f"p_{k}").to_pylist()), np.int64) for k in pairs}
        joined = interval_join({k: np.concatenate([pairs[k], own[k]]) for k in pairs})
        out = pa.table({k: pa.array(joined[k].astype(np.int64), pa.int64()) for k in ("b", "a", "diag", "lo", "hi")})
        # signatures that go the exact way, with their windows: rows without documents
        none = pa.nulls(int(more.sum()), pa.int64())
        return pa.concat_tables([out, pa.table({
            "b": none, "a": none, "diag": pa.array(sigs[more].view(np.int64)), "lo": pa.array(held[more]), "hi": none})])

    met = checkpointed(packed_windows(docs, t, parts).groupBy("part").applyInArrow(meet, _PAIR))
    met = met.where("b is not null").union(exact_pairs(docs, t, met.where("b is null").select(
        F.col("diag").alias("sig"), F.col("lo").alias("n"))))
    # over all functions, nodes and diagonals: the places of either document that need a look
    at = F.col("lo") - F.col("diag"), F.col("hi") - F.col("diag")
    return met.groupBy("b", "a").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                     F.min(at[0]).alias("alo"), F.max(at[1]).alias("ahi"))


def packed_windows(docs: DataFrame, t: int, parts: int) -> DataFrame:
    """Per batch and group: the windows that go on, and pairs of the others with these."""
    names = [n for n, _ in _FIELDS]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in in_groups([len(x or "") // 5 + 1 for x in texts], SLICE):
                seqs = [(i, sequence(hashes.of(space_words(x)), WORDS)) for i, x in zip(ids[lo:hi], texts[lo:hi])]
                seqs = [(i, s) for i, s in seqs if len(s) >= t]
                if not seqs:
                    continue
                w = windows_of([i for i, _ in seqs], [s for _, s in seqs], t)
                if not len(w["sig"]):
                    continue
                first, n, pairs = _leaders(w)
                w = {**{k: x[first] for k, x in w.items()}, "n": n}
                part = ((w["sig"] >> U(32)) * U(parts) >> U(32)).astype(np.int64)   # rows ascend by sig
                rows = [(int(part[x[0]]), *(w[n][x].tobytes() for n in names), *[b""] * 5)
                        for x in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1)]
                # a batch's own pairs are dealt by themselves over all groups
                rows += [(g, *[b""] * len(names), *_pairs_batch({k: v[x] for k, v in pairs.items()}).values())
                         for g, x in dealt(parts, pairs["b"], pairs["a"])]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                    ["part", *names, "p_b", "p_a", "p_diag", "p_lo", "p_hi"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, _PACK_SCHEMA)


def passage_keys(s: np.ndarray, start: np.ndarray, t: int) -> np.ndarray:
    """Hash of the ``t`` shingles from each start on."""
    odd, n = 0x9E3779B97F4A7C15, len(s) + 1
    power, back = (np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, x, U)]), dtype=U)
                   for x in (odd, pow(odd, -1, 1 << 64)))
    total = np.concatenate([np.zeros(1, U), np.cumsum(s * power[:-1], dtype=U)])
    return mix((total[start + t] - total[start]) * back[start])


def _key_stars(key: np.ndarray, doc: np.ndarray, at: np.ndarray, t: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The first (least document and place) of each key, in order of the keys,
    and pairs of the others with it."""
    order = np.lexsort((at, doc, key))
    key, doc, at = key[order], doc[order], at[order].astype(np.int64)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)
    b = np.flatnonzero(doc != doc[head])
    a = head[b]
    return order[new], interval_join({"b": doc[b], "a": doc[a], "diag": at[b] - at[a], "lo": at[b], "hi": at[b] + t - 1})


def exact_pairs(docs: DataFrame, t: int, sigs: DataFrame) -> DataFrame:
    """Pairs of documents with ``t`` equal shingles around a place of one of ``sigs`` (sig, n)."""
    # a map of fixed size: a signature that is not meant may pass, none is lost
    rows = (sigs.groupBy(F.shiftrightunsigned("sig", 47).alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(sig, 41) & 63 as int)))").alias("bits"),
                 F.sum("n").alias("n")).collect())
    bits = np.zeros(MAP_WORDS, np.int64)
    for r in rows:
        bits[r["w"]] = r["bits"]
    parts = max(1, -(-sum(r["n"] for r in rows) * t // KEYS))
    shared = docs.sparkSession.sparkContext.broadcast(bits.view(U))
    if not rows:
        return docs.sparkSession.createDataFrame([], _PAIR)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bitmap = WordHashes(), shared.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in in_groups([len(x or "") // 5 + 1 for x in texts], SLICE):
                seqs = [(i, sequence(hashes.of(space_words(x)), WORDS)) for i, x in zip(ids[lo:hi], texts[lo:hi])]
                seqs = [(i, s) for i, s in seqs if len(s) >= t]
                if not seqs:
                    continue
                first = np.concatenate([[0], np.cumsum([len(s) for _, s in seqs])]).astype(np.int64)
                s = np.concatenate([s for _, s in seqs])
                h = mix(s + U(0x9E3779B97F4A7C15))          # the first function of windows_of
                c, left, right = compact_windows(h, first, t)
                sig = mix(h[c])
                go = (bitmap[(sig >> U(47)).astype(np.int64)] >> ((sig >> U(41)) & U(63)) & U(1)) > 0
                c, left, right = c[go], left[go], right[go]
                low = np.maximum(left, c - t + 1)
                many = np.minimum(c, right - t + 1) - low + 1
                start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
                if not len(start):
                    continue
                owner = np.searchsorted(first, start, side="right") - 1
                doc = np.array([i for i, _ in seqs], np.int64)[owner]
                key, at = passage_keys(s, start, t), (start - first[owner]).astype(np.int32)
                own, pairs = _key_stars(key, doc, at, t)
                key, doc, at = key[own], doc[own], at[own]
                part = ((key >> U(32)) * U(parts) >> U(32)).astype(np.int64)
                rows = [(int(part[x[0]]), key[x].tobytes(), doc[x].tobytes(), at[x].tobytes(), *[b""] * 5)
                        for x in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1)]
                rows += [(g, b"", b"", b"", *_pairs_batch({k: v[x] for k, v in pairs.items()}).values())
                         for g, x in dealt(parts, pairs["b"], pairs["a"])]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *(pa.array(x, pa.binary()) for x in cols[1:])],
                    ["part", "key", "doc", "at", "p_b", "p_a", "p_diag", "p_lo", "p_hi"])

    def meet(table: pa.Table) -> pa.Table:
        key, doc, at = (np.frombuffer(b"".join(table.column(n).to_pylist()), kind)
                        for n, kind in (("key", U), ("doc", np.int64), ("at", np.int32)))
        _, pairs = _key_stars(key, doc, at, t)
        own = {k: np.frombuffer(b"".join(table.column(f"p_{k}").to_pylist()), np.int64) for k in pairs}
        joined = interval_join({k: np.concatenate([pairs[k], own[k]]) for k in pairs})
        return pa.table({k: pa.array(joined[k].astype(np.int64), pa.int64()) for k in ("b", "a", "diag", "lo", "hi")})

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "part int, key binary, doc binary, at binary, p_b binary, p_a binary, p_diag binary, p_lo binary, p_hi binary")
    return packed.groupBy("part").applyInArrow(meet, _PAIR)


def runs(mark: np.ndarray, t: int) -> list[tuple[int, int]]:
    """Maximal ranges of at least ``t`` places, at least 8/9 of them marked,
    beginning and ending at a mark: neighbouring stretches of marks are put
    together while the share holds."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    done: list[list[int]] = []          # begin, end, marks
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        cur = [a, b, b - a]
        while done and 9 * (done[-1][2] + cur[2]) >= 8 * (cur[1] - done[-1][0]):
            last = done.pop()
            cur = [last[0], cur[1], last[2] + cur[2]]
        done.append(cur)
    return [(a, b) for a, b, _ in done if b - a >= t]


def _slicer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        doc, start, end, body = [], [], [], []
        for i, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(3))):
            s = sequence(hashes.of(space_words(text)), WORDS)
            for x in wanted:
                doc.append(i), start.append(x["qs"]), end.append(x["qe"])
                body.append((s[x["qs"]:x["qe"]] & U(0xFFFFFFFF)).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                          pa.array(end, pa.int64()), pa.array(body, pa.binary())],
                                         ["a", "qs", "qe", "body"])


def _marker(t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        current, own = None, []                 # (text hash, its shingles) of the document at hand
        for batch in batches:
            out = []
            for doc, kind, text, a, lo, hi, body in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if kind == 0:
                    if doc != current:
                        current, own = doc, []
                    s = sequence(hashes.of(space_words(text)), WORDS)
                    own.append((xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63),
                                (s & U(0xFFFFFFFF)).astype(np.uint32)))
                elif doc == current:
                    other = np.frombuffer(body, np.uint32)
                    for h, s in own:
                        begin = max(lo - ALIGN, 0)
                        for x, y in runs(np.isin(s[begin:hi + 1 + ALIGN], other), t):
                            out.append((doc, h, begin + x, begin + y + WORDS - 1, a))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "text_hash", "begin", "end", "source_doc_id"])
    return run


def find_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``(doc_id, text_hash, begin, end, source_doc_id)``: words begin..end-1 of the
    document repeat a passage of the smaller document; spans do not overlap."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pairs = checkpointed(candidates(docs, min_words, n // 5))
    # slices of the earlier documents, cut at multiples so that many pairs share one
    pairs = (pairs.withColumn("qs", F.expr(f"greatest((alo - {ALIGN}) div {ALIGN} * {ALIGN}, 0L)"))
             .withColumn("qe", F.expr(f"((ahi + {ALIGN}) div {ALIGN} + 1) * {ALIGN}")))
    wanted = (pairs.select("a", "qs", "qe").distinct().groupBy("a")
              .agg(F.collect_list(F.struct("qs", "qe")).alias("wanted")))
    # of rows with one id, the least text stands for it here
    sources = (maybe_member(docs, "doc_id", wanted.select("a")).join(wanted, F.col("doc_id") == F.col("a"))
               .groupBy("a").agg(F.min(F.struct("text", "wanted")).alias("m")).select("a", "m.text", "m.wanted"))
    slices = sources.mapInArrow(_slicer, "a long, qs long, qe long, body binary")
    asked = pairs.join(slices, ["a", "qs", "qe"]).select(
        F.col("b").alias("doc_id"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text"),
        "a", "lo", "hi", "body")
    texts = maybe_member(docs, "doc_id", pairs.select("b")).select(
        "doc_id", F.lit(0).alias("kind"), "text", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("lo"),
        F.lit(0).cast("long").alias("hi"), F.lit(None).cast("binary").alias("body"))
    spans = (texts.union(asked).repartition("doc_id").sortWithinPartitions("doc_id", "kind")
             .mapInArrow(_marker(min_words - WORDS + 1),
                         "doc_id long, text_hash long, begin long, `end` long, source_doc_id long"))
    per_doc = spans.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("begin", "end", "source_doc_id"))).alias("spans"))
    # overlapping spans become one; it names the smallest source
    merged = F.aggregate("spans", F.expr("cast(array() as array<struct<begin:long,`end`:long,source_doc_id:long>>)"),
                         _merge)
    return per_doc.select("doc_id", "text_hash", F.explode(merged).alias("s")).select(
        "doc_id", "text_hash", "s.begin", "s.end", "s.source_doc_id")


def _merge(done, span):
    last = F.element_at(done, -1)
    joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"),
                      F.least(last["source_doc_id"], span["source_doc_id"]).alias("source_doc_id"))
    overlap = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["begin"])
    return F.when(overlap, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(
        F.concat(done, F.array(span)))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space after them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done:at[min(a, len(at) - 1)]])
        done = at[min(b, len(at) - 1)]
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` without the repeated passages; rows nothing is left of go.  A
    column ``n_chars`` follows the shortened text; others stay."""
    found = checkpointed(find_repeats(docs, min_words))
    spans = found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("__spans")).withColumnsRenamed(
        {"doc_id": "__doc", "text_hash": "__hash"})
    apart, maybe = split_by_membership(docs, "doc_id", found.select("doc_id"))
    joined = maybe.join(spans.groupBy("__doc").agg(F.map_from_entries(F.collect_list(
        F.struct("__hash", "__spans"))).alias("__by_text")), F.col("doc_id") == F.col("__doc"), "left").drop("__doc")
    text_at, map_at = joined.columns.index("text"), joined.columns.index("__by_text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c for i, c in enumerate(batch.columns) if i != map_at]
            texts, keep = [], []
            for text, by_text in zip(batch.column(text_at).to_pylist(), batch.column(map_at).to_pylist()):
                spans_ = None
                if by_text and text is not None:
                    spans_ = dict(by_text).get(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63))
                if spans_:
                    text = cut_spans(text, [(s["begin"], s["end"]) for s in spans_])
                texts.append(text)
                keep.append(not spans_ or bool(space_words(text)))
            cols[text_at] = pa.array(texts, cols[text_at].type)
            if chars_at is not None:
                old = cols[chars_at].to_pylist()
                new = [len(t) if by and t is not None else o
                       for t, o, by in zip(texts, old, batch.column(map_at).to_pylist())]
                cols[chars_at] = pa.array(new).cast(cols[chars_at].type)
            out = pa.RecordBatch.from_arrays(cols, [n for i, n in enumerate(batch.schema.names) if i != map_at])
            yield out.filter(pa.array(keep, pa.bool_()))

    return apart.union(joined.mapInArrow(cut, docs.schema))

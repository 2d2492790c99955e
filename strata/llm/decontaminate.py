"""Benchmark decontamination by latent semantic retrieval.

1. Words of the benchmark are the columns.  One pass turns every whole text
   into its benchmark words with their places, written once to the shared
   folder; all later passes read only that.
2. Passages are blocks of words (for frequencies, two together).  Document frequencies over all of them give
   idf weights; words in more than ``stop_share`` of the passages are left
   out of the vectors.  Words of an item do not count where a copy of it
   stands (step 5), so a leak that is copied often keeps its weights.
3. Randomised SVD: every partition adds up its part of ``A'(A omega)`` of
   the TF-IDF matrix ``A`` of all passages; the sum (columns x sketch, of at
   most ``COLUMNS`` columns) gives the leading singular directions by the
   Nystroem formula, so one pass is enough.
4. Candidate search: windows of two neighbouring blocks and the benchmark's
   items are projected; windows within ``min_cosine`` of an item are
   candidates.  Items are the query set, taken in blocks of ``ITEM_BLOCK``.
5. Exact path, without weights: a copy of an item of ``n`` words with ``k``
   words replaced, left out or put in keeps at least ``n - 1 - 2 k`` of its
   pairs of neighbouring words.  Places with as many pairs as ``min_lcs``
   asks for are candidates too, and every place of an item's answer.
6. Checks: the longest common subsequence of item and neighbourhood, over
   the item's length, must reach ``min_lcs``, or ``paraphrase_lcs`` where
   also the item's answer (its last ``answer_words`` words) stands there.

Defined results: a null or empty text has no words and matches nothing; an
item without words matches nothing; repeated items and rows give their rows
once per (doc_id, item_id), the best; an empty benchmark gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ALNUM_WORDS, alnum_words, checkpointed, without

BLOCK = 24                  # words in a block; a window is two of them
RANK, OVERSAMPLE = 192, 16
COLUMNS = 1 << 14           # columns of the matrix; more words share them by hash
ITEM_BLOCK = 2048
LONG_ITEM = 64              # longer items are taken in parts of two blocks
CHUNK = 400_000             # words worked on at once
PIECE, SLAB = 32, 512       # rows added up in one piece, pieces taken together


@dataclass
class Items:
    """Benchmark items (or parts of long ones) as word numbers."""
    vocab: dict[bytes, int]
    ids: list[int]
    words: list[np.ndarray]


def read_items(rows: list[tuple[int, str]]) -> Items:
    vocab: dict[bytes, int] = {}
    ids, words = [], []
    for item, text in rows:
        seq = [vocab.setdefault(w, len(vocab)) for w in alnum_words(text)]
        starts = [0] if len(seq) <= LONG_ITEM else range(0, len(seq) - BLOCK, BLOCK)
        for a in starts if seq else ():
            part = seq if len(seq) <= LONG_ITEM else seq[a:a + 2 * BLOCK]
            ids.append(item)
            words.append(np.array(part, np.int32))
    return Items(vocab, ids, words)


Postings = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]    # sorted codes, bounds, items, bitmap of the codes


@dataclass
class Grams:
    """Pairs of neighbouring words of all items, and their answers, by code."""
    base: int
    pairs: Postings
    answers: Postings
    single: bool                # some item has one word: its code has no second one
    answer_words: int
    ends: np.ndarray            # by word: an answer ends with it
    need: np.ndarray            # by item: pairs a copy keeps
    reach: np.ndarray           # by item: blocks a copy may touch
    columns: list[np.ndarray]   # by item


def _index(codes: list[int], items: list[int]) -> Postings:
    rows = np.unique(np.stack([np.array(codes, np.int64), np.array(items, np.int64)], axis=1), axis=0)
    keys, begin = np.unique(rows[:, 0], return_index=True)
    bitmap = np.zeros(1 << 18, bool)
    bitmap[_bit(keys)] = True
    return keys, np.append(begin, len(rows)), rows[:, 1], bitmap


def _bit(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.int64(0x2545F4914F6CDD1D)) >> 40) & ((1 << 18) - 1)


def _run_code(code, word):
    """The code of a run of words, one word on; equal ones are verified later."""
    return code * np.int64(0x2545F4914F6CDD1D) + word + 1


def read_grams(items: Items, min_lcs: float, answer_words: int) -> Grams:
    base = len(items.vocab) + 1
    pairs, owners, tails, of = [], [], [], []
    ends = np.zeros(base, bool)
    need, reach = np.ones(len(items.words), np.int64), np.ones(len(items.words), np.int64)
    for i, own in enumerate(items.words):
        w = own.astype(np.int64)
        codes = (w[:-1] + 1) * base + w[1:] + 1 if len(w) > 1 else (w + 1) * base
        pairs += codes.tolist()
        owners += [i] * len(codes)
        edits = int(len(w) * (1 - min_lcs) + 1e-9)
        need[i] = max(1, len(w) - 1 - 2 * edits)
        reach[i] = -(-(len(w) + edits) // BLOCK) + 1
        if 0 < answer_words <= len(w):
            code = np.zeros(1, np.int64)
            for word in w[-answer_words:]:
                code = _run_code(code, word)
            tails += code.tolist()
            of.append(i)
            ends[w[-1]] = True
    return Grams(base, _index(pairs, owners), _index(tails, of), any(len(w) == 1 for w in items.words), answer_words,
                 ends, need, reach, [np.unique(_column(w.astype(np.int64))) for w in items.words])


def _posted(table: Postings, codes: np.ndarray, blocks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``item * n + block`` of all hits and their numbers, in slabs of bounded size."""
    keys, begin, items, bitmap = table
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.flatnonzero(bitmap[_bit(codes)])
    codes, blocks = codes[maybe], blocks[maybe]
    at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
    hit = keys[at] == codes
    at, blocks = at[hit], blocks[hit]
    size = begin[at + 1] - begin[at]
    slab = np.cumsum(size) // (1 << 22)
    found, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in zip(edges := np.flatnonzero(np.diff(slab, prepend=-1)), np.append(edges[1:], len(at))):
        own = size[lo:hi]
        within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        key, c = np.unique(items[np.repeat(begin[at[lo:hi]], own) + within] * n + np.repeat(blocks[lo:hi], own),
                           return_counts=True)
        found.append(key), count.append(c)
    if len(found) == 2:
        return found[1], count[1]
    key, back = np.unique(np.concatenate(found), return_inverse=True)
    return key, np.bincount(back, np.concatenate(count), len(key)).astype(np.int64)


def copies(grams: Grams, owner: np.ndarray, place: np.ndarray, words: np.ndarray, block: np.ndarray,
           first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(block, item)``: a copy of the item, or its answer, may begin there."""
    n = int(first[-1])
    joined = (owner[1:] == owner[:-1]) & (place[1:] == place[:-1] + 1)
    codes, at = ((words[:-1] + 1) * grams.base + words[1:] + 1)[joined], block[:-1][joined]
    if grams.single:
        codes, at = np.concatenate([codes, (words + 1) * grams.base]), np.concatenate([at, block])
    key, count = _posted(grams.pairs, codes, at, n)
    item, start = key // n, key % n
    end = first[np.searchsorted(first, start, side="right")] if len(key) else start
    total = count.copy()
    for j in range(1, int(grams.reach.max(initial=1))):
        to = np.minimum(np.searchsorted(key, key + j), max(len(key) - 1, 0))
        own = (key[to] == key + j) & (j < grams.reach[item]) & (start + j < end)
        total[own] += count[to[own]]
    key = key[total >= grams.need[item]]
    m = grams.answer_words
    if len(grams.answers[0]) and len(words) >= m:
        last = m - 1 + np.flatnonzero(grams.ends[words[m - 1:]])
        last = last[(owner[last] == owner[last - m + 1]) & (place[last] - place[last - m + 1] == m - 1)]
        codes = np.zeros(len(last), np.int64)
        for j in range(m):
            codes = _run_code(codes, words[last - m + 1 + j])
        key = np.union1d(key, _posted(grams.answers, codes, block[last - m + 1], n)[0])
    return key % n, key // n


def _outside(grams: Grams, columns: int, words: np.ndarray, block: np.ndarray, first: np.ndarray, start: np.ndarray,
             item: np.ndarray) -> np.ndarray:
    """Mask of the words that do not stand in a copy of an item that has them."""
    held = []
    for i in np.unique(item):
        own = start[item == i]
        end = first[np.searchsorted(first, own, side="right")]
        at = own[:, None] + np.arange(grams.reach[i])
        at = np.unique(at[at < end[:, None]])
        held.append((at[:, None] * columns + grams.columns[i]).ravel())
    if not held:
        return np.ones(len(words), bool)
    return ~np.isin(block * columns + _column(words), np.concatenate(held))


def encode(docs: DataFrame, items: Items, grams: Grams) -> DataFrame:
    """``(doc_id, n_words, places, words, starts, copied)``: the benchmark's words
    of every text, and the blocks where copies of items may begin."""
    shared = docs.sparkSession.sparkContext.broadcast((items.vocab, grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, grams = shared.value
        get = vocab.get
        wide = len(vocab) >= 1 << 16
        kind = np.int32 if wide else np.uint16
        for batch in batches:
            n, places, words = [], [], []
            for raw in batch.column(1).to_pylist():
                ws = raw.translate(ALNUM_WORDS).split() if raw else []
                ids = np.fromiter(map(get, ws, repeat(-1)), np.int32, len(ws))
                at = np.flatnonzero(ids >= 0)
                n.append(len(ws))
                places.append(at.astype(np.int32).tobytes())
                words.append(ids[at].astype(kind).tobytes())
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(places, pa.binary()), pa.array(words, pa.binary())]
            names = ["doc_id", "n_words", "places", "words"]
            starts, copied = [], []
            for docs_, _, owner, place, flat, block, first, *_ in _chunks(pa.RecordBatch.from_arrays(cols, names), wide):
                start, item = copies(grams, owner, place, flat, block, first)
                order = np.lexsort((item, start))
                start, item = start[order], item[order]
                cuts = np.searchsorted(start, first)
                for d, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    starts.append((start[a:b] - first[d]).astype(np.int32).tobytes())
                    copied.append(item[a:b].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(starts, pa.binary()), pa.array(copied, pa.binary())], [*names, "starts", "copied"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, n_words long, places binary, words binary, starts binary, copied binary")


def _chunks(batch: pa.RecordBatch, wide: bool) -> Iterator[tuple]:
    """Documents put together: ids, and per word its document, place and block;
    per document the first block; blocks and items of copies, where they are
    known.  A very long document is one chunk."""
    docs = batch.column(0).to_pylist()
    n_words = batch.column(1).to_pylist()
    places, words = batch.column(2).to_pylist(), batch.column(3).to_pylist()
    starts, copied = (batch.column(i).to_pylist() if batch.num_columns > 4 else [b""] * len(docs) for i in (4, 5))
    kind = np.int32 if wide else np.uint16
    lo = 0
    while lo < len(docs):
        hi, total = lo, 0
        while hi < len(docs) and (hi == lo or total + n_words[hi] <= CHUNK):
            total += n_words[hi]
            hi += 1
        blocks = np.array([max(1, -(-n // BLOCK)) for n in n_words[lo:hi]], np.int64)
        first = np.concatenate([[0], np.cumsum(blocks)])
        place = [np.frombuffer(p, np.int32) for p in places[lo:hi]]
        flat_words = np.concatenate([np.frombuffer(w, kind) for w in words[lo:hi]]).astype(np.int64)
        owner = np.repeat(np.arange(hi - lo), [len(p) for p in place])
        flat_places = np.concatenate(place).astype(np.int64)
        start = [np.frombuffer(x, np.int32) + a for x, a in zip(starts[lo:hi], first)]
        yield (docs[lo:hi], n_words[lo:hi], owner, flat_places, flat_words, first[owner] + flat_places // BLOCK, first,
               np.concatenate(start), np.frombuffer(b"".join(copied[lo:hi]), np.int32))
        lo = hi


def _column(words: np.ndarray) -> np.ndarray:
    return words % COLUMNS


def document_frequencies(encoded: DataFrame, columns: int, wide: bool, grams: Grams) -> tuple[np.ndarray, int]:
    """Passages (two blocks, not overlapping) that hold each column outside
    copies of its items; the number of passages."""
    shared = encoded.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(columns, np.int64), 0
        for batch in batches:
            for docs, n_words, owner, place, words, block, first, start, item in _chunks(batch, wide):
                passages = np.concatenate([[0], np.cumsum([max(1, -(-k // (2 * BLOCK))) for k in n_words])])
                n += int(passages[-1])
                out = _outside(shared.value, columns, words, block, first, start, item)
                passage, cols = (passages[owner] + place // (2 * BLOCK))[out], _column(words[out])
                held = np.sort(passage * columns + cols)
                new = np.concatenate([[True], held[1:] != held[:-1]])[:len(held)]
                df += np.bincount(held[new] % columns, minlength=columns)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1), pa.int64()), pa.array(np.append(df[held], n), pa.int64())], ["c", "df"])

    rows = encoded.mapInArrow(run, "c long, df long").groupBy("c").agg(F.sum("df").alias("df")).collect()
    out, total = np.zeros(columns, np.int64), 0       # at most COLUMNS + 1 rows
    for r in rows:
        if r["c"] < 0:
            total = r["df"]
        else:
            out[r["c"]] = r["df"]
    return out, total


def _sums(values: np.ndarray, rows: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """``out[to[i]] += values[rows[i]]``: (n x dimensions).

    The rows of a target are added up in pieces of at most ``PIECE``; pieces
    of like length are taken together, so each step adds whole rows of a slab
    that stays in the processor's cache.  A target of several pieces is
    added up from their sums in the same way."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if not len(to):
        return out
    if np.any(to[1:] < to[:-1]):
        order = np.argsort(to, kind="stable")
        rows, to = rows[order], to[order]
    change = np.concatenate([[True], to[1:] != to[:-1]])
    at = np.arange(len(to))
    since = at - np.maximum.accumulate(np.where(change, at, 0))
    start = np.flatnonzero(since % PIECE == 0)
    length = np.diff(np.append(start, len(to)))
    target = to[start]
    several = bool(np.any(target[1:] == target[:-1]))
    parts = np.empty((len(start), values.shape[1]), values.dtype) if several else out
    place = np.arange(len(start)) if several else target
    by = np.argsort(-length, kind="stable")
    for lo in range(0, len(by), SLAB):
        own = by[lo:lo + SLAB]
        first, size = start[own], length[own]
        total = values[rows[first]]
        for k in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -k, side="left"))        # pieces longer than k
            total[:m] += values[rows[first[:m] + k]]
        parts[place[own]] = total
    return _sums(parts, place, target, n) if several else out


def singular_directions(encoded: DataFrame, idf: np.ndarray, wide: bool, rank: int = RANK,
                        seed: int = 5) -> np.ndarray:
    """Leading right singular vectors (columns x rank) of all passages' TF-IDF matrix."""
    columns = len(idf)
    rank = min(rank, columns)
    sketch = min(rank + OVERSAMPLE, columns)
    omega = np.linalg.qr(np.random.default_rng(seed).normal(size=(columns, sketch)))[0].astype(np.float32)
    spark = encoded.sparkSession
    table = spark.sparkContext.broadcast((idf, (omega * idf[:, None]).astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, rows = table.value
        total = np.zeros((columns, sketch), np.float64)
        for batch in batches:
            for docs, n_words, owner, place, words, block, first, *_ in _chunks(batch, wide):
                used = weight[_column(words)] > 0
                cols, block = _column(words)[used], block[used]
                passage = _sums(rows, cols, block, int(first[-1]))          # A omega, a passage a block
                total += _sums(passage, block, cols, columns) * weight[:, None]
        held = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array([total[c].tobytes() for c in held], pa.binary())], ["c", "y"])

    def add(t: pa.Table) -> pa.Table:
        rows = np.stack([np.frombuffer(y, np.float64) for y in t.column("y").to_pylist()])
        return pa.table({"c": t.column("c").slice(0, 1), "y": pa.array([rows.sum(axis=0).tobytes()], pa.binary())})

    y = np.zeros((columns, sketch))
    # one row of `sketch` numbers per column
    for r in encoded.mapInArrow(run, "c long, y binary").groupBy("c").applyInArrow(add, "c long, y binary").collect():
        y[r["c"]] = np.frombuffer(r["y"], np.float64)
    norm = np.linalg.norm(y)
    if not norm:
        return omega[:, :rank].astype(np.float64)
    shift = norm * 1e-7
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    half = vectors / np.sqrt(np.maximum(values, shift * 1e-3))
    return np.linalg.svd(y @ half, full_matrices=False)[0][:, :rank]


def lcs(masks: dict[int, int], length: int, sequence: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word in the item."""
    row, full = (1 << length) - 1, (1 << length) - 1
    for w in sequence:
        hit = masks.get(w, 0)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return length - row.bit_count()


def find_leaks(docs: DataFrame, benchmark: DataFrame, stop_share: float = 0.02, min_cosine: float = 0.3,
               min_lcs: float = 0.7, paraphrase_lcs: float = 0.5, answer_words: int = 4) -> DataFrame:
    """``(doc_id, item_id, begin, end, cosine, lcs, answer)``: the best place (in
    words) of each benchmark item in each document that holds it."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, begin long, `end` long, cosine double, lcs double, answer boolean"
    # the benchmark is the query set; its texts are what the driver holds
    items = read_items([(r[0], r[1]) for r in benchmark.select(F.col("item_id").cast("long"), "text")
                        .where("item_id is not null and text is not null").distinct().collect()])
    if not items.ids:
        return spark.createDataFrame([], schema)
    columns, wide = min(len(items.vocab), COLUMNS), len(items.vocab) >= 1 << 16
    grams = read_grams(items, min_lcs, answer_words)
    encoded = checkpointed(encode(docs.where(F.col("doc_id").isNotNull()), items, grams))
    df, passages = document_frequencies(encoded, columns, wide, grams)
    idf = np.log((1 + passages) / (1 + df))
    # a word of few passages counts whatever its share of a small corpus
    idf[(df > stop_share * passages) & (df > 50)] = 0
    directions = singular_directions(encoded, idf, wide)
    shared = spark.sparkContext.broadcast((items.ids, items.words, (directions * idf[:, None]).astype(np.float32), idf > 0))

    n_vocab = len(items.vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, item_words, table, used = shared.value
        queries = np.stack([table[_column(w)].sum(axis=0) for w in item_words])
        queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
        lengths = np.array([len(w) for w in item_words], np.int64)
        own_words = np.zeros(n_vocab, bool)     # of the item at hand
        masks: list[dict[int, int]] = []
        for w in item_words:
            own: dict[int, int] = {}
            for i, x in enumerate(w.tolist()):
                own[x] = own.get(x, 0) | 1 << i
            masks.append(own)
        for batch in batches:
            out = []
            for docs_, n_words, owner, place, words, block, first, starts, copied in _chunks(batch, wide):
                weighty = used[_column(words)]
                sums = _sums(table, _column(words)[weighty], block[weighty], int(first[-1]))
                windows = sums.copy()
                last = np.zeros(len(sums), bool)
                last[first[1:] - 1] = True
                windows[:-1][~last[:-1]] += sums[1:][~last[:-1]]
                size = np.linalg.norm(windows, axis=1)
                busy = np.flatnonzero(size > 0)
                found = [[], [], []]                    # windows, items, cosines
                for lo in range(0, len(queries), ITEM_BLOCK):
                    for wlo in range(0, len(busy), 1 << 14):
                        rows = busy[wlo:wlo + (1 << 14)]
                        near = (windows[rows] / size[rows, None]) @ queries[lo:lo + ITEM_BLOCK].T
                        i, q = np.nonzero(near >= min_cosine)
                        found[0].append(rows[i]), found[1].append(lo + q), found[2].append(near[i, q])
                near_by = len(windows) * np.concatenate([*found[1], copied[:0]]) + np.concatenate([*found[0], starts[:0]])
                alone = ~np.isin(len(windows) * copied.astype(np.int64) + starts, near_by)
                w, q = starts[alone], copied[alone]
                found[0].append(w), found[1].append(q)
                found[2].append(np.einsum("ij,ij->i", windows[w], queries[q]) / np.maximum(size[w], 1e-12))
                window, item, cosine = (np.concatenate(x) for x in found)
                order = np.lexsort((cosine < min_cosine, item))
                window, item, cosine = window[order], item[order], cosine[order].astype(np.float64)
                # the window and as much around it as the item may reach out
                doc = np.searchsorted(first, window, side="right") - 1
                start, length = (window - first[doc]) * BLOCK, lengths[item]
                far = max(n_words, default=0) + 1
                line = owner * far + place
                lows = np.searchsorted(line, doc * far + np.clip(start - length, 0, far - 1))
                highs = np.searchsorted(line, doc * far + np.clip(start + 2 * BLOCK + length, 0, far - 1))
                whole: set[tuple[int, int]] = set()
                before = -1
                for d, i, c, lo_at, hi_at in zip(*(x.tolist() for x in (doc, item, cosine, lows, highs))):
                    if i != before:
                        own_words[item_words[before] if before >= 0 else slice(0)] = False
                        own_words[item_words[i]] = True
                        before, n = i, len(item_words[i])
                    if c < min_cosine and (d, i) in whole:
                        continue        # at best the same share at a smaller cosine
                    got, at = words[lo_at:hi_at], place[lo_at:hi_at]
                    own = own_words[got]
                    if np.count_nonzero(own) / n < paraphrase_lcs:
                        continue
                    common = lcs(masks[i], n, got[own].tolist()) / n
                    if common < paraphrase_lcs:
                        continue
                    got = got.tolist()
                    tail = item_words[i].tolist()[-answer_words:]
                    answer = any(got[k:k + len(tail)] == tail and at[k + len(tail) - 1] - at[k] == len(tail) - 1
                                 for k in range(len(got) - len(tail) + 1))
                    if common == 1 and c >= min_cosine:
                        whole.add((d, i))
                    if common >= min_lcs or answer:
                        at = at[own]
                        out.append((docs_[d], ids[i], int(at[0]), int(at[-1]) + 1, c, common, answer))
                own_words[:] = False
            cols = list(zip(*out)) or [[]] * 7
            types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["doc_id", "item_id", "begin", "end", "cosine", "lcs", "answer"])

    hits = encoded.mapInArrow(run, schema)
    best = F.max(F.struct("lcs", "cosine", -F.col("begin"), "end", "answer")).alias("m")
    return hits.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("m.col3")).alias("begin"), "m.end", "m.cosine", "m.lcs", "m.answer")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    return without(docs, "doc_id", checkpointed(find_leaks(docs, benchmark, **options).select("doc_id").distinct()))

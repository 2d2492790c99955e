"""Hierarchical Pitman-Yor scores of texts.

Words are dishes.  A word is served in the restaurant of its context, the last
two bytes of the word before it (none at a text's start); restaurants whose
contexts end in the same byte share a parent, all of those share the root, and
the root's base is uniform over the known words and one unknown.  A table of a
restaurant is a customer of its parent (Chinese-restaurant seating).

1. Counting: tasks count (word, context) pairs of the training texts and send
   them in packs by a hash of the word; packs of many tasks are merged in a
   tree.  Every word of the corpus is counted, with the documents that hold it.
2. Seating: all pairs of a word lie in one pack, so seating a word needs only
   the restaurants' totals, arrays of fixed size (65,536 + 256 + 1).  A first
   pass seats all customers and sums the totals; a second seats them alike
   and sweeps by Gibbs: in every sweep all customers of every pair stand up
   and are seated anew, in one draw of their number of tables from its law
   given all other pairs (``Law``), and the pair's tables leave and join the
   parent.  Pairs are drawn together in ``TURNS`` turns a level, those of one
   turn see each other as they were before it; a pack sees the totals of the
   others as they were after the first pass.  Seatings after ``BURN`` sweeps
   are the samples.
3. Scoring: the predictive probability of a word in its context is averaged
   over the samples.  Words of the highest document frequency, as many as
   fit into ``HOT_BYTES``, are broadcast and scored where the text is read;
   all others are sent, packed, to their word's part of the model, and a
   document's sums are added up with those of the texts read beside it.

Contexts are two bytes and not whole words because pairs of words would have
to be dealt by both words, several times the text in shuffle.

Defined results: a null text is empty and holds its end alone; rows with null
``doc_id`` train the model; repeated rows count as often as they stand; without
training texts every probability is that of the base; an empty table has no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

#: strength of every restaurant
THETA = 1.0
BURN, SAMPLES = 8, 3
#: bytes of text behind one part of the model
SHARD_BYTES = 12 << 20
#: words of the model in one row
PACK_WORDS = 2048
#: bytes of text a task counts or sends at once (a longer text alone)
COUNT_BYTES, SEND_BYTES = 6 << 20, 3 << 20
#: packs of so many tasks are merged at once
FAN = 256
#: packed bytes of the words scored where the text is read
HOT_BYTES = 12 << 20
C1, C2 = 1 << 8, 1 << 16
#: pairs whose tables may take more numbers are looked through at so many nodes first
WIDE = 64
#: numbers weighed at once when tables are drawn
DRAW = 1 << 18
#: siblings are seated anew in so many turns
TURNS = 2


class _Ids(dict):
    """word -> number, given when first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _runs(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of ``lengths``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


@dataclass
class Tokens:
    """Words between ASCII white space, A-Z in lower case, then each text's end."""

    doc: np.ndarray      # per token: the text's number,
    word: np.ndarray     # the word's number in ``words`` (the last one is the end)
    context: np.ndarray  # and the last two bytes of the word before
    words: pa.Array

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        # taken anew: of a slice the split reads wrong offsets
        texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))).fill_null("")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        if not full.all():                      # white space at a text's ends leaves empty words
            n = np.bincount(np.repeat(np.arange(len(n)), n)[full], minlength=len(n))
            flat = flat.filter(pa.array(full))
        coded = flat.dictionary_encode()
        words = pa.concat_arrays([coded.dictionary, pa.array([""], pa.large_string())])
        doc = np.repeat(np.arange(len(n)), n + 1)
        ends = np.cumsum(n + 1) - 1
        word = np.full(len(doc), len(words) - 1)
        is_word = np.ones(len(doc), bool)
        is_word[ends] = False
        word[is_word] = coded.indices.to_numpy(zero_copy_only=False)
        raw = words.cast(pa.large_binary())
        stops = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"\0", np.uint8)
        size = np.diff(stops)
        suffix = np.zeros(len(words), np.int64)
        one, two = size > 0, size > 1
        suffix[one] = data[stops[1:][one] - 1]
        suffix[two] |= data[stops[1:][two] - 2].astype(np.int64) << 8
        context = np.zeros(len(doc), np.int64)
        context[1:] = suffix[word[:-1]]
        context[ends - n] = 0
        return Tokens(doc, word, context, words)

    def bytes_of(self, which: np.ndarray) -> list[bytes]:
        return self.words.take(pa.array(which)).cast(pa.large_binary()).to_pylist()


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text (column 0)."""
    for batch in batches:
        if batch.num_rows:
            n = pc.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(n) // size
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            for a, b in zip(cuts, cuts[1:]):
                yield batch.slice(a, b - a)


def _packed(values: np.ndarray | bytes, kind: str = "") -> bytes:
    """A cell: little-endian numbers of ``kind`` (or bytes), compressed."""
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values, kind).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _numbers(cell: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(_text(cell), kind)


def _text(cell: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(cell)


def _summed(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their number or summed weights."""
    if weights is None:
        keys, n = np.unique(keys, return_counts=True)
        return keys, n.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(weights[order], first) if len(keys) else np.zeros(0, np.int64))


# ------------------------------------------------------------------ counting

COUNTS = "shard int, src int, words binary, docs binary, pairs binary, u binary, c binary"


def _count_rows(words: list[bytes], docs: np.ndarray, keys: np.ndarray, n: np.ndarray, shards: int, src: int,
                ) -> pa.RecordBatch:
    """Packs by shard; ``keys``: word number and context, ascending."""
    shard = np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))
    order = np.argsort(shard, kind="stable")
    w, u = keys >> 16, (keys & 0xFFFF).astype("<u2")
    pairs = np.bincount(w, minlength=len(words))
    first = np.cumsum(pairs) - pairs
    ends = np.flatnonzero(np.r_[shard[order][1:] != shard[order][:-1], True]) + 1 if len(words) else []
    columns: list[list] = [[], [], [], [], [], [], []]
    a = 0
    for b in ends:
        for lo in range(a, b, PACK_WORDS):
            own = order[lo:min(lo + PACK_WORDS, b)]
            at = np.repeat(first[own], pairs[own]) + _runs(pairs[own])
            for column, value in zip(columns, (
                    int(shard[own[0]]), src, _packed(b" ".join([words[i] for i in own])), _packed(docs[own], "<u8"),
                    _packed(pairs[own], "<u4"), _packed(u[at], "<u2"), _packed(n[at], "<u8"))):
                column.append(value)
        a = b
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      [f.split()[0] for f in COUNTS.split(", ")])


def _counter(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src = TaskContext.get().partitionId()
        for batch in _chunks(batches, COUNT_BYTES):
            tokens = Tokens.of(batch.column(0))
            own = batch.column(1).to_numpy(zero_copy_only=False)[tokens.doc]
            n = len(tokens.words)
            held = np.unique(tokens.doc * n + tokens.word) % n
            keys, times = _summed(tokens.word[own] << 16 | tokens.context[own])
            yield _count_rows(tokens.bytes_of(np.arange(n)), np.bincount(held, minlength=n), keys, times, shards, src)
    return run


def _merged(packs: pa.Table, shards: int, src: int) -> pa.RecordBatch:
    ids, docs, keys, n = _Ids(), [], [], []
    for row in packs.to_pylist():
        at = np.fromiter(map(ids.__getitem__, _text(row["words"]).split(b" ")), np.int64)
        docs.append((at, _numbers(row["docs"], "<u8").astype(np.int64)))
        keys.append(np.repeat(at, _numbers(row["pairs"], "<u4")) << 16 | _numbers(row["u"], "<u2"))
        n.append(_numbers(row["c"], "<u8").astype(np.int64))
    total = np.zeros(len(ids), np.int64)
    for at, d in docs:
        np.add.at(total, at, d)
    return _count_rows(list(ids), total, *_summed(np.concatenate(keys), np.concatenate(n)), shards, src)


def counts(docs: DataFrame, trains: Column, shards: int, parts: int) -> DataFrame:
    """Packed counts, every word in one pack: documents that hold it and, of the training texts, its contexts."""
    packs = docs.select("text", trains.alias("trains")).mapInArrow(_counter(shards), COUNTS)

    def merge(packs: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_merged(packs, shards, packs["src"][0].as_py() // FAN)])

    while parts > FAN:
        packs = packs.groupBy("shard", F.expr(f"src div {FAN}")).applyInArrow(merge, COUNTS)
        parts = -(-parts // FAN)
    return packs.groupBy("shard").applyInArrow(merge, COUNTS)


# ------------------------------------------------------------------- seating

@dataclass
class Totals:
    """What all words share: per level (root, last byte, two bytes) the
    discount and, per restaurant, its customers and tables."""

    tokens: int
    words: int
    discount: tuple[float, float, float]
    customers: list[np.ndarray]
    tables: list[np.ndarray]

    @property
    def base(self) -> float:
        return 1.0 / (self.words + 1)


def _tables_below(d: float, c: int, row: np.ndarray, until: int) -> Iterator[tuple[int, np.ndarray]]:
    """``S(n, t-1) / S(n, t)`` for t = 0 .. n, n from ``c`` (whose row is given) to ``until``."""
    while True:
        yield c, row
        if c == until:
            return
        gain = c - d * np.arange(1, c + 1) + row[1:]         # S(c+1, t) / S(c, t)
        row = np.concatenate([[0.0, 0.0], row[2:] * gain[:-1] / gain[1:], [row[c] + c * (1 - d)]])
        c += 1


class Law:
    """The law of the tables of c customers of one word at discount ``d``.

    With all else given, P(t) is in proportion to S(c, t) and the weights of t
    tables; S are generalized Stirling numbers, S(c+1, t) = S(c, t-1) + (c - d t)
    S(c, t).  Up to ``EXACT`` customers their ratios stand in a table.  Beyond,
    they are those of the saddle point, d (t - k) / (1 - y^d) where tables of
    mean size c / t have parameter y; the small shift k is read from exact rows
    of up to ``ROWS[-1]`` customers.  At discounts from 0.5 up the ratios are right
    to 0.1 %, at 0.1, the least, to 3 % where 8 tables hold 16,384 customers.
    """

    EXACT = 512
    ROWS = (512, 1024, 2048, 4096, 8192)

    def __init__(self, d: float):
        self.d = d
        self.table = np.zeros((self.EXACT + 1, self.EXACT + 1))
        log_y = -np.exp(np.linspace(np.log(300), -12, 8000))
        rest = -np.expm1(d * log_y)
        self.log_share, self.slope = np.log(rest / (d * -np.expm1(log_y))) + (1 - d) * log_y, d / rest
        self.shifts = []
        for c, row in _tables_below(d, 1, np.zeros(2), self.ROWS[-1]):
            if c <= self.EXACT:
                self.table[c, :c + 1] = row
            if c in self.ROWS:
                t = np.arange(1, c + 1)
                self.shifts.append(t - row[1:] / self._slope(t / c))
        self.crowd = row

    def _slope(self, share: np.ndarray) -> np.ndarray:
        return np.interp(np.log(share), self.log_share, self.slope)

    def _shift(self, row: int, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        k, scale = self.shifts[row], self.ROWS[row] / c
        at = np.arange(1, len(k) + 1)
        # few tables go with c^d, many with c
        few = np.where(t * scale ** self.d < len(k) / 2, 1 / (1 + (t / c ** self.d) ** 4), 0.0)
        return few * np.interp(t * scale ** self.d, at, k) + (1 - few) * np.interp(t * scale, at, k)

    def below(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """``S(c, t-1) / S(c, t)``, 1 <= t <= c."""
        out = self.table[np.minimum(c, self.EXACT), np.minimum(t, self.EXACT)]
        big = np.flatnonzero(c > self.EXACT)
        if len(big):
            c, t = c[big].astype(float), t[big].astype(float)
            row = np.log2(np.minimum(c / self.ROWS[0], self.ROWS[-1] / self.ROWS[0]))
            at, shift = np.minimum(row.astype(np.int64), len(self.ROWS) - 2), np.empty(len(c))
            for i in np.unique(at):
                own = np.flatnonzero(at == i)
                low, high = (self._shift(j, c[own], t[own]) for j in (i, i + 1))
                shift[own] = low + (row[own] - i) * (high - low)
            out[big] = np.where(t > 1, self._slope(t / c) * (t - shift), 0.0)
            alone = np.flatnonzero(t > .95 * c)             # hardly two at a table: c^2 over those not at a table's head
            out[big[alone]] = self._alone(c[alone], t[alone])
        return out

    def _alone(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        row = self.ROWS[-1]
        at = np.arange(row * 9 // 10, row + 1)
        return np.interp(t * (row / c), at, self.crowd[at] * (row - at + 1)) * (c / row) ** 2 / (c - t + 1)


@lru_cache(maxsize=8)
def law(d: float) -> Law:
    return Law(d)


def _drawn(step: Callable, i: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """For each ``i`` one of ``low`` .. ``high``; ``step(i, t)`` is log P(t) - log P(t-1)."""
    out = np.empty(len(i), np.int64)
    size = high - low + 1
    part = np.cumsum(size) // DRAW
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(i) else []
    for a, b in zip(cuts, cuts[1:]):
        n = size[a:b]
        start = np.cumsum(n) - n
        t = np.repeat(low[a:b], n) + _runs(n)
        t[start] += 1                                  # of the least no step is asked
        log_p = step(np.repeat(i[a:b], n), t)
        log_p[start] = 0.0
        t[start] -= 1
        log_p = np.cumsum(log_p)
        p = np.cumsum(np.exp(log_p - np.repeat(np.maximum.reduceat(log_p, start), n)))
        before = np.r_[0.0, p[start[1:] - 1]]
        at = np.searchsorted(p, before + rng.random(b - a) * (p[start + n - 1] - before), "right")
        out[a:b] = t[np.clip(at, start, start + n - 1)]
    return out


def draw_tables(c: np.ndarray, least: np.ndarray, seating: Law, weight: Callable, rng: np.random.Generator) -> np.ndarray:
    """All ``c`` customers of every pair are seated anew at once: their tables, ``least`` or more, under the exact law.

    ``weight(i, t)``: log weight of pair ``i``'s ``t``-th table, beyond the least."""
    def step(i: np.ndarray, t: np.ndarray) -> np.ndarray:
        return weight(i, t) - np.log(np.maximum(seating.below(c[i], t), 1e-300))

    out = np.minimum(c, np.maximum(least, 1))
    low, high = out.copy(), c.copy()
    wide = np.flatnonzero(high - low > WIDE)
    if len(wide):
        # where P is not below e^-40 of its largest, seen at nodes that lie closer at the low end
        nodes = low[wide, None] + np.expm1(np.log1p(high - low)[wide, None] * np.linspace(0, 1, WIDE)).round().astype(np.int64)
        nodes[:, -1] = high[wide]
        grown = step(np.repeat(wide, WIDE), np.maximum(nodes, low[wide, None] + 1).ravel()).reshape(nodes.shape)
        log_p = np.cumsum(np.c_[np.zeros(len(wide)), (grown[:, 1:] + grown[:, :-1]) / 2 * np.diff(nodes)], axis=1)
        held = log_p >= log_p.max(axis=1, keepdims=True) - 40
        first, last = held.argmax(axis=1), WIDE - 1 - held[:, ::-1].argmax(axis=1)
        at = np.arange(len(wide))
        low[wide], high[wide] = nodes[at, np.maximum(first - 1, 0)], nodes[at, np.minimum(last + 1, WIDE - 1)]
    free = np.flatnonzero(high > low)
    out[free] = _drawn(step, free, low[free], high[free], rng)
    return out


class Level:
    """The tables of many (restaurant, word) pairs of one level.

    Scores need their numbers alone, and ``draw_tables`` draws these.  ``remove``
    and ``add`` move single customers between seats, laid out when first asked
    for: each pair has ``room`` slots from ``first``; a slot of size 0 is free."""

    size: np.ndarray | None = None

    def __init__(self, c: np.ndarray, u: np.ndarray, up: np.ndarray, t: np.ndarray, d: float, rng: np.random.Generator):
        self.c, self.u, self.up, self.t, self.d, self.rng = c, u, up, t, d, rng

    def _lay_out(self) -> None:
        c, t, d, rng = self.c, self.t, self.d, self.rng
        self.room = np.where(c > 1, t + 1 + t // 2, 1)
        self.first = np.cumsum(self.room) - self.room
        self.size = np.zeros(int(self.room.sum()), np.int64)
        # c customers at t tables: one each, the rest in random shares
        slot = np.repeat(self.first, t) + _runs(t)
        pair = np.repeat(np.arange(len(c)), t)
        share = rng.gamma(1 - d, size=len(slot)) + 1e-300
        upto = np.cumsum(share)
        start = np.r_[0.0, upto][np.cumsum(t) - t] if len(t) else upto
        whole = np.add.reduceat(share, np.cumsum(t)[t > 0] - t[t > 0]) if len(slot) else share
        spread = np.zeros(len(c))
        spread[t > 0] = whole
        got = np.floor((upto - start[pair]) / spread[pair] * (c - t)[pair] + 0.5).astype(np.int64)
        last = np.cumsum(t)[t > 0] - 1
        got[last] = (c - t)[t > 0]
        before = np.r_[0, got[:-1]] if len(got) else got
        before[np.cumsum(t)[t > 0] - t[t > 0]] = 0
        self.size[slot] = 1 + got - before

    def _slots(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        room = self.room[pairs]
        slots = np.repeat(self.first[pairs], room) + _runs(room)
        return slots, self.size[slots], np.cumsum(room) - room

    def remove(self, pairs: np.ndarray) -> np.ndarray:
        """One random customer leaves each of the (distinct) pairs; where a table closed."""
        if self.size is None:
            self._lay_out()
        slots, size, start = self._slots(pairs)
        upto = np.cumsum(size)
        before = upto[start] - size[start]
        at = np.searchsorted(upto, before + (self.rng.random(len(pairs)) * self.c[pairs]).astype(np.int64), "right")
        chosen = slots[at]
        self.size[chosen] -= 1
        closed = self.size[chosen] == 0
        self.c[pairs] -= 1
        self.t[pairs[closed]] -= 1
        return closed

    def add(self, pairs: np.ndarray, new: np.ndarray) -> np.ndarray:
        """One customer joins each of the (distinct) pairs, a new table with weight ``new``; where one opened."""
        old = self.c[pairs] - self.d * self.t[pairs]
        x = self.rng.random(len(pairs)) * (old + new)
        opened = (x >= old) | (self.c[pairs] == 0)
        self._make_room(pairs[opened])
        slots, size, start = self._slots(pairs)
        weight = np.where(size > 0, size - self.d, 0.0)
        upto = np.cumsum(weight)
        at = np.searchsorted(upto, upto[start] - weight[start] + np.minimum(x, old * (1 - 1e-9)), "right")
        end = start + self.room[pairs]
        at = np.clip(at, start, end - 1)
        free = np.minimum.reduceat(np.where(size == 0, np.arange(len(size)), len(size)), start)
        at[opened] = free[opened]
        for i in np.flatnonzero((size[at] == 0) & ~opened):         # a rounded sum met a free slot
            at[i] = start[i] + np.flatnonzero(size[start[i]:end[i]])[0]
        self.size[slots[at]] += 1
        self.c[pairs] += 1
        self.t[pairs[opened]] += 1
        return opened

    def _make_room(self, pairs: np.ndarray) -> None:
        full = pairs[self.t[pairs] >= self.room[pairs]]
        if not len(full):
            return
        room = self.room.copy()
        room[full] += room[full] // 2 + 1
        first = np.cumsum(room) - room
        size = np.zeros(int(room.sum()), np.int64)
        size[np.repeat(first, self.room) + _runs(self.room)] = self.size
        self.room, self.first, self.size = room, first, size


def _first_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``c`` customers, all seated, where the word's base is ``p`` and the restaurant has ``others``' tables."""
    out = np.minimum(c, 1)
    pairs = np.flatnonzero(c > 1)
    out[pairs] = draw_tables(c[pairs], out[pairs], law(d), lambda i, t: np.log(
        (THETA + d * (others[pairs[i]] + t - 1)) * p[pairs[i]]), rng)
    return out


class Seating:
    """Seated customers of the words of one pack, at three levels."""

    def __init__(self, pairs: np.ndarray, u: np.ndarray, c: np.ndarray, totals: Totals, seed: int):
        rng = np.random.default_rng(seed)
        w = np.repeat(np.arange(len(pairs)), pairs)
        self.n = np.bincount(w, c, len(pairs)).astype(np.int64)
        p = self.n / max(totals.tokens, 1)
        d = totals.discount
        # the totals hold one table of every pair
        t2 = _first_tables(c, totals.tables[2][u] - 1, p[w], d[2], rng)
        key1, up2 = np.unique(w << 8 | (u & 255), return_inverse=True)
        w1, u1 = key1 >> 8, key1 & 255
        c1 = np.bincount(up2, t2, len(key1)).astype(np.int64)
        t1 = _first_tables(c1, totals.tables[1][u1] - 1, p[w1], d[1], rng)
        c0 = np.bincount(w1, t1, len(pairs)).astype(np.int64)
        root = np.zeros(len(pairs), np.int64)
        t0 = _first_tables(c0, totals.tables[0][root] - 1, np.full(len(pairs), totals.base), d[0], rng)
        self.levels = [Level(c0, root, root, t0, d[0], rng), Level(c1, u1, w1, t1, d[1], rng),
                       Level(c.copy(), u, up2, t2, d[2], rng)]
        # siblings in turns: those of one turn see the others' new tables
        self.turns = [self._turns(own.up) if k else root for k, own in enumerate(self.levels)]
        self.base = totals.base

    @staticmethod
    def _turns(up: np.ndarray) -> np.ndarray:
        out = np.empty(len(up), np.int64)
        out[np.argsort(up, kind="stable")] = _runs(np.bincount(up)) % TURNS if len(up) else 0
        return out

    def sweep(self, totals: Totals) -> None:
        """Every customer of every pair is seated anew, given the other pairs' tables; ``totals`` (of all packs)
        follow the own changes."""
        for level in (2, 1, 0):
            own = self.levels[level]
            for turn in range(TURNS):
                pairs = np.flatnonzero((own.c > 1) & (self.turns[level] == turn))
                if len(pairs):
                    weight, least = self._weight(level, pairs, totals)
                    self._set(level, pairs, draw_tables(own.c[pairs], least, law(own.d), weight, own.rng), totals)

    def _weight(self, level: int, pairs: np.ndarray, totals: Totals) -> tuple[Callable, np.ndarray]:
        """``weight`` and ``least`` of ``draw_tables``: a table opened is a customer that joins the parent's tables."""
        own = self.levels[level]
        d, others = own.d, totals.tables[level][own.u[pairs]] - own.t[pairs]
        if not level:
            return lambda i, t: np.log((THETA + d * (others[i] + t - 1)) * self.base), np.ones(len(pairs), np.int64)
        parent, up = self.levels[level - 1], own.up[pairs]
        siblings, tables = parent.c[up] - own.t[pairs], parent.t[up]
        customers = totals.customers[level - 1][parent.u[up]] - own.t[pairs]

        def weight(i: np.ndarray, t: np.ndarray) -> np.ndarray:
            before = siblings[i] + t - 1
            joins = before - parent.d * tables[i] + law(parent.d).below(before, tables[i])
            return np.log((THETA + d * (others[i] + t - 1)) * joins / (THETA + customers[i] + t - 1))

        return weight, np.maximum(tables - siblings, 1)

    def _set(self, level: int, pairs: np.ndarray, t: np.ndarray, totals: Totals) -> None:
        """The (distinct) pairs get ``t`` tables, the customers of their parents follow."""
        own = self.levels[level]
        change, own.t[pairs] = t - own.t[pairs], t

        def add(to: np.ndarray, at: np.ndarray) -> None:
            to += np.bincount(at, change, len(to)).astype(np.int64)

        add(totals.tables[level], own.u[pairs])
        if level:
            parent = self.levels[level - 1]
            add(parent.c, own.up[pairs])
            add(totals.customers[level - 1], parent.u[own.up[pairs]])
            over = np.flatnonzero(parent.t > parent.c)       # siblings of one turn left fewer customers than tables
            if len(over):
                self._set(level - 1, over, parent.c[over], totals)


def _fresh(totals: Totals) -> Totals:
    return Totals(totals.tokens, totals.words, totals.discount, [a.copy() for a in totals.customers],
                  [a.copy() for a in totals.tables])


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (_numbers(row["pairs"], "<u4").astype(np.int64), _numbers(row["u"], "<u2").astype(np.int64),
            _numbers(row["c"], "<u8").astype(np.int64))


SUMS = "sample int, level int, u int, customers long, tables long, once long, twice long, words long"


def _sum_rows(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    """``(sample, level)`` -> array of (restaurants, 5)."""
    parts = []
    for (sample, level), a in sums.items():
        u = np.flatnonzero(a.any(axis=1))
        parts.append(np.column_stack([np.full(len(u), sample), np.full(len(u), level), u, a[u]]).astype(np.int64))
    flat = np.concatenate(parts) if parts else np.zeros((0, 8), np.int64)
    names = [f.split()[0] for f in SUMS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(flat[:, i], pa.int32() if i < 3 else pa.int64()) for i in range(8)], names)


def _tally(sums: dict, sample: int, level: int, own_u: np.ndarray, c: np.ndarray, t: np.ndarray) -> None:
    n = (1, C1, C2)[level]
    a = sums.setdefault((sample, level), np.zeros((n, 5)))
    for i, weight in enumerate((c, t, c == 1, c == 2, c > 0)):
        a[:, i] += np.bincount(own_u, weight, n)


def _collected(sums: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Summed over all tasks: at most 65,793 restaurants a sample come to the driver."""
    total = sums.groupBy("sample", "level", "u").agg(*[F.sum(f.split()[0]).cast("long").alias(f.split()[0])
                                                       for f in SUMS.split(", ")[3:]]).toArrow()
    cols = [total[f.split()[0]].to_numpy() for f in SUMS.split(", ")]
    out = {}
    for sample in np.unique(cols[0]):
        for level in range(3):
            a = np.zeros(((1, C1, C2)[level], 5), np.int64)
            own = (cols[0] == sample) & (cols[1] == level)
            a[cols[2][own]] = np.column_stack([c[own] for c in cols[3:]])
            out[int(sample), level] = a
    return out


def _discount(once: int, twice: int) -> float:
    """Absolute discounting's estimate from how many dishes were taken once and twice."""
    return float(min(max(once / (once + 2 * twice), 0.1), 0.95)) if once else 0.1


def _count_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            pairs, u, c = _unpacked(row)
            w = np.repeat(np.arange(len(pairs)), pairs)
            one = np.ones(len(u), np.int64)
            _tally(sums, 0, 2, u, c, one)
            key1 = np.unique(w << 8 | (u & 255))
            _tally(sums, 0, 1, key1 & 255, np.ones(len(key1), np.int64), np.ones(len(key1), np.int64))
            known = np.flatnonzero(pairs)
            _tally(sums, 0, 0, known * 0, np.ones(len(known), np.int64), np.ones(len(known), np.int64))
    yield _sum_rows(sums)


def _seats(row: dict, totals: Totals) -> Seating:
    return Seating(*_unpacked(row), totals, zlib.crc32(_text(row["words"])))


def _first_sums(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                for level, own in enumerate(_seats(row, shared.value).levels):
                    _tally(sums, 0, level, own.u, own.c, own.t)
        yield _sum_rows(sums)
    return run


MODEL = ("shard int, words binary, docs binary, n binary, pairs binary, u binary, c binary, t2 binary, "
         "pairs1 binary, u1 binary, c1 binary, t1 binary, c0 binary, t0 binary")


#: the numbers of a model row, in the order of ``MODEL``
KINDS = {"docs": "<u8", "n": "<u8", "pairs": "<u4", "u": "<u2", "c": "<u8", "t2": "<u4", "pairs1": "<u4", "u1": "<u1",
         "c1": "<u4", "t1": "<u4", "c0": "<u4", "t0": "<u4"}


def _sampler(guess, seated):
    """Packs with the seatings of ``SAMPLES`` sweeps after ``BURN``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MODEL.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                seating = _seats(row, guess.value)
                totals = _fresh(seated.value)
                for own, d in zip(seating.levels, totals.discount):
                    own.d = d
                kept = []
                for turn in range(BURN + SAMPLES):
                    seating.sweep(totals)
                    if turn >= BURN:
                        kept.append([(own.c.copy(), own.t.copy()) for own in seating.levels])
                own1 = seating.levels[1]

                def many(level: int, what: int) -> bytes:
                    return _packed(np.stack([k[level][what] for k in kept]), "<u4")

                values = {"shard": row["shard"], "words": row["words"], "docs": row["docs"],
                          "n": _packed(seating.n, "<u8"), "pairs": row["pairs"], "u": row["u"], "c": row["c"],
                          "t2": many(2, 1), "pairs1": _packed(np.bincount(own1.up, minlength=len(seating.n)), "<u4"),
                          "u1": _packed(own1.u, "<u1"), "c1": many(1, 0), "t1": many(1, 1), "c0": many(0, 0),
                          "t0": many(0, 1)}
                yield pa.RecordBatch.from_pylist([values], pa.schema(
                    [(n, pa.int32() if n == "shard" else pa.binary()) for n in names]))
    return run


class Words:
    """Model rows, unpacked for look-ups."""

    def __init__(self, rows: list[dict]):
        def joined(name: str, kind: str) -> np.ndarray:
            return np.concatenate([_numbers(r[name], kind) for r in rows] or [np.zeros(0, kind)])

        def sampled(name: str) -> np.ndarray:
            parts = [_numbers(r[name], "<u4").reshape(SAMPLES, -1) for r in rows]
            return np.concatenate(parts or [np.zeros((SAMPLES, 0), "<u4")], axis=1)

        self.words = [w for r in rows for w in _text(r["words"]).split(b" ")]
        self.docs, self.n = joined("docs", "<u8").astype(np.int64), joined("n", "<u8").astype(np.int64)
        self.pairs, self.u, self.c = joined("pairs", "<u4"), joined("u", "<u2"), joined("c", "<u8").astype(np.int64)
        self.pairs1, self.u1 = joined("pairs1", "<u4"), joined("u1", "<u1")
        self.t2, self.c1, self.t1, self.c0, self.t0 = map(sampled, ("t2", "c1", "t1", "c0", "t0"))

    def only(self, keep: np.ndarray) -> Words:
        out = object.__new__(Words)
        at2, at1 = np.repeat(keep, self.pairs), np.repeat(keep, self.pairs1)
        out.words = [w for w, k in zip(self.words, keep) if k]
        for name in ("docs", "n", "pairs", "pairs1"):
            setattr(out, name, getattr(self, name)[keep])
        out.u, out.c, out.t2 = self.u[at2], self.c[at2], self.t2[:, at2]
        out.u1, out.c1, out.t1 = self.u1[at1], self.c1[:, at1], self.t1[:, at1]
        out.c0, out.t0 = self.c0[:, keep], self.t0[:, keep]
        return out

    def ready(self) -> Words:
        """With the dictionary and the sorted keys that look-ups need."""
        self.ids = dict(zip(self.words, range(len(self.words))))
        self.key2 = np.repeat(np.arange(len(self.n)), self.pairs) << 16 | self.u
        self.key1 = np.repeat(np.arange(len(self.n)), self.pairs1) << 8 | self.u1
        return self

    def probability(self, w: np.ndarray, u: np.ndarray, samples: list[Totals]) -> np.ndarray:
        """Of word number ``w`` (-1: unknown) in context ``u``, averaged over the samples."""
        def found(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(keys):
                return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return at, keys[at] == key

        u1 = u & 255
        at0, in0 = np.maximum(w, 0), (w >= 0) & (len(self.n) > 0)
        at1, in1 = found(self.key1, w << 8 | u1)
        at2, in2 = found(self.key2, w << 16 | u)
        total = np.zeros(len(w))
        for s, sample in enumerate(samples):
            p = np.full(len(w), sample.base)
            for level, (c, t, at, here, r) in enumerate((
                    (self.c0[s], self.t0[s], at0, in0, np.zeros(len(w), np.int64)), (self.c1[s], self.t1[s], at1, in1, u1),
                    (self.c, self.t2[s], at2, in2, u))):
                d = sample.discount[level]
                own = np.zeros(len(w))
                own[here] = c[at[here]] - d * t[at[here]]
                p = (own + (THETA + d * sample.tables[level][r]) * p) / (THETA + sample.customers[level][r])
            total += p
        return total / len(samples)


def _model_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            part = Words([row])
            for s in range(SAMPLES):
                _tally(sums, s, 2, part.u.astype(np.int64), part.c, part.t2[s])
                _tally(sums, s, 1, part.u1.astype(np.int64), part.c1[s], part.t1[s])
                _tally(sums, s, 0, np.zeros(len(part.n), np.int64), part.c0[s], part.t0[s])
    yield _sum_rows(sums)


@dataclass
class Model:
    """Packed words with their seatings, and the restaurants' totals of each sample."""

    words: DataFrame
    samples: list[Totals]
    shards: int


def train(docs: DataFrame, trains: Column, shard_bytes: int = SHARD_BYTES) -> Model:
    """The model of the texts of ``docs`` where ``trains`` holds."""
    spark = docs.sparkSession
    size, parts = (docs.select(F.octet_length("text").alias("size"), F.spark_partition_id().alias("part"))
                   .agg(F.sum("size"), F.max("part")).first())
    shards = max(1, -(-(size or 0) // shard_bytes))
    packs = stored(counts(docs, trains, shards, (parts or 0) + 1))

    sums = _collected(packs.mapInArrow(_count_sums, SUMS)) or {(0, k): np.zeros(((1, C1, C2)[k], 5), np.int64) for k in range(3)}
    tokens, words = int(sums[0, 2][:, 0].sum()), int(sums[0, 0][:, 0].sum())
    d = _discount(int(sums[0, 2][:, 2].sum()), int(sums[0, 2][:, 3].sum()))

    def totals(a: dict, sample: int, discount: tuple) -> Totals:
        return Totals(tokens, words, discount, [a[sample, k][:, 0].copy() for k in range(3)],
                      [a[sample, k][:, 1].copy() for k in range(3)])

    guess = totals(sums, 0, (d, d, d))
    if not tokens:
        return Model(packs.limit(0).mapInArrow(lambda b: iter(()), MODEL), [guess], shards)
    shared = spark.sparkContext.broadcast(guess)
    sums = _collected(packs.mapInArrow(_first_sums(shared), SUMS))
    fitted = tuple(_discount(int(sums[0, k][:, 2].sum()), int(sums[0, k][:, 3].sum())) for k in range(3))
    seated = spark.sparkContext.broadcast(totals(sums, 0, fitted))
    model = stored(packs.mapInArrow(_sampler(shared, seated), MODEL))
    sums = _collected(model.mapInArrow(_model_sums, SUMS))
    return Model(model, [totals(sums, s, fitted) for s in range(SAMPLES)], shards)


# ------------------------------------------------------------------- scoring

def hot_words(model: Model, limit: int) -> Words:
    """The words in most documents whose packed rows take at most ``limit`` bytes."""
    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Words([row])
                k = (np.log2(np.maximum(part.docs, 1)) * 8).astype(np.int64)
                size = (np.fromiter(map(len, part.words), np.int64) + 40 + part.pairs * (10 + 4 * SAMPLES)
                        + part.pairs1 * (1 + 8 * SAMPLES) + 8 * SAMPLES)
                total = np.bincount(k, size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["k", "bytes"])

    left, least = limit, None
    # some 500 levels at most
    for r in sorted(model.words.mapInArrow(levels, "k int, bytes long").groupBy("k").agg(F.sum("bytes").alias("b")).collect(),
                    key=lambda r: -r["k"]):
        left -= r["b"]
        if left < 0:
            break
        least = r["k"]
    if least is None:
        return Words([])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Words([row])
                k = (np.log2(np.maximum(part.docs, 1)) * 8).astype(np.int64)
                if (k >= least).any():
                    hot = part.only(k >= least)
                    values = {"words": _packed(b" ".join(hot.words))}
                    for name, kind in KINDS.items():
                        values[name] = _packed(getattr(hot, name), kind)
                    yield pa.RecordBatch.from_pylist([values], pa.schema([(n, pa.binary()) for n in values]))

    kept = ", ".join(MODEL.split(", ")[1:])
    return Words([r.asDict() for r in model.words.mapInArrow(chosen, kept).collect()])


PARTS = "shard int, chunk long, docs binary, ids binary, flags binary, tokens binary, known binary, base binary, score binary, " \
        "words binary, runs binary, w binary, u binary, times binary"
SUMMED = ", ".join(PARTS.split(", ")[1:9])
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _cells(names: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in names.split(", ")])


def _sender(hot, samples, shards: int):
    """Texts as packs: a pack of rows with what their hot words give, and per shard the other words' places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value.ready()
        known_words = pa.array(known.words, pa.binary()).cast(pa.large_binary())
        totals = samples.value
        task = TaskContext.get().partitionId()
        chunk = task << 36
        schema = _cells(PARTS)
        for batch in _chunks(batches, SEND_BYTES):
            chunk += 1
            tokens = Tokens.of(batch.column(0))
            pair, at = np.unique(tokens.word << 16 | tokens.context, return_inverse=True)
            keys, times = np.unique(tokens.doc * len(pair) + at, return_counts=True)
            doc, at = np.divmod(keys, len(pair))
            w, u = pair[at] >> 16, pair[at] & 0xFFFF
            at = pc.index_in(tokens.words.cast(pa.large_binary()), value_set=known_words).fill_null(-1).to_numpy().astype(np.int64)
            mine = at[w] >= 0
            sums = _summed_scores(known, at[w[mine]], u[mine], times[mine], doc[mine], batch.num_rows, totals)
            n_tokens = np.bincount(doc, times, batch.num_rows)
            ids = batch.column(1)
            flags = (ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
                     | batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8) << 1)
            out = [{"shard": chunk % shards, "chunk": chunk, "docs": _packed(np.arange(batch.num_rows), "<u4"),
                    "ids": _packed(ids.fill_null(0).to_numpy(), "<i8"), "flags": _packed(flags, "<u1"),
                    "tokens": _packed(n_tokens, "<u8"), **_sums_of(sums)}]
            other = ~mine
            doc, w, u, times = doc[other], w[other], u[other], times[other]
            sent = np.flatnonzero(at < 0)
            names = dict(zip(sent.tolist(), tokens.bytes_of(sent)))
            shard_of = np.zeros(len(at), np.int64)
            shard_of[sent] = np.fromiter(map(zlib.crc32, names.values()), np.int64, len(sent)) % shards
            shard = shard_of[w]
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1], True]) if len(order) else [0]
            for a, b in zip(cuts, cuts[1:]):
                own = order[a:b]
                local, place = np.unique(w[own], return_inverse=True)
                in_docs, runs = np.unique(doc[own], return_counts=True)
                out.append({"shard": int(shard[own[0]]), "chunk": chunk, "docs": _packed(in_docs, "<u4"),
                            "words": _packed(b" ".join([names[i] for i in local.tolist()])), "runs": _packed(runs, "<u4"),
                            "w": _packed(place, "<u4"), "u": _packed(u[own], "<u2"), "times": _packed(times[own], "<u4")})
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _sums_of(sums: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[str, bytes]:
    known, base, score = sums
    return {"known": _packed(known, "<u8"), "base": _packed(base, "<f8"), "score": _packed(score, "<f8")}


def _summed_scores(words: Words, w: np.ndarray, u: np.ndarray, times: np.ndarray, doc: np.ndarray, n: int,
                   totals: list[Totals]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: tokens known, base score, score."""
    count = np.zeros(len(w))
    here = w >= 0
    count[here] = words.n[w[here]]
    t = totals[0]
    base = np.log10((count + 0.5) / (t.tokens + 0.5 * (t.words + 1)))
    score = np.log10(words.probability(w, u, totals))
    return (np.bincount(doc, times * (count > 0), n), np.bincount(doc, times * base, n), np.bincount(doc, times * score, n))


def _receiver(samples):
    """Places of a shard's words become sums by document; packs of rows go through."""
    def run(packs: pa.Table, model: pa.Table) -> pa.Table:
        words = Words(model.to_pylist()).ready()
        schema = _cells(SUMMED)
        out = []
        for batch in packs.to_batches():
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["words"] is not None:
                    doc = _numbers(row["runs"], "<u4")
                    n = len(doc)
                    names = _text(row["words"]).split(b" ")
                    at = np.fromiter((words.ids.get(x, -1) for x in names), np.int64, len(names))
                    row.update(_sums_of(_summed_scores(
                        words, at[_numbers(row["w"], "<u4")], _numbers(row["u"], "<u2").astype(np.int64),
                        _numbers(row["times"], "<u4").astype(np.int64), np.repeat(np.arange(n), doc), n, samples.value)))
                out.append({n: row[n] for n in schema.names})
        return pa.Table.from_pylist(out, schema)
    return run


def _add_up(packs: pa.Table) -> pa.Table:
    """The rows of one chunk from its sums over all shards."""
    rows = packs.to_pylist()
    own = next(r for r in rows if r["tokens"] is not None)
    n = len(_numbers(own["docs"], "<u4"))
    known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for r in rows:
        docs = _numbers(r["docs"], "<u4")
        known[docs] += _numbers(r["known"], "<u8").astype(np.int64)
        base[docs] += _numbers(r["base"], "<f8")
        score[docs] += _numbers(r["score"], "<f8")
    flags = _numbers(own["flags"], "<u1")
    return pa.table([pa.array(_numbers(own["ids"], "<i8"), mask=(flags & 1) == 0), pa.array((flags & 2) > 0),
                     pa.array(_numbers(own["tokens"], "<u8").astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)],
                    schema=_cells(SCORED))


def score(docs: DataFrame, held_out: Column, model: Model, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens, ``base_score``, ``score`` (log10) and ``perplexity``."""
    spark = docs.sparkSession
    # at most hot_bytes packed, and 65,793 restaurants a sample
    hot = spark.sparkContext.broadcast(hot_words(model, hot_bytes))
    samples = spark.sparkContext.broadcast(model.samples)
    packs = docs.select("text", F.col("doc_id").cast("long"), held_out.alias("held_out")).mapInArrow(
        _sender(hot, samples, model.shards), PARTS)
    parts = packs.groupBy("shard").cogroup(model.words.groupBy("shard")).applyInArrow(_receiver(samples), SUMMED)
    rows = parts.groupBy("chunk").applyInArrow(_add_up, SCORED)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.samples[0].tokens).cast("long").alias("train_tokens"),
                       "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def remainder(doc_id: Column, by: int) -> Column:
    """CRC-32 of the id as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % by, F.lit(0))

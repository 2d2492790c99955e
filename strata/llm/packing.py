"""Packing documents into windows by the sum-of-squares rule.

Each Spark partition streams its documents once: a document's ids (its
tokens, then the end id) fill whole windows first; the rest of ``r`` ids goes
to the fill level that makes the sum over levels of (open windows at that
level) squared least, kept in one array of counts by level.  Nothing is
shuffled or collected, and a lost task repeats only its own partition.

What is still open when the partition ends is placed by the same rule, the
emptiest window as a document of its fill; one that fits behind no other is
cut, its first part filling the fullest window.  The last remainder is cut by
its binary digits: a window filled to a power of two needs no padding.

Token ids: Latin text goes, whole, through the rank file of the same
vocabulary.  Any other text is cut before single spaces, where the byte-level
pre-tokenizer always cuts too, and each distinct piece is encoded once per
worker, Latin ones by the rank file, others (and a text with two spaces in a
row) by the tokenizer file itself.

Defined results: a null text is empty and gives the end id alone; repeated
rows and null ids are packed like any other; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a worker's cache of encoded pieces is emptied beyond this many
CACHE = 1_000_000
_PLAIN = re.compile(r"[\t-\r -~\xa0-ɏ]*\Z")


class _Pieces(dict):
    """piece -> its ids as little-endian 32-bit bytes, encoded when first met."""

    def __init__(self, tokenizer: str, ranks: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                           special_tokens={}).encode_to_numpy

    def whole(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ranked(self, text: str) -> bytes | None:
        """Ids by the rank file, where its pattern surely cuts as the tokenizer's does."""
        if self.plain and _PLAIN.match(text) and not any(s in text for s in self.special):
            return self.plain(text).astype("<u4", copy=False).tobytes()
        return None

    def __missing__(self, piece: str) -> bytes:
        ids = self.ranked(piece)
        if ids is None:
            ids = self.whole(piece)
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        ids = self.ranked(text)
        if ids is not None:
            return ids
        if "  " in text:
            return self.whole(text)
        if len(self) > CACHE:
            self.clear()
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + p] for p in rest])


class _Levels:
    """Open windows by fill level and how many there are at each."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def _best(self, r: int, alone: float) -> int:
        """The level that ``r`` more ids join at the least sum of squares; 0 where ``alone`` is less."""
        n = self.count
        here = n[1:self.size + 1 - r]
        if not here.any():
            return 0
        # change of the sum of squares for level h -> h + r, halved, without what is common
        gain = 2 * (n[1 + r:] - here) + 2
        gain[-1] -= 1                                   # a full window counts at no level
        gain[here == 0] = 1 << 60
        at = len(gain) - 1 - int(gain[::-1].argmin())   # ties: the fuller window
        return at + 1 if gain[at] <= alone else 0

    def _take(self, level: int) -> list:
        window = self.open[level].pop()
        self.count[level] -= 1
        if not self.open[level]:
            del self.open[level]
        return window

    def _put(self, window: list, fill: int) -> list | None:
        if fill == self.size:
            return window
        self.count[fill] += 1
        self.open.setdefault(fill, []).append(window)
        return None

    def place(self, piece: tuple, r: int) -> list | None:
        """Put a piece of ``r`` < size ids; the window, when it became full."""
        best = self._best(r, 2 * self.count[r] + 1) if self.open else 0
        return self._put([*(self._take(best) if best else []), piece], best + r)

    def close(self) -> Iterator[list]:
        """What is open, as full windows and at last windows of a power of two.

        The emptiest window is placed as a piece of its fill, never alone; where it
        fits behind none, its first ids fill the fullest and the rest stays open."""
        while self.open:
            least = min(self.open)
            window = self._take(least)
            if not self.open:
                while least:
                    part = 1 << (least.bit_length() - 1)
                    head, window = _cut(window, part)
                    least -= part
                    yield head
                return
            best = self._best(least, float("inf"))
            if best:
                done = self._put(self._take(best) + window, best + least)
                if done:
                    yield done
                continue
            most = max(self.open)
            head, rest = _cut(window, self.size - most)
            yield self._take(most) + head
            self._put(rest, least - (self.size - most))


def _cut(window: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
    """The first ``n`` ids of a window's pieces and the others."""
    head, rest = [], []
    for doc, start, ids, total in window:
        size = len(ids) // 4
        if n >= size:
            head.append((doc, start, ids, total))
            n -= size
        elif n:
            head.append((doc, start, ids[:4 * n], total))
            rest.append((doc, start + n, ids[4 * n:], total))
            n = 0
        else:
            rest.append((doc, start, ids, total))
    return head, rest


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, size: int = 1024,
         end_id: int = 0) -> DataFrame:
    """``docs`` (doc_id, text) as pieces of windows of at most ``size`` ids.

    Per piece: doc_id, start (ids of the document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    end = np.asarray([end_id], "<u4").tobytes()

    def rows(windows: list[tuple[int, list[tuple]]]) -> pa.RecordBatch:
        flat, offsets, seq = [], [], []
        for number, window in windows:
            at = 0
            for piece in window:
                flat.append(piece)
                offsets.append(at)
                seq.append(number)
                at += len(piece[2]) // 4
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in flat], pa.int64()), pa.array([p[1] for p in flat], pa.int64()),
             pa.array([len(p[2]) // 4 for p in flat], pa.int64()), pa.array([p[2] for p in flat], pa.binary()),
             pa.array([p[3] for p in flat], pa.int64()), pa.array(seq, pa.int64()), pa.array(offsets, pa.int64())],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, levels = _Pieces(tokenizer, ranks), _Levels(size)
        number = TaskContext.get().partitionId() << 36
        done: list[tuple[int, list[tuple]]] = []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (pieces.encode(text) if text else b"") + end
                total = len(ids) // 4
                full = total - total % size
                for start in range(0, full, size):
                    done.append((number, [(doc, start, ids[4 * start:4 * (start + size)], total)]))
                    number += 1
                if total > full:
                    window = levels.place((doc, full, ids[4 * full:], total), total - full)
                    if window:
                        done.append((number, window))
                        number += 1
                if len(done) >= 2048:
                    yield rows(done)
                    done = []
        for window in levels.close():
            done.append((number, window))
            number += 1
        if done:
            yield rows(done)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

"""License scans: short notices found also with a few edits.

A notice that may hold ``k`` edits is cut into ``k + 1`` seeds: by the
pigeonhole principle one of them stands unchanged in every such place.  An
Aho-Corasick automaton finds the seeds of all notices in one pass over the
normalised text; around each, the ``regex`` library's bounded-error matching
verifies the edits and reports the span.  Exact base phrases are places
where a phrase's words stand consecutively.

One pass over the texts, no shuffle.  Defined results: a null text is empty;
an empty text has no words, no labels (empty strings) and score 0; repeated
rows are all returned; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alnum_words

# fixed values: base phrases and their labels
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Notice:
    """A notice in normal form (words, one space between) and its edit bound."""
    text: str
    label: str
    edits: int


# common short notices; about one edit for twelve characters
NOTICES = (
    Notice("under the mit license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    Notice("licensed under the apache license version 2 0", "apache-2", 4),
    Notice("apache license version 2", "apache-2", 2),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 3),
    Notice("licensed under cc by nc", "cc-by-nc", 1),
    Notice("creative commons attribution sharealike", "cc-by-sa", 3),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("mozilla public license version 2 0", "mpl-2", 2),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
)


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """``edits + 1`` parts of the notice of nearly equal length, with their offsets."""
    n, k = len(notice.text), notice.edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Compiled base phrases and notices; built once per task."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES, base: dict[str, str] = BASE):
        import ahocorasick
        import regex

        self.base, self.notices = base, notices
        self.patterns = [regex.compile(rf"(?b)(?<= )(?:{regex.escape(n.text, literal_spaces=True)})"
                                       rf"{{e<={n.edits}}}(?= )") for n in notices]
        self.seeds = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for at, seed in seeds(n):
                found.setdefault(seed, []).append((i, at))
        for seed, uses in found.items():
            self.seeds.add_word(seed, (len(seed), uses))
        if found:
            self.seeds.make_automaton()

    @staticmethod
    def spaces(text: str):
        """Sorted places of the spaces of ``text``: how many lie before a place is a binary search."""
        import numpy as np

        return np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)

    def base_places(self, text: str) -> list[tuple[int, str]]:
        """``(word number, label)`` of every exact place in ``' w0 w1 ... '``."""
        found = []
        for phrase, label in self.base.items():
            at = text.find(f" {phrase} ")
            while at >= 0:
                found.append((at, label))
                at = text.find(f" {phrase} ", at + 1)
        if not found:
            return []
        words = self.spaces(text).searchsorted([at for at, _ in found]).tolist()
        return list(zip(words, (label for _, label in found)))

    def spans(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """``(label, begin, end, edits, length of notice)`` by fuzzy search, places in words."""
        windows: dict[int, list[list[int]]] = {}
        for last, (length, uses) in self.seeds.iter(text) if len(self.seeds) else ():
            for i, at in uses:
                n, k = len(self.notices[i].text), self.notices[i].edits
                begin = last - length + 1 - at
                # with the space on either side that the pattern looks at
                lo, hi = max(0, begin - k - 1), min(len(text), begin + n + k + 1)
                own = windows.setdefault(i, [])
                if own and lo <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(lo, own[-1][0]), max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        out = []
        for i, own in windows.items():
            notice = self.notices[i]
            todo = list(own)
            while todo:
                lo, hi = todo.pop()
                # the best place of the range, then the text before and after it
                if m := self.patterns[i].search(text, lo, hi):
                    todo += [[lo, m.start()], [m.end(), hi]]
                    out.append((notice.label, m.start(), m.end(), sum(m.fuzzy_counts), len(notice.text)))
        if not out:
            return []
        spaces = self.spaces(text)
        begins = (spaces.searchsorted([m[1] for m in out]) - 1).tolist()
        ends = spaces.searchsorted([m[2] for m in out]).tolist()
        return [(m[0], b, e, m[3], m[4]) for m, b, e in zip(out, begins, ends)]


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<label:string,begin:long,`end`:long,edits:int>>")
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()),
                            ("edits", pa.int32())]))


def scan_licenses(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES,
                  base: dict[str, str] = BASE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): exact places, labels, score and fuzzy spans (in words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, base)
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in batch.column(1).to_pylist():
                words = alnum_words(text)
                # one character a byte, so that both libraries see the bytes
                flat = " " + b" ".join(words).decode("latin-1") + " "
                exact = scanner.base_places(flat)
                fuzzy = scanner.spans(flat)
                places = [p for p, _ in exact]
                score = 1.0 if exact else max((1 - e / n for *_, e, n in fuzzy), default=0.0)
                row = (len(words), len(exact), min(places, default=None), max(places, default=None),
                       ",".join(sorted({label for _, label in exact})),
                       ",".join(sorted({label for _, label in exact} | {f[0] for f in fuzzy})), score,
                       [{"label": f[0], "begin": f[1], "end": f[2], "edits": f[3]} for f in sorted(set(fuzzy))])
                for col, value in zip(cols, row):
                    col.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)

"""Token counts: pieces are counted once per distinct pre-token.

A byte-fallback BPE model whose pieces hold the space mark only at their
start never merges across the end of a word, so a text's count is the sum of
its pre-tokens' counts (a pre-token: a word with the spaces before it).

1. Each batch of documents gives its distinct pre-tokens with the number of
   documents; grouped, that is the vocabulary, and the library runs once on
   each entry.  No ids are kept.
2. Pre-tokens of the highest document frequency (at most ``hot_units``, by a
   frequency bound found from a small histogram, each at most
   ``HOT_BYTES`` long) are broadcast and summed where the text is read.
3. All others, frequent in no group, are rows (document, pre-token, times)
   joined to the vocabulary and summed by document.

A row is known by its task and its place there, never by its id or text.

Defined results: a null text is empty; an empty text has 0 tokens; rows with
a null ``doc_id`` are counted like any other; repeated rows are all returned;
an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored, utf8

SPACE_MARK = "▁"
HOT_UNITS = 1 << 19
HOT_BYTES = 64
_UNIT = re.compile(r"(?:^| )( *[^ ]*)")


def pre_tokens(text: str | None) -> list[str]:
    """The text's pre-tokens; each stands for itself behind one space."""
    if not text:
        return []
    text = text.replace(SPACE_MARK, " ")
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return _UNIT.findall(text)


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            seen.update(set(pre_tokens(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["unit", "docs"])


def _counter(model: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(model)
        for batch in batches:
            units = batch.column(0).to_pylist()
            n = [len(ids) if u else 1 for u, ids in zip(units, sp.encode(units, num_threads=1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["unit", "docs", "pieces"])
    return count


def vocabulary(docs: DataFrame, model: str) -> DataFrame:
    """``(unit, docs, pieces)``: every distinct pre-token of ``text``."""
    freq = (docs.select("text").mapInArrow(_frequencies, "unit string, docs long")
            .groupBy("unit").agg(F.sum("docs").alias("docs")))
    return freq.mapInArrow(_counter(model), "unit string, docs long, pieces long")


def _hot_bound(vocab: DataFrame, hot_units: int) -> int:
    """Least document frequency that at most ``hot_units`` units reach."""
    level = F.floor(F.log2("docs") * 8).cast("int")
    left, bound = hot_units, None
    for row in vocab.groupBy(level.alias("k")).agg(
            F.count(F.lit(1)).alias("n"), F.min("docs").alias("least")).orderBy(F.desc("k")).collect():
        if row["n"] > left:
            break
        left, bound = left - row["n"], row["least"]
    return bound if bound is not None else 1 << 62


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, hot_units: int = HOT_UNITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    vocab = stored(vocabulary(docs, model))
    is_hot = (F.col("docs") >= _hot_bound(vocab, hot_units)) & (F.octet_length("unit") <= HOT_BYTES)
    # at most hot_units rows of at most HOT_BYTES each
    hot = spark.sparkContext.broadcast(
        {r["unit"]: r["pieces"] for r in vocab.where(is_hot).select("unit", "pieces").collect()})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            rids, ids, units, times, base, size = [], [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = utf8(text)
                row += 1
                total, rest = 0, []
                for unit, n in Counter(pre_tokens(text)).items():
                    pieces = known.get(unit)
                    if pieces is None:
                        rest.append((unit, n))
                    else:
                        total += n * pieces
                # the document's own row: its unit is none of the vocabulary's, which hold no mark
                rids += [row] * (len(rest) + 1)
                ids += [doc] + [None] * len(rest)
                units += [f"{SPACE_MARK}{row}"] + [u for u, _ in rest]
                times += [None] + [n for _, n in rest]
                base += [total] + [None] * len(rest)
                size += [len(raw)] + [None] * len(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), pa.array(ids, pa.int64()), pa.array(units, pa.string()),
                 pa.array(times, pa.int32()), pa.array(base, pa.int64()), pa.array(size, pa.int64())],
                ["rid", "doc_id", "unit", "times", "base", "size"])

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "rid long, doc_id long, unit string, times int, base long, size long")
    joined = parts.join(vocab.where(~is_hot).select("unit", "pieces"), "unit", "left")
    n = F.sum("base") + F.coalesce(F.sum(F.col("times") * F.col("pieces")), F.lit(0))
    per_row = joined.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("size").alias("n_bytes"), n.alias("n_tokens"))
    return per_row.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

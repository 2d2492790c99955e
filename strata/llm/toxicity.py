"""Toxicity: a small convolutional text classifier trained in numpy.

Words (runs of letters and digits) are hashed to embeddings, one of the word
and one of its first bytes added; filters of several widths slide over them, the maximum over the whole text is kept of
each filter, and a logistic layer scores the maxima.  A filter's value at a
place is a sum of table rows (embedding times filter, one table per place in
the filter), so scoring a text is a few look-ups a word.

The model learns from every labelled text, whole, by parameter averaging: texts
become packed word ids, dealt by ``doc_id`` into parts of about
``ROWS_PER_PART`` rows; a pass sends the parameters out, every part takes
Adagrad steps over its rows, and the parts' moves are averaged, each row of
the embeddings by how often the parts touched it.  Few rows are passed over
more often.  Rows count by the inverse share of their class.  Held-out rows
(``crc32`` of the id's text divisible by ``folds``) never enter it.  A fifth
of the labelled texts take no steps: all of them are scored and counted by
language (guessed from function words of the text itself), label and score
to choose a threshold for each language; scores are stretched so that the
threshold lies at 0.5; a language with few toxic rows there is drawn to the
common threshold by ``pooling``, at every size alike.  The parameters and
the counts are all that comes to the driver, of fixed size.  Scoring reads
every whole text, with no shuffle.

Defined results: a null or empty text gets the score of a text of padding; a
null ``doc_id`` is not held out and matches no label; of repeated labels of
one id the largest counts; without labels of both classes every score is the
smoothed share of toxic labels (below 0.5 if there are none).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alnum_words, checkpointed, maybe_member

BUCKETS, STEMS, STEM_BYTES = 1 << 15, 1 << 12, 4
DIM, FILTERS, WIDTHS = 16, 8, (1, 2, 3)
#: a word's id: its stem's bucket above 16 bits of its own; padding lies past both
PAD = STEMS << 16 | BUCKETS
ROWS = BUCKETS + 1 + STEMS + 1
#: words scored at once: bounds the memory of a task whatever the text's length
SLICE = 1 << 17
#: labelled rows a task learns from in a pass; passes over all rows, more for fewer than ``ENOUGH_ROWS``
ROWS_PER_PART, ENOUGH_ROWS, MOST_PASSES, LEAST_PASSES = 20_000, 60_000, 6, 2
#: rows of the parameters in one message; messages of so many parts are added at once
CHUNK, FAN = 512, 256
#: steps of the score that thresholds are chosen from
BINS = 1 << 13
# fixed values: frequent function words by language
FUNCTION_WORDS = {
    "en": "the of and to that is was for with he it on are this",
    "de": "der die und den das ist von mit zu auf für im dem auch",
    "fr": "le les des et est un une du dans que pour qui au par",
    "es": "el los las del que en y por con para una se lo su",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        bucket = (zlib.crc32(word[:STEM_BYTES]) & (STEMS - 1)) << 16 | zlib.crc32(word) & (BUCKETS - 1)
        if len(self) < 500_000:
            self[word] = bucket
        return bucket


def word_ids(text: str | None, buckets: dict) -> np.ndarray:
    words = alnum_words(text)
    return np.fromiter(map(buckets.__getitem__, words), np.int32, len(words))


def _language_codes() -> np.ndarray:
    """bucket -> bit set of the languages one of whose function words it holds."""
    codes = np.zeros(BUCKETS + 1, np.uint8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            codes[zlib.crc32(w.encode()) & (BUCKETS - 1)] |= 1 << k
    return codes


def language_of(ids: np.ndarray, codes: np.ndarray) -> int:
    """The language with most function words (ties: the first); ``other`` without any."""
    got = codes[ids & 0xFFFF]
    counts = [int(np.count_nonzero(got & (1 << k))) for k in range(len(FUNCTION_WORDS))]
    best = int(np.argmax(counts))
    return best if counts[best] else len(FUNCTION_WORDS)


@dataclass
class Model:
    prior: float = 0.25
    embed: np.ndarray | None = None                 # (ROWS, DIM), rows of padding zero
    filters: list[np.ndarray] = field(default_factory=list)   # per width (width, DIM, FILTERS)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: float = 0.0
    thresholds: tuple[float, ...] = (0.5,) * len(LANGUAGES)

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embed @ w[j] for j in range(len(w))] for w in self.filters]


def rows_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words and of their stems."""
    return ids & 0xFFFF, (ids >> 16) + BUCKETS + 1


def _values(ids: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
    """Filter values at every place of ``ids`` but the last ``max(WIDTHS) - 1``."""
    n = len(ids) - max(WIDTHS) + 1
    word, stem = rows_of(ids)
    return np.concatenate([sum(t[j][word[j:j + n]] + t[j][stem[j:j + n]] for j in range(len(t)))
                           for t in tables], axis=1)


def pooled(texts: list[np.ndarray], tables: list[list[np.ndarray]]) -> np.ndarray:
    """Largest value of each filter over each whole text, in slices of ``SLICE`` words."""
    extra = max(WIDTHS) - 1
    pad = np.full(extra, PAD, np.int32)
    top = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    group: list[np.ndarray] = []
    starts: list[int] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if group:
            v = _values(np.concatenate(group), tables)
            ends = [s + len(g) - extra for s, g in zip(starts, group)]
            for owner, a, b in zip(owners, starts, ends):
                np.maximum(top[owner], v[a:b].max(axis=0), out=top[owner])
            group.clear(), starts.clear(), owners.clear()
            size = 0

    for i, ids in enumerate(texts):
        ids = np.concatenate([ids if len(ids) else pad[:1], pad])
        for a in range(0, len(ids) - extra, SLICE):
            part = ids[a:a + SLICE + extra]
            starts.append(size)
            owners.append(i)
            group.append(part)
            size += len(part)
            if size >= SLICE:
                flush()
    flush()
    return top


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def raw_scores(model: Model, texts: list[np.ndarray], tables=None) -> np.ndarray:
    if model.embed is None:
        return np.full(len(texts), model.prior)
    h = np.maximum(pooled(texts, tables or model.tables()) + model.bias, 0)
    return _sigmoid((h @ model.out + model.out_bias).astype(np.float64))


class Learner:
    """A model and the sums of squared gradients that divide its steps (Adagrad)."""

    def __init__(self, model: Model, sums: list[np.ndarray], rate: float = 0.08):
        self.m, self.sums, self.rate = model, sums, rate
        self.touched = np.zeros(ROWS)

    @staticmethod
    def start(seed: int = 7) -> Learner:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        m = Model(embed=rng.normal(0, 0.2, (ROWS, DIM)).astype(np.float32),
                  filters=[rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  bias=np.zeros(n, np.float32), out=rng.normal(0, 0.3, n).astype(np.float32))
        m.embed[[BUCKETS, ROWS - 1]] = 0
        own = Learner(m, [])
        own.sums = [np.full(v.shape, 1e-3) for v in own.values()]
        return own

    def values(self) -> list[np.ndarray]:
        m = self.m
        return [m.embed, *m.filters, m.bias, m.out, np.array([m.out_bias])]

    def matrix(self) -> np.ndarray:
        """All parameters beside their sums, ``DIM`` of each a row; the embeddings first."""
        sides = []
        for many in (self.values(), self.sums):
            flat = np.concatenate([v.ravel() for v in many]).astype(np.float64)
            sides.append(np.r_[flat, np.zeros(-len(flat) % DIM)].reshape(-1, DIM))
        return np.concatenate(sides, axis=1)

    @staticmethod
    def of(matrix: np.ndarray) -> Learner:
        own = Learner.start()
        for side, many in ((matrix[:, :DIM], own.values()), (matrix[:, DIM:], own.sums)):
            flat, at = side.ravel(), 0
            for v in many:
                v[...] = flat[at:at + v.size].reshape(v.shape)
                at += v.size
            if many is not own.sums:
                own.m.out_bias = float(many[-1][0])
        return own

    def top(self, ids: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter over the text, and the words it stands on."""
        extra, n = max(WIDTHS) - 1, FILTERS * len(WIDTHS)
        ids = np.concatenate([ids if len(ids) else [PAD], np.full(extra, PAD, np.int32)])
        value, best = np.full(n, -np.inf, np.float32), np.full((n, extra + 1), PAD, np.int32)
        for a in range(0, len(ids) - extra, SLICE):
            part = ids[a:a + SLICE + extra]
            word, stem = rows_of(part)
            z = (self.m.embed[word] + self.m.embed[stem]) @ columns
            k, at, v = len(part) - extra, 0, []
            for w in WIDTHS:
                v.append(sum(z[j:j + k, at + j * FILTERS:at + (j + 1) * FILTERS] for j in range(w)))
                at += w * FILTERS
            v = np.concatenate(v, axis=1)
            at = v.argmax(axis=0)
            here = v[at, np.arange(n)]
            more = here > value
            value[more] = here[more]
            best[more] = part[at[more][:, None] + np.arange(extra + 1)]
        return value, best

    def step(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> None:
        """One step on a batch; only rows of words at a maximum move."""
        m, rate = self.m, self.rate
        g_embed, g_filters, (g_bias, g_out, g_ob) = self.sums[0], self.sums[1:-3], self.sums[-3:]
        columns = np.concatenate([w[j] for w in m.filters for j in range(len(w))], axis=1)
        value, best = map(np.stack, zip(*(self.top(ids, columns) for ids in texts)))
        h = np.maximum(value + m.bias, 0)
        err = (_sigmoid(h @ m.out + m.out_bias) - labels) * weights / len(texts)
        d = (err[:, None] * m.out) * (h > 0)
        grad = h.T @ err
        g_out += grad ** 2
        m.out -= (rate * grad / np.sqrt(g_out)).astype(np.float32)
        g_ob += err.sum() ** 2
        m.out_bias -= float(rate * err.sum() / np.sqrt(g_ob[0]))
        grad = d.sum(axis=0)
        g_bias += grad ** 2
        m.bias -= (rate * grad / np.sqrt(g_bias)).astype(np.float32)
        touched, moves = [], []
        for i, w in enumerate(m.filters):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            dz, grad = d[:, own], np.zeros(w.shape)
            for j in range(len(w)):
                word, stem = rows_of(best[:, own, j])
                grad[j] = np.einsum("nf,nfd->df", dz, m.embed[word] + m.embed[stem])
                touched += [word.ravel(), stem.ravel()]
                moves += [(dz[:, :, None] * w[j].T[None]).reshape(-1, DIM)] * 2
            g_filters[i] += grad ** 2
            w -= (rate * grad / np.sqrt(g_filters[i])).astype(np.float32)
        rows, place = np.unique(np.concatenate(touched), return_inverse=True)
        grad = np.zeros((len(rows), DIM))
        np.add.at(grad, place, np.concatenate(moves))
        g_embed[rows] += grad ** 2
        m.embed[rows] -= (rate * grad / np.sqrt(g_embed[rows])).astype(np.float32)
        m.embed[[BUCKETS, ROWS - 1]] = 0
        self.touched[rows] += 1


MOVES = "chunk int, part int, weight binary, total binary"


def _cell(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, kind).tobytes())


def _array(cell: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), kind)


def _learn(shared, seed: int, balance: tuple[float, float], batch: int = 64, word_dropout: float = 0.1):
    """One pass over a part's rows (toxic, ids); its moves, weighted, in chunks of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part, seen = shared.value, TaskContext.get().partitionId(), 0
        rng, learner = np.random.default_rng((seed, part)), Learner.of(before)
        for rows in batches:
            y = rows.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            weight = np.where(y == 1, balance[1], balance[0])
            # taken in random order within what one batch of rows holds
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                texts = [_array(rows.column(1)[int(i)].as_py(), "<i4") for i in own]
                texts = [np.where(rng.random(len(t)) < word_dropout, PAD, t) for t in texts]
                learner.step(texts, y[own], weight[own])
                seen += 1
        if seen:
            moved = learner.matrix() - before
            weight = np.r_[learner.touched, np.full(len(moved) - ROWS, float(seen))]
            moved *= weight[:, None]
            cuts = range(0, len(moved), CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(cuts)), pa.int32()), pa.array([part] * len(cuts), pa.int32()),
                 pa.array([_cell(weight[a:a + CHUNK], "<f8") for a in cuts], pa.binary()),
                 pa.array([_cell(moved[a:a + CHUNK], "<f4") for a in cuts], pa.binary())],
                [f.split()[0] for f in MOVES.split(", ")])
    return run


def _added(moves: pa.Table) -> pa.Table:
    rows = sorted(moves.to_pylist(), key=lambda r: r["part"])       # one order of the sums
    weight = sum(_array(r["weight"], "<f8") for r in rows)
    total = sum(_array(r["total"], "<f4").astype(np.float64) for r in rows)
    return pa.table({"chunk": pa.array([rows[0]["chunk"]], pa.int32()),
                     "part": pa.array([rows[0]["part"] // FAN], pa.int32()),
                     "weight": pa.array([_cell(weight, "<f8")], pa.binary()),
                     "total": pa.array([_cell(total, "<f4")], pa.binary())})


def train(rows: DataFrame, passes: int, balance: tuple[float, float]) -> Model:
    """Fit by averaged passes over all ``rows`` (toxic, ids), a learner a partition."""
    spark = rows.sparkSession
    state = Learner.start().matrix()
    n_parts = rows.rdd.getNumPartitions()
    for turn in range(passes):
        shared = spark.sparkContext.broadcast(state)
        moves, parts = rows.mapInArrow(_learn(shared, turn, balance), MOVES), n_parts
        while parts > FAN:
            moves = moves.groupBy("chunk", F.expr(f"part div {FAN}")).applyInArrow(_added, MOVES)
            parts = -(-parts // FAN)
        state = state.copy()
        for r in moves.groupBy("chunk").applyInArrow(_added, MOVES).toLocalIterator():
            weight = _array(r["weight"], "<f8")[:, None]
            own = slice(r["chunk"] * CHUNK, r["chunk"] * CHUNK + len(weight))
            state[own] += np.where(weight > 0, _array(r["total"], "<f4").reshape(len(weight), -1) / np.maximum(weight, 1), 0)
        shared.unpersist()
    return Learner.of(state).m


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Threshold of the largest weighted F1: the middle between two neighbouring scores."""
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], labels[order], weights[order]
    hit = np.cumsum(w * y)
    f1 = 2 * hit / np.maximum(np.cumsum(w) + (w * y).sum(), 1e-12)
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float(np.clip((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2, 1e-3, 1 - 1e-3))


def held_out(folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) as (doc_id, language, packed word ids)."""
    buckets, codes = _Buckets(), _language_codes()
    for batch in batches:
        texts = [word_ids(t, buckets) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([language_of(t, codes) for t in texts], pa.int32()),
             pa.array([_cell(t, "<i4") for t in texts], pa.binary())], ["doc_id", "lang", "ids"])


def labelled(docs: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """Every labelled text as (toxic, check, lang, ids), in ``parts`` partitions of a fixed order."""
    # texts that surely have no label are not moved
    words = (maybe_member(docs.where(F.col("text").isNotNull() & ~held_out()), "doc_id", known.select("doc_id"))
             .select(F.col("doc_id").cast("long"), "text").mapInArrow(_worded, "doc_id long, lang int, ids binary"))
    # fewer partitions than the session's would be dealt once more
    n = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = known.select(F.col("doc_id").cast("long").alias("__id"), "__toxic").repartition(n, "__id").hint("merge")
    check = F.crc32(F.concat(F.lit("check "), F.col("doc_id").cast("string"))) % 5 == 0
    return checkpointed(words.repartition(n, "doc_id").join(own, F.col("doc_id") == F.col("__id")).coalesce(parts)
                        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "ids")
                        .select(F.col("__toxic").alias("toxic"), check.alias("check"), "lang", "ids"))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, pooling: float = 20.0,
        rows_per_part: int = ROWS_PER_PART) -> Model:
    """Fit on all labelled texts (see the module's text)."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic")).where(~held_out(folds)))
    counts = {int(r["__toxic"]): r["count"] for r in known.groupBy("__toxic").count().collect()}
    model = Model(prior=(counts.get(1, 0) + 0.5) / (sum(counts.values()) + 2))
    if not (counts.get(0) and counts.get(1)):
        return model
    rows = labelled(docs, known, -(-sum(counts.values()) // rows_per_part))
    learns = {r["toxic"]: r["count"] for r in rows.where(~F.col("check")).groupBy("toxic").count().collect()}
    if not (learns.get(0) and learns.get(1)):
        return model
    n = learns[0] + learns[1]
    passes = min(max(-(-ENOUGH_ROWS // n), LEAST_PASSES), MOST_PASSES)
    fitted = train(rows.where(~F.col("check")).select("toxic", "ids"), passes, (n / learns[0] / 2, n / learns[1] / 2))
    fitted.prior = model.prior
    fitted.thresholds = language_thresholds(*score_counts(rows.where("check"), fitted), pooling)
    return fitted


def score_counts(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score, label, rows, language) of all ``rows``, counted in ``BINS`` steps of the score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        n = np.zeros(len(LANGUAGES) * 2 * BINS, np.int64)
        for batch in batches:
            s = raw_scores(shared.value, [_array(c.as_py(), "<i4") for c in batch.column(2)], tables)
            group = batch.column(1).to_numpy() * 2 + (batch.column(0).to_numpy() == 1)
            n += np.bincount(group * BINS + np.minimum((s * BINS).astype(np.int64), BINS - 1), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["at", "n"])

    # at most a number per language, label and step comes to the driver
    found = (rows.select("toxic", "lang", "ids").mapInArrow(run, "at int, n long")
             .groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").toArrow())
    group, step = np.divmod(found["at"].to_numpy().astype(np.int64), BINS)
    return (step + 0.5) / BINS, (group % 2).astype(float), found["n"].to_numpy().astype(float), group // 2


def language_thresholds(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, lang: np.ndarray,
                        pooling: float) -> tuple[float, ...]:
    """Each language's best threshold, shrunk towards the one of all rows.

    Rows of other languages count with ``pooling / (pooling + own toxic rows)`` of their weight: without own
    toxic rows that is the common threshold, with many it is the language's own.  0.5 where a class is missing."""
    if len(set(labels.tolist())) < 2:
        return (0.5,) * len(LANGUAGES)
    out = []
    for k in range(len(LANGUAGES)):
        own = lang == k
        share = pooling / (pooling + weights[own & (labels == 1)].sum())
        out.append(best_threshold(scores, labels, weights * np.where(own, 1.0, share)))
    return tuple(out)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` as (doc_id, score, language) - language is the text's guess."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tables = m.tables() if m.embed is not None else None
        buckets, codes, cuts = _Buckets(), _language_codes(), np.array(m.thresholds)
        for batch in batches:
            texts = [word_ids(t, buckets) for t in batch.column(1).to_pylist()]
            lang = np.array([language_of(t, codes) for t in texts], np.int64)
            s = raw_scores(m, texts, tables)
            if m.embed is not None:
                t = cuts[lang] if len(lang) else np.zeros(0)
                s = np.where(s < t, 0.5 * s / t, 0.5 + 0.5 * (s - t) / (1 - t))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array([LANGUAGES[k] for k in lang], pa.string())],
                ["doc_id", "score", "language"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, language string")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels, **options)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns as they are.

    The text is scored beside its row, so no join is needed and rows with
    equal ids are judged by their own texts."""
    model = fit(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tables = m.tables() if m.embed is not None else None
        buckets, codes, cuts = _Buckets(), _language_codes(), np.array(m.thresholds)
        for batch in batches:
            texts = [word_ids(t, buckets) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            lang = np.array([language_of(t, codes) for t in texts], np.int64)
            s = raw_scores(m, texts, tables)
            limit = cuts[lang] if m.embed is not None else 0.5
            yield batch.filter(pa.array(s < limit))

    return docs.mapInArrow(keep, docs.schema)

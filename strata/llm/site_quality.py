"""Quality classifier: a document's own evidence and its site's, by
hierarchical empirical Bayes.

1. A text's shape (words, distinct words, longest repeat, symbol, capital
   and digit shares, repeated lines ...) is measured over the whole text.  A
   logistic model of these, fitted on the driver on at most ``sample``
   labelled rows (the least by hash of ``doc_id``), gives the document's
   log-odds.
2. Labels are counted by host and by path under a host (grouped
   aggregation).  A host's posterior is its rate shrunk towards the global
   rate, a path's is shrunk towards its host's; the weight of each prior is
   estimated by moments from the spread of the rates, so sites with few
   labels stay near their parent.
3. The score is the document's log-odds plus the shift of its path's
   posterior against the global rate.

Every fifth id (``crc32`` of its text divisible by ``folds``) is held out of
model and counts.  Defined results: a null text is empty; an empty text is
scored like any other; a null host or path is a site of its own; of repeated
labels of one id the least counts; without labels of both classes the score
is the smoothed global rate.  Repeated rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, utf8

FEATURES = ("log_words", "distinct", "longest_run", "symbols", "capitals", "digits", "word_length", "repeated_lines",
            "short", "marks_per_word", "top_word")
SAMPLE = 20_000
_KIND = np.zeros(256, np.uint8)
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3


def features(text: str | None) -> list[float]:
    raw = utf8(text)
    words = raw.lower().split()
    n = len(words)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=4) / max(len(raw), 1)
    counts: dict[bytes, int] = {}
    run = longest = 0
    last = None
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        run = run + 1 if w == last else 1
        longest = max(longest, run)
        last = w
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(1 for w in words if not (w[-1:].isalnum() or w[-1] >= 0x80))
    return [np.log1p(n), len(counts) / max(n, 1), min(longest / max(n, 1), 1.0), kinds[1], kinds[2], kinds[3],
            min(len(raw) / max(n, 1), 50) / 50, 1 - len(set(lines)) / max(len(lines), 1), float(n < 20),
            ends / max(n, 1), max(counts.values(), default=0) / max(n, 1)]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], ["doc_id", "host", "path", "x"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
    """Newton's method on standardised features and their squares; mean, scale, weights."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6

    z = _expand(x, mean, scale)
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def _expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)


def _weight(rates: DataFrame, n: str, k: str, mean: Column) -> Column:
    """Aggregate: weight (in labels) of a beta prior around ``mean``, by moments."""
    rate = F.col(k) / F.col(n)
    noise = F.sum(F.col(n) * mean * (1 - mean) / F.col(n))
    total = F.sum(F.col(n) * (rate - mean) * (rate - mean))
    # between-site variance: what is left of the spread beyond binomial noise
    between = F.greatest((total - noise) / F.sum(F.col(n)), F.lit(1e-6))
    return F.least(F.greatest(F.max(mean * (1 - mean)) / between - 1, F.lit(1.0)), F.lit(1e4))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, folds: int = 5,
                  sample: int = SAMPLE, keep_at: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): host, path, held_out, document and site
    log-odds, score, predicted, keep."""
    measured = checkpointed(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"),
        path.cast("string").alias("path"), F.col("text")
    ).mapInArrow(_measure, "doc_id long, host string, path string, x array<double>"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").cast("int").alias("y")).where(F.col("y").isNotNull() & ~held))
    rows = measured.join(known, "doc_id")
    picked = rows.select("x", "y", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    x, y = np.array([r["x"] for r in picked]), np.array([r["y"] for r in picked], float)
    if len(set(y.tolist())) < 2:
        # one class of labels: the smoothed prior is all there is
        prior = float((y.sum() + 1) / (len(y) + 2))
        return measured.select("doc_id", "host", "path", held.alias("held_out"), F.lit(0.0).alias("document_logit"),
                               F.lit(0.0).alias("site_logit"), F.lit(prior).alias("score"),
                               F.lit(int(prior >= 0.5)).alias("predicted"), F.lit(prior >= keep_at).alias("keep"))
    mean, scale, w = fit_logistic(x, y)

    sites = checkpointed(rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").cast("double").alias("k")))
    hosts = sites.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    g = hosts.agg((F.sum("hk") / F.sum("hn")).alias("g")).first()["g"]
    g = min(max(g, 1e-3), 1 - 1e-3)
    host_weight = hosts.agg(_weight(hosts, "hn", "hk", F.lit(g)).alias("w")).first()["w"]
    shrunk = hosts.withColumn("hp", (F.col("hk") + host_weight * g) / (F.col("hn") + host_weight))
    both = sites.join(shrunk, sites["host"].eqNullSafe(shrunk["host"])).drop(shrunk["host"])
    path_weight = both.agg(_weight(both, "n", "k", F.col("hp")).alias("w")).first()["w"]

    def logit(p):
        return F.log(p / (1 - p))

    posterior = both.select(
        F.col("host").alias("h"), F.col("path").alias("p"),
        (logit((F.col("k") + path_weight * F.col("hp")) / (F.col("n") + path_weight)) - logit(F.lit(g))).alias("path_shift"))
    host_shift = shrunk.select(F.col("host").alias("h2"), (logit(F.col("hp")) - logit(F.lit(g))).alias("host_shift"))

    def own_logit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array(batch.column(3).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(_expand(m, mean, scale) @ w, pa.float64())],
                                             ["doc_id", "host", "path", "document_logit"])

    scored = measured.mapInArrow(own_logit, "doc_id long, host string, path string, document_logit double")
    placed = (scored.join(posterior, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
              .join(host_shift, F.col("host").eqNullSafe(F.col("h2")), "left")
              .withColumn("site_logit", F.coalesce("path_shift", "host_shift", F.lit(0.0))))
    odds = F.col("document_logit") + F.col("site_logit")
    score = 1 / (1 + F.exp(-odds))
    return placed.select("doc_id", "host", "path", held.alias("held_out"), "document_logit", "site_logit",
                         score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                         (score >= keep_at).alias("keep"))

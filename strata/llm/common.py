"""Small helpers the operators share: reading tables, words, cut lineage,
connected components and a bounded membership filter."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, stored  # noqa: F401

#: bytes that separate words in the license and toxicity operators: every
#: ASCII byte that is neither digit nor letter; A-Z become a-z
ALNUM_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else (b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20)
    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    """The text's bytes; a null text is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return utf8(text).lower().split()


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters and of all non-ASCII, A-Z in lower case."""
    return utf8(text).translate(ALNUM_WORDS).split()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: with it a query's shuffle files go when it ends; else they stay until the driver collects garbage, which may be never
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed_alone(df: DataFrame) -> DataFrame:
    """``checkpointed``, for a ``df`` that moves much data: its shuffle files go at once.

    ``df`` gets a plan of its own for it, so nothing else reads these files."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        return checkpointed(df.select("*"))
    finally:
        conf.unset(RELEASE) if before is None else conf.set(RELEASE, before)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges``.

    Rounds of contraction: each node moves to the neighbour (or itself) of
    the least rank, edges follow, and loops and repeats go.  In two rounds the
    rank is the node, so stars around their least node are done at once; then
    it is a hash salted by the round, so a long chain halves about every
    round.  The
    choice is an aggregate with map-side combining, so a node with very many
    edges is not gathered anywhere.  At the end the moves are composed.  The
    joins are merge joins: a broadcast a round would pile up in the driver.
    The edges are stored as files: a checkpoint keeps its plan's estimate of
    the size, a product over the joins of all rounds, whose digits triple with
    each (the eighth round took a minute to plan).
    """
    live = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    moves: list[DataFrame] = []
    while True:
        turn = len(moves)

        def ranked(c: str):
            rank = F.lit(0).cast("long") if turn < 2 else F.xxhash64(F.lit(turn), F.col(c))
            return F.struct(rank.alias("h"), F.col(c).alias("to"))

        ends = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = checkpointed(
            ends.groupBy("a").agg(F.min(F.least(ranked("a"), ranked("b"))).alias("m"))
            .select(F.col("a").alias("node"), F.col("m.to").alias("to")))
        moves.append(move)
        ma = move.withColumnsRenamed({"node": "a", "to": "ta"})
        mb = move.withColumnsRenamed({"node": "b", "to": "tb"})
        live = stored(
            live.hint("merge").join(ma, "a").hint("merge").join(mb, "b").where(F.col("ta") != F.col("tb"))
            .select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct())
        if live.isEmpty():
            break
    out = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        nxt = move.withColumnsRenamed({"node": "root", "to": "next"})
        out = out.hint("merge").join(nxt, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root"))
    return out


#: bits of the membership filter: 131,072 longs, 1 MB; fixed at every size
FILTER_WORDS = 1 << 17


def _marked(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    def place(c):
        h = F.xxhash64(c.cast("long"))
        return (F.pmod(F.shiftright(h, 6), F.lit(FILTER_WORDS)).alias("w"),
                F.pmod(h, F.lit(64)).cast("int").alias("bit"))

    first = F.col(keys.columns[0])
    w, bit = place(first)
    words = (keys.where(first.isNotNull()).select(w, bit)
             .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")))
    words = words.withColumnsRenamed({"w": "__w", "bits": "__bits"})
    w, bit = place(F.col(column))
    return (df.withColumns({"__at": w, "__bit": bit})
            .join(F.broadcast(words), F.col("__at") == F.col("__w"), "left"))


def maybe_member(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` may occur in ``keys`` (first column).

    A bitmap of fixed size (at most ``FILTER_WORDS`` longs) is built by an
    aggregate and broadcast.  It only saves moving rows that surely have no
    partner: false positives pass, members always do, so a join must follow.
    """
    return split_by_membership(df, column, keys)[1]


def split_by_membership(df: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(surely not in keys, maybe in keys)`` by the bitmap of ``maybe_member``."""
    marked = _marked(df, column, keys)
    hit = F.coalesce(F.expr("shiftrightunsigned(__bits, __bit) & 1") == 1, F.lit(False))
    clean = ["__at", "__bit", "__w", "__bits"]
    return marked.where(~hit).drop(*clean), marked.where(hit).drop(*clean)


def without(docs: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``column`` is not in ``keys``; only rows that may be in it are moved."""
    keys = keys.select(F.col(keys.columns[0]).alias("__key")).distinct()
    apart, maybe = split_by_membership(docs, column, keys)
    return apart.union(maybe.join(keys, F.col(column) == F.col("__key"), "left_anti"))


#: rows and bytes of the batches a Python worker gets
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in tasks are found by name there; where the package is
    installed on the workers this changes nothing."""
    sc = spark.sparkContext
    # texts are long: small batches bound the memory of a Python worker
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="strata-code-")
        with zipfile.ZipFile(os.path.join(folder, "strata_code.zip"), "w") as archive:
            for at, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(archive.filename)
        _shipped.add(sc.applicationId)

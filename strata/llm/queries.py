"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import merkle, url_templates
from strata.llm.common import ship_code, table

Query = Callable[[SparkSession, str], DataFrame]

#: fields of a leaf of the manifest, in this order
MERKLE_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ngram_join import components

    return components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.repeats import find_repeats

    return find_repeats(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.site_quality import score_quality

    # a document's host is its source; the path under it is the language section
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                         F.col("source"), F.col("lang"))


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.url_templates import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                  tokenizer_path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.hnsw import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.merkle import folded, leaf_hash, manifest, proof_digest

    docs = table(spark, sf_dir, "documents")
    # tampered: one more character said than there is; exact beyond a long, too
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
    original = leaf_hash([F.col(c) for c in MERKLE_FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proved = manifest(docs, MERKLE_FIELDS, "lang", "doc_id", F.when(hit, tampered).otherwise(original))
    root = folded(F.col("presented"), F.col("path"))
    return proved.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.conversation_repair import audits, damaged, faulted

    return audits(faulted(damaged(table(spark, sf_dir, "conversations"))))


def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pitman_yor import remainder, score, train

    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 1
    return score(docs, held_out, train(docs, ~held_out))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {f.__name__: _shipped(f) for f in (
    op1_ngram_join, op2_repeats, op3_license_scan,
    op4_decontamination, op5_toxicity, op6_site_quality,
    op7_url_templates, op8_token_counts, op9_packing,
    op10_nearest_neighbours, op11_merkle_manifest, op12_conversation_repair,
    op13_pitman_yor,
)}

ORACLE_SQL: dict[str, str] = {"op7_url_templates": url_templates.oracle_sql(),
                              "op11_merkle_manifest": merkle.oracle_sql()}

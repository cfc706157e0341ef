"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import (
    alignment,
    bpe,
    embedding_dedup,
    exact_dedup,
    language_id,
    merkle,
    minhash,
    mixing,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    url_filter,
)
from tallywright.llm.common import held_out, table

URL_RULES = [
    url_filter.Rule.parse("block", "net/"),
    url_filter.Rule.parse("allow", "example.net/en/"),
    url_filter.Rule.parse("block", "example.com/de/"),
    url_filter.Rule.parse("allow", "org/fr/"),
]


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learned from labels and texts of the rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 3, 1) & (F.col("quality") == 1))
    return quality.learn(docs.where(~held_out(F.col("doc_id"), 3, 1)), labels)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_documents(docs, quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file of the registered queries; the package lies beside the interpreter's own."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep_singles=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, teaching=~held_out(F.col("doc_id"), 3, 1))
    return found.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "begin", "end", "score", "secret")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", merkle.CAPITALS, merkle.CAPITALS.lower())
    return merkle.prove(table(spark, sf_dir, "documents"), altered={"text": lowered}, where=held_out(F.col("doc_id"), 5, 0))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aligned, _ = alignment.align(docs, vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
    return aligned.drop("a", "b")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    taught = lambda rows: rows.where(~held_out(F.col("doc_id"), 5, 0))
    model = toxicity.learn(taught(docs), taught(table(spark, sf_dir, "labels")))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_suffix_array": op2_suffix_array,
        "op3_bpe": op3_bpe,
        "op4_url_filter": op4_url_filter,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_mixing": op6_mixing,
        "op7_embeddings": op7_embeddings,
        "op8_language_id": op8_language_id,
        "op9_minhash": op9_minhash,
        "op10_secrets": op10_secrets,
        "op11_merkle": op11_merkle,
        "op12_alignment": op12_alignment,
        "op13_toxicity": op13_toxicity,
    }

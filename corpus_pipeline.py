"""From raw documents to token ids: the operators of ``tallywright.llm`` in sequence.

Rows are judged one by one in every stage, whatever their id: a null or repeated one is no
exception. Null and empty texts go in the first stage, as they score 0, so later stages
meet none; each of them would let such rows through by its own rules. An empty table gives
an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywright.llm import bpe, exact_dedup, minhash, mixing, quality
from tallywright.llm.common import table, written
from tallywright.llm.queries import quality_model, vocabulary_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share asks for."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, repeated ones too, and the text that they decode to."""
    return bpe.encode_and_decode(docs, vocabulary_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact),
    ("MinHash near-dedup", drop_near),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", tokens),
]

#: Stages are learned or iterative, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline of the training-data operators: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import prepare, stored
from tickloom.llm.decontamination import decontaminate
from tickloom.llm.language_id import recognised, train_language_model
from tickloom.llm.lm_scoring import held_out_column
from tickloom.llm.packing import pack
from tickloom.llm.queries import BYTE_BPE, piece_digests
from tickloom.llm.simhash import keep_one_of_each
from tickloom.llm.substrings import remove_repeats

#: A text whose best language is less likely than this is rejected.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter go."""
    prepare(spark)
    model = train_language_model(docs, ~held_out_column("doc_id", 4, 2))
    return recognised(docs, model, LEAST_SCORE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return keep_one_of_each(docs)


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages in their first document only."""
    prepare(spark)
    return remove_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    prepare(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    prepare(spark)
    return piece_digests(pack(docs, BYTE_BPE))


STAGES = [
    ("language_id", known_language),
    ("simhash", one_of_each),
    ("substrings", passages_once),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# tokens, learned weights and fingerprints have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

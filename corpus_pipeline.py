"""From raw documents to token digests: five stages, each written to Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacancia.llm import language, leaks, lines, pieces, simhash
from vacancia.llm.common import shared_folder, table
from vacancia.llm.queries import TOKENIZER


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language shows (operator 2)."""
    return language.keep_known(docs, language.train(docs))


def without_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs cut out; documents of which nothing is left go (operator 3)."""
    return lines.keep_first_runs(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (SimHash of 3-word shingles, at most 2 differing bits) the document of least id (operator 8)."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 9)."""
    return leaks.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text per document (operator 5)."""
    return pieces.digests(docs, pieces.model_bytes(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_runs),
    ("near_copies", without_near_copies),
    ("decontamination", without_leaks),
    ("tokens", tokens),
]

#: Compression, SimHash, BM25 bounds and the tokenizer have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

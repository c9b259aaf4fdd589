"""A training-data pipeline over ``documents``, each stage one of the operators of rolefit.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rolefit.llm.minhash import keep_one
from rolefit.llm.mixing import mixed_documents
from rolefit.llm.pieces import encode_documents
from rolefit.llm.pii import redact
from rolefit.llm.quality import keep_good
from rolefit.session import shared_dir

#: Near duplicates of the pipeline share this percentage of their five-word shingles, documents are kept from this score on.
SIMILAR, GOOD = 80, 0.3
#: Words of a block of the mix.
BLOCK = 64


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the table ``labels``."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), GOOD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id."""
    return keep_one(docs, SIMILAR)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources: a row per time the mix takes a document, or the part of it that it takes."""
    return mixed_documents(docs, block=BLOCK)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row of the mix, and whether decoding them restores the text."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding and decoding", encode_stage),
]

#: Not a SQL question; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            path = shared_dir(spark, f"pipeline-{n}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

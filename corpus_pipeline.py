"""Training corpus from raw documents: five stages, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of ``docs``; each result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import bpe, lines, minhash, mixing, rules
from tallgrass.llm.common import stored
from tallgrass.queries import read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the decision list learned from ``labels`` keeps."""
    return rules.good_documents(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one has."""
    return lines.without_shared_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.distinct_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every document, and their decoded text's digest."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.encode(docs.select("doc_id", "source", "text"), path)
    return out.select("row.doc_id", "row.source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near dedup", near_dedup), ("source mix", mix), ("encode", encode)]

#: Near-duplicate classes and balanced sampling aren't expressible in SQL; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

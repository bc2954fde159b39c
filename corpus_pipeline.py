"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, byte-level BPE."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyweb.llm import byte_bpe, line_dedup, quality_rules, simhash_dedup, source_mixing
from tallyweb.llm.common import forget, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality_rules.keep_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document (or line) has; those left without words go."""
    return line_dedup.dedup_lines(docs, chars="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return simhash_dedup.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each whole pass over a document, and one for the part taken once more."""
    return source_mixing.mixed_rows(docs, chars="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row of the mix, and what they decode to."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("byte-level BPE", tokens),
]

#: Fingerprints and byte-pair merges have no SQL; tests/llm/test_pipeline.py holds it against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as a table and read again; a table goes once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            done = store(done, f"stage{k}")
            forget(docs)
        docs = done
    return docs

"""A corpus pipeline: language, near copies, benchmark passages, secrets, tokens.

``STAGES`` lists the stages in order. Each takes the session, the documents its predecessor kept and
the folder of the input tables. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialweave.llm import byte_bpe, decontaminate, language, secrets, simhash
from trialweave.llm.common import table
from trialweave.session import configure, remove_folder, scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, or no letter in it. All others stay.

    Those without a label get the predicted language as theirs.
    """
    return language.keep_identified(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash group: that of the smallest id, rows without an id last.

    Texts that share an id but are not alike are members of different groups.
    """
    return simhash.keep_representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the text; no document goes."""
    return secrets.redact_secrets(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its number of tokens and the digests of its ids and their bytes."""
    return byte_bpe.round_trip_digests(docs, RANKS, PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language", identified),
    ("simhash", unlike),
    ("decontamination", decontaminated),
    ("secrets", masked),
    ("byte_bpe", tokenised),
]

# Fingerprints, automata and merges are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next.

    What a stage wrote goes when the next one has been written; the last one's input stays, as the
    result is read from it.
    """
    configure(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

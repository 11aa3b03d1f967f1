"""The corpus pipeline: documents in, token counts and digests of the mixed corpus out.

Token ids themselves do not leave the task that made them; writing them is not measured.

Each stage applies one training-data operator to all that the stage before kept; between
stages the rows are written to the shared folder and read again, so a lost executor never
costs more than the stage it was in. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.llm import exact_dedup, language_id, mixing, simhash
from telmart.llm.common import read, stored
from telmart.llm.digests import token_digests

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the predicted language into ``lang``; documents without any (null texts, texts without a letter) go."""
    return language_id.with_language(docs, language_id.fit_learnable(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest doc_id, exactly one."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints keep the document with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every copy of a document in the mix."""
    return token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: Fingerprints, prototypes and merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

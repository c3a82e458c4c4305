"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, as a table, and returns the columns of
documents; the last returns the encoding of each document of the mix.

    quality          documents that a rule rejects go
    near_duplicates  of documents linked by 0.75 of their five-word shingles one stays
    secrets          confirmed and patterned secrets are replaced by a mark
    mix              documents by weighted fair queueing of their sources, some twice
    pieces           piece ids of every document, their number and checksum, and whether they decode to its text

Secrets, the mix's order and the pieces have no SQL form, so there is no check in
SQL; a test compares the pipeline with a plain one. Null texts count as empty and
go in the first stage; an empty table gives an empty one; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelmill.llm import mixing, pieces, quality, secret, shingle_join
from panelmill.llm.common import stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.cascade(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.deduplicate(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digest(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("secrets", without_secrets),
    ("mix", mixed),
    ("pieces", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

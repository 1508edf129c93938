"""The corpus pipeline: stages over documents, each one operator of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import exact_dedup, near_dedup, queries, secrets, toxicity
from rowtide.llm.common import saved

#: No SQL: a fitted classifier and a tokenizer have none. The tests compare the
#: stages with the operators they call, which have tests of their own.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, queries.toxicity_model(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each is written and read again.

    Null texts count as empty and, like all rows, are copies of each other if
    equal; empty texts are linked with nothing by the near-duplicate stage. Rows
    that repeat wholly are exact copies, of which one stays. An empty table gives
    no pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

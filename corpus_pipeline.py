"""A corpus run: quality rules, exact and near deduplication, mixing, token ids.

Each stage reads what the one before it kept, as Parquet. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnwatch.llm import bpe, cuckoo, mixing, quality_rules, simhash
from txnwatch.llm.catalog import vocabulary_path
from txnwatch.llm.common import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents inside the limits of their language and source stay."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the one with the largest id stays."""
    return cuckoo.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near copies the one with the smallest id stays."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every document as often as the mix takes it."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token count and digests of the ids and of the decoded text, a row per document."""
    return bpe.encode_and_decode(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixed),
    ("byte-pair encoding", tokens),
]

#: The mix rounds by a running error and the last stage runs a tokenizer: no SQL for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

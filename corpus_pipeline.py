"""Corpus pipeline: documents to token files, in stages that are each stored and read again.

Rows that a stage rejects are gone for the following ones, and every stage but the last returns the
columns of ``documents``. ``run`` applies the stages to ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm.common import stored, table
from usagelens.llm.decontaminate import clean_documents
from usagelens.llm.mixing import mixed_documents
from usagelens.llm.near_dup import unique_documents
from usagelens.llm.quality import good_documents
from usagelens.llm.token_files import tokenized_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return unique_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document appears as often as the mix takes it."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; for each document its place, size and checksum as read back."""
    return tokenized_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("token ids", token_ids),
]

# a trained model, signatures, hash thresholds and code tables have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

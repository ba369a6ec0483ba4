"""The corpus pipeline: stages that each take the documents the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import decontaminate, jaccard, mixing, queries, token_files, toxicity
from paperloom.llm.common import documents
from paperloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 0, by the model fitted on the labels of the supplied tables."""
    return toxicity.without_toxic(docs, queries.toxic_model(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts connected by a Jaccard similarity of 0.8 or more."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, documents(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken, shortened where it is in part."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, in files of independent frames, as read back from them."""
    return token_files.token_table(spark, docs, queries.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("token_files", encode),
]

# A fitted model, MinHash groups, alignments and files cannot be written in SQL; tests/llm checks
# the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

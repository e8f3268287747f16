"""From raw documents to token ids: quality, exact and near duplicates, mixing, encoding.

Every stage works on all rows its predecessor kept and, but for the last, returns the
columns of ``documents``.  What a stage defines for nulls, empty texts, ties and repeated
rows is stated by its operator.  :func:`run` writes each stage's rows as Parquet below the
shared folder, where the next one reads them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.mixing import mixed
from tidemark.llm.pieces import encode
from tidemark.llm.quality import quality_filter
from tidemark.llm.simhash import simhash_dedup
from tidemark.operators.publish import exists
from tidemark.sources.lake import work_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality_filter(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints."""
    return simhash_dedup(docs, shingle=3, radius=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every text."""
    return encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

# A trained classifier and tokenizer are in it, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The ids of the last stage.  Tables of the stages before it stay in ``folder``, a new one
    unless given; a run that is given the folder of one that broke off goes on from the last
    stage that was written whole."""
    folder = folder or f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1], 1):
        path = f"{folder}/{number}_{name}"
        if not exists(spark, f"{path}/_SUCCESS"):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The training-data pipeline: toxicity, near duplicates, repeated substrings, source mixture, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept. run() writes each stage's
rows as Parquet below the shared folder and reads them back as the next one's documents.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import mixture, neardup, packing, queries, suffixes, toxicity
from marketlens.sizing import shared_folder

#: Not expressible in SQL: the fitted model, the tilted rates and the tokenizer.
ORACLE_SQL = None


#: Texts that a Python worker holds at a time, unless the session says otherwise. They may be long, and their arrays take
#: several times their bytes.
BATCH_ROWS, BATCH_CONF = 100, "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(stage):
    """The stage under a session that hands whole texts to Python workers a hundred at a time."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_CONF) == "10000":  # Spark's default
            spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def _without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the rejection bound."""
    labels = queries.table(spark, sf_dir, "labels")
    return toxicity.kept_documents(docs, labels)


@_in_small_batches
def _without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id; all without an id."""
    return neardup.kept_documents(docs)


@_in_small_batches
def _without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes under repeated strings; a document of which nothing is left goes."""
    return suffixes.cut_documents(docs)


@_in_small_batches
def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, the last time in part if it takes a part."""
    return mixture.mixed_documents(docs)


@_in_small_batches
def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences for training."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", _without_toxic),
    ("near_dedup", _without_near_duplicates),
    ("suffix_dedup", _without_repeats),
    ("mixing", _mixed),
    ("packing", _packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs, folder = queries.documents(spark, sf_dir), f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

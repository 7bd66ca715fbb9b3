"""A training corpus from ``documents``: five stages, each an operator of ``concordia.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents.  All but the last return the columns of the
documents they were given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.llm import decontaminate, mixing, packing, simhash, toxicity
from concordia.llm.common import source_table, stored

TOKENIZER = "piece_bpe_32k.model"
#: Bytes of rows that pass to Python at a time; Spark's 64 MB stand in memory several times
#: over, in the executor and in each of its Python workers.
BATCH_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """Frames run after their stage has returned, so the session keeps the setting."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below 0.5; the model learns from their labels."""
    labels = source_table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


@in_small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of texts with near fingerprints."""
    return simhash.keep_representatives(docs, shingle_words=3)


@in_small_batches
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no window of a benchmark item."""
    return decontaminate.decontaminated(docs, source_table(spark, sf_dir, "benchmark"))


@in_small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix by shard and shuffled within; documents may recur or be cut."""
    return mixing.mix(docs).select("doc.*")


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_output", packed),
]

#: A trained score and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

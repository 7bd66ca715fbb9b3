"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.hadoop import delete_directory
from ..sources.scratch import shared_folder

#: White space that separates words: space and the code points 9 to 13.
BLANKS = " \t\n\v\f\r"
#: A word as the contracts of sizes and statistics define it (Java and Python regex).
WORD = r"[^\x20\x09-\x0D]+"

_stored: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and return it from there.

    This cuts the lineage without depending on any executor's disk: the rows are committed
    task by task, so every later reader sees one consistent version of them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session once their results are written."""
    while _stored:
        delete_directory(spark, _stored.pop())


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text):
    """Number of words of a text column; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_bytes(text):
    """Length of a text column in UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def hash_sample(df: DataFrame, key: list[str], max_rows: int, seed: int = 1) -> DataFrame:
    """About ``max_rows`` rows of a table, all of a smaller one, with their hash as ``place``.

    Rows are chosen by the hash of ``key`` alone, so reruns choose the same ones.  The
    table is counted first; that only hashes below a bound pass keeps the later sort for
    an exact limit as small as the sample.
    """
    share = min(1.0, max_rows / max(1, df.count()))
    placed = df.withColumn("place", F.xxhash64(*(F.col(k).cast("string") for k in key), F.lit(seed)))
    if share == 1.0:
        return placed
    return placed.filter(F.col("place") < F.lit(int(-(2.0**63) + share * 2.0**64)))


def values(array: pa.Array, rows: int = 512) -> Iterator:
    """Python values of an Arrow array, of which only some rows are held at a time."""
    for start in range(0, len(array), rows):
        yield from array.slice(start, rows).to_pylist()

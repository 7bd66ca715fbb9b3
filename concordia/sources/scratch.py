"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import HASH
from .hadoop import delete_directory, path_exists


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    A folder of our own is made up only for local mode, where driver and executors are
    one machine; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="concordia-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small intermediate result so that later steps only read it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def cached_hashes(hashes: DataFrame) -> Iterator[DataFrame]:
    """Row hashes kept on the executors, spilling to disk.

    A lost executor means its rows are hashed again, so the table must not change.
    """
    hashes = hashes.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield hashes
    finally:
        hashes.unpersist()


@contextmanager
def frozen_hashes(hashes: DataFrame) -> Iterator[DataFrame]:
    """Row hashes of a table as of now, for sources that may change while being compared.

    They are written once as a parquet table of 32-byte values, so every check sees the
    same rows, a lost executor costs no second read of the source, and nothing has to
    fit in memory.  The table is removed when the block ends.
    """
    spark = hashes.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/row-hashes-{uuid.uuid4().hex}"
    try:
        hashes.select(F.unhex(HASH).alias(HASH)).write.parquet(path)
        stored = spark.read.schema(f"`{HASH}` binary").parquet(path)
        yield stored.select(F.coalesce(F.lower(F.hex(HASH)), F.lit("")).alias(HASH))
    finally:
        delete_directory(spark, path)


def files_stamp(*frames: DataFrame) -> str | None:
    """Digest of the names, sizes and times of the files the frames read.

    None if a frame reads no files, so that nothing tells whether its rows have changed.
    Files that lie beside those read count, too: a new one changes the stamp.
    """
    found = []
    for frame in frames:
        folders = sorted({unquote(name).rsplit("/", 1)[0] for name in frame.inputFiles()})
        if not folders:
            return None
        spark = frame.sparkSession
        listed = spark.read.format("binaryFile").load(folders).select("path", "length", "modificationTime")
        entry = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(20,0)")
        found.append(tuple(listed.agg(F.count(F.lit(1)), F.sum(entry)).first()))
        found.append(tuple(frame.columns))
    return hashlib.sha256(repr(found).encode()).hexdigest()


def kept(df: DataFrame, path: str) -> DataFrame:
    """A small result that a later attempt may take up: computed unless it is there whole.

    The folder counts only once its writer has left the mark of success, which it does
    last, so a half written one is computed and written again.
    """
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

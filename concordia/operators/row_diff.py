"""Multiplicity-aware row differences between two frames of row hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    BROADCAST_BUCKETS,
    BROADCAST_SAMPLE,
    BUCKET,
    CHECKSUM_BUCKETS,
    COUNT_DIFFERS,
    HASH,
    ONLY_IN_SINK,
    ONLY_IN_SOURCE,
    ROW_SAMPLE,
    ROWS_PER_SHUFFLE_TASK,
)
from ..functions.canonical import DEFAULT_OPTIONS, CanonicalOptions, quoted
from ..functions.fingerprint import XXHASH64, fingerprint, with_bucket
from .frames import first_text, one_row


def size_shuffle(spark: SparkSession, rows: int) -> None:
    """Raise ``spark.sql.shuffle.partitions`` if ``rows`` hashes would overload its tasks.

    It is never lowered, and adaptive execution merges tasks that turn out small, so a
    larger value does no harm to other queries of the session.
    """
    key = "spark.sql.shuffle.partitions"
    wanted = -(-rows // ROWS_PER_SHUFFLE_TASK)
    if wanted > int(spark.conf.get(key)):
        spark.conf.set(key, wanted)


def row_multiplicity(hashes: DataFrame) -> DataFrame:
    """(row_hash, row_count): how often each row occurs."""
    return hashes.groupBy(F.col(HASH).alias("row_hash")).agg(F.count(F.lit(1)).alias("row_count"))


def row_diff(
    source: DataFrame,
    sink: DataFrame,
    differing_buckets: DataFrame | None = None,
    bucket_count: int = CHECKSUM_BUCKETS,
    bucket_fn: str = XXHASH64,
    differing_count: int | None = None,
) -> DataFrame:
    """(row_hash, src_count, sink_count, diff_kind) of every row whose counts differ.

    Both sides are stacked and counted in one aggregation: one shuffle and no sort,
    where joining two counted sides would sort each of them.  Copies of one row collapse
    in the map tasks, so a row repeated billions of times is no hot key.  The shuffle
    carries the 32 raw bytes of the hash instead of its 64 hex digits.

    ``differing_buckets`` (a frame with bucket_id, as from ``checksum_diff``) drops rows
    of matching buckets before the shuffle.  It only saves work, the result is the same
    without it, and it is used only while ``differing_count``, its number of rows, or else
    ``bucket_count`` proves it small enough to be broadcast.
    """
    stacked = source.select(HASH, F.lit(1).alias("in_source")).unionAll(
        sink.select(HASH, F.lit(0).alias("in_source"))
    )
    most = bucket_count if differing_count is None else differing_count
    if differing_buckets is not None and most <= BROADCAST_BUCKETS:
        wanted = differing_buckets.select(F.col("bucket_id").alias(BUCKET))
        stacked = with_bucket(stacked, bucket_count, bucket_fn).join(
            F.broadcast(wanted), BUCKET, "left_semi"
        )
    counted = stacked.groupBy(F.unhex(HASH).alias(HASH)).agg(
        F.sum("in_source").alias("src_count"),
        F.sum(F.lit(1) - F.col("in_source")).alias("sink_count"),
    )
    kind = (
        F.when(F.col("sink_count") == 0, ONLY_IN_SOURCE)
        .when(F.col("src_count") == 0, ONLY_IN_SINK)
        .otherwise(COUNT_DIFFERS)
    )
    return counted.filter("src_count != sink_count").select(
        F.lower(F.hex(HASH)).alias("row_hash"), "src_count", "sink_count", kind.alias("diff_kind")
    )


def row_diff_summary(diff: DataFrame) -> DataFrame:
    """One row with the number of differing rows of each kind, in a single pass."""
    return diff.agg(
        F.count_if(F.col("diff_kind") == ONLY_IN_SOURCE).alias("only_in_source"),
        F.count_if(F.col("diff_kind") == ONLY_IN_SINK).alias("only_in_sink"),
        F.count_if(F.col("diff_kind") == COUNT_DIFFERS).alias("count_mismatch"),
    )


def row_diff_report(diff: DataFrame, samples: int) -> DataFrame:
    """The summary plus the lowest ``samples`` hashes of each one-sided kind as text.

    The three parts share the shuffle below ``diff`` (Spark reuses equal exchanges), so
    the tables are scanned once.
    """
    parts = [row_diff_summary(diff)]
    for kind, name in ((ONLY_IN_SOURCE, "source_sample"), (ONLY_IN_SINK, "sink_sample")):
        parts.append(
            first_text(diff.filter(F.col("diff_kind") == kind), "row_hash", samples, name)
        )
    return one_row(*parts)


def diff_sample(
    rows: DataFrame,
    diff: DataFrame,
    kind: str,
    sample_size: int = ROW_SAMPLE,
    options: CanonicalOptions = DEFAULT_OPTIONS,
) -> DataFrame:
    """At most ``sample_size`` rows present on one side only, lowest hash first.

    ``rows`` is the raw table of that side, ``diff`` the result of ``row_diff``.  The
    result holds the canonical columns, the row hash and all of it as pipe-joined text.
    The hashes are cut to the sample size before they meet the table.
    """
    if sample_size < 0:
        raise ValueError(f"sample_size must not be negative, got {sample_size}")
    if kind not in (ONLY_IN_SOURCE, ONLY_IN_SINK):
        raise ValueError(f"kind must be {ONLY_IN_SOURCE} or {ONLY_IN_SINK}, got {kind!r}")
    wanted = (
        diff.filter(F.col("diff_kind") == kind)
        .select(F.col("row_hash").alias(HASH))
        .orderBy(HASH)
        .limit(sample_size)
    )
    if sample_size <= BROADCAST_SAMPLE:
        wanted = F.broadcast(wanted)
    marked = fingerprint(rows, options)
    values = [F.coalesce(quoted(c), F.lit("null")) for c in [HASH] + marked.columns[:-1]]
    return (
        marked.join(wanted, HASH, "left_semi")
        .withColumn("__row_text", F.concat_ws("|", *values))
        .orderBy(HASH)
        .limit(sample_size)
    )

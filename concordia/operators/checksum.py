"""Order-independent bucket checksums and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BROADCAST_BUCKETS, BUCKET, CHECKSUM_BUCKETS, CHECKSUM_REFINEMENT, HASH
from ..functions.fingerprint import XXHASH64, bucket_of, hash_number, with_bucket

# A 64-bit number is summed as three pieces of at most 22 bits.  Their bigint sums stay
# exact for 2^41 rows in one bucket (beyond, ANSI mode raises instead of wrapping), and
# bigint sums are far cheaper per row than decimal ones.
_PIECE_BITS = 22
_PIECE_MASK = (1 << _PIECE_BITS) - 1


def bucket_checksum(
    hashes: DataFrame, bucket_count: int = CHECKSUM_BUCKETS, bucket_fn: str = XXHASH64
) -> DataFrame:
    """(bucket_id, row_count, bucket_hash) of a frame of row hashes.

    Rows are pre-aggregated in the map tasks: at most ``bucket_count`` rows per task are
    shuffled, whatever the table size and however rows are repeated.
    """
    if HASH not in hashes.columns:
        raise ValueError(f"a frame with the column {HASH} is required")
    number = F.col("number")
    low = number.bitwiseAND(F.lit(_PIECE_MASK))
    middle = F.shiftright(number, _PIECE_BITS).bitwiseAND(F.lit(_PIECE_MASK))
    high = F.shiftright(number, 2 * _PIECE_BITS)
    pieces = (
        hashes.select(hash_number(F.col(HASH), bucket_fn).alias("number"))
        .groupBy(bucket_of(number, bucket_count).alias("bucket_id"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(high).alias("high"),
            F.sum(middle).alias("middle"),
            F.sum(low).alias("low"),
        )
    )

    def scaled(name: str, bits: int):
        return F.col(name).cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(14,0)")

    total = scaled("high", 2 * _PIECE_BITS) + scaled("middle", _PIECE_BITS) + F.col("low")
    return pieces.select("bucket_id", "row_count", total.cast("decimal(38,0)").alias("bucket_hash"))


def bucket_compare(source_checksums: DataFrame, sink_checksums: DataFrame) -> DataFrame:
    """Both checksums of every bucket next to each other, with a ``differs`` flag.

    Both inputs are already partitioned by bucket_id, so the join shuffles nothing.
    """
    left = source_checksums.select(
        "bucket_id",
        F.col("row_count").alias("source_count"),
        F.col("bucket_hash").alias("source_hash"),
    )
    right = sink_checksums.select(
        "bucket_id",
        F.col("row_count").alias("sink_count"),
        F.col("bucket_hash").alias("sink_hash"),
    )
    same = F.col("source_count").eqNullSafe(F.col("sink_count")) & F.col(
        "source_hash"
    ).eqNullSafe(F.col("sink_hash"))
    return left.join(right, "bucket_id", "full_outer").withColumn("differs", ~same)


def checksum_diff(
    source: DataFrame,
    sink: DataFrame,
    bucket_count: int = CHECKSUM_BUCKETS,
    bucket_fn: str = XXHASH64,
) -> DataFrame:
    """Buckets whose row count or checksum differs between two frames of row hashes."""
    compared = bucket_compare(
        bucket_checksum(source, bucket_count, bucket_fn),
        bucket_checksum(sink, bucket_count, bucket_fn),
    )
    return compared.filter("differs").drop("differs")


def checksum_refined(
    source: DataFrame,
    sink: DataFrame,
    coarse: DataFrame,
    bucket_count: int = CHECKSUM_BUCKETS,
    refinement: int = CHECKSUM_REFINEMENT,
    bucket_fn: str = XXHASH64,
) -> DataFrame:
    """Differing buckets of a finer level, looked for inside the differing coarse ones only.

    ``coarse`` holds the differing ``bucket_id`` of ``bucket_count`` buckets; each is cut
    into ``refinement`` parts, so the ids are those of ``bucket_count * refinement``
    buckets.  ``coarse`` is broadcast if ``bucket_count`` or its count proves it small.  Map tasks shuffle at most that many rows however large the table is, and
    rows of clean coarse buckets are dropped before they are grouped.
    """
    ids = coarse.select(F.col("bucket_id").alias(BUCKET))
    if bucket_count <= BROADCAST_BUCKETS or coarse.count() <= BROADCAST_BUCKETS:
        ids = F.broadcast(ids)

    def within(hashes: DataFrame) -> DataFrame:
        return with_bucket(hashes, bucket_count, bucket_fn).join(ids, BUCKET, "left_semi").select(HASH)

    return checksum_diff(within(source), within(sink), bucket_count * refinement, bucket_fn)

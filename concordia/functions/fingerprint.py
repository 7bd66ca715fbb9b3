"""Row fingerprints and the buckets they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BUCKET, FIELD_SEPARATOR, HASH, NULL_SENTINEL
from .canonical import DEFAULT_OPTIONS, CanonicalOptions, canonical_columns, quoted

XXHASH64 = "xxhash64"
SHA_PREFIX = "sha_prefix"


def fingerprint(
    df: DataFrame, options: CanonicalOptions = DEFAULT_OPTIONS, keep_columns: bool = True
) -> DataFrame:
    """Canonical columns plus the SHA-256 of the row; only the hash if not ``keep_columns``."""
    canonical = canonical_columns(df, options)
    names = canonical.columns
    if HASH.upper() in names or BUCKET.upper() in names:
        raise ValueError(f"column names {HASH} and {BUCKET} are reserved")
    row = F.concat_ws(
        FIELD_SEPARATOR, *[F.coalesce(quoted(n), F.lit(NULL_SENTINEL)) for n in names]
    )
    kept = [quoted(n) for n in names] if keep_columns else []
    return canonical.select(*kept, _never_null(F.sha2(row, 256), "").alias(HASH))


def _never_null(c: Column, stand_in: object) -> Column:
    """Tell the optimizer that an expression is not NULL, which none of these ever is.

    Before a join on a nullable key Spark adds a NOT NULL filter and pushes it down to
    the scan, where it would compute every row hash a second time.
    """
    return F.coalesce(c, F.lit(stand_in))


def hash_number(row_hash: Column, bucket_fn: str = XXHASH64) -> Column:
    """64-bit number of a row hash.

    "xxhash64" is Spark's own hash function; "sha_prefix" reads the first 15 hex
    digits, which any SQL engine can recompute.
    """
    if bucket_fn == XXHASH64:
        return F.xxhash64(row_hash)
    if bucket_fn == SHA_PREFIX:
        return F.conv(F.substring(row_hash, 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown bucket function {bucket_fn!r}")


def bucket_of(number: Column, bucket_count: int) -> Column:
    if bucket_count <= 0:
        raise ValueError(f"bucket_count must be positive, got {bucket_count}")
    return _never_null(F.pmod(number, F.lit(bucket_count).cast("bigint")).cast("int"), 0)


def with_bucket(hashes: DataFrame, bucket_count: int, bucket_fn: str = XXHASH64) -> DataFrame:
    return hashes.withColumn(BUCKET, bucket_of(hash_number(F.col(HASH), bucket_fn), bucket_count))

"""Bucket checksums, recomputed in Python."""

from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from concordia.constants import HASH
from concordia.functions.fingerprint import SHA_PREFIX, XXHASH64, fingerprint
from concordia.operators import bucket_checksum, bucket_compare, checksum_diff, checksum_refined
from concordia.sources.sessions import restored_settings
from workload import tables as t
from workload.queries import _dealt_anew

SF = "/root/testdata/sf0.001"


def xxhash64(text):
    """Signed 64-bit xxHash with Spark's seed."""
    number = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return number - (1 << 64) if number >= 1 << 63 else number


NUMBERS = {XXHASH64: xxhash64, SHA_PREFIX: lambda text: int(text[:15], 16)}


def by_hand(hashes, buckets, bucket_fn):
    sums = defaultdict(lambda: [0, 0])
    for h in hashes:
        number = NUMBERS[bucket_fn](h)
        sums[number % buckets][0] += 1
        sums[number % buckets][1] += number
    return {b: tuple(v) for b, v in sums.items()}


def as_dict(checksums):
    return {r.bucket_id: (r.row_count, int(r.bucket_hash)) for r in checksums.collect()}


@pytest.mark.parametrize("bucket_fn", [XXHASH64, SHA_PREFIX])
@pytest.mark.parametrize("name, buckets", [("orders", 1000), ("lineitem", 7)])
def test_checksums_match_python(spark, table, name, buckets, bucket_fn):
    hashes = fingerprint(table(name), keep_columns=False)
    expected = by_hand([r[0] for r in hashes.collect()], buckets, bucket_fn)
    assert as_dict(bucket_checksum(hashes, buckets, bucket_fn)) == expected


@pytest.mark.parametrize("bucket_fn, buckets, ids", [(SHA_PREFIX, 73, 37386), (XXHASH64, 77, 38858)])
def test_differing_buckets_of_the_orders_pair(spark, table, bucket_fn, buckets, ids):
    left = fingerprint(table("orders"), keep_columns=False)
    right = fingerprint(t.sql(spark, SF, t.ORDERS_COPY, "orders"), keep_columns=False)
    diff = checksum_diff(left, right, 1000, bucket_fn).collect()
    assert (len(diff), sum(r.bucket_id for r in diff)) == (buckets, ids)
    a = by_hand([r[0] for r in left.collect()], 1000, bucket_fn)
    b = by_hand([r[0] for r in right.collect()], 1000, bucket_fn)
    assert {r.bucket_id for r in diff} == {k for k in a.keys() | b.keys() if a.get(k) != b.get(k)}


def test_equal_sums_need_equal_counts(spark):
    """A bucket is different when a row is repeated, even if one side lacks the bucket."""
    one = spark.createDataFrame([("x",)], "v string")
    two = one.unionAll(one)
    for left, right in ((one, two), (one, one.limit(0)), (one.limit(0), one)):
        compared = bucket_compare(
            bucket_checksum(fingerprint(left)), bucket_checksum(fingerprint(right))
        )
        assert [r.differs for r in compared.collect()] == [True]


def test_one_hot_row_sums_exactly(spark):
    hashes = spark.range(100_000).select(F.sha2(F.lit("same"), 256).alias("__hash"))
    expected = by_hand([hashes.first()[0]], 1000, XXHASH64)
    ((bucket, (_, number)),) = expected.items()
    assert as_dict(bucket_checksum(hashes)) == {bucket: (100_000, number * 100_000)}


def test_map_tasks_shuffle_few_rows_however_large_they_are(spark):
    """A million distinct rows in one task leave at most one row per bucket."""
    rows = spark.range(0, 1_000_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias(HASH))
    sums = bucket_checksum(rows)
    assert sums.count() == 1000 and sums.agg(F.sum("row_count")).first()[0] == 1_000_000


def test_refined_buckets_are_those_of_the_finer_level(spark):
    def hashes(df):
        return df.select(F.sha2(F.col("id").cast("string"), 256).alias(HASH))

    source, sink = hashes(spark.range(3000)), hashes(spark.range(5, 3002))
    coarse = checksum_diff(source, sink, 50).select("bucket_id")
    fine = checksum_refined(source, sink, coarse, 50, 8)
    assert sorted(fine.collect()) == sorted(checksum_diff(source, sink, 400).collect())



def test_arguments_are_checked(spark, table):
    hashes = fingerprint(table("region"))
    with pytest.raises(ValueError, match="positive"):
        bucket_checksum(hashes, 0)
    with pytest.raises(ValueError, match="__hash"):
        bucket_checksum(table("region"))
    with pytest.raises(ValueError, match="bucket function"):
        bucket_checksum(hashes, 10, "md5")


def test_row_hash_is_computed_once(spark, table):
    """No plan may evaluate the row hash in a filter as well as in the projection."""
    from concordia.operators import row_diff

    left = fingerprint(table("orders"), keep_columns=False)
    differing = spark.createDataFrame([(1,)], "bucket_id int")
    plan = row_diff(left, left, differing)._jdf.queryExecution().executedPlan().toString()
    assert Counter(w for w in plan.split() if "sha2(" in w).total() == 2


def test_a_copy_has_as_many_partitions_as_the_table_is_read_in(spark, table):
    """So a task of the copy gets no more, however large the table is."""
    key = "spark.sql.files.maxPartitionBytes"
    with restored_settings(spark, (key,)):
        spark.conf.set(key, "4k")
        lines = table("lineitem")
        read = lines.rdd.getNumPartitions()
        assert read > 20 and _dealt_anew(lines, 5).rdd.getNumPartitions() == read
    assert _dealt_anew(table("region"), 7).rdd.getNumPartitions() == 7
    assert _dealt_anew(table("region"), 7).exceptAll(table("region")).count() == 0

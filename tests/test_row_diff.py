"""Row differences: known pairs, brute force and properties."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from concordia.constants import BROADCAST_BUCKETS, ONLY_IN_SINK, ONLY_IN_SOURCE
from concordia.functions.canonical import canonical_columns
from concordia.functions.fingerprint import SHA_PREFIX, XXHASH64, fingerprint
from concordia.operators import (
    checksum_diff,
    diff_sample,
    row_diff,
    row_diff_report,
    row_diff_summary,
)
from workload import tables as t

SF = "/root/testdata/sf0.001"


def hashes(df):
    return fingerprint(df, keep_columns=False)


def counts(diff):
    return tuple(row_diff_summary(diff).first())


def two_phase(left, right, buckets=1000, bucket_fn=XXHASH64):
    a, b = hashes(left), hashes(right)
    return row_diff(a, b, checksum_diff(a, b, buckets, bucket_fn), buckets, bucket_fn)


def by_hand(left, right):
    a, b = (Counter(r[0] for r in hashes(df).collect()) for df in (left, right))
    return {(h, a[h], b[h]) for h in a.keys() | b.keys() if a[h] != b[h]}


@pytest.mark.parametrize(
    "name, copy, known",
    [("orders", t.ORDERS_COPY, (32, 31, 14)), ("events", t.EVENTS_COPY, (281, 204, 0))],
)
def test_known_pairs(spark, table, name, copy, known):
    left, right = table(name), t.sql(spark, SF, copy, name)
    diff = two_phase(left, right)
    assert counts(diff) == known
    assert {(r.row_hash, r.src_count, r.sink_count) for r in diff.collect()} == by_hand(left, right)
    mirrored = counts(two_phase(right, left))
    assert mirrored == (known[1], known[0], known[2])


def test_identical_tables(spark, table):
    for name in t.COLUMNS:
        df = table(name)
        other = df.select(*[F.col(c).alias(c.upper()) for c in reversed(df.columns)]).repartition(5)
        assert counts(row_diff(hashes(df), hashes(other))) == (0, 0, 0)


def test_repeated_rows_differ_in_count_only(spark, table):
    orders = table("orders")
    assert counts(two_phase(orders, t.sql(spark, SF, t.ORDERS_REPEATED, "orders"))) == (0, 0, 15)


def test_rows_repeated_on_both_sides_agree(spark, table):
    labels = table("labels")
    assert counts(two_phase(labels.unionAll(labels), labels.unionAll(labels))) == (0, 0, 0)


@pytest.mark.parametrize("buckets", [1, 13, 1000, 50_000])
@pytest.mark.parametrize("bucket_fn", [XXHASH64, SHA_PREFIX])
def test_result_does_not_depend_on_buckets(spark, table, buckets, bucket_fn):
    right = t.sql(spark, SF, t.ORDERS_COPY, "orders")
    assert counts(two_phase(table("orders"), right, buckets, bucket_fn)) == (32, 31, 14)


def test_too_many_buckets_to_broadcast_still_gives_everything(spark, table):
    left, right = hashes(table("orders")), hashes(t.sql(spark, SF, t.ORDERS_COPY, "orders"))
    buckets = BROADCAST_BUCKETS * 2
    diff = row_diff(left, right, checksum_diff(left, right, buckets), buckets)
    assert "Broadcast" not in diff._jdf.queryExecution().executedPlan().toString()
    assert counts(diff) == (32, 31, 14)


@pytest.mark.parametrize("seed", range(4))
def test_random_changes_match_except_all(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(40), rng.choice(["a", "b ", None, ""]), rng.choice([0.5, None, -0.0])) for _ in range(300)]
    changed = [r for r in rows if rng.random() > 0.1] + rng.choices(rows, k=20)
    changed += [(rng.randrange(1000), "new", 1.0) for _ in range(10)]
    rng.shuffle(changed)
    schema = "k int, s string, v double"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)
    diff = two_phase(left, right).collect()
    assert {(r.row_hash, r.src_count, r.sink_count) for r in diff} == by_hand(left, right)
    a, b = canonical_columns(left), canonical_columns(right)
    assert sum(max(r.src_count - r.sink_count, 0) for r in diff) == a.exceptAll(b).count()
    assert sum(max(r.sink_count - r.src_count, 0) for r in diff) == b.exceptAll(a).count()


def test_report_scans_the_tables_once(spark, table):
    """Counts and both samples share one shuffle of the stacked sides."""
    left, right = hashes(table("orders")), hashes(table("orders").filter("o_orderkey % 7 <> 0"))
    report = row_diff_report(row_diff(left, right), 5)
    assert report.collect()[0].only_in_source == 215
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") == 2


def test_third_of_all_rows_is_one_row(spark):
    common = spark.range(60_000).select(F.lit("hot").alias("v"))
    rest = spark.range(120_000).select(F.col("id").cast("string").alias("v"))
    left = common.unionAll(rest)
    right = common.limit(59_999).unionAll(rest.filter("v != '5'"))
    diff = two_phase(left, right).collect()
    assert sorted((r.src_count, r.sink_count, r.diff_kind) for r in diff) == [
        (1, 0, ONLY_IN_SOURCE),
        (60_000, 59_999, "COUNT_DIFFERS"),
    ]


def test_samples_are_the_lowest_hashes(spark, table):
    left, right = table("orders"), t.sql(spark, SF, t.ORDERS_COPY, "orders")
    diff = two_phase(left, right)
    for kind, rows in ((ONLY_IN_SOURCE, left), (ONLY_IN_SINK, right)):
        wanted = sorted(r.row_hash for r in diff.filter(F.col("diff_kind") == kind).collect())
        sample = diff_sample(rows, diff, kind, 10).collect()
        assert [r["__hash"] for r in sample] == wanted[:10]
        whole = diff_sample(rows, diff, kind, 1000).collect()
        assert [r["__hash"] for r in whole] == wanted
        assert diff_sample(rows, diff, kind, 0).count() == 0
    first = sample[0]
    assert first["__row_text"].split("|") == [first["__hash"]] + [first[c] for c in sorted(c.upper() for c in left.columns)]


def test_sample_keeps_columns_named_like_helpers(spark):
    left = spark.createDataFrame([(1, "x"), (2, None)], "bucket_id int, row_hash string")
    right = left.limit(0)
    sample = diff_sample(left, two_phase(left, right), ONLY_IN_SOURCE).collect()
    assert {r["__row_text"].split("|", 1)[1] for r in sample} == {"1|X", "2|null"}


def test_sample_arguments(spark, table):
    df = table("region")
    diff = two_phase(df, df)
    with pytest.raises(ValueError, match="negative"):
        diff_sample(df, diff, ONLY_IN_SOURCE, -1)
    with pytest.raises(ValueError, match="kind"):
        diff_sample(df, diff, "BOTH", 1)

"""Committed attempts, stored differences, leases, kept phases and checksum trees."""

import threading

import pytest
from pyspark.sql import functions as F

from concordia import ParquetTables, Run, SuiteSettings, compare_database, compare_table
from concordia.constants import CATALOG_TABLE
from concordia.functions.canonical import CanonicalOptions, canonical_columns
from concordia.functions.fingerprint import fingerprint
from concordia.operators import checksum_tree, row_diff
from concordia.plans import footer_counts, pending_tables, schema_checks, table_states
from concordia.sources import (
    commit_attempt,
    compact_verdicts,
    files_stamp,
    read_diff_buckets,
    read_diff_rows,
    read_inventory,
    read_running,
    read_verdicts,
    write_diff_rows,
    write_inventory,
    write_running,
    write_verdicts,
)
from concordia.sources.sessions import TUNED, child_session, restored_settings

RUN = Run("r1", "2024-01-01", "DB")


def rows_of(spark, n, changed=()):
    rows = [(i, f"v{i}" + ("!" if i in changed else "")) for i in range(n)]
    return spark.createDataFrame(rows, "k int, v string")


@pytest.fixture
def folders(spark, tmp_path):
    """A snapshot and a lake with a table that differs in two rows and one that does not."""
    for name, changed in (("t1", (3, 7)), ("t2", ())):
        rows_of(spark, 50).write.parquet(f"{tmp_path}/left/app/{name}")
        rows_of(spark, 50, changed).write.parquet(f"{tmp_path}/right/APP/{name.upper()}")
    return f"{tmp_path}/left", f"{tmp_path}/right", f"{tmp_path}/verdicts"


def test_differences_are_stored_whole(spark, folders):
    left, right, root = folders
    compare_database(spark, ParquetTables(spark, left), right, RUN, root, SuiteSettings(parallel_tables=2))
    expected = row_diff(
        fingerprint(spark.read.parquet(f"{left}/app/t1")), fingerprint(spark.read.parquet(f"{right}/APP/T1"))
    )
    stored = read_diff_rows(spark, root, "r1").select("table_name", *expected.columns).collect()
    assert {r.table_name for r in stored} == {"APP.T1"} and len(stored) == 4
    assert sorted(tuple(r)[1:] for r in stored) == sorted(map(tuple, expected.collect()))
    buckets = read_diff_buckets(spark, root, "r1").collect()
    assert {(r.table_name, r.level) for r in buckets} == {("APP.T1", 0)}
    assert sum((r.source_count or 0) + (r.sink_count or 0) for r in buckets) >= 4


def test_half_written_attempts_are_invisible(spark, folders):
    left, right, root = folders
    verdicts = compare_database(spark, ParquetTables(spark, left), right, RUN, root)
    before = sorted(map(str, verdicts.collect()))
    write_verdicts(verdicts.filter("check_type = 'COUNT'").withColumn("status", F.lit("ERROR")), root, "9", commit=False)
    write_diff_rows(read_diff_rows(spark, root).drop("run_id", "db_name", "table_name").limit(1), root, "r1", "DB", "APP.T1", "9")
    inventory = read_inventory(spark, root, "r1").drop("run_id", "db_name")
    write_inventory(inventory.limit(1), root, "r1", "DB", "9")
    assert sorted(map(str, read_verdicts(spark, root, "r1").collect())) == before
    assert read_diff_rows(spark, root).count() == 4 and read_inventory(spark, root).count() == 2
    assert read_verdicts(spark, root, "r1", all_attempts=True).count() == len(before) + 2
    commit_attempt(spark, root, "r1", "DB", ["APP.T1", CATALOG_TABLE], "9")
    assert read_diff_rows(spark, root).count() == 1 and read_inventory(spark, root).count() == 1
    assert [r.status for r in read_verdicts(spark, root, "r1").filter("table_name = 'APP.T1'").collect()] == ["ERROR"]


def test_an_inventory_of_a_failed_listing_is_replaced(spark, folders):
    left, right, root = folders
    spark.range(1).selectExpr("'x'").write.text(f"{left}/app/bad")
    for _ in range(2):
        compare_database(spark, ParquetTables(spark, left), right, RUN, root)
    names = [r.table_name for r in read_inventory(spark, root, "r1").collect()]
    assert sorted(names) == ["APP.BAD", "APP.T1", "APP.T2"]


def test_compaction_keeps_what_is_visible(spark, folders):
    left, right, root = folders
    for db in ("DB", "D B/2"):
        compare_database(spark, ParquetTables(spark, left), right, Run("r1", "2024-01-01", db), root)
    write_verdicts(read_verdicts(spark, root).limit(1), root, "9", commit=False)
    before = sorted(map(str, read_verdicts(spark, root).collect()))
    files = len(set(spark.read.parquet(root).inputFiles()))
    for _ in range(2):
        compact_verdicts(spark, root, "r1", "D B/2")
        assert sorted(map(str, read_verdicts(spark, root).collect())) == before
    assert len(set(spark.read.parquet(root).inputFiles())) < files
    assert read_diff_rows(spark, root).count() == 8 and read_inventory(spark, root).count() == 4
    compare_database(spark, ParquetTables(spark, left), right, Run("r1", "2024-01-01", "DB"), root)
    assert sorted(map(str, read_verdicts(spark, root).collect())) == before


def test_a_table_being_compared_is_in_progress(spark, folders):
    """The scan of one table waits until its state has been looked at."""
    left, right, root = folders
    go_on, begun = threading.Event(), threading.Event()

    class Slow(ParquetTables):
        def scan(self, table_name):
            if threading.current_thread() is not threading.main_thread() and table_name == "APP.T2" and listed.is_set():
                begun.set()
                go_on.wait(60)
            return super().scan(table_name)

        def columns(self):
            listed.set()
            return super().columns()

    listed = threading.Event()
    suite = threading.Thread(
        target=compare_database, args=(spark, Slow(spark, left), right, RUN, root, SuiteSettings(lease_seconds=60))
    )
    suite.start()
    assert begun.wait(120)
    verdicts, running = read_verdicts(spark, root, "r1"), read_running(spark, root, "r1")
    states = {r.table_name: r.state for r in table_states(verdicts, running).collect()}
    later = F.current_timestamp() + F.expr("INTERVAL 1 DAY")
    lapsed = {r.table_name: r.state for r in table_states(verdicts, running, later).collect()}
    wanted = spark.createDataFrame([("r1", "DB", "APP.T2"), ("r1", "DB", "APP.T3")], "run_id string, db_name string, table_name string")
    free = {r.table_name for r in pending_tables(wanted, verdicts, running).collect()}
    freed = {r.table_name for r in pending_tables(wanted, verdicts, running, later).collect()}
    go_on.set()
    suite.join(120)
    assert states["APP.T2"] == "IN_PROGRESS" and lapsed["APP.T2"] == "FAILED"
    assert free == {"APP.T3"} and freed == {"APP.T2", "APP.T3"}
    done = table_states(read_verdicts(spark, root, "r1"), read_running(spark, root, "r1")).collect()
    assert {(r.table_name, r.state) for r in done} == {("APP.T1", "DONE"), ("APP.T2", "DONE")}


def test_leases_are_renewed(spark, tmp_path):
    for seconds in (0, 100):
        write_running(spark, f"{tmp_path}/v", "r1", "DB", ["A.T"], "COMPARE", seconds, "1")
    assert read_running(spark, f"{tmp_path}/v").filter("lease_until > current_timestamp()").count() == 1
    commit_attempt(spark, f"{tmp_path}/v", "r1", "DB", ["a.t"], "1")
    assert read_running(spark, f"{tmp_path}/v").count() == 0


def test_phase_1_is_taken_up_without_reading_data(spark, folders, tmp_path):
    left, right, _ = folders
    sides = spark.read.parquet(f"{left}/app/t1"), spark.read.parquet(f"{right}/APP/T1")
    kept = f"{tmp_path}/phases/T1"
    first = compare_table(*sides, RUN, "APP.T1", phase_folder=kept).drop("duration_ms").collect()

    # The same files and columns, but any row that is read fails the job.
    broken = [s.withColumn("v", F.raise_error(F.lit("data was read")).cast("string")) for s in sides]
    assert files_stamp(*broken) == files_stamp(*sides)
    seen = []
    with pytest.raises(Exception, match="data was read"):
        compare_table(*broken, RUN, "APP.T1", phase_folder=kept, emit=seen.append)
    assert [tuple(r)[:-1] for r in seen] == [tuple(r) for r in first[:3]]

    # New files mean a new phase 1.
    rows_of(spark, 1).write.mode("append").parquet(f"{left}/app/t1")
    with pytest.raises(Exception, match="data was read"):
        changed = spark.read.parquet(f"{left}/app/t1").withColumn("v", F.raise_error(F.lit("data was read")).cast("string"))
        seen.clear()
        compare_table(changed, broken[1], RUN, "APP.T1", phase_folder=kept, emit=seen.append)
    assert [r.check_type for r in seen] == ["SCHEMA"]


def test_a_half_written_phase_is_computed_again(spark, folders, tmp_path):
    left, right, _ = folders
    sides = spark.read.parquet(f"{left}/app/t1"), spark.read.parquet(f"{right}/APP/T1")
    kept = tmp_path / "phases"
    first = compare_table(*sides, RUN, "APP.T1", phase_folder=str(kept)).drop("duration_ms").collect()
    for mark in kept.glob("*/_SUCCESS"):
        mark.unlink()
    assert compare_table(*sides, RUN, "APP.T1", phase_folder=str(kept)).drop("duration_ms").collect() == first


@pytest.mark.parametrize("changed, deep", [((5,), True), (range(400), False), ((), False)])
def test_descent_is_decided_by_counts(spark, changed, deep):
    source, sink = (fingerprint(rows_of(spark, 400, c), keep_columns=False) for c in ((), changed))
    tree = checksum_tree(source, sink, 16, 4, leaf_rows=4)
    assert (tree.levels > 1) == deep and tree.bucket_count == 16 * 4 ** (tree.levels - 1)
    rows = {}
    for r in tree.nodes.collect():
        rows[r.level] = rows.get(r.level, 0) + (r.source_count or 0) + (r.sink_count or 0)
    assert sorted(rows) == (list(range(tree.levels)) if changed else [])
    if deep:
        assert all(rows[i] > 4 for i in range(tree.levels - 1)) and rows[tree.levels - 1] <= 4
    assert tree.touched == sum((r.source_count or 0) + (r.sink_count or 0) for r in tree.leaves.collect())
    diff = row_diff(source, sink, tree.leaves, tree.bucket_count, differing_count=tree.differing)
    assert sorted(diff.collect()) == sorted(row_diff(source, sink).collect())


def test_more_leaves_than_can_be_broadcast_end_the_descent(spark, monkeypatch):
    from concordia.operators import hash_tree

    monkeypatch.setattr(hash_tree, "BROADCAST_BUCKETS", 1)
    source, sink = (fingerprint(rows_of(spark, 400, c), keep_columns=False) for c in ((), (5, 6)))
    assert checksum_tree(source, sink, 16, 4, leaf_rows=1).levels == 1
    assert checksum_tree(source, sink, 16, 1, leaf_rows=1).levels == 1


def test_settings_of_the_caller_stay(spark, folders):
    left, right, root = folders
    before = {key: spark.conf.get(key, None) for key in TUNED}
    compare_database(spark, ParquetTables(spark, left), right, RUN, root, SuiteSettings(parallel_tables=2))
    sides = spark.read.parquet(f"{left}/app/t1"), spark.read.parquet(f"{right}/APP/T1")
    compare_table(*sides, RUN, "APP.T1")
    assert {key: spark.conf.get(key, None) for key in TUNED} == before
    with pytest.raises(ZeroDivisionError), restored_settings(spark):
        spark.conf.set(TUNED[0], 77)
        1 / 0
    assert spark.conf.get(TUNED[0]) == before[TUNED[0]]
    child = child_session(spark)
    child.conf.set(TUNED[0], 78)
    assert spark.conf.get(TUNED[0]) == before[TUNED[0]]
    assert child.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_schema_of_all_tables_is_one_aggregation(spark):
    diff = spark.createDataFrame(
        [("A.T1", "Y", "MISMATCH"), ("A.T1", "X", "MISSING_IN_SINK"), ("A.GONE", "Z", "MISMATCH")],
        "table_name string, column_name string, issue string",
    )
    tables = spark.createDataFrame([("a.t1",), ("A.T2",), ("A.T2",)], "table_name string")
    checks = schema_checks(diff, tables, RUN)
    assert {(r.table_name, r.status, r.detail) for r in checks.collect()} == {
        ("A.T1", "MISMATCH", "X:MISSING_IN_SINK;Y:MISMATCH"), ("A.T2", "OK", ""),
    }


def test_footer_counts_read_no_column(spark, folders):
    left, right, _ = folders
    counts = footer_counts(spark, f"{left}/app/t1", f"{right}/APP/T1")
    assert tuple(counts.first()) == (50, 50)
    plan = counts._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_exact_digits(spark):
    exact, by_value = CanonicalOptions(digits="exact"), CanonicalOptions(digits="exact", numeric="by_value")
    rows = spark.sql(
        "SELECT CAST('1.00000000000000000100' AS DECIMAL(38,20)) a, CAST('1.5' AS DECIMAL(10,4)) b, 0.1D + 0.2D c, "
        "-0.0D d, 12345678901234567890D e, CAST('1E-20' AS DECIMAL(38,20)) f, CAST(100 AS DECIMAL(5,0)) g, 5 h, 1E-12D i"
    )
    assert tuple(canonical_columns(rows, exact).first()) == (
        "1.000000000000000001", "1.5", "0.30000000000000004", "0.0", "1.2345678901234567E19", "0.00000000000000000001",
        "100", "5", "1.0E-12",
    )
    values = canonical_columns(rows, by_value).first()
    assert (values.C, values.D, values.G, values.H) == ("0.30000000000000004", "0", "100", "5")
    same = spark.sql("SELECT 5 a, 5.0D b, CAST(5 AS DECIMAL(38,4)) c, 5.0F d")
    assert set(canonical_columns(same, by_value).first()) == {"5"}
    with pytest.raises(ValueError, match="digits"):
        CanonicalOptions(digits="some")


def test_no_task_gets_all_verdicts_or_commits_of_a_run(spark, tmp_path):
    """Where an advisory partition is small, a database is written by several tasks."""
    root, adaptive = f"{tmp_path}/verdicts", "spark.sql.adaptive"
    sizes = (f"{adaptive}.advisoryPartitionSizeInBytes", f"{adaptive}.coalescePartitions.minPartitionSize")
    values = {"run_id": "r1", "run_time": "", "db_name": "DB", "check_type": "COUNT", "status": "OK"}
    rows = spark.range(20000).select(
        *[F.when(F.col("id") >= 0, v).alias(k) for k, v in values.items()],
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("table_name"),
        *[F.lit("").alias(k) for k in ("source_value", "sink_value", "detail")],
        F.lit(0).cast("long").alias("duration_ms"),
    )

    def files(path):
        return len(set(spark.read.parquet(path).inputFiles()))

    with restored_settings(spark, sizes):
        for key in sizes:
            spark.conf.set(key, "10k")
        write_verdicts(rows, root, "1")
        assert files(f"{root}_commits") > 1
        compact_verdicts(spark, root, "r1", "DB")
        assert files(root) > 1 and files(f"{root}_commits") > 1
    compact_verdicts(spark, root, "r1", "DB")
    assert files(root) == 1 and files(f"{root}_commits") == 1
    assert read_verdicts(spark, root).select("table_name").distinct().count() == 20000

"""Lake folders, the verdict table and intermediate tables."""

import os

import pytest
from pyspark.sql import functions as F

from concordia.functions.fingerprint import fingerprint
from concordia.plans import Run, mismatch_count, mismatches, pending_tables, summary, table_states
from concordia.plans.compare_table import plain_verdict
from concordia.constants import VERDICT_SCHEMA
from concordia.sources import (
    frozen_hashes,
    list_lake_tables,
    read_verdicts,
    scan_lake,
    shared_folder,
    write_verdicts,
)


def test_lake_listing(spark, table, tmp_path):
    base = str(tmp_path)
    for path in ("app/T1", "APP/t2", "_tmp/x", "app/_old", "hr/emp"):
        table("region").write.parquet(f"{base}/{path}")
    os.makedirs(f"{base}/app/empty")
    (tmp_path / "app" / "a_file").write_text("x")
    rows = list_lake_tables(spark, base).collect()
    assert [r.table_name for r in rows] == ["APP.EMPTY", "APP.T1", "APP.T2", "HR.EMP"]
    assert {r.table_name: r.path.split("/")[-2:] for r in rows}["APP.T2"] == ["APP", "t2"]


def test_missing_lake(spark, tmp_path):
    assert list_lake_tables(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(FileNotFoundError):
        list_lake_tables(spark, f"{tmp_path}/none", missing_ok=False)


def test_lake_scan_ignores_case(spark, table, tmp_path):
    table("nation").write.parquet(f"{tmp_path}/App/nation")
    assert scan_lake(spark, str(tmp_path), "app.NATION").count() == 25
    for name, error in (("NATION", ValueError), ("A.B.C", ValueError), ("APP.NONE", FileNotFoundError)):
        with pytest.raises(error):
            scan_lake(spark, str(tmp_path), name)


def verdicts(spark, run_id, db, *rows):
    run = Run(run_id, "2024-01-01", db)
    return spark.createDataFrame([plain_verdict(run, t, c, s, d) for t, c, s, d in rows], VERDICT_SCHEMA)


def test_appends_keep_earlier_rows_and_runs_are_separate(spark, tmp_path):
    root = str(tmp_path / "verdicts")
    assert read_verdicts(spark, root).count() == 0
    write_verdicts(verdicts(spark, "007", "1", ("_CATALOG_", "TABLE_COUNT", "OK", "")), root)
    write_verdicts(verdicts(spark, "007", "1", ("A.T1", "COUNT", "MISMATCH", "x")), root)
    write_verdicts(verdicts(spark, "007", "2", ("A.T1", "COUNT", "OK", "")), root)
    write_verdicts(verdicts(spark, "008", "1", ("A.T1", "COUNT", "OK", "")), root)
    assert read_verdicts(spark, root).count() == 4
    run = read_verdicts(spark, root, "007")
    assert run.schema.fieldNames() == VERDICT_SCHEMA.fieldNames()
    assert {r.db_name for r in run.collect()} == {"1", "2"}
    assert "PartitionFilters: [isnotnull(run_id" in run._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in summary(run).collect()] == [
        ("1", "COUNT", "MISMATCH", 1),
        ("1", "TABLE_COUNT", "OK", 1),
        ("2", "COUNT", "OK", 1),
    ]
    assert mismatch_count(run).first()[0] == 1
    assert [tuple(r) for r in mismatches(read_verdicts(spark, root), "007").collect()] == [
        ("1", "A.T1", "COUNT", "", "", "x")
    ]


def test_states_and_pending_tables(spark):
    rows = verdicts(
        spark, "r1", "erp",
        ("_CATALOG_", "TABLE_COUNT", "ERROR", ""),
        ("A.DONE", "SCHEMA", "MISMATCH", ""), ("A.DONE", "ROW_DIFF", "MISMATCH", ""),
        ("A.RETRIED", "TIMEOUT", "ERROR", ""), ("A.RETRIED", "ROW_DIFF", "OK", ""),
        ("A.FAILED", "READ_SINK", "ERROR", ""),
        ("A.HALF", "SCHEMA", "OK", ""),
    )
    assert {r.table_name: r.state for r in table_states(rows).collect()} == {
        "A.DONE": "DONE", "A.RETRIED": "DONE", "A.FAILED": "FAILED", "A.HALF": "IN_PROGRESS",
    }
    wanted = spark.createDataFrame(
        [("r1", "ERP", f"a.{n}") for n in ("done", "retried", "failed", "half", "new")]
        + [("r2", "ERP", "A.DONE")],
        "run_id string, db_name string, table_name string",
    )
    left = {(r.run_id, r.table_name) for r in pending_tables(wanted, rows).collect()}
    assert left == {("r1", "A.FAILED"), ("r1", "A.HALF"), ("r1", "A.NEW"), ("r2", "A.DONE")}


def test_frozen_hashes_do_not_follow_the_source_and_are_removed(spark, table, tmp_path):
    path = str(tmp_path / "source")
    table("nation").write.parquet(path)
    live = fingerprint(spark.read.parquet(path), keep_columns=False)
    before = sorted(r[0] for r in live.collect())
    folder = shared_folder(spark).removeprefix("file:")
    with frozen_hashes(live) as frozen:
        table("nation").limit(3).write.mode("overwrite").parquet(path)
        assert sorted(r[0] for r in frozen.collect()) == before
        assert any(n.startswith("row-hashes-") for n in os.listdir(folder))
    assert not any(n.startswith("row-hashes-") for n in os.listdir(folder))


def test_shared_folder_is_the_sessions(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


def test_verdict_text_never_null(spark, tmp_path):
    rows = verdicts(spark, "r", "d", ("T", "COUNT", "OK", "")).withColumn("detail", F.lit(None).cast("string"))
    write_verdicts(rows, str(tmp_path / "v"))
    assert read_verdicts(spark, str(tmp_path / "v")).first().detail == ""

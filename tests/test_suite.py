"""Whole tables and whole databases."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from concordia import ParquetTables, Run, SuiteSettings, compare_database, compare_table
from concordia.__main__ import main
from concordia.constants import ROWS_PER_SHUFFLE_TASK
from concordia.operators.row_diff import size_shuffle
from concordia.plans import read_check
from concordia.plans.compare_database import TimeLimitReached, run_limited
from concordia.plans.compare_table import error_text
from concordia.sources import list_lake_tables, read_inventory, read_verdicts
from workload import tables as t

SF = "/root/testdata/sf0.001"
RUN = Run("r1", "2024-01-01", "ERP")


def by_check(verdicts):
    return {r.check_type: r for r in verdicts.collect()}


def test_differing_table(spark, table):
    copy = t.sql(spark, SF, t.ORDERS_COPY, "orders")
    found = by_check(compare_table(table("orders"), copy, RUN, "APP.ORDERS"))
    assert {k: v.status for k, v in found.items()} == {
        "SCHEMA": "OK", "COUNT": "MISMATCH", "CHECKSUM": "MISMATCH", "ROW_DIFF": "MISMATCH",
    }
    assert found["COUNT"].detail == "Mismatch 13 rows"
    assert (found["CHECKSUM"].source_value, found["CHECKSUM"].sink_value) == ("1000", "923")
    assert (found["ROW_DIFF"].source_value, found["ROW_DIFF"].sink_value) == ("32", "31")
    assert "count_mismatch=14" in found["ROW_DIFF"].detail
    assert all(r.duration_ms >= 0 for r in found.values())


def test_clean_table_skips_the_row_diff(spark, table):
    found = by_check(compare_table(table("labels"), table("labels").repartition(3), RUN, "L"))
    assert {v.status for v in found.values()} == {"OK"}
    assert "skipped" in found["ROW_DIFF"].detail


@pytest.mark.parametrize("multiset, status", [(True, "MISMATCH"), (False, "OK")])
def test_copies_count_unless_told_otherwise(spark, table, multiset, status):
    copy = t.sql(spark, SF, t.ORDERS_REPEATED, "orders")
    found = by_check(compare_table(table("orders"), copy, RUN, "O", multiset=multiset))
    assert (found["CHECKSUM"].status, found["ROW_DIFF"].status) == ("MISMATCH", status)


@pytest.mark.parametrize(
    "settings", [{"refinement": 8}, {"bucket_count": 3}, {"reuse": "freeze_source"}, {"reuse": "cache"}, {"bucket_fn": "sha_prefix"}]
)
def test_settings_do_not_change_the_result(spark, table, settings):
    copy = t.sql(spark, SF, t.ORDERS_COPY, "orders")
    found = by_check(compare_table(table("orders"), copy, RUN, "O", **settings))
    assert (found["ROW_DIFF"].source_value, found["ROW_DIFF"].sink_value) == ("32", "31")


def test_empty_tables(spark, table):
    empty = table("orders").limit(0)
    assert {v.status for v in by_check(compare_table(empty, empty, RUN, "O")).values()} == {"OK"}
    found = by_check(compare_table(table("region"), table("region").limit(0), RUN, "R"))
    assert (found["COUNT"].sink_value, found["ROW_DIFF"].source_value) == ("0", "5")


def test_extra_column_breaks_hashes_unless_ignored(spark, table):
    wide = table("region").withColumn("loaded", F.lit(1))
    assert by_check(compare_table(table("region"), wide, RUN, "R"))["CHECKSUM"].status == "MISMATCH"
    found = by_check(compare_table(table("region"), wide, RUN, "R", columns="common"))
    assert (found["SCHEMA"].status, found["CHECKSUM"].status) == ("MISMATCH", "OK")
    with pytest.raises(ValueError, match="common"):
        compare_table(table("region"), table("nation"), RUN, "R", columns="common")
    with pytest.raises(ValueError, match="reuse"):
        compare_table(table("region"), wide, RUN, "R", reuse="always")
    with pytest.raises(ValueError, match="columns"):
        compare_table(table("region"), wide, RUN, "R", columns="some")


def test_declared_types_are_checked_by_category(spark, table):
    declared = spark.createDataFrame(
        [("app.region", "R_REGIONKEY", "NUMBER"), ("APP.REGION", "R_NAME", "DATE"), ("APP.X", "Y", "CLOB")],
        "table_name string, column_name string, data_type string",
    )
    found = by_check(
        compare_table(table("region"), table("region"), RUN, "APP.REGION", source_columns=declared, dialect="oracle")
    )
    assert (found["SCHEMA"].status, found["SCHEMA"].detail) == ("MISMATCH", "R_NAME:MISMATCH")


def test_read_check():
    frame, verdict = read_check(lambda: 1 / 0, RUN, "A.T", "sink")
    assert frame is None and (verdict.check_type, verdict.status) == ("READ_SINK", "ERROR")
    assert read_check(lambda: "df", RUN, "A.T", "source") == ("df", None)
    assert error_text(KeyError()) == "KeyError"
    assert len(error_text(ValueError("x" * 900))) == 500


class Snapshot(ParquetTables):
    """A source with one table that cannot be opened and one that is slow."""

    def scan(self, table_name):
        if table_name == "APP.BROKEN" and self.broken:
            raise OSError("disk gone")
        return super().scan(table_name)

    def tables(self):
        self.broken = False
        found = super().tables()
        return found

    def columns(self):
        found = super().columns()
        self.broken = True
        return found


@pytest.fixture
def two_sides(spark, table, tmp_path):
    left, right = f"{tmp_path}/left", f"{tmp_path}/right"
    for name, frame in (("a", table("region")), ("broken", table("nation")), ("c", table("labels"))):
        frame.write.parquet(f"{left}/app/{name}")
        frame.write.parquet(f"{right}/APP/{name.upper()}")
    return left, right, f"{tmp_path}/verdicts"


def test_one_failing_table_does_not_stop_the_others_and_a_rerun_finishes_it(spark, two_sides):
    left, right, root = two_sides
    settings = SuiteSettings()
    rows = compare_database(spark, Snapshot(spark, left), right, RUN, root, settings).collect()
    checks = sorted((r.table_name, r.check_type, r.status) for r in rows if r.table_name != "APP.A")
    assert checks == [
        ("APP.BROKEN", "READ_SOURCE", "ERROR"),
        ("APP.C", "CHECKSUM", "OK"), ("APP.C", "COUNT", "OK"), ("APP.C", "ROW_DIFF", "OK"), ("APP.C", "SCHEMA", "OK"),
        ("_CATALOG_", "TABLE_COUNT", "OK"),
    ]
    again = compare_database(spark, ParquetTables(spark, left), right, RUN, root, settings).collect()
    # The error of the first attempt gives way to the four verdicts of the second.
    assert len(again) == len(rows) + 3
    assert {r.table_name for r in again if r not in rows} == {"APP.BROKEN"}
    assert not [r for r in again if r.status == "ERROR"]
    assert read_verdicts(spark, root, "r1", all_attempts=True).count() == len(rows) + 4
    assert len(compare_database(spark, ParquetTables(spark, left), right, RUN, root).collect()) == len(again)


def test_lake_folders_that_differ_by_case_are_an_error(spark, two_sides):
    left, right, root = two_sides
    spark.range(3).write.parquet(f"{left}/app/z")
    spark.range(3).write.parquet(f"{right}/app/z")
    spark.range(5).write.parquet(f"{right}/APP/Z")
    found = compare_database(spark, ParquetTables(spark, left), right, RUN, root)
    row = found.filter("table_name = 'APP.Z'").collect()
    assert [(r.check_type, r.status) for r in row] == [("READ_SINK", "ERROR")]
    assert "app/z" in row[0].detail and "APP/Z" in row[0].detail


def test_every_missing_table_is_stored(spark, tmp_path):
    for i in range(53):
        (tmp_path / "left" / "app" / f"t{i}").mkdir(parents=True)
    spark.range(1).write.parquet(f"{tmp_path}/right/app/x")

    class Names(ParquetTables):
        def tables(self):
            names = list_lake_tables(self.spark, self.base).select("table_name")
            return names.withColumn("has_rows", F.lit(True))

    root = f"{tmp_path}/verdicts"
    compare_database(spark, Names(spark, f"{tmp_path}/left"), f"{tmp_path}/right", RUN, root)
    assert read_inventory(spark, root, "r1").filter("status = 'MISSING_IN_SINK'").count() == 53


def test_tables_compared_at_the_same_time(spark, two_sides):
    left, right, root = two_sides
    settings = SuiteSettings(parallel_tables=3)
    rows = compare_database(spark, ParquetTables(spark, left), right, RUN, root, settings).collect()
    assert len(rows) == 13 and {r.status for r in rows} == {"OK"}


def test_missing_lake_is_an_error_verdict(spark, two_sides):
    left, _, root = two_sides
    rows = compare_database(spark, ParquetTables(spark, left), "/nowhere/at/all", RUN, root).collect()
    assert [(r.table_name, r.check_type, r.status) for r in rows] == [("_CATALOG_", "TABLE_COUNT", "ERROR")]


CATALOGUE = [
    {
        "name": name, "dbType": db_type, "jdbcUrl": "jdbc:none:x", "user": "u", "password": "p",
        "driver": "no.such.Driver", "hdfsBasePath": "/lake",
    }
    for name, db_type in (("ERP", "oracle"), ("CMIS", "db2"))
]


def test_unreachable_databases_do_not_stop_each_other(spark, tmp_path, capsys):
    """Neither the driver class nor the second kind of database exists."""
    (tmp_path / "databases.json").write_text(json.dumps(CATALOGUE))
    main([f"{tmp_path}/databases.json", f"{tmp_path}/verdicts", "--run-id", "r9"])
    rows = read_verdicts(spark, f"{tmp_path}/verdicts", "r9").collect()
    assert {(r.db_name, r.check_type, r.status) for r in rows} == {
        ("ERP", "TABLE_COUNT", "ERROR"), ("CMIS", "TABLE_COUNT", "ERROR"),
    }
    assert not any("jdbc:" in r.detail for r in rows)
    shown = capsys.readouterr().out
    assert "Run r9" in shown and "0 mismatches" in shown


def test_run_named_after_its_start():
    run = Run.starting(datetime(2024, 1, 2, 3, 4, 5), "ERP")
    assert (run.run_id, run.run_time, run.db_name) == ("20240102_030405", "2024-01-02", "ERP")


def test_shuffle_grows_with_the_rows_to_compare(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size_shuffle(spark, 1000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        size_shuffle(spark, 100 * ROWS_PER_SHUFFLE_TASK + 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "101"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def unreadable(frame, column):
    """Any row that is read fails the job."""
    return frame.withColumn(column, F.raise_error(F.lit("a row was read")).cast(frame.schema[column].dataType))


def test_a_failing_check_is_a_verdict(spark, table):
    seen = []
    region = table("region")
    found = by_check(
        compare_table(unreadable(region, "r_name"), region, RUN, "R", errors="verdict", emit=seen.append)
    )
    assert {k: v.status for k, v in found.items()} == {
        "SCHEMA": "OK", "COUNT": "ERROR", "CHECKSUM": "ERROR", "ROW_DIFF": "ERROR",
    }
    assert "a row was read" in found["COUNT"].detail and "Not run" in found["ROW_DIFF"].detail
    assert [r.check_type for r in seen] == ["SCHEMA", "COUNT", "CHECKSUM", "ROW_DIFF"]
    with pytest.raises(Exception, match="a row was read"):
        compare_table(unreadable(region, "r_name"), region, RUN, "R")
    with pytest.raises(ValueError, match="errors"):
        compare_table(region, region, RUN, "R", errors="ignore")


def test_a_failing_column_list_does_not_stop_the_other_checks(spark, table):
    region = table("region")
    declared = spark.createDataFrame([("R", "R_NAME", "string")], "table_name string, column_name string, data_type string")
    bad = unreadable(declared, "column_name")
    found = by_check(compare_table(region, region, RUN, "R", source_columns=bad, errors="verdict"))
    assert {k: v.status for k, v in found.items()} == {
        "SCHEMA": "ERROR", "COUNT": "OK", "CHECKSUM": "OK", "ROW_DIFF": "OK",
    }


def test_a_failing_row_diff_keeps_counts_and_checksums(spark, table):
    def broken_store(diff):
        raise OSError("no room for differences")

    copy = t.sql(spark, SF, t.ORDERS_COPY, "orders")
    found = by_check(compare_table(table("orders"), copy, RUN, "O", errors="verdict", store_rows=broken_store))
    assert [found[c].status for c in ("COUNT", "CHECKSUM", "ROW_DIFF")] == ["MISMATCH", "MISMATCH", "ERROR"]
    assert found["ROW_DIFF"].detail == "no room for differences" and found["ROW_DIFF"].duration_ms >= 0


def slow_frame(spark):
    return spark.range(200, numPartitions=200).select(
        F.expr("java_method('java.lang.Thread', 'sleep', id * 0 + 1000L)").alias("x")
    )


def test_time_limit_cancels_the_jobs(spark):
    start = time.monotonic()
    with pytest.raises(TimeLimitReached):
        run_limited(spark, lambda: slow_frame(spark).agg(F.count("x")).collect(), 2, "slow-one")
    assert time.monotonic() - start < 15
    time.sleep(3)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_time_limit_verdict(spark, two_sides):
    left, right, root = two_sides
    settings = SuiteSettings(time_limit_seconds=0.01)
    rows = compare_database(spark, ParquetTables(spark, left), right, RUN, root, settings).collect()
    assert {r.check_type for r in rows if r.status == "ERROR"} == {"TIMEOUT"}
    stored = read_verdicts(spark, root, "r1").filter("check_type = 'TIMEOUT'").first()
    assert "0.01 seconds" in stored.detail


def test_a_table_list_restricts_the_run(spark, table, tmp_path):
    for base in ("source", "lake"):
        for name in ("region", "nation", "part"):
            table(name).write.parquet(f"{tmp_path}/{base}/app/{name}")
    settings = SuiteSettings(tables={"ERP": ["app.region", "APP.GONE", "APP.REGION"]}, parallel_tables=2)
    rows = compare_database(
        spark, ParquetTables(spark, f"{tmp_path}/source"), f"{tmp_path}/lake", RUN, f"{tmp_path}/v", settings
    ).collect()
    assert {r.table_name: r.status for r in rows} == {"_CATALOG_": "OK", "APP.REGION": "OK", "APP.GONE": "ERROR"}


def test_samples_are_handed_out_only_if_rows_differ(spark, table):
    found = {}
    copy = t.sql(spark, SF, t.ORDERS_COPY, "orders")
    options = {"samples": lambda side, rows: found.setdefault(side, rows.collect()), "reuse": "freeze_source"}
    compare_table(table("labels"), table("labels"), RUN, "L", **options)
    assert found == {}
    compare_table(table("orders"), copy, RUN, "O", sample_size=7, **options)
    assert {side: len(rows) for side, rows in found.items()} == {"source": 7, "sink": 7}


def test_command_line_settings_reach_the_suite(spark, tmp_path, monkeypatch):
    import concordia.__main__ as entry

    seen = {}

    def compared(spark, configs, run_id, run_time, root, settings):
        seen["settings"] = settings
        return spark.createDataFrame([], read_verdicts(spark, root, run_id).schema)

    monkeypatch.setattr(entry, "compare_databases", compared)
    (tmp_path / "databases.json").write_text(json.dumps(CATALOGUE))
    (tmp_path / "tables.json").write_text(json.dumps([{"database": "erp", "tables": ["a.t"]}]))
    main([
        f"{tmp_path}/databases.json", f"{tmp_path}/v", "--tables", f"{tmp_path}/tables.json", "--time-limit", "5",
        "--ntz-zone", "UTC", "--numeric", "by_value", "--nested", "by_options", "--bucket-count", "64",
    ])
    settings = seen["settings"]
    assert (settings.time_limit_seconds, settings.tables) == (300, {"ERP": ["A.T"]})
    assert settings.compare["bucket_count"] == 64
    chosen = settings.compare["options"]
    assert (chosen.ntz_zone, chosen.numeric, chosen.nested) == ("UTC", "by_value", "by_options")

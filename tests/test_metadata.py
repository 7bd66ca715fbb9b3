"""Column lists, table lists and configuration files."""

import json

import pytest

from concordia.operators import columns_of, inventory_report, schema_diff, table_inventory_diff
from concordia.plans import Run, schema_check, table_inventory_check
from concordia.sources import (
    load_databases,
    load_table_list,
    table_list_entries,
    tables_per_database,
)

RUN = Run("r1", "2024-01-01", "ERP")
COLUMNS = "table_name string, column_name string, data_type string"


def test_schema_of_orders(spark, table):
    declared = spark.createDataFrame(
        [
            ("app.orders", c, d)
            for c, d in (
                ("O_ORDERKEY", "NUMBER"), ("o_custkey", "VARCHAR2"), ("O_ORDERSTATUS", "CHAR"),
                ("O_TOTALPRICE", "NUMBER"), ("O_ORDERDATE", "DATE"), ("O_COMMENT", "VARCHAR2"),
            )
        ],
        COLUMNS,
    )
    landed = columns_of(spark, "APP.ORDERS", table("orders").schema)
    diff = schema_diff(declared, landed, "oracle")
    assert sorted((r.column_name, r.issue) for r in diff.collect()) == [
        ("O_COMMENT", "MISSING_IN_SINK"),
        ("O_CUSTKEY", "MISMATCH"),
        ("O_ORDERPRIORITY", "MISSING_IN_SOURCE"),
    ]
    row = schema_check(diff, RUN, "app.orders").first()
    assert row.status == "MISMATCH"
    assert row.detail == (
        "O_COMMENT:MISSING_IN_SINK;O_CUSTKEY:MISMATCH;O_ORDERPRIORITY:MISSING_IN_SOURCE"
    )
    assert schema_check(diff, RUN, "APP.OTHER").first().status == "OK"


def test_columns_of_unknown_type_still_count_as_present(spark):
    declared = spark.createDataFrame([("T", "A", None)], COLUMNS)
    landed = spark.createDataFrame([("T", "a", "string")], COLUMNS)
    assert [r.issue for r in schema_diff(declared, landed, "mysql").collect()] == ["MISMATCH"]


def inventory(spark, source, lake):
    return table_inventory_diff(
        spark.createDataFrame(source, "table_name string, has_rows boolean"),
        spark.createDataFrame([(t,) for t in lake], "table_name string"),
    )


def test_inventory(spark):
    diff = inventory(
        spark,
        [("a.t1", True), ("A.T2", True), ("A.T3", False), ("A.T4", True), ("A.T5", False)],
        ["A.T1", "a.t3", "A.T9"],
    )
    assert {r.table_name: (r.status, r.reason) for r in diff.collect()} == {
        "A.T1": ("COMMON", None),
        "A.T2": ("MISSING_IN_SINK", None),
        "A.T3": ("EXTRA_IN_SINK", "EMPTY_IN_SOURCE"),
        "A.T4": ("MISSING_IN_SINK", None),
        "A.T5": ("SKIPPED_EMPTY", None),
        "A.T9": ("EXTRA_IN_SINK", "ABSENT_IN_SOURCE"),
    }
    row = table_inventory_check(diff, RUN).first()
    assert (row.status, row.source_value, row.sink_value) == ("MISMATCH", "3", "3")
    assert row.detail == (
        "skipped_empty_in_source=A.T3,A.T5|missing_in_sink=A.T2,A.T4|extra_in_sink=A.T3,A.T9"
    )
    report = inventory_report(diff).first()
    assert (report.source_tables, report.common, report.missing_in_sink, report.extra_in_sink) == (5, 1, 2, 2)


def test_equal_inventories_and_long_lists(spark):
    names = [f"A.T{i:03d}" for i in range(120)]
    same = inventory(spark, [(n, True) for n in names], names)
    assert table_inventory_check(same, RUN).first().status == "OK"
    lost = table_inventory_check(inventory(spark, [(n, True) for n in names], ["A.T000"]), RUN).first()
    assert lost.detail.split("missing_in_sink=")[1].split("|")[0] == ",".join(names[1:51])
    assert lost.source_value == "120"


def test_failed_probe_is_an_error_not_an_empty_table(spark):
    row = table_inventory_check(inventory(spark, [("A.T1", None)], ["A.T1"]), RUN).first()
    assert row.status == "ERROR"
    assert row.detail.endswith("|probe_failed=A.T1")


def write(tmp_path, content):
    path = tmp_path / "config.json"
    path.write_text(json.dumps(content, indent=2))
    return str(path)


DATABASE = {
    "name": " ERP ", "dbType": "Oracle", "jdbcUrl": "jdbc:oracle:thin:@//host/x", "user": "u",
    "password": "secret", "driver": "d", "hdfsBasePath": "/lake\t",
}


def test_database_catalogue(spark, tmp_path):
    (config,) = load_databases(spark, write(tmp_path, [DATABASE]))
    assert (config.name, config.db_type, config.lake_base) == ("ERP", "oracle", "/lake")
    assert "secret" not in repr(config) and "jdbc:" not in repr(config)


@pytest.mark.parametrize("change", [{"user": None}, {"password": " \t"}])
def test_database_catalogue_needs_every_value(spark, tmp_path, change):
    with pytest.raises(ValueError, match="empty value"):
        load_databases(spark, write(tmp_path, [DATABASE, DATABASE | change]))


def test_database_catalogue_needs_every_column(spark, tmp_path):
    short = {k: v for k, v in DATABASE.items() if k != "driver"}
    with pytest.raises(ValueError, match="driver"):
        load_databases(spark, write(tmp_path, [short]))


def test_splits_of_the_database_catalogue(spark, tmp_path):
    splits = [
        {"table": "app.orders ", "partitionColumn": "ID", "numPartitions": 8},
        {"table": "APP.LINES", "predicates": ["a = 1", "a <> 1 OR a IS NULL"]},
    ]
    first, second = load_databases(spark, write(tmp_path, [DATABASE | {"splits": splits}, DATABASE]))
    assert first.splits == {
        "APP.ORDERS": {"partition_column": "ID", "num_partitions": 8},
        "APP.LINES": {"predicates": ["a = 1", "a <> 1 OR a IS NULL"]},
    }
    assert second.splits == {}
    for bad in ({"table": "A.B"}, {"table": "A.B", "partitionColumn": "X"}, {"predicates": ["a = 1"]}):
        with pytest.raises(ValueError, match="split"):
            load_databases(spark, write(tmp_path, [DATABASE | {"splits": [bad]}]))


def test_password_from_the_environment(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("ERP_PASSWORD", "from-env")
    (config,) = load_databases(spark, write(tmp_path, [DATABASE | {"password": "env:ERP_PASSWORD"}]))
    assert config.resolved_password() == "from-env"


def test_table_catalogue(spark, tmp_path):
    path = write(
        tmp_path,
        [
            {"database": " erp ", "tables": ["a.t1", " A.T1 ", "", None, "a.t2"]},
            {"database": "ERP", "tables": ["a.t3"]},
            {"database": "CMIS", "tables": None},
        ],
    )
    found = {r.database: r.tables for r in load_table_list(spark, path).collect()}
    assert found == {"ERP": ["A.T1", "A.T2", "A.T3"], "CMIS": []}
    entries = spark.read.option("multiLine", True).json(path)
    assert {tuple(r) for r in tables_per_database(entries).collect()} == {("ERP", 3), ("CMIS", 0)}


def test_table_catalogue_with_only_null_lists(spark, tmp_path):
    path = write(tmp_path, [{"database": "a", "tables": None}])
    entries = spark.read.schema("database string, tables string").option("multiLine", True).json(path)
    assert [tuple(r) for r in table_list_entries(entries).collect()] == [("A", None)]


@pytest.mark.parametrize(
    "entry, message",
    [
        ({"database": None, "tables": ["x"], "n": 1}, "without database"),
        ({"database": " ", "tables": ["x"]}, "without database"),
        ({"database": "a", "tables": "x"}, "must be an array"),
    ],
)
def test_bad_table_catalogue_entries(spark, tmp_path, entry, message):
    with pytest.raises(Exception, match=message):
        load_table_list(spark, write(tmp_path, [entry])).collect()


def test_table_catalogue_needs_its_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="columns"):
        load_table_list(spark, write(tmp_path, [{"db": "a"}]))

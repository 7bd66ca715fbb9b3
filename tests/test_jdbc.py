"""Queries and options for relational sources, checked as text.

No database is started here; only what would be sent to one is checked.
"""

import datetime as dt
from decimal import Decimal

import pytest

from concordia.sources import jdbc
from concordia.sources.catalogs import DatabaseConfig


def config(db_type="oracle", **changes):
    values = {
        "name": "ERP", "db_type": db_type, "jdbc_url": "jdbc:x", "user": "u", "password": "p",
        "driver": "", "lake_base": "/lake",
    }
    return DatabaseConfig(**(values | changes))


def test_table_lists():
    oracle = jdbc.dialect_of("Oracle").tables_query()
    assert oracle.startswith("SELECT OWNER AS owner_name, TABLE_NAME AS bare_name FROM ALL_TABLES WHERE")
    assert "'SYS', 'SYSTEM'" in oracle and "OWNER NOT LIKE 'C##%'" in oracle
    mysql = jdbc.dialect_of(" mysql ").tables_query()
    assert "TABLE_TYPE = 'BASE TABLE' AND TABLE_SCHEMA NOT IN ('information_schema', 'mysql'" in mysql
    mssql = jdbc.dialect_of("mssql").tables_query()
    assert "FROM sys.tables WHERE SCHEMA_NAME(schema_id) NOT IN ('sys', 'INFORMATION_SCHEMA'" in mssql
    assert [len(jdbc.DIALECTS[d].system_schemas) for d in ("oracle", "mysql", "mssql")] == [22, 4, 12]
    with pytest.raises(ValueError, match="unsupported"):
        jdbc.dialect_of("db2")


@pytest.mark.parametrize(
    "db_type, source", [("oracle", "ALL_TAB_COLUMNS"), ("mysql", "INFORMATION_SCHEMA.COLUMNS"), ("mssql", "INFORMATION_SCHEMA.COLUMNS")]
)
def test_column_lists_cover_all_tables_in_one_query(db_type, source):
    sql = jdbc.dialect_of(db_type).columns_query()
    assert f"FROM {source} WHERE" in sql and "COLUMN_NAME AS column_name" in sql and "=" not in sql


@pytest.mark.parametrize(
    "db_type, probe",
    [
        ("oracle", "SELECT 'A.O''B' AS table_name FROM (SELECT 1 AS has_row FROM \"a\".\"o'b\" WHERE ROWNUM = 1) p0"),
        ("mysql", "SELECT 'A.O''B' AS table_name FROM (SELECT 1 AS has_row FROM `a`.`o'b` LIMIT 1) p0"),
        ("mssql", "SELECT 'A.O''B' AS table_name FROM (SELECT TOP 1 1 AS has_row FROM [a].[o'b]) p0"),
    ],
)
def test_probe(db_type, probe):
    dialect = jdbc.dialect_of(db_type)
    assert dialect.probe_query([("A.O'B", "a", "o'b")]) == probe
    two = dialect.probe_query([("A.X", "a", "x"), ("A.Y", "a", "y")])
    assert two.count(" UNION ALL ") == 1 and ") p1" in two


def test_identifiers_are_quoted():
    assert jdbc.dialect_of("mssql").relation("a]b", "t") == "[a]]b].[t]"
    assert jdbc.dialect_of("mysql").quote("x`y") == "`x``y`"


def test_connection_options(monkeypatch):
    monkeypatch.setenv("DB_PW", "hidden")
    options = jdbc.connection_options(config("mysql", password="env:DB_PW"))
    assert options == {
        "url": "jdbc:x", "user": "u", "password": "hidden",
        "driver": "com.mysql.cj.jdbc.Driver", "fetchsize": "5000",
    }
    assert jdbc.connection_options(config(driver="own.Driver"))["driver"] == "own.Driver"


def test_scan_options():
    plain = jdbc.scan_options(config(), "APP", "T1")
    assert plain["dbtable"] == '(SELECT * FROM "APP"."T1") t'
    assert plain["numPartitions"] == "1" and "partitionColumn" not in plain
    split = jdbc.scan_options(config(), "APP", "T1", "ID", 1, dt.date(2024, 1, 1), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "ID", "1", "2024-01-01", "8",
    )
    with pytest.raises(ValueError, match="lower_bound"):
        jdbc.scan_options(config(), "APP", "T1", "ID")


class FakeReader:
    """Stands in for spark.read: records options, returns a fixed row or frame."""

    def __init__(self, log, answer):
        self.log, self.answer, self.set = log, answer, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.set |= options
        return self

    def option(self, key, value):
        self.set[key] = value
        return self

    def load(self):
        self.log.append(self.set)
        return self.answer(self.set)

    def jdbc(self, url, table, predicates, properties):
        self.log.append({"dbtable": table, "predicates": predicates} | properties)


class FakeSpark:
    def __init__(self, answer, real=None):
        self.log, self.answer, self.real = [], answer, real

    @property
    def read(self):
        return FakeReader(self.log, self.answer)

    def createDataFrame(self, *args):
        return self.real.createDataFrame(*args)


class OneRow:
    def __init__(self, *values):
        self.values = values

    def first(self):
        return self.values

    def collect(self):
        return [(v,) for v in self.values]


def test_parallel_scan_asks_for_bounds():
    spark = FakeSpark(lambda options: OneRow(Decimal("1.5"), Decimal("99.5")))
    jdbc.scan_jdbc(spark, config(), "APP", "T1", "ID", 4)
    assert spark.log[0]["dbtable"] == '(SELECT MIN("ID") AS lo, MAX("ID") AS hi FROM "APP"."T1") t'
    assert (spark.log[1]["lowerBound"], spark.log[1]["upperBound"], spark.log[1]["numPartitions"]) == ("1", "100", "4")


def test_scan_of_an_empty_or_constant_key_is_not_split():
    for bounds in ((None, None), (5, 5)):
        spark = FakeSpark(lambda options, b=bounds: OneRow(*b))
        jdbc.scan_jdbc(spark, config(), "APP", "T1", "ID", 4)
        assert spark.log[1]["numPartitions"] == "1" and "partitionColumn" not in spark.log[1]


def test_scan_by_predicates():
    spark = FakeSpark(None)
    jdbc.scan_jdbc(spark, config(), "APP", "T1", predicates=["a = 1", "a <> 1 OR a IS NULL"])
    assert spark.log[0]["predicates"] == ["a = 1", "a <> 1 OR a IS NULL"]
    assert "url" not in spark.log[0] and spark.log[0]["fetchsize"] == "5000"


def test_one_bad_table_does_not_spoil_the_probe_of_others(spark):
    from pyspark.errors import PySparkException

    def answer(options):
        if "BAD" in options["dbtable"]:
            raise PySparkException("no such table")
        return OneRow(*(n for n in ("A.FULL", "A.MORE") if f"'{n}'" in options["dbtable"]))

    fake = FakeSpark(answer, spark)
    names = ["A.FULL", "A.EMPTY", "A.BAD", "A.MORE"]
    found = jdbc.non_empty_tables(fake, config(), [(n, *n.split(".")) for n in names])
    assert {r.table_name: r.has_rows for r in found.collect()} == {
        "A.FULL": True, "A.EMPTY": False, "A.BAD": None, "A.MORE": True,
    }
    assert len(fake.log) == 1 + len(names)


def test_scan_uses_the_splits_of_the_catalogue():
    from concordia.plans.compare_database import JdbcTables

    spark = FakeSpark(None)
    tables = JdbcTables(spark, config(splits={"app.t1": {"predicates": ["a = 1", "a <> 1"]}}))
    tables._names = {"APP.T1": [("APP", "T1")]}
    tables.scan("APP.T1")
    assert spark.log[0]["predicates"] == ["a = 1", "a <> 1"]


@pytest.mark.parametrize(
    "db_type, source, rows",
    [
        ("oracle", "FROM ALL_TABLES WHERE OWNER NOT IN", "NUM_ROWS AS row_estimate"),
        ("mysql", "FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_SCHEMA NOT IN", "TABLE_ROWS AS row_estimate"),
        ("mssql", "p.index_id IN (0, 1) GROUP BY t.schema_id, t.name) s WHERE owner_name NOT IN", "row_count AS row_estimate"),
    ],
)
def test_sizes_come_from_the_dictionary_in_one_query(db_type, source, rows):
    sql = jdbc.dialect_of(db_type).sizes_query()
    assert source in sql and rows in sql and sql.startswith("SELECT ")


@pytest.mark.parametrize(
    "db_type, key, first, last",
    [
        ("oracle", [], "ORA_HASH(ROWID, 2) = 0", "ORA_HASH(ROWID, 2) = 2"),
        (
            "mysql",
            [("b`", 2), ("a", 1)],
            "MOD(CRC32(CONCAT_WS(',', `a`, `b```)), 3) = 0",
            "MOD(CRC32(CONCAT_WS(',', `a`, `b```)), 3) = 2",
        ),
        (
            "mssql",
            [("ID", 1)],
            "ABS(CAST(CHECKSUM([ID]) AS BIGINT)) % 3 = 0",
            "ABS(CAST(CHECKSUM([ID]) AS BIGINT)) % 3 = 2",
        ),
        (
            "mssql",
            [],
            "ABS(CAST(CHECKSUM(%%physloc%%) AS BIGINT)) % 3 = 0",
            "ABS(CAST(CHECKSUM(%%physloc%%) AS BIGINT)) % 3 = 2",
        ),
    ],
)
def test_large_tables_are_dealt_by_key_or_address(db_type, key, first, last):
    spark = FakeSpark(lambda options: Rows(key))
    split = jdbc.planned_split(spark, config(db_type), "app", "o'b", 25, rows_per_task=10)
    assert [split["predicates"][i] for i in (0, -1)] == [first, last] and len(split["predicates"]) == 3
    asked = [o["dbtable"] for o in spark.log]
    assert len(asked) == (db_type != "oracle")
    assert all("c.TABLE_SCHEMA = 'app' AND c.TABLE_NAME = 'o''b'" in sql for sql in asked)
    jdbc.scan_jdbc(spark, config(db_type), "app", "o'b", **split)
    assert spark.log[-1]["predicates"] == split["predicates"]


class Rows:
    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        return self.rows


def test_tables_that_stay_one_task():
    spark = FakeSpark(lambda options: Rows([]))
    for rows in (None, 0, 1, 10):
        assert jdbc.planned_split(spark, config("mysql"), "APP", "T1", rows, rows_per_task=10) == {}
    assert not spark.log
    assert jdbc.planned_split(spark, config("mysql"), "APP", "T1", 11, rows_per_task=10) == {}
    many = jdbc.planned_split(spark, config(), "APP", "T1", 10**12, rows_per_task=10, max_tasks=16)
    assert len(many["predicates"]) == 16
    with pytest.raises(ValueError, match="positive"):
        jdbc.planned_split(spark, config(), "APP", "T1", 5, rows_per_task=0)


def test_configured_splits_come_before_planned_ones():
    from concordia.plans.compare_database import JdbcTables

    spark = FakeSpark(lambda options: Rows([]))
    tables = JdbcTables(spark, config(splits={"app.t1": {"predicates": ["a = 1", "a <> 1"]}}), rows_per_task=10)
    tables._names = {f"APP.T{i}": [("APP", f"T{i}")] for i in (1, 2, 3)}
    tables._sizes = {("APP", "T1"): 100, ("APP", "T2"): 20}
    for name in tables._names:
        tables.scan(name)
    assert spark.log[0]["predicates"] == ["a = 1", "a <> 1"]
    assert spark.log[1]["predicates"] == ["ORA_HASH(ROWID, 1) = 0", "ORA_HASH(ROWID, 1) = 1"]
    assert spark.log[2]["numPartitions"] == "1" and "predicates" not in spark.log[2]


def test_parts_of_numbers_cover_every_row_once(spark):
    # The same arithmetic as Spark's: a hash modulo the number of parts hits each row once.
    parts = jdbc.dialect_of("mysql").part_predicates(7, ["a", "b"])
    rows = spark.range(1000).selectExpr("id as a", "cast(id % 13 as string) as b")
    hits = rows.selectExpr(*[f"cast({p} as int) as p{i}" for i, p in enumerate(parts)])
    assert {sum(r) for r in hits.collect()} == {1}


def test_sizes_that_cannot_be_read_leave_tables_whole():
    from pyspark.errors import PySparkException

    def refuse(options):
        raise PySparkException("no right to read the dictionary")

    with pytest.warns(UserWarning, match="not split"):
        assert jdbc.known_sizes(FakeSpark(refuse), config("mssql")) == {}

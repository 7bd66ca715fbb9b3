"""Relational sources over JDBC: table list, columns, non-empty probe and table scan."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import JDBC_FETCH_SIZE, JDBC_MAX_TASKS, JDBC_ROWS_PER_TASK
from .catalogs import DatabaseConfig

# Schemas that belong to the database system, per dialect.
ORACLE_SYSTEM_SCHEMAS = [
    "SYS", "SYSTEM", "XDB", "MDSYS", "CTXSYS", "DBSNMP", "OUTLN", "SYSMAN", "AUDSYS",
    "APPQOSSYS", "WMSYS", "OLAPSYS", "ORDSYS", "ORDDATA", "ORDPLUGINS", "DVSYS", "LBACSYS",
    "EXFSYS", "GSMADMIN_INTERNAL", "DBSFWUSER", "ANONYMOUS", "SI_INFORMTN_SCHEMA",
]
ORACLE_SYSTEM_PATTERNS = ["APEX_%", "FLOWS_%", "C##%"]
MYSQL_SYSTEM_SCHEMAS = ["information_schema", "mysql", "performance_schema", "sys"]
MSSQL_SYSTEM_SCHEMAS = [
    "sys", "INFORMATION_SCHEMA", "guest", "db_owner", "db_accessadmin", "db_securityadmin",
    "db_ddladmin", "db_backupoperator", "db_datareader", "db_datawriter", "db_denydatareader",
    "db_denydatawriter",
]

_PROBES_PER_QUERY = 50


_TABLE = ("TABLE_SCHEMA", "TABLE_NAME")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Dialect:
    """How one kind of database spells its dictionary and its identifiers."""

    name: str
    driver: str
    quotes: tuple[str, str]
    tables_from: str
    columns_from: str
    table_columns: tuple[str, str]
    column_columns: tuple[str, str, str, str, str]
    table_filter: str
    system_schemas: tuple[str, ...]
    system_patterns: tuple[str, ...]
    one_row: str
    sizes_from: str
    size_columns: tuple[str, str, str]
    key_part: str
    row_part: str | None

    def quote(self, identifier: str) -> str:
        start, end = self.quotes
        return start + identifier.replace(end, end * 2) + end

    def relation(self, owner: str, table: str) -> str:
        return f"{self.quote(owner)}.{self.quote(table)}"

    def _user_schemas(self, owner: str) -> str:
        names = ", ".join(f"'{s}'" for s in self.system_schemas)
        clauses = [f"{owner} NOT IN ({names})"]
        clauses += [f"{owner} NOT LIKE '{p}'" for p in self.system_patterns]
        return " AND ".join(clauses)

    def tables_query(self) -> str:
        owner, table = self.table_columns
        where = " AND ".join(c for c in (self.table_filter, self._user_schemas(owner)) if c)
        return f"SELECT {owner} AS owner_name, {table} AS bare_name FROM {self.tables_from} WHERE {where}"

    def sizes_query(self) -> str:
        """Rows of each table as the dictionary last counted or estimated them."""
        owner, table, rows = self.size_columns
        return (
            f"SELECT {owner} AS owner_name, {table} AS bare_name, {rows} AS row_estimate "
            f"FROM {self.sizes_from} WHERE {self._user_schemas(owner)}"
        )

    def key_query(self, owner: str, table: str) -> str:
        """Columns of a table's primary key; for databases without row addresses of their own."""
        match = " AND ".join(f"k.{c} = c.{c}" for c in ("CONSTRAINT_SCHEMA", "CONSTRAINT_NAME", *_TABLE))
        wanted = " AND ".join(f"c.{c} = {_literal(v)}" for c, v in zip(_TABLE, (owner, table)))
        return (
            "SELECT k.COLUMN_NAME AS column_name, k.ORDINAL_POSITION AS ordinal_no "
            "FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS c "
            f"JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k ON {match} "
            f"WHERE c.CONSTRAINT_TYPE = 'PRIMARY KEY' AND {wanted}"
        )

    def part_predicates(self, parts: int, key: Iterable[str] = ()) -> list[str] | None:
        """Conditions that deal the rows into ``parts``, each row into exactly one.

        Rows are dealt by a hash of their ``key`` if there is one, else by that of their
        address; None if the database has neither.
        """
        columns = ", ".join(self.quote(c) for c in key)
        if columns and self.key_part:
            part = self.key_part.format(columns=columns, parts=parts, last=parts - 1)
        elif self.row_part is not None:
            part = self.row_part.format(parts=parts, last=parts - 1)
        else:
            return None
        return [f"{part} = {i}" for i in range(parts)]

    def columns_query(self) -> str:
        owner, table, column, position, data_type = self.column_columns
        return (
            f"SELECT {owner} AS owner_name, {table} AS bare_name, {column} AS column_name, "
            f"{position} AS ordinal_no, {data_type} AS type_name "
            f"FROM {self.columns_from} WHERE {self._user_schemas(owner)}"
        )

    def probe_query(self, tables: Iterable[tuple[str, str, str]]) -> str:
        """One row per non-empty table of (table_name, owner, table), in one statement."""
        parts = [
            "SELECT '{}' AS table_name FROM ({}) p{}".format(
                key.replace("'", "''"), self.one_row.format(relation=self.relation(owner, table)), i
            )
            for i, (key, owner, table) in enumerate(tables)
        ]
        return " UNION ALL ".join(parts)


_INFORMATION_SCHEMA_COLUMNS = (
    "TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME", "ORDINAL_POSITION", "DATA_TYPE",
)

DIALECTS = {
    "oracle": Dialect(
        name="oracle",
        driver="oracle.jdbc.driver.OracleDriver",
        quotes=('"', '"'),
        tables_from="ALL_TABLES",
        columns_from="ALL_TAB_COLUMNS",
        table_columns=("OWNER", "TABLE_NAME"),
        column_columns=("OWNER", "TABLE_NAME", "COLUMN_NAME", "COLUMN_ID", "DATA_TYPE"),
        table_filter="",
        system_schemas=tuple(ORACLE_SYSTEM_SCHEMAS),
        system_patterns=tuple(ORACLE_SYSTEM_PATTERNS),
        one_row="SELECT 1 AS has_row FROM {relation} WHERE ROWNUM = 1",
        sizes_from="ALL_TABLES",
        size_columns=("OWNER", "TABLE_NAME", "NUM_ROWS"),
        key_part="",
        row_part="ORA_HASH(ROWID, {last})",
    ),
    "mysql": Dialect(
        name="mysql",
        driver="com.mysql.cj.jdbc.Driver",
        quotes=("`", "`"),
        tables_from="INFORMATION_SCHEMA.TABLES",
        columns_from="INFORMATION_SCHEMA.COLUMNS",
        table_columns=("TABLE_SCHEMA", "TABLE_NAME"),
        column_columns=_INFORMATION_SCHEMA_COLUMNS,
        table_filter="TABLE_TYPE = 'BASE TABLE'",
        system_schemas=tuple(MYSQL_SYSTEM_SCHEMAS),
        system_patterns=(),
        one_row="SELECT 1 AS has_row FROM {relation} LIMIT 1",
        sizes_from="INFORMATION_SCHEMA.TABLES",
        size_columns=("TABLE_SCHEMA", "TABLE_NAME", "TABLE_ROWS"),
        key_part="MOD(CRC32(CONCAT_WS(',', {columns})), {parts})",
        row_part=None,
    ),
    "mssql": Dialect(
        name="mssql",
        driver="com.microsoft.sqlserver.jdbc.SQLServerDriver",
        quotes=("[", "]"),
        tables_from="sys.tables",
        columns_from="INFORMATION_SCHEMA.COLUMNS",
        table_columns=("SCHEMA_NAME(schema_id)", "name"),
        column_columns=_INFORMATION_SCHEMA_COLUMNS,
        table_filter="",
        system_schemas=tuple(MSSQL_SYSTEM_SCHEMAS),
        system_patterns=(),
        one_row="SELECT TOP 1 1 AS has_row FROM {relation}",
        # The heap or the clustered index of a table holds each of its rows once.
        sizes_from=(
            "(SELECT SCHEMA_NAME(t.schema_id) AS owner_name, t.name AS bare_name, SUM(p.rows) AS row_count "
            "FROM sys.tables t JOIN sys.partitions p ON p.object_id = t.object_id AND p.index_id IN (0, 1) "
            "GROUP BY t.schema_id, t.name) s"
        ),
        size_columns=("owner_name", "bare_name", "row_count"),
        # CHECKSUM may be the lowest int, which has no absolute value as an int.
        key_part="ABS(CAST(CHECKSUM({columns}) AS BIGINT)) % {parts}",
        row_part="ABS(CAST(CHECKSUM(%%physloc%%) AS BIGINT)) % {parts}",
    ),
}


def dialect_of(db_type: str) -> Dialect:
    try:
        return DIALECTS[db_type.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported database type {db_type!r}") from None


def connection_options(config: DatabaseConfig) -> dict[str, str]:
    """Reader options of a database; the driver class falls back to the dialect's."""
    return {
        "url": config.jdbc_url,
        "user": config.user,
        "password": config.resolved_password(),
        "driver": config.driver or dialect_of(config.db_type).driver,
        "fetchsize": str(JDBC_FETCH_SIZE),
    }


def _query(spark: SparkSession, config: DatabaseConfig, sql: str) -> DataFrame:
    return (
        spark.read.format("jdbc")
        .options(**connection_options(config))
        .option("dbtable", f"({sql}) t")
        .load()
    )


def list_source_tables(spark: SparkSession, config: DatabaseConfig) -> DataFrame:
    """(table_name, owner, table) of all user tables; table_name is OWNER.TABLE in capitals."""
    found = _query(spark, config, dialect_of(config.db_type).tables_query())
    return found.select(
        F.upper(F.concat_ws(".", "owner_name", "bare_name")).alias("table_name"),
        F.col("owner_name").alias("owner"),
        F.col("bare_name").alias("table"),
    )


def list_source_columns(spark: SparkSession, config: DatabaseConfig) -> DataFrame:
    """(table_name, column_name, ordinal, data_type) of all user tables in one query."""
    found = _query(spark, config, dialect_of(config.db_type).columns_query())
    return found.select(
        F.upper(F.concat_ws(".", "owner_name", "bare_name")).alias("table_name"),
        "column_name",
        F.col("ordinal_no").cast("int").alias("ordinal"),
        F.col("type_name").alias("data_type"),
    )


def non_empty_tables(
    spark: SparkSession, config: DatabaseConfig, tables: Iterable[tuple[str, str, str]]
) -> DataFrame:
    """(table_name, has_rows) of (table_name, owner, table) triples.

    Many tables are probed by one statement that reads at most one row of each.  If a
    statement fails, its tables are probed one by one; has_rows is NULL for those that
    cannot be read.
    """
    dialect = dialect_of(config.db_type)

    def probe(chunk: list[tuple[str, str, str]]) -> set[str]:
        found = _query(spark, config, dialect.probe_query(chunk))
        return {row[0] for row in found.collect()}

    wanted = list(tables)
    rows: list[tuple[str, bool | None]] = []
    for start in range(0, len(wanted), _PROBES_PER_QUERY):
        chunk = wanted[start : start + _PROBES_PER_QUERY]
        try:
            filled = probe(chunk)
            rows += [(key, key in filled) for key, _, _ in chunk]
        except Exception as error:  # noqa: BLE001 - drivers raise all kinds of Java errors
            if not _is_database_error(error):
                raise
            for table in chunk:
                try:
                    rows.append((table[0], bool(probe([table]))))
                except Exception as single:  # noqa: BLE001
                    if not _is_database_error(single):
                        raise
                    rows.append((table[0], None))
    return spark.createDataFrame(rows, "table_name string, has_rows boolean")


def _is_database_error(error: Exception) -> bool:
    return isinstance(error, PySparkException) or type(error).__name__ == "Py4JJavaError"


def scan_options(
    config: DatabaseConfig,
    owner: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: object | None = None,
    upper_bound: object | None = None,
    num_partitions: int = 1,
) -> dict[str, str]:
    """Options of a whole-table read, split into ranges of ``partition_column`` if given."""
    dialect = dialect_of(config.db_type)
    options = connection_options(config)
    options["dbtable"] = f"(SELECT * FROM {dialect.relation(owner, table)}) t"
    options["numPartitions"] = str(num_partitions)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partition column needs lower_bound and upper_bound")
        options["partitionColumn"] = partition_column
        options["lowerBound"] = str(lower_bound)
        options["upperBound"] = str(upper_bound)
    return options


def partition_bounds(
    spark: SparkSession, config: DatabaseConfig, owner: str, table: str, column: str
) -> tuple[object, object]:
    """Smallest and largest value of a column, asked from the database."""
    dialect = dialect_of(config.db_type)
    name = dialect.quote(column)
    sql = f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {dialect.relation(owner, table)}"
    row = _query(spark, config, sql).first()
    return _whole(row[0], math.floor), _whole(row[1], math.ceil)


def _whole(bound: object, rounded: Callable) -> object:
    """Spark wants whole numbers as bounds of numeric columns."""
    return rounded(bound) if isinstance(bound, (Decimal, float)) else bound


def table_sizes(spark: SparkSession, config: DatabaseConfig) -> DataFrame:
    """(table_name, owner, table, rows) of all user tables; rows are the dictionary's estimate or NULL."""
    found = _query(spark, config, dialect_of(config.db_type).sizes_query())
    return found.select(
        F.upper(F.concat_ws(".", "owner_name", "bare_name")).alias("table_name"),
        F.col("owner_name").alias("owner"),
        F.col("bare_name").alias("table"),
        F.col("row_estimate").cast("long").alias("rows"),
    )


def known_sizes(spark: SparkSession, config: DatabaseConfig) -> dict[tuple[str, str], int | None]:
    """``table_sizes`` by (owner, table).

    They only plan splits, so a user who may not read them gets a warning and one task a table.
    """
    try:
        return {(r["owner"], r["table"]): r["rows"] for r in table_sizes(spark, config).collect()}
    except Exception as error:  # noqa: BLE001 - drivers raise all kinds of Java errors
        if not _is_database_error(error):
            raise
        warnings.warn(f"no table sizes from {config.name}, tables are not split: {type(error).__name__}", stacklevel=2)
        return {}


def planned_split(
    spark: SparkSession,
    config: DatabaseConfig,
    owner: str,
    table: str,
    rows: int | None,
    rows_per_task: int = JDBC_ROWS_PER_TASK,
    max_tasks: int = JDBC_MAX_TASKS,
) -> dict[str, list[str]]:
    """Arguments of ``scan_jdbc`` for a table without a configured split.

    A table of more than ``rows_per_task`` rows is dealt by a hash of its primary key, or
    of its row address, among as many tasks as that takes.  ``max_tasks`` bounds the connections to the
    database, not the rows: each task of a larger table reads more.  Every task makes the
    database look through the whole table, so a partition column with an index, where
    there is one, is better configured.  A table of unknown size, or one that has neither
    a key nor an address to hash, stays one task.
    """
    if rows_per_task < 1 or max_tasks < 1:
        raise ValueError("rows_per_task and max_tasks must be positive")
    parts = min(max_tasks, -(-(rows or 0) // rows_per_task))
    if parts < 2:
        return {}
    dialect = dialect_of(config.db_type)
    key = []
    if dialect.key_part:
        found = _query(spark, config, dialect.key_query(owner, table)).collect()
        key = [name for name, _ in sorted(found, key=lambda r: r[1])]
    predicates = dialect.part_predicates(parts, key)
    return {} if predicates is None else {"predicates": predicates}


def scan_jdbc(
    spark: SparkSession,
    config: DatabaseConfig,
    owner: str,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 1,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Read a whole table.

    With ``partition_column`` the read is split into ``num_partitions`` ranges between
    its smallest and largest value; the outer ranges are open and the first takes NULLs,
    so no row is lost.  With ``predicates`` each condition is one task, for keys so
    uneven that ranges would leave most rows in one of them; the conditions must cover
    every row exactly once.
    """
    if predicates is not None:
        options = scan_options(config, owner, table)
        properties = {k: v for k, v in options.items() if k not in ("url", "dbtable", "numPartitions")}
        return spark.read.jdbc(
            options["url"], options["dbtable"], predicates=predicates, properties=properties
        )
    bounds = {}
    if partition_column is not None and num_partitions > 1:
        low, high = partition_bounds(spark, config, owner, table, partition_column)
        if low is not None and low != high:
            bounds = {
                "partition_column": partition_column,
                "lower_bound": low,
                "upper_bound": high,
                "num_partitions": num_partitions,
            }
    return spark.read.format("jdbc").options(**scan_options(config, owner, table, **bounds)).load()

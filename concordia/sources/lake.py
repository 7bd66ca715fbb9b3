"""Landed parquet tables, stored as <base>/<owner>/<table>."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .hadoop import child_directories, path_exists

_SCHEMA = "table_name string, owner string, table string, path string"


def list_lake_tables(spark: SparkSession, base: str, missing_ok: bool = True) -> DataFrame:
    """(table_name, owner, table, path) of all tables below ``base``.

    table_name is the upper-cased OWNER.TABLE under which tables are matched, path the
    directory as it is really spelled.  Directories starting with "_" are skipped.  Only
    the two directory levels are listed, one call per owner; the data files, of which a
    lake may hold millions, are not.  A missing base gives no tables, or an error
    without ``missing_ok``.
    """
    if not path_exists(spark, base):
        if not missing_ok:
            raise FileNotFoundError(f"lake folder not found: {base}")
        return spark.createDataFrame([], _SCHEMA)
    rows = [
        (f"{owner}.{table}".upper(), owner, table, path)
        for owner, owner_path in child_directories(spark, base)
        if not owner.startswith("_")
        for table, path in child_directories(spark, owner_path)
        if not table.startswith("_")
    ]
    return spark.createDataFrame(rows, _SCHEMA).orderBy("table_name")


def split_table_name(table_name: str) -> tuple[str, str]:
    """(owner, table) of OWNER.TABLE; anything else is an error."""
    parts = table_name.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"expected OWNER.TABLE, got {table_name!r}")
    return parts[0], parts[1]


def one_spelling(table_name: str, found: list):
    """The only place of a table; names that differ by case alone are an error, not a guess."""
    if len(found) > 1:
        places = ", ".join(sorted(str(f) for f in found))
        raise ValueError(f"{table_name} stands for several tables that differ by case only: {places}")
    return found[0]


def scan_lake(spark: SparkSession, base: str, table_name: str) -> DataFrame:
    """Read one lake table by its OWNER.TABLE name, whatever the case of its folders."""
    owner, table = split_table_name(table_name.upper())
    paths = [
        path
        for owner_dir, owner_path in child_directories(spark, base)
        if owner_dir.upper() == owner
        for table_dir, path in child_directories(spark, owner_path)
        if table_dir.upper() == table
    ]
    if not paths:
        raise FileNotFoundError(f"lake table not found: {base}/{owner}/{table}")
    return spark.read.parquet(one_spelling(table_name, paths))

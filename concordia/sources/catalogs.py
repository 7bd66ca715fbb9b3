"""Configuration files: databases to compare and tables to compare in them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of one database entry, all required.
DATABASE_FIELDS = ["name", "dbType", "jdbcUrl", "user", "password", "driver", "hdfsBasePath"]

# Blank space as configuration files may hold it: everything up to the space character.
_BLANKS = "".join(chr(i) for i in range(1, 33))


@dataclass(frozen=True)
class DatabaseConfig:
    """One database and its lake folder.

    A password of the form ``env:NAME`` is read from that environment variable when a
    connection is made.  Credentials never appear in the printed form.  ``splits`` says
    by OWNER.TABLE how tables are read in parallel, as arguments of ``scan_jdbc``.
    """

    name: str
    db_type: str
    jdbc_url: str = field(repr=False)
    user: str = field(repr=False)
    password: str = field(repr=False)
    driver: str
    lake_base: str
    splits: dict[str, dict] = field(default_factory=dict)

    def resolved_password(self) -> str:
        if self.password.startswith("env:"):
            return os.environ[self.password[4:]]
        return self.password


# The optional field of a database entry for tables to be read in parallel.
_SPLITS = "array<struct<table string, partitionColumn string, numPartitions int, predicates array<string>>>"


def _splits(entries: list | None) -> dict[str, dict]:
    """scan_jdbc arguments by table; an entry has a partition column or predicates."""
    found = {}
    for e in entries or []:
        if not e["table"] or (e["partitionColumn"] is None) == (e["predicates"] is None):
            raise ValueError("a split needs a table and either partitionColumn or predicates")
        if e["predicates"] is not None:
            split = {"predicates": list(e["predicates"])}
        else:
            if (e["numPartitions"] or 0) < 1:
                raise ValueError(f"the split of {e['table']} needs numPartitions")
            split = {"partition_column": e["partitionColumn"], "num_partitions": e["numPartitions"]}
        found[e["table"].strip().upper()] = split
    return found


def _trimmed(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(_BLANKS))


def load_databases(spark: SparkSession, path: str) -> list[DatabaseConfig]:
    """Read the database catalogue (one multi-line JSON file); every field must be filled.

    An entry may add ``splits``, a list of tables to be read in parallel: ``table`` with
    ``partitionColumn`` and ``numPartitions``, or with ``predicates``.
    """
    df = spark.read.option("multiLine", True).json(path)
    missing = [f for f in DATABASE_FIELDS if f not in df.columns]
    if missing:
        raise ValueError(f"database catalogue lacks {', '.join(missing)}")
    configs = []
    splits = F.from_json(F.to_json("splits"), _SPLITS) if "splits" in df.columns else F.lit(None).cast(_SPLITS)
    fields = [_trimmed(F.col(f)).alias(f) for f in DATABASE_FIELDS]
    for row in df.select(*fields, splits.alias("splits")).toLocalIterator():
        blank = [f for f in DATABASE_FIELDS if not row[f]]
        if blank:
            raise ValueError(f"empty value for {', '.join(blank)} in the database catalogue")
        configs.append(
            DatabaseConfig(
                name=row["name"],
                db_type=row["dbType"].lower(),
                jdbc_url=row["jdbcUrl"],
                user=row["user"],
                password=row["password"],
                driver=row["driver"],
                lake_base=row["hdfsBasePath"],
                splits=_splits(row["splits"]),
            )
        )
    return configs


def table_list_entries(entries: DataFrame) -> DataFrame:
    """Distinct (database, table_name) pairs of (database, tables[]) records.

    Names are trimmed and upper-cased, blank ones dropped.  A record without tables
    leaves one row with a NULL table_name, so that the database stays known.
    """
    if not {"database", "tables"} <= set(entries.columns):
        raise ValueError("a table catalogue needs the columns database and tables")
    database = F.upper(_trimmed(F.col("database")))
    checked = F.when(database != "", database).otherwise(
        F.raise_error(F.lit("table catalogue entry without database name"))
    )
    tables = F.col("tables")
    if not isinstance(entries.schema["tables"].dataType, T.ArrayType):
        # A file whose lists are all null is inferred as text; any real value is an error.
        tables = F.when(
            tables.isNotNull(), F.raise_error(F.lit("tables must be an array")).cast("array<string>")
        )
    return (
        entries.select(checked.alias("database"), F.explode_outer(tables).alias("table_name"))
        .select(
            "database", F.nullif(F.upper(_trimmed(F.col("table_name"))), F.lit("")).alias("table_name")
        )
        .distinct()
    )


def tables_per_database(entries: DataFrame) -> DataFrame:
    """(database, table_count): distinct tables of every database, 0 for an empty one."""
    return (
        table_list_entries(entries)
        .groupBy("database")
        .agg(F.count("table_name").alias("table_count"))
    )


def load_table_list(spark: SparkSession, path: str) -> DataFrame:
    """(database, tables[]) of a table catalogue file, lists sorted and without repeats.

    The lists are gathered because the file, one JSON document, already holds them in
    one record; use ``table_list_entries`` for lists that come from data.
    """
    entries = spark.read.option("multiLine", True).json(path)
    return (
        table_list_entries(entries)
        .groupBy("database")
        .agg(F.array_sort(F.collect_set("table_name")).alias("tables"))
    )

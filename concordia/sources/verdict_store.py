"""The append-only store of a run: verdicts, inventories, differences, progress.

Everything an attempt at a table finds is written under the name of the attempt, and last
of all a commit row.  Readers take the last committed attempt of each table, so a half
written one is never seen and a repeated one replaces the earlier.  Rows written without
an attempt need no commit; they count until an attempt at their table is committed.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CATALOG_TABLE, VERDICT_SCHEMA
from .hadoop import delete_files, path_exists

_ATTEMPT, _GENERATION, _PIECE = "attempt", "generation", "piece"
_STORED = T.StructType(
    [*VERDICT_SCHEMA.fields, T.StructField(_ATTEMPT, T.StringType()), T.StructField(_GENERATION, T.StringType())]
)
_KEY = ["run_id", "db_name", "tried"]
_COMMITS = "run_id string, db_name string, tried string, attempt string, generation string"
_INVENTORY = (
    "run_id string, db_name string, table_name string, in_source boolean, has_rows boolean, "
    "in_lake boolean, status string, reason string, attempt string"
)
_DIFF_ROWS = (
    "run_id string, db_name string, table_name string, row_hash string, src_count long, "
    "sink_count long, diff_kind string, attempt string"
)
_DIFF_BUCKETS = (
    "run_id string, db_name string, table_name string, level int, bucket_count long, bucket_id int, "
    "source_count long, sink_count long, source_hash decimal(38,0), sink_hash decimal(38,0), attempt string"
)
_RUNNING = (
    "run_id string, db_name string, table_name string, phase string, started timestamp, "
    "lease_until timestamp, attempt string"
)


def new_attempt() -> str:
    """A name that sorts after those of all earlier attempts."""
    return f"{time.time_ns():020d}"


def _beside(verdict_root: str, name: str) -> str:
    return f"{verdict_root.rstrip('/')}_{name}"


def _read(spark: SparkSession, root: str, schema: str | T.StructType, run_id: str | None) -> DataFrame:
    # The schema is given: run ids and database names made of digits stay text.
    if path_exists(spark, root):
        stored = spark.read.schema(schema).parquet(root).drop(_PIECE)
    else:
        stored = spark.createDataFrame([], schema)
    return stored if run_id is None else stored.filter(stored.run_id == run_id)


def _write(rows: DataFrame, root: str) -> None:
    """Append rows as a piece of their own, so that writers at the same time never meet."""
    (
        rows.write.mode("append")
        .partitionBy("run_id", "db_name")
        .option("compression", "snappy")
        .parquet(f"{root.rstrip('/')}/{_PIECE}={uuid.uuid4().hex}")
    )


def _append(rows: DataFrame, root: str, run_id: str, db_name: str, attempt: str) -> None:
    _write(rows.withColumns({"run_id": F.lit(run_id), "db_name": F.lit(db_name), _ATTEMPT: F.lit(attempt)}), root)


def _by_run(rows: DataFrame) -> DataFrame:
    """One task and file per run and database, more where one task would get too many rows."""
    return rows.hint("rebalance", "run_id", "db_name")


def _append_commits(commits: DataFrame, verdict_root: str) -> None:
    _write(commits, _beside(verdict_root, "commits"))


def commit_attempt(
    spark: SparkSession, verdict_root: str, run_id: str, db_name: str, tables: list[str], attempt: str
) -> None:
    """Make what an attempt has written for these tables visible."""
    rows = [(run_id, db_name, name.upper(), attempt, "") for name in tables]
    if rows:
        _append_commits(spark.createDataFrame(rows, _COMMITS).coalesce(1), verdict_root)


def _commits(spark: SparkSession, verdict_root: str, run_id: str | None) -> DataFrame:
    return _read(spark, _beside(verdict_root, "commits"), _COMMITS, run_id)


def _last_commits(commits: DataFrame, rows: DataFrame) -> DataFrame:
    """The attempt that counts of every table; ``rows`` without an attempt are one, too."""
    plain = rows.filter(F.col(_ATTEMPT) == "").select(*_KEY, _ATTEMPT, _GENERATION)
    last = F.max(F.struct(_ATTEMPT, _GENERATION)).alias("last")
    return commits.unionByName(plain).groupBy(*_KEY).agg(last).select(*_KEY, "last.*")


def _visible(stored: DataFrame, commits: DataFrame, tried: Column, generations: bool = False) -> DataFrame:
    columns = stored.columns
    rows = stored.withColumn("tried", F.upper(tried)).withColumn(_ATTEMPT, F.coalesce(_ATTEMPT, F.lit("")))
    generation = F.coalesce(F.col(_GENERATION), F.lit("")) if generations else F.lit("")
    rows = rows.withColumn(_GENERATION, generation)
    keys = [*_KEY, _ATTEMPT, *([_GENERATION] if generations else [])]
    return rows.join(_last_commits(commits, rows), keys, "left_semi").select(*columns).drop(_ATTEMPT, _GENERATION)


def write_verdicts(verdicts: DataFrame, root: str, attempt: str = "", commit: bool = True) -> None:
    """Append verdict rows, partitioned by run and database.

    Appending keeps the rows of earlier writes of the same run.  Rows of a later
    ``attempt`` (by text order) at a table replace those of earlier ones for readers; the
    attempt is committed at once unless the caller does so later.  The rebalance gives one
    file per database and write, and splits a database whose rows would make a file too
    large.
    """
    ordered = verdicts.select(*VERDICT_SCHEMA.fieldNames()).na.fill("").na.fill(0)
    marked = ordered.withColumn(_ATTEMPT, F.lit(attempt)).withColumn(_GENERATION, F.lit(""))
    _write(_by_run(marked), root)
    if attempt and commit:
        tables = ordered.select("run_id", "db_name", F.upper("table_name").alias("tried")).distinct()
        _append_commits(
            _by_run(tables.withColumn(_ATTEMPT, F.lit(attempt)).withColumn(_GENERATION, F.lit(""))), root
        )


def read_verdicts(
    spark: SparkSession, root: str, run_id: str | None = None, all_attempts: bool = False
) -> DataFrame:
    """All verdicts, or those of one run (only its folders are read).

    Of a table that was tried more than once, the rows of the last committed attempt
    count, unless ``all_attempts`` are asked for, finished or not.
    """
    stored = _read(spark, root, _STORED, run_id)
    names = VERDICT_SCHEMA.fieldNames()
    if all_attempts:
        return stored.filter(F.coalesce(_GENERATION, F.lit("")) == "").select(*names)
    return _visible(stored, _commits(spark, root, run_id), F.col("table_name"), generations=True).select(*names)


def inventory_root(verdict_root: str) -> str:
    """Folder of the inventory rows that belong to a verdict table."""
    return _beside(verdict_root, "inventory")


def write_inventory(
    inventory: DataFrame, verdict_root: str, run_id: str, db_name: str, attempt: str = ""
) -> None:
    """Store all rows of a table list comparison; a verdict's detail shows only the first.

    They belong to the attempt at the table list and are committed with it.
    """
    _append(inventory, inventory_root(verdict_root), run_id, db_name, attempt)


def read_inventory(spark: SparkSession, verdict_root: str, run_id: str | None = None) -> DataFrame:
    """The stored inventory rows of the last committed attempt, or those of one run."""
    stored = _read(spark, inventory_root(verdict_root), _INVENTORY, run_id)
    return _visible(stored, _commits(spark, verdict_root, run_id), F.lit(CATALOG_TABLE))


def write_diff_rows(
    diff: DataFrame, verdict_root: str, run_id: str, db_name: str, table_name: str, attempt: str = ""
) -> DataFrame:
    """Store every differing row hash of a table with both counts, and return what is stored."""
    root = _beside(verdict_root, "diff_rows")
    _append(diff.withColumn("table_name", F.lit(table_name)), root, run_id, db_name, attempt)
    own = (F.col("db_name") == db_name) & (F.col("table_name") == table_name) & (F.col(_ATTEMPT) == attempt)
    return _read(diff.sparkSession, root, _DIFF_ROWS, run_id).filter(own).select(*diff.columns)


def read_diff_rows(spark: SparkSession, verdict_root: str, run_id: str | None = None) -> DataFrame:
    """(run_id, db_name, table_name, row_hash, src_count, sink_count, diff_kind) of all tables."""
    stored = _read(spark, _beside(verdict_root, "diff_rows"), _DIFF_ROWS, run_id)
    return _visible(stored, _commits(spark, verdict_root, run_id), F.col("table_name"))


def write_diff_buckets(
    buckets: DataFrame, verdict_root: str, run_id: str, db_name: str, table_name: str, attempt: str = ""
) -> None:
    """Store the differing nodes of a table's checksum tree, all levels."""
    root = _beside(verdict_root, "diff_buckets")
    _append(buckets.withColumn("table_name", F.lit(table_name)), root, run_id, db_name, attempt)


def read_diff_buckets(spark: SparkSession, verdict_root: str, run_id: str | None = None) -> DataFrame:
    """Differing buckets of all tables: level, number of buckets of the level, id, both sides."""
    stored = _read(spark, _beside(verdict_root, "diff_buckets"), _DIFF_BUCKETS, run_id)
    return _visible(stored, _commits(spark, verdict_root, run_id), F.col("table_name"))


def write_running(
    spark: SparkSession,
    verdict_root: str,
    run_id: str,
    db_name: str,
    tables: list[str],
    phase: str,
    lease_seconds: float,
    attempt: str,
) -> None:
    """Say ahead that tables are being compared; the claim lapses unless it is renewed."""
    if not tables:
        return
    rows = spark.createDataFrame([(name, phase) for name in tables], "table_name string, phase string")
    now = F.current_timestamp()
    until = F.timestamp_millis(F.unix_millis(now) + F.lit(int(lease_seconds * 1000)))
    _append(
        rows.withColumn("started", now).withColumn("lease_until", until).coalesce(1),
        _beside(verdict_root, "running"),
        run_id,
        db_name,
        attempt,
    )


def read_running(spark: SparkSession, verdict_root: str, run_id: str | None = None) -> DataFrame:
    """(run_id, db_name, table_name, phase, started, lease_until) of attempts not committed yet.

    Of an attempt that has renewed its claim the longest lease counts.
    """
    stored = _read(spark, _beside(verdict_root, "running"), _RUNNING, run_id).withColumn(
        "tried", F.upper("table_name")
    )
    open_ = stored.join(_commits(spark, verdict_root, run_id), [*_KEY, _ATTEMPT], "left_anti")
    first = F.min("started").alias("started")
    last = F.max(F.struct("lease_until", "phase")).alias("last")
    return (
        open_.groupBy("run_id", "db_name", "table_name", _ATTEMPT)
        .agg(first, last)
        .select("run_id", "db_name", "table_name", "last.phase", "started", "last.lease_until")
    )


def compact_verdicts(spark: SparkSession, root: str, run_id: str, db_name: str) -> None:
    """Put the visible verdicts of a run and database into few files, and its commits too.

    One file each, unless its rows are too many for one task.

    The copies are written as a new generation of their attempts and become visible with
    its commits; only then are the files they replace deleted.  A crash in between leaves
    files that nobody reads.  Attempts that were never committed are removed, so this must
    not run beside a comparison of the same run and database.
    """
    part = F.col("db_name") == db_name
    stored, commits = _read(spark, root, _STORED, run_id).filter(part), _commits(spark, root, run_id).filter(part)
    # Files of this run and database only; one per attempt at a table or so.
    files = [frame.select(F.input_file_name().alias("file")) for frame in (stored, commits)]
    old = [r["file"] for r in files[0].union(files[1]).distinct().collect()]
    if not old:
        return
    rows = stored.withColumn("tried", F.upper("table_name")).withColumn(_ATTEMPT, F.coalesce(_ATTEMPT, F.lit("")))
    rows = rows.withColumn(_GENERATION, F.coalesce(_GENERATION, F.lit("")))
    last = _last_commits(commits, rows)
    generation = F.lit(new_attempt())
    kept = rows.join(last, [*_KEY, _ATTEMPT, _GENERATION], "left_semi").drop("tried")
    _write(_by_run(kept.withColumn(_GENERATION, generation)), root)
    _append_commits(_by_run(last.withColumn(_GENERATION, generation)), root)
    delete_files(spark, old)

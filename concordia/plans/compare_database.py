"""All tables of a database against its lake."""

from __future__ import annotations

import copy
import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Event
from typing import Any, Protocol

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    CATALOG_TABLE,
    CHECKSUM_REFINEMENT,
    COMMON,
    ERROR,
    JDBC_ROWS_PER_TASK,
    READ_SOURCE,
    TABLE_COUNT,
    TABLE_TIMEOUT_MINUTES,
    TIMEOUT,
    VERDICT_SCHEMA,
)
from ..operators.inventory import table_inventory_diff
from ..operators.schema_diff import schema_diff
from ..sources import jdbc
from ..sources.catalogs import DatabaseConfig
from ..sources.lake import list_lake_tables, one_spelling
from ..sources.hadoop import delete_directory
from ..sources.sessions import child_session
from ..sources.verdict_store import (
    commit_attempt,
    new_attempt,
    read_running,
    read_verdicts,
    write_diff_buckets,
    write_diff_rows,
    write_inventory,
    write_running,
    write_verdicts,
)
from .checks import Run, schema_checks, table_inventory_check
from .compare_table import compare_table, error_text, plain_verdict, read_check
from .ledger import pending_tables


_CANCEL_ATTEMPTS = 30
# Tables of a lake folder probed at the same time.
_PROBES = 16


class SourceTables(Protocol):
    """What the suite needs to know about the database side."""

    dialect: str
    changes_while_read: bool

    def tables(self) -> DataFrame:
        """(table_name, has_rows)"""

    def columns(self) -> DataFrame:
        """(table_name, column_name, data_type)"""

    def scan(self, table_name: str) -> DataFrame: ...

    def on(self, spark: SparkSession) -> SourceTables:
        """The same tables, read through another session."""


class JdbcTables:
    """A live database; ``splits`` gives scan_jdbc arguments (such as partition_column)
    for tables that are read in parallel, by OWNER.TABLE, in place of the catalogue's.
    Other tables of more than ``rows_per_task`` rows are split as ``planned_split`` says;
    None leaves each of them to one task."""

    changes_while_read = True

    def __init__(
        self,
        spark: SparkSession,
        config: DatabaseConfig,
        splits: dict[str, dict] | None = None,
        rows_per_task: int | None = JDBC_ROWS_PER_TASK,
    ):
        self.spark, self.config, self.rows_per_task = spark, config, rows_per_task
        self.dialect = jdbc.dialect_of(config.db_type).name
        chosen = config.splits if splits is None else splits
        self.splits = {k.upper(): v for k, v in chosen.items()}
        self._names: dict[str, list[tuple[str, str]]] = {}
        self._sizes: dict[tuple[str, str], int | None] = {}

    def tables(self) -> DataFrame:
        listed = jdbc.list_source_tables(self.spark, self.config).collect()
        self._names = {}
        for r in listed:
            self._names.setdefault(r["table_name"], []).append((r["owner"], r["table"]))
        if self.rows_per_task is not None:
            self._sizes = jdbc.known_sizes(self.spark, self.config)
        return jdbc.non_empty_tables(
            self.spark, self.config, [(r["table_name"], r["owner"], r["table"]) for r in listed]
        )

    def on(self, spark: SparkSession) -> JdbcTables:
        other = copy.copy(self)
        other.spark = spark
        return other

    def columns(self) -> DataFrame:
        return jdbc.list_source_columns(self.spark, self.config)

    def scan(self, table_name: str) -> DataFrame:
        owner, table = one_spelling(table_name, self._names[table_name])
        split = self.splits.get(table_name)
        if split is None:
            rows = self._sizes.get((owner, table))
            split = (
                jdbc.planned_split(self.spark, self.config, owner, table, rows, self.rows_per_task) if rows else {}
            )
        return jdbc.scan_jdbc(self.spark, self.config, owner, table, **split)


class ParquetTables:
    """A second lake folder as the source side: a snapshot or an export."""

    dialect = "spark"
    changes_while_read = False

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._paths: dict[str, list[str]] = {}
        self._columns: list[tuple[str, str, str]] = []

    def tables(self) -> DataFrame:
        listed = list_lake_tables(self.spark, self.base, missing_ok=False).collect()
        self._paths = {}
        for r in listed:
            self._paths.setdefault(r["table_name"], []).append(r["path"])
        self._columns = []
        rows = []
        with ThreadPoolExecutor(max_workers=_PROBES) as pool:
            for name, has_rows, fields in pool.map(self._probe, self._paths):
                rows.append((name, has_rows))
                self._columns += [(name, f.name, f.dataType.simpleString()) for f in fields]
        return self.spark.createDataFrame(rows, "table_name string, has_rows boolean")

    def on(self, spark: SparkSession) -> ParquetTables:
        other = copy.copy(self)
        other.spark = spark
        return other

    def _probe(self, name: str) -> tuple[str, bool | None, list]:
        """Whether a table has rows, and its fields: one read of its footer."""
        try:
            table = self.scan(name)
            return name, bool(table.take(1)), table.schema.fields
        except Exception:  # noqa: BLE001 - an unreadable table is reported, not skipped
            return name, None, []

    def columns(self) -> DataFrame:
        return self.spark.createDataFrame(
            self._columns, "table_name string, column_name string, data_type string"
        )

    def scan(self, table_name: str) -> DataFrame:
        return self.spark.read.parquet(one_spelling(table_name, self._paths[table_name]))


class TimeLimitReached(Exception):
    """A table took longer than allowed."""


def run_limited(
    spark: SparkSession, work: Callable[[], Any], seconds: float, tag: str, expired: Event | None = None
) -> Any:
    """Run ``work`` with a time limit; on reaching it its Spark jobs are cancelled.

    ``expired`` is set first, so that ``work`` can tell a cancelled job from a failed one.
    """
    outcome: dict[str, Any] = {}
    context = spark.sparkContext

    def tagged() -> None:
        context.addJobTag(tag)
        try:
            outcome["value"] = work()
        except Exception as error:  # noqa: BLE001 - handed to the caller below
            outcome["error"] = error
        finally:
            context.removeJobTag(tag)

    worker = InheritableThread(target=tagged, daemon=True)
    worker.start()
    worker.join(seconds)
    if worker.is_alive():
        if expired is not None:
            expired.set()
        # Cancelling ends the running job; repeating it catches a job started meanwhile.
        for _ in range(_CANCEL_ATTEMPTS):
            context.cancelJobsWithTag(tag)
            worker.join(1)
            if not worker.is_alive():
                break
        raise TimeLimitReached(f"not finished within {seconds:g} seconds")
    if "error" in outcome:
        raise outcome["error"]
    return outcome["value"]


@dataclass(frozen=True)
class SuiteSettings:
    """``compare`` is passed on to compare_table, in place of the suite's own choices:
    a second level of checksums, and frozen row hashes for a live source.
    ``parallel_tables`` are compared at the same time, so that small tables do not leave
    a cluster idle.  ``tables`` restricts the comparison of a database, by its upper-cased
    name, to the tables listed; the table lists are still compared as a whole, and a listed
    table that neither side has is an error.  Databases not named are compared whole.
    ``shared_run`` leaves out tables on which another process working on the same run holds
    a lease of ``lease_seconds``, renewed while it is at work.  ``store_diffs`` keeps every
    differing row hash and bucket beside the verdicts.
    """

    time_limit_seconds: float = TABLE_TIMEOUT_MINUTES * 60
    parallel_tables: int = 1
    compare: dict[str, Any] | None = None
    tables: dict[str, list[str]] | None = None
    shared_run: bool = False
    lease_seconds: float = 300
    store_diffs: bool = True


def _schema_verdicts(
    source: SourceTables, declared: DataFrame, landed: dict[str, T.StructType], run: Run, categories: str
) -> dict[str, Row]:
    """SCHEMA verdicts of all tables by one plan, from both sides' column lists."""
    if not landed:
        return {}
    start, spark = time.monotonic(), declared.sparkSession
    rows = [(name, f.name, f.dataType.simpleString()) for name, schema in landed.items() for f in schema.fields]
    lake = spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
    tables = spark.createDataFrame([(name,) for name in landed], "table_name string")
    found = declared.join(tables, "table_name", "left_semi")
    verdicts = schema_checks(schema_diff(found, lake, source.dialect, categories), tables, run).collect()
    each = int((time.monotonic() - start) * 1000) // len(landed)
    names = VERDICT_SCHEMA.fieldNames()
    return {
        r["table_name"]: Row(*names)(*[each if n == "duration_ms" else r[n] for n in names]) for r in verdicts
    }


def compare_database(
    spark: SparkSession,
    source: SourceTables,
    lake_base: str,
    run: Run,
    verdict_root: str,
    settings: SuiteSettings = SuiteSettings(),
) -> DataFrame:
    """Compare the table lists, then every common table; returns the run's verdicts.

    Verdicts are appended after the inventory and as each table finishes.  Calling it
    again with the same run continues with the tables that have not finished; the new
    verdicts of a table replace those of its earlier attempt, which are visible only once
    everything the attempt has to say of the table is stored.  A table whose phase 1 was
    finished by an earlier attempt goes on with phase 2 if its files are the same.  All
    rows of the inventory and all differing rows and buckets are stored beside the verdicts.
    """

    attempt = new_attempt()
    phases = f"{verdict_root.rstrip('/')}_phases/{run.run_id}/{run.db_name}"

    def store(rows: list[Row]) -> None:
        if rows:
            tables = list(dict.fromkeys(r["table_name"] for r in rows))
            frame = spark.createDataFrame(rows, VERDICT_SCHEMA)
            write_verdicts(frame, verdict_root, attempt, commit=False)
            commit_attempt(spark, verdict_root, run.run_id, run.db_name, tables, attempt)

    try:
        known = read_verdicts(spark, verdict_root, run.run_id).filter(F.col("db_name") == run.db_name)
        lake = list_lake_tables(spark, lake_base, missing_ok=False)
        inventory = table_inventory_diff(source.tables(), lake)
        common = inventory.filter(F.col("status") == COMMON).select("table_name")
        wanted = (settings.tables or {}).get(run.db_name.upper())
        unknown: list[str] = []
        if wanted is not None:
            chosen = spark.createDataFrame([(n.upper(),) for n in wanted], "table_name string").distinct()
            common = common.join(chosen, "table_name", "left_semi")
            absent = chosen.join(inventory, "table_name", "left_anti").orderBy("table_name")
            unknown = [r["table_name"] for r in absent.collect()]
        listed = known.filter((F.col("table_name") == CATALOG_TABLE) & (F.col("status") != ERROR))
        if listed.isEmpty():
            # Committed with the verdict, so a later attempt at the lists replaces both.
            write_inventory(inventory, verdict_root, run.run_id, run.db_name, attempt)
            store([table_inventory_check(inventory, run).first()])
        # One row per table, all of them metadata.
        paths: dict[str, list[str]] = {}
        for r in lake.collect():
            paths.setdefault(r["table_name"], []).append(r["path"])
        todo = pending_tables(
            common.withColumn("run_id", F.lit(run.run_id)).withColumn("db_name", F.lit(run.db_name)),
            known,
            read_running(spark, verdict_root, run.run_id) if settings.shared_run else None,
        )
        names = [r["table_name"] for r in todo.orderBy("table_name").collect()]
        options = {
            "reuse": "freeze_source" if source.changes_while_read else "rescan",
            "refinement": CHECKSUM_REFINEMENT,
        }
        options |= settings.compare or {}

        def landed_schema(name: str) -> T.StructType | None:
            try:
                return spark.read.parquet(one_spelling(name, paths[name])).schema
            except Exception:  # noqa: BLE001 - becomes the verdict of the table that cannot be read
                return None

        with ThreadPoolExecutor(max_workers=_PROBES) as pool:
            landed = {n: s for n, s in zip(names, pool.map(landed_schema, names)) if s is not None}
        declared = source.columns()
        schemas = _schema_verdicts(source, declared, landed, run, options.get("categories", "exact"))
    except Exception as error:  # noqa: BLE001 - without the lists nothing can be compared
        store([plain_verdict(run, CATALOG_TABLE, TABLE_COUNT, ERROR, error_text(error))])
        return read_verdicts(spark, verdict_root, run.run_id)

    detail = "Listed for comparison, but neither side has it"
    store([plain_verdict(run, name, READ_SOURCE, ERROR, detail) for name in unknown])
    def one_table(name: str) -> list[Row]:
        rows: list[Row] = []
        expired = Event()
        # Settings are adapted to the table in a session of its own.
        session = child_session(spark)
        target = (verdict_root, run.run_id, run.db_name, name, attempt)

        def sink() -> DataFrame:
            reader = session.read.schema(landed[name]) if name in landed else session.read
            return reader.parquet(one_spelling(name, paths[name]))

        def emit(row: Row) -> None:
            if expired.is_set():  # what a cancelled check reports is no finding
                raise TimeLimitReached(name)
            rows.append(row)

        def work() -> None:
            left, failure = read_check(lambda: source.on(session).scan(name), run, name, "source")
            if failure is None:
                right, failure = read_check(sink, run, name, "sink")
            if failure is not None:
                rows.append(failure)
                return
            stores = {}
            if settings.store_diffs:
                stores["store_buckets"] = lambda nodes: write_diff_buckets(nodes, *target)
                stores["store_rows"] = lambda diff: write_diff_rows(diff, *target)
            given = stores | {"phase_folder": f"{phases}/{name}", "errors": "verdict"} | options
            compare_table(left, right, run, name, schema_verdict=schemas[name], emit=emit, **given)
            # What phase 1 has found serves the next attempt after a failure.
            if not any(row["status"] == ERROR for row in rows):
                delete_directory(spark, f"{phases}/{name}")

        try:
            tag = f"{run.run_id}-{run.db_name}-{name}"
            run_limited(spark, work, settings.time_limit_seconds, tag, expired)
        except TimeLimitReached as limit:
            return list(rows) + [plain_verdict(run, name, TIMEOUT, ERROR, error_text(limit))]
        except Exception as error:  # noqa: BLE001 - one bad table must not stop the others
            return list(rows) + [plain_verdict(run, name, ERROR, ERROR, error_text(error))]
        return rows

    at_work: set[str] = set()

    def claim(tables: list[str]) -> None:
        lease = (run.run_id, run.db_name, tables, "COMPARE", settings.lease_seconds, attempt)
        write_running(spark, verdict_root, *lease)

    def claimed(name: str) -> list[Row]:
        claim([name])
        at_work.add(name)
        try:
            return one_table(name)
        finally:
            at_work.discard(name)

    with ThreadPoolExecutor(max_workers=settings.parallel_tables) as pool:
        waiting = {pool.submit(claimed, name) for name in names}
        while waiting:
            finished, waiting = wait(waiting, settings.lease_seconds / 3, FIRST_COMPLETED)
            for done in finished:
                store(done.result())
            if not finished:
                claim(sorted(at_work))
    return read_verdicts(spark, verdict_root, run.run_id)


def compare_databases(
    spark: SparkSession,
    configs: list[DatabaseConfig],
    run_id: str,
    run_time: str,
    verdict_root: str,
    settings: SuiteSettings = SuiteSettings(),
) -> DataFrame:
    """Compare every configured database; one that fails does not stop the next."""
    for config in configs:
        run = Run(run_id, run_time, config.name)
        try:
            source = JdbcTables(spark, config)
            compare_database(spark, source, config.lake_base, run, verdict_root, settings)
        except Exception as error:  # noqa: BLE001 - recorded, then the next database
            row = plain_verdict(run, CATALOG_TABLE, TABLE_COUNT, ERROR, error_text(error))
            failed = spark.createDataFrame([row], VERDICT_SCHEMA)
            write_verdicts(failed, verdict_root, f"{time.time_ns():020d}")
    return read_verdicts(spark, verdict_root, run_id)

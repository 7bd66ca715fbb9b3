"""The checks as one-row verdict frames."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    CATALOG_TABLE,
    CHECKSUM,
    CHECKSUM_BUCKETS,
    COUNT,
    DETAIL_BUCKETS,
    DETAIL_SAMPLES,
    ERROR,
    MISMATCH,
    OK,
    ROW_DIFF,
    SCHEMA,
    TABLE_COUNT,
    VERDICT_SCHEMA,
)
from ..operators.frames import first_text, one_row
from ..operators.inventory import inventory_report
from ..operators.row_diff import row_diff_report
from ..sources.sessions import child_session


@dataclass(frozen=True)
class Run:
    """Identity of a run; one run_time for all its verdicts."""

    run_id: str
    run_time: str
    db_name: str

    @classmethod
    def starting(cls, moment: datetime, db_name: str = "") -> Run:
        """A run named after the time it starts at, to the second."""
        return cls(moment.strftime("%Y%m%d_%H%M%S"), moment.strftime("%Y-%m-%d"), db_name)


def _status(good: Column) -> Column:
    return F.when(good, OK).otherwise(MISMATCH)


def verdict(
    report: DataFrame,
    run: Run,
    table_name: str | Column,
    check_type: str,
    status: Column,
    source_value: Column | None = None,
    sink_value: Column | None = None,
    detail: Column | None = None,
) -> DataFrame:
    """Turn each row of a report, mostly one, into a verdict row."""

    def text(c: Column | None) -> Column:
        return F.lit("") if c is None else F.coalesce(c.cast("string"), F.lit(""))

    columns = {
        "run_id": F.lit(run.run_id),
        "run_time": F.lit(run.run_time),
        "db_name": F.lit(run.db_name),
        "table_name": table_name if isinstance(table_name, Column) else F.lit(table_name),
        "check_type": F.lit(check_type),
        "status": status,
        "source_value": text(source_value),
        "sink_value": text(sink_value),
        "detail": text(detail),
        "duration_ms": F.lit(0).cast("bigint"),
    }
    return report.select(*[columns[n].alias(n) for n in VERDICT_SCHEMA.fieldNames()])


def schema_check(diff: DataFrame, run: Run, table_name: str) -> DataFrame:
    """SCHEMA verdict of one table from its ``schema_diff`` rows.

    The rows of one table are gathered into the detail text: they are bounded by its
    number of columns.
    """
    entries = F.array_sort(F.collect_list(F.concat_ws(":", "column_name", "issue")))
    report = diff.filter(F.col("table_name") == table_name.upper()).agg(
        F.count(F.lit(1)).alias("issues"), F.array_join(entries, ";").alias("entries")
    )
    return verdict(
        report, run, table_name, SCHEMA, _status(F.col("issues") == 0), detail=F.col("entries")
    )


def schema_checks(diff: DataFrame, tables: DataFrame, run: Run) -> DataFrame:
    """SCHEMA verdicts of all ``tables`` (table_name) from the ``schema_diff`` rows of all.

    One aggregation whatever the number of tables; a table without an issue is OK.  The
    rows of a table are gathered into its detail text: they are bounded by its columns.
    """
    issues = diff.select("table_name", F.concat_ws(":", "column_name", "issue").alias("entry"))
    wanted = tables.select(F.upper("table_name").alias("table_name")).distinct()
    # Every table adds a row without an entry, so those without an issue are there as well.
    entries = F.array_sort(F.collect_list("entry"))
    report = (
        issues.withColumn("wanted", F.lit(False))
        .union(wanted.select("table_name", F.lit(None).cast("string"), F.lit(True)))
        .groupBy("table_name")
        .agg(F.count("entry").alias("issues"), F.array_join(entries, ";").alias("entries"), F.bool_or("wanted").alias("wanted"))
        .filter("wanted")
    )
    return verdict(
        report, run, F.col("table_name"), SCHEMA, _status(F.col("issues") == 0), detail=F.col("entries")
    )


def row_counts(source: DataFrame, sink: DataFrame) -> DataFrame:
    """(source_count, sink_count) of two frames; only row counts are read."""
    return one_row(
        source.agg(F.count(F.lit(1)).alias("source_count")),
        sink.agg(F.count(F.lit(1)).alias("sink_count")),
    )


def footer_counts(spark: SparkSession, source_path: str, sink_path: str) -> DataFrame:
    """(source_count, sink_count) of two stored tables, from the footers of their files.

    Spark pushes the count into its parquet reader, so no column is read, whatever the
    size of the tables.  The setting that allows it belongs to a session of its own.
    """
    child = child_session(spark)
    child.conf.set("spark.sql.sources.useV1SourceList", "")
    child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return row_counts(child.read.parquet(source_path), child.read.parquet(sink_path))


def count_check(counts: DataFrame, run: Run, table_name: str) -> DataFrame:
    """COUNT verdict from a frame holding source_count and sink_count.

    ``counts`` is either ``row_counts`` or the ``bucket_compare`` frame of the table,
    whose bucket counts add up to the same totals without another scan.
    """
    report = counts.agg(
        F.coalesce(F.sum("source_count"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("sink_count"), F.lit(0)).alias("sink_count"),
    )
    gap = F.abs(F.col("source_count") - F.col("sink_count"))
    return verdict(
        report,
        run,
        table_name,
        COUNT,
        _status(gap == 0),
        F.col("source_count"),
        F.col("sink_count"),
        F.when(gap != 0, F.concat(F.lit("Mismatch "), gap.cast("string"), F.lit(" rows"))),
    )


def checksum_check(
    differing: DataFrame, run: Run, table_name: str, bucket_count: int = CHECKSUM_BUCKETS
) -> DataFrame:
    """CHECKSUM verdict from the differing buckets (as from ``checksum_diff``)."""
    report = one_row(
        differing.agg(F.count(F.lit(1)).alias("buckets")),
        first_text(differing, "bucket_id", DETAIL_BUCKETS, "first_ids"),
    )
    buckets = F.col("buckets")
    return verdict(
        report,
        run,
        table_name,
        CHECKSUM,
        _status(buckets == 0),
        F.lit(bucket_count),
        F.lit(bucket_count) - buckets,
        F.when(
            buckets > 0,
            F.concat(buckets.cast("string"), F.lit(" buckets differ: "), F.col("first_ids")),
        ),
    )


def row_diff_check(diff: DataFrame, run: Run, table_name: str, multiset: bool = True) -> DataFrame:
    """ROW_DIFF verdict from ``row_diff`` rows.

    With ``multiset`` rows that occur on both sides but not equally often are a mismatch
    too; without it only rows missing on one side count.
    """
    report = row_diff_report(diff, DETAIL_SAMPLES)
    good = (F.col("only_in_source") == 0) & (F.col("only_in_sink") == 0)
    if multiset:
        good = good & (F.col("count_mismatch") == 0)
    parts = [
        ("only_in_source", "only_in_source"),
        ("only_in_sink", "only_in_sink"),
        ("count_mismatch", "count_mismatch"),
        ("sample_hashes_src", "source_sample"),
        ("sample_hashes_sink", "sink_sample"),
    ]
    detail = F.concat_ws(
        "|", *[F.concat(F.lit(label + "="), F.col(c).cast("string")) for label, c in parts]
    )
    return verdict(
        report,
        run,
        table_name,
        ROW_DIFF,
        _status(good),
        F.col("only_in_source"),
        F.col("only_in_sink"),
        detail,
    )


def table_inventory_check(diff: DataFrame, run: Run) -> DataFrame:
    """TABLE_COUNT verdict from ``table_inventory_diff`` rows; ERROR if a probe failed."""
    report = inventory_report(diff)
    failed = F.col("probe_failed") > 0
    complete = (F.col("missing_in_sink") == 0) & (F.col("extra_in_sink") == 0)
    parts = [
        ("skipped_empty_in_source", "skipped_names"),
        ("missing_in_sink", "missing_names"),
        ("extra_in_sink", "extra_names"),
    ]
    detail = F.concat_ws("|", *[F.concat(F.lit(label + "="), F.col(c)) for label, c in parts])
    return verdict(
        report,
        run,
        CATALOG_TABLE,
        TABLE_COUNT,
        F.when(failed, ERROR).otherwise(_status(complete)),
        F.col("non_empty"),
        F.col("lake_tables"),
        F.when(failed, F.concat(detail, F.lit("|probe_failed="), F.col("failed_names"))).otherwise(
            detail
        ),
    )

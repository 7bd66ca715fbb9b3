"""Comparison of the table lists of a database and its lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    COMMON,
    DETAIL_TABLES,
    EXTRA_IN_SINK,
    MISSING_IN_SINK,
    PROBE_FAILED,
    SKIPPED,
)
from .frames import first_text, one_row


def table_inventory_diff(source_tables: DataFrame, lake_tables: DataFrame) -> DataFrame:
    """(table_name, in_source, has_rows, in_lake, status, reason), one row per table.

    ``source_tables`` holds table_name and has_rows, ``lake_tables`` holds table_name.
    has_rows is NULL when the source could not be asked.  A table that is empty in the
    source counts as extra when the lake has it.
    """
    source = source_tables.select(
        F.upper("table_name").alias("table_name"),
        F.lit(True).alias("in_source"),
        "has_rows",
        F.lit(False).alias("in_lake"),
    )
    lake = lake_tables.select(
        F.upper("table_name").alias("table_name"),
        F.lit(False).alias("in_source"),
        F.lit(None).cast("boolean").alias("has_rows"),
        F.lit(True).alias("in_lake"),
    )
    matched = (
        source.unionByName(lake)
        .groupBy("table_name")
        .agg(
            F.max("in_source").alias("in_source"),
            F.max("has_rows").alias("has_rows"),
            F.max("in_lake").alias("in_lake"),
        )
    )
    has_rows, in_lake, in_source = F.col("has_rows"), F.col("in_lake"), F.col("in_source")
    status = (
        F.when(in_source & has_rows.isNull(), PROBE_FAILED)
        .when(has_rows & in_lake, COMMON)
        .when(has_rows, MISSING_IN_SINK)
        .when(in_lake, EXTRA_IN_SINK)
        .otherwise(SKIPPED)
    )
    reason = F.when(
        F.col("status") == EXTRA_IN_SINK,
        F.when(in_source, "EMPTY_IN_SOURCE").otherwise("ABSENT_IN_SOURCE"),
    )
    return matched.withColumn("status", status).withColumn("reason", reason)


def inventory_report(diff: DataFrame) -> DataFrame:
    """One row: sizes of both lists and of each class, and the first names of each class."""
    status, has_rows = F.col("status"), F.col("has_rows")
    empty = F.col("in_source") & ~has_rows
    sizes = diff.agg(
        F.count_if("in_source").alias("source_tables"),
        F.count_if(has_rows).alias("non_empty"),
        F.count_if(empty).alias("skipped_empty"),
        F.count_if("in_lake").alias("lake_tables"),
        F.count_if(status == COMMON).alias("common"),
        F.count_if(status == MISSING_IN_SINK).alias("missing_in_sink"),
        F.count_if(status == EXTRA_IN_SINK).alias("extra_in_sink"),
        F.count_if(status == PROBE_FAILED).alias("probe_failed"),
    )
    names = [
        first_text(diff.filter(wanted), "table_name", DETAIL_TABLES, name)
        for wanted, name in (
            (empty, "skipped_names"),
            (status == MISSING_IN_SINK, "missing_names"),
            (status == EXTRA_IN_SINK, "extra_names"),
            (status == PROBE_FAILED, "failed_names"),
        )
    ]
    return one_row(sizes, *names)

"""What a run found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MISMATCH


def _of_run(verdicts: DataFrame, run_id: str | None) -> DataFrame:
    return verdicts if run_id is None else verdicts.filter(F.col("run_id") == run_id)


def summary(verdicts: DataFrame, run_id: str | None = None, rows: int | None = None) -> DataFrame:
    """(db_name, check_type, status, cnt) in that order, the first ``rows`` if given."""
    found = (
        _of_run(verdicts, run_id)
        .groupBy("db_name", "check_type", "status")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("db_name", "check_type", "status")
    )
    return found if rows is None else found.limit(rows)


def mismatch_count(verdicts: DataFrame, run_id: str | None = None) -> DataFrame:
    """One row with the number of MISMATCH verdicts."""
    return _of_run(verdicts, run_id).agg(
        F.count_if(F.col("status") == MISMATCH).alias("mismatches")
    )


def mismatches(
    verdicts: DataFrame, run_id: str | None = None, rows: int | None = None
) -> DataFrame:
    """All mismatching verdicts, or the first ``rows`` by database, table and check."""
    found = (
        _of_run(verdicts, run_id)
        .filter(F.col("status") == MISMATCH)
        .select("db_name", "table_name", "check_type", "source_value", "sink_value", "detail")
    )
    if rows is None:
        return found
    return found.orderBy("db_name", "table_name", "check_type").limit(rows)

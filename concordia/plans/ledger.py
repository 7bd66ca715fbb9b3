"""Progress of a run, derived from the verdicts already stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CATALOG_TABLE, ERROR, ROW_DIFF

DONE, FAILED, IN_PROGRESS = "DONE", "FAILED", "IN_PROGRESS"


def _names() -> list:
    return ["run_id", F.upper("db_name").alias("db_name"), F.upper("table_name").alias("table_name")]


def table_states(
    verdicts: DataFrame, running: DataFrame | None = None, now: Column | None = None
) -> DataFrame:
    """(run_id, db_name, table_name, state) of every table with verdicts.

    DONE     the last check of the suite was reached without an error
    IN_PROGRESS  an attempt holds a lease on the table (``running``, as from
             ``read_running``), or some checks are recorded, but neither the last one nor
             an error
    FAILED   an error was recorded and no later attempt finished, or an attempt let its
             lease lapse without leaving a verdict

    A finished attempt settles a table for good, whatever failed before it, so no order
    of attempts is needed.  ``now`` is the time at which leases are looked at, the current
    one by default.
    """
    finished = (F.col("check_type") == ROW_DIFF) & (F.col("status") != ERROR)
    found = (
        verdicts.filter(F.col("table_name") != CATALOG_TABLE)
        .groupBy(*_names())
        .agg(
            F.bool_or(finished).alias("finished"),
            F.bool_or(F.col("status") == ERROR).alias("failed"),
        )
    )
    if running is not None:
        held = F.col("lease_until") > (F.current_timestamp() if now is None else now)
        claims = running.groupBy(*_names()).agg(F.bool_or(held).alias("held"))
        keys = ["run_id", "db_name", "table_name"]
        found = found.join(claims, keys, "full_outer")
    else:
        found = found.withColumn("held", F.lit(None).cast("boolean"))
    state = (
        F.when(F.col("finished"), DONE)
        .when(F.col("held"), IN_PROGRESS)
        .when(F.col("failed") | F.col("failed").isNull(), FAILED)
        .otherwise(IN_PROGRESS)
    )
    return found.select("run_id", "db_name", "table_name", state.alias("state"))


def pending_tables(
    tables: DataFrame, verdicts: DataFrame, running: DataFrame | None = None, now: Column | None = None
) -> DataFrame:
    """Rows of ``tables`` (run_id, db_name, table_name, ...) that are not DONE yet.

    With ``running`` those that another attempt holds a lease on are left out, too.
    """
    settled = F.col("state") == DONE
    if running is not None:
        held = running.filter(F.col("lease_until") > (F.current_timestamp() if now is None else now))
        leased = held.select(*_names()).distinct()
    done = table_states(verdicts).filter(settled).drop("state")
    wanted = tables.withColumn("db_name", F.upper("db_name")).withColumn(
        "table_name", F.upper("table_name")
    )
    left = wanted.join(done, ["run_id", "db_name", "table_name"], "left_anti")
    return left if running is None else left.join(leased, ["run_id", "db_name", "table_name"], "left_anti")

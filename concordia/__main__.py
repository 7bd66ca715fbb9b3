"""Compare all databases of a catalogue file and show what was found.

    spark-submit --py-files concordia.zip -m concordia CATALOGUE VERDICTS [--run-id ID]

Pass the run id of an interrupted run to continue it.
"""

from __future__ import annotations

import argparse
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from .constants import CHECKSUM_BUCKETS, MISMATCH_ROWS, SUMMARY_ROWS, TABLE_TIMEOUT_MINUTES
from .functions.canonical import CanonicalOptions
from .plans import Run, SuiteSettings, compare_databases, mismatch_count, mismatches, summary
from .sources import load_databases, load_table_list


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="concordia", description=__doc__)
    parser.add_argument("catalogue", help="JSON file listing the databases")
    parser.add_argument("verdicts", help="folder of the verdict table")
    parser.add_argument("--run-id")
    parser.add_argument("--zone", default="UTC", help="time zone of run id and run date")
    parser.add_argument("--parallel-tables", type=int, default=1)
    parser.add_argument("--tables", help="JSON file of the tables to compare, by database")
    parser.add_argument("--time-limit", type=float, default=TABLE_TIMEOUT_MINUTES, help="minutes a table may take")
    parser.add_argument("--bucket-count", type=int, default=CHECKSUM_BUCKETS)
    parser.add_argument("--categories", choices=["exact", "substring"], default="exact")
    parser.add_argument("--columns", choices=["all", "common"], default="all")
    parser.add_argument("--ignore-copies", action="store_true", help="numbers of equal rows may differ")
    parser.add_argument("--strings", choices=["fold", "exact"], default="fold")
    parser.add_argument("--empty-as-null", action="store_true")
    parser.add_argument("--numeric", choices=["by_type", "by_value"], default="by_type")
    parser.add_argument("--ts-precision", choices=["ms", "us"], default="ms")
    parser.add_argument("--ntz-zone", help="time zone of times without one, to compare them with instants")
    parser.add_argument("--nested", choices=["as_stored", "by_options"], default="as_stored")
    chosen = parser.parse_args(arguments)
    canonical = CanonicalOptions(
        strings=chosen.strings,
        empty_as_null=chosen.empty_as_null,
        numeric=chosen.numeric,
        ts_precision=chosen.ts_precision,
        ntz_zone=chosen.ntz_zone,
        nested=chosen.nested,
    )

    spark = SparkSession.builder.appName("table parity").getOrCreate()
    started = Run.starting(datetime.now(ZoneInfo(chosen.zone)))
    run_id = chosen.run_id or started.run_id
    tables = None
    if chosen.tables:
        tables = {r["database"]: r["tables"] for r in load_table_list(spark, chosen.tables).collect()}
    verdicts = compare_databases(
        spark,
        load_databases(spark, chosen.catalogue),
        run_id,
        started.run_time,
        chosen.verdicts,
        SuiteSettings(
            time_limit_seconds=chosen.time_limit * 60,
            parallel_tables=chosen.parallel_tables,
            compare={
                "options": canonical,
                "bucket_count": chosen.bucket_count,
                "categories": chosen.categories,
                "columns": chosen.columns,
                "multiset": not chosen.ignore_copies,
            },
            tables=tables,
        ),
    )
    print(f"Run {run_id}")
    summary(verdicts, rows=SUMMARY_ROWS).show(SUMMARY_ROWS, truncate=False)
    found = mismatch_count(verdicts).first()["mismatches"]
    print(f"{found} mismatches")
    if found:
        mismatches(verdicts, rows=MISMATCH_ROWS).show(MISMATCH_ROWS, truncate=False)


if __name__ == "__main__":
    main()

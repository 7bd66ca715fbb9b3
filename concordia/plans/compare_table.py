"""All checks of one table."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..constants import (
    CHECKSUM,
    CHECKSUM_BUCKETS,
    COUNT,
    DETAIL_ERROR_CHARS,
    ERROR,
    OK,
    ONLY_IN_SINK,
    ONLY_IN_SOURCE,
    READ_SINK,
    READ_SOURCE,
    ROW_DIFF,
    ROW_SAMPLE,
    ROWS_PER_SHUFFLE_TASK,
    SCHEMA,
    VERDICT_SCHEMA,
)
from ..functions.canonical import DEFAULT_OPTIONS, CanonicalOptions, quoted
from ..functions.fingerprint import XXHASH64, fingerprint
from ..operators.checksum import bucket_checksum, bucket_compare
from ..operators.hash_tree import checksum_tree
from ..operators.row_diff import diff_sample, row_diff, size_shuffle
from ..operators.schema_diff import columns_of, schema_diff
from ..sources.scratch import cached_hashes, checkpointed, files_stamp, frozen_hashes, kept
from ..sources.sessions import restored_settings
from .checks import Run, checksum_check, count_check, row_diff_check, schema_check

Emit = Callable[[Row], None]


def plain_verdict(
    run: Run, table_name: str, check_type: str, status: str, detail: str, duration_ms: int = 0
) -> Row:
    """A verdict that needs no data, such as an error."""
    values = (run.run_id, run.run_time, run.db_name, table_name, check_type, status, "", "")
    return Row(*VERDICT_SCHEMA.fieldNames())(*values, detail, duration_ms)


def error_text(error: BaseException) -> str:
    """First characters of the message, or the class name of an error without one."""
    return (str(error) or type(error).__name__)[:DETAIL_ERROR_CHARS]


def shared_columns(source: DataFrame, sink: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames cut to the columns they have in common, ignoring case."""
    common = {c.upper() for c in source.columns} & {c.upper() for c in sink.columns}
    if not common:
        raise ValueError("the two sides have no column in common")

    def cut(df: DataFrame) -> DataFrame:
        return df.select(*[quoted(c) for c in df.columns if c.upper() in common])

    return cut(source), cut(sink)


def compare_table(
    source: DataFrame,
    sink: DataFrame,
    run: Run,
    table_name: str,
    *,
    source_columns: DataFrame | None = None,
    dialect: str = "spark",
    categories: str = "exact",
    options: CanonicalOptions = DEFAULT_OPTIONS,
    columns: str = "all",
    bucket_count: int = CHECKSUM_BUCKETS,
    refinement: int = 1,
    bucket_fn: str = XXHASH64,
    multiset: bool = True,
    reuse: str = "rescan",
    emit: Emit | None = None,
    samples: Callable[[str, DataFrame], None] | None = None,
    sample_size: int = ROW_SAMPLE,
    schema_verdict: Row | None = None,
    leaf_rows: int = ROWS_PER_SHUFFLE_TASK,
    phase_folder: str | None = None,
    store_buckets: Callable[[DataFrame], None] | None = None,
    store_rows: Callable[[DataFrame], DataFrame] | None = None,
    errors: str = "raise",
) -> DataFrame:
    """SCHEMA, COUNT, CHECKSUM and ROW_DIFF verdicts of one table pair.

    Phase 1 scans each side once and reduces it to bucket checksums, which answer COUNT
    and CHECKSUM together.  Phase 2 runs only if buckets differ and shuffles only the
    hashes of rows in those buckets.

    ``source_columns`` is the declared column list (table_name, column_name, data_type)
    in the type names of ``dialect``; without it the types of ``source`` itself are used.
    With ``refinement`` above 1 the differing buckets are cut into so many parts and
    compared again before phase 2, level by level as ``checksum_tree`` decides: only while
    few of the buckets differ and they hold more than ``leaf_rows`` rows.
    ``reuse`` says where phase 2 gets the row hashes from.  "rescan" reads both sides
    again: right for stored files, since a clean table, the usual case, then pays for
    nothing but one scan.  "cache" persists the hashes (memory and disk), worth it for
    wide rows where differences are expected.  "freeze_source" stores those of the source as a table
    first, for a database that changes meanwhile or must not be read twice.
    ``emit`` is called with each verdict as soon as it is known.
    ``samples`` is called with "source" and "sink" and at most ``sample_size`` rows found on
    that side only (see ``diff_sample``) if rows differ; it must write or collect them before
    it returns.  They hold row contents, so verdicts never do, and take one more scan.
    ``store_buckets`` is handed all differing nodes of the checksum tree, ``store_rows`` all
    rows of the row diff; it returns them from where it has put them, so that verdict and
    samples need no second computation.
    ``phase_folder`` keeps the result of phase 1 for a later attempt, which takes it up if
    both sides still read the same files (only with "rescan").  ``schema_verdict`` is taken
    for SCHEMA if it is at hand.  Session settings are the same afterwards as before.

    With ``errors="verdict"`` a check that fails is an ERROR verdict with the message, and the
    others still run; those that need the checksums of phase 1 are ERROR, too, if these fail.
    Only wrong arguments and failures of ``emit`` and ``samples`` are raised then.
    """
    if columns not in ("all", "common"):
        raise ValueError(f"columns must be 'all' or 'common', got {columns!r}")
    if errors not in ("raise", "verdict"):
        raise ValueError(f"errors must be 'raise' or 'verdict', got {errors!r}")
    if reuse not in ("rescan", "cache", "freeze_source"):
        raise ValueError(f"reuse must be rescan, cache or freeze_source, got {reuse!r}")
    spark = sink.sparkSession
    rows: list[Row] = []
    settings = ExitStack()
    for session in {id(s): s for s in (spark, source.sparkSession)}.values():
        settings.enter_context(restored_settings(session))

    def add(row: Row) -> None:
        rows.append(row)
        if emit is not None:
            emit(row)

    def timed(check_type: str, build: Callable[[], DataFrame]) -> Row | None:
        """Run one check; its frame has exactly one row.  None if it fails and that is a verdict."""
        start = time.monotonic()
        try:
            values, failure = build().first().asDict(), None
        except Exception as error:  # noqa: BLE001 - any failure of a check is its verdict
            if errors == "raise":
                raise
            values, failure = {}, error_text(error)
        duration = int((time.monotonic() - start) * 1000)
        if failure is not None:
            add(plain_verdict(run, table_name, check_type, ERROR, failure, duration))
            return None
        values["duration_ms"] = duration
        row = Row(*VERDICT_SCHEMA.fieldNames())(*[values[n] for n in VERDICT_SCHEMA.fieldNames()])
        add(row)
        return row

    with settings as stack:
        if schema_verdict is not None:
            add(schema_verdict)
        else:

            def schema_phase() -> DataFrame:
                own = source_columns is None
                listed = columns_of(spark, table_name, source.schema) if own else source_columns
                declared = listed.filter(F.upper("table_name") == table_name.upper())
                landed = columns_of(spark, table_name, sink.schema)
                diff = schema_diff(declared, landed, "spark" if own else dialect, categories)
                return schema_check(diff, run, table_name)

            timed(SCHEMA, schema_phase)

        if columns == "common":
            source, sink = shared_columns(source, sink)
        source_hashes = sink_hashes = None
        compared: list[DataFrame] = []

        def phase_one() -> DataFrame:
            nonlocal source_hashes, sink_hashes
            source_hashes = fingerprint(source, options, keep_columns=False)
            sink_hashes = fingerprint(sink, options, keep_columns=False)
            if reuse == "freeze_source":
                source_hashes = stack.enter_context(frozen_hashes(source_hashes))
            elif reuse == "cache":
                source_hashes = stack.enter_context(cached_hashes(source_hashes))
                sink_hashes = stack.enter_context(cached_hashes(sink_hashes))
            both = bucket_compare(
                bucket_checksum(source_hashes, bucket_count, bucket_fn),
                bucket_checksum(sink_hashes, bucket_count, bucket_fn),
            )
            stamp = files_stamp(source, sink) if phase_folder is not None and reuse == "rescan" else None
            # At most bucket_count rows; all later steps read these instead of the tables.
            if stamp is not None:
                asked = hashlib.sha256(repr((stamp, options, bucket_count, bucket_fn)).encode()).hexdigest()
                compared.append(kept(both, f"{phase_folder}/{asked}"))
            else:
                compared.append(checkpointed(both))
            return count_check(compared[0], run, table_name)

        def phase_two() -> DataFrame:
            nonlocal diff
            tree = checksum_tree(
                source_hashes, sink_hashes, bucket_count, refinement, bucket_fn, leaf_rows, compared[0]
            )
            if store_buckets is not None:
                store_buckets(tree.nodes)
            # The tree has counted exactly the rows that phase 2 is going to shuffle.
            for session in (spark, source.sparkSession):
                size_shuffle(session, tree.touched)
            diff = row_diff(
                source_hashes, sink_hashes, tree.leaves, tree.bucket_count, bucket_fn, tree.differing
            )
            if store_rows is not None:
                diff = store_rows(diff)
            return row_diff_check(diff, run, table_name, multiset)

        diff: DataFrame | None = None
        if timed(COUNT, phase_one) is None:
            for check_type in (CHECKSUM, ROW_DIFF):
                add(plain_verdict(run, table_name, check_type, ERROR, "Not run, the checksums of COUNT have failed"))
            return spark.createDataFrame(rows, VERDICT_SCHEMA)
        differing = compared[0].filter("differs")
        checksum = timed(CHECKSUM, lambda: checksum_check(differing, run, table_name, bucket_count))
        if checksum is not None and checksum["status"] == OK:
            detail = "No checksum differences, row diff skipped"
            add(plain_verdict(run, table_name, ROW_DIFF, OK, detail))
        elif timed(ROW_DIFF, phase_two) is not None and samples is not None:
            samples("source", diff_sample(source, diff, ONLY_IN_SOURCE, sample_size, options))
            samples("sink", diff_sample(sink, diff, ONLY_IN_SINK, sample_size, options))
    return spark.createDataFrame(rows, VERDICT_SCHEMA)


def read_check(
    read: Callable[[], DataFrame], run: Run, table_name: str, side: str
) -> tuple[DataFrame | None, Row | None]:
    """Open one side of a table: the frame, or the ERROR verdict to record."""
    check_type = {"source": READ_SOURCE, "sink": READ_SINK}[side]
    try:
        return read(), None
    except Exception as error:  # noqa: BLE001 - any failure to open a table is a verdict
        detail = f"Failed to read {side} table {table_name}: {error_text(error)}"
        return None, plain_verdict(
            run, table_name, check_type, ERROR, detail[:DETAIL_ERROR_CHARS]
        )

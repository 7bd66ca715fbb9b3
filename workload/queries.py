"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.constants import CATALOG_TABLE, HASH, MISMATCH_ROWS, ONLY_IN_SINK, ONLY_IN_SOURCE
from concordia.functions.canonical import CanonicalOptions, canonical_columns
from concordia.functions.fingerprint import SHA_PREFIX, XXHASH64, fingerprint
from concordia.functions.type_category import type_category
from concordia.operators import (
    bucket_checksum,
    bucket_compare,
    checksum_diff,
    checksum_refined,
    checksum_tree,
    diff_sample,
    row_diff,
    row_diff_summary,
    row_multiplicity,
    schema_diff,
    table_inventory_diff,
)
from concordia.plans import (
    ParquetTables,
    Run,
    SuiteSettings,
    checksum_check,
    compare_database,
    compare_table,
    count_check,
    footer_counts,
    mismatch_count,
    mismatches,
    pending_tables,
    row_counts,
    row_diff_check,
    schema_check,
    schema_checks,
    summary,
    table_inventory_check,
    table_states,
)
from concordia.sources import (
    checkpointed,
    commit_attempt,
    compact_verdicts,
    list_lake_tables,
    read_diff_buckets,
    read_diff_rows,
    read_inventory,
    read_verdicts,
    scan_lake,
    shared_folder,
    table_list_entries,
    tables_per_database,
    write_inventory,
    write_verdicts,
)

from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run("r1", "2024-01-01", "TPCH")
BUCKETS = 1000
TREE_LEAF_ROWS = 16
SAMPLE = 100


def _hashes(df: DataFrame, options: CanonicalOptions = CanonicalOptions()) -> DataFrame:
    return fingerprint(df, options, keep_columns=False)


def _orders_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return t.table(spark, sf, "orders"), t.sql(spark, sf, t.ORDERS_COPY, "orders")


def _events_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return t.table(spark, sf, "events"), t.sql(spark, sf, t.EVENTS_COPY, "events")


def _documents_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return t.table(spark, sf, "documents"), t.sql(spark, sf, t.DOCUMENTS_COPY, "documents")


def _pruned_diff(source: DataFrame, sink: DataFrame, bucket_fn: str = XXHASH64) -> DataFrame:
    """Two-phase row diff: bucket checksums first, then only the differing buckets."""
    left, right = _hashes(source), _hashes(sink)
    differing = checkpointed(checksum_diff(left, right, BUCKETS, bucket_fn).select("bucket_id"))
    return row_diff(left, right, differing, BUCKETS, bucket_fn)


def _dealt_anew(df: DataFrame, least: int) -> DataFrame:
    """The same rows in other partitions: as many as the table is read in, but at least so many."""
    return df.repartition(max(least, df.rdd.getNumPartitions()))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Canonical forms ------------------------------------------------------------------


def canonical(name: str) -> Query:
    return lambda spark, sf: canonical_columns(t.table(spark, sf, name))


def canonical_decimal(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    return canonical_columns(
        orders.select(
            "o_orderkey",
            F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
            F.col("o_orderkey").cast("decimal(10,0)").alias("whole"),
        )
    )


def canonical_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    return canonical_columns(orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")))


def canonical_boolean(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    flag = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus") == "F")
    return canonical_columns(orders.select("o_orderkey", flag.alias("is_final")))


def canonical_binary(spark: SparkSession, sf: str) -> DataFrame:
    pages = t.table(spark, sf, "pages")
    return canonical_columns(pages.select("page_id", F.encode("html", "UTF-8").alias("html")))


def canonical_instant(spark: SparkSession, sf: str) -> DataFrame:
    """Instants, read from the zone-less event times as UTC."""
    events = t.table(spark, sf, "events")
    instant = F.concat(F.col("ts").cast("string"), F.lit(" UTC")).cast("timestamp")
    return canonical_columns(events.select("event_id", instant.alias("ts")))


def canonical_ntz_as_instant(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events")
    options = CanonicalOptions(ntz_zone="UTC", ts_precision="us")
    return canonical_columns(events.select("event_id", "ts"), options)


def canonical_micros(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events")
    return canonical_columns(events.select("event_id", "ts"), CanonicalOptions(ts_precision="us"))


def canonical_by_value(spark: SparkSession, sf: str) -> DataFrame:
    return canonical_columns(t.table(spark, sf, "lineitem"), CanonicalOptions(numeric="by_value"))


def canonical_decimal_exact(spark: SparkSession, sf: str) -> DataFrame:
    """All digits of decimals that the ten-digit form would round."""
    return canonical_columns(t.sql(spark, sf, t.LONG_DECIMALS, "part"), CanonicalOptions(digits="exact"))


def canonical_double_exact(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.table(spark, sf, "lineitem")
    picked = lines.select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_tax") / 3).alias("third"))
    return canonical_columns(picked, CanonicalOptions(digits="exact"))


def canonical_exact_strings(spark: SparkSession, sf: str) -> DataFrame:
    copy = t.sql(spark, sf, t.CUSTOMER_NULLS, "customer")
    return canonical_columns(copy, CanonicalOptions(strings="exact", empty_as_null=True))


def canonical_map(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.table(spark, sf, "lineitem")
    return canonical_columns(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            F.create_map(
                F.lit("tax"), F.col("l_tax"), F.lit("quantity"), F.col("l_quantity")
            ).alias("figures"),
            F.struct("l_returnflag", "l_discount").alias("pair"),
            F.array("l_linestatus", "l_returnflag").alias("flags"),
        )
    )


def canonical_nested_by_value(spark: SparkSession, sf: str) -> DataFrame:
    lines, embeddings = t.table(spark, sf, "lineitem"), t.table(spark, sf, "embeddings")
    options = CanonicalOptions(numeric="by_value", nested="by_options")
    numbers = canonical_columns(
        lines.select(
            F.struct("l_quantity", F.col("L_ORDERKEY").alias("key")).alias("pair"),
            F.array("l_discount", "l_tax").alias("rates"),
            F.array("l_linenumber", "l_partkey").alias("wholes"),
        ),
        options,
    )
    labels = embeddings.select(
        F.struct("label", "vec_id").alias("pair"),
        F.array(F.col("label").cast("double")).alias("rates"),
        F.array("vec_id").alias("wholes"),
    )
    return numbers.unionByName(canonical_columns(labels, options))


def canonical_nested_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Case, outer spaces and empty texts inside arrays and maps."""
    lines = t.table(spark, sf, "lineitem")
    spaced = F.concat(F.lit(" "), F.lower("l_returnflag"), F.lit("  "))
    return canonical_columns(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            F.array(spaced, F.lit(""), "l_linestatus").alias("flags"),
            F.create_map(F.lit("status"), F.lower("l_linestatus"), F.lit("Flag"), spaced).alias("by_name"),
        ),
        CanonicalOptions(empty_as_null=True, nested="by_options"),
    )


def canonical_struct(spark: SparkSession, sf: str) -> DataFrame:
    """Fields in any order and case, NULL fields and NULL structs."""
    lines = t.table(spark, sf, "lineitem")
    flag = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_returnflag"))
    inner = F.when(F.col("l_linenumber") % 2 == 0, F.struct(flag.alias("z"), F.col("l_linenumber").alias("a")))
    return canonical_columns(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            F.struct(flag.alias("flag"), F.col("l_orderkey").alias("Key"), inner.alias("inner")).alias("whole"),
            inner.alias("part"),
        ),
        CanonicalOptions(nested="by_options"),
    )


def row_fingerprint(name: str) -> Query:
    return lambda spark, sf: _hashes(t.table(spark, sf, name)).select(F.col(HASH).alias("row_hash"))


def fingerprint_nulls(spark: SparkSession, sf: str) -> DataFrame:
    marked = fingerprint(t.sql(spark, sf, t.CUSTOMER_NULLS, "customer"))
    return marked.select("C_CUSTKEY", F.col(HASH).alias("row_hash"))


# Checksums ------------------------------------------------------------------------


def _portable(checksums: DataFrame, *hash_columns: str) -> DataFrame:
    for c in hash_columns:
        checksums = checksums.withColumn(c, F.col(c).cast("string"))
    return checksums


def checksum_of(name: str, bucket_fn: str = SHA_PREFIX) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        sums = bucket_checksum(_hashes(t.table(spark, sf, name)), BUCKETS, bucket_fn)
        return _portable(sums, "bucket_hash")

    return query


def checksum_diff_orders(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    diff = checksum_diff(_hashes(source), _hashes(sink), BUCKETS, SHA_PREFIX)
    return _portable(diff, "source_hash", "sink_hash").orderBy("bucket_id")


def checksum_diff_xxhash(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    diff = checksum_diff(_hashes(source), _hashes(sink), BUCKETS, XXHASH64)
    return _portable(diff, "source_hash", "sink_hash").orderBy("bucket_id")


def checksum_refined_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Second level of checksums inside the differing buckets of the first."""
    source, sink = (_hashes(df) for df in _orders_pair(spark, sf))
    coarse = checkpointed(checksum_diff(source, sink, BUCKETS, SHA_PREFIX).select("bucket_id"))
    fine = checksum_refined(source, sink, coarse, BUCKETS, 64, SHA_PREFIX)
    return _portable(fine, "source_hash", "sink_hash")


def _tree(spark: SparkSession, sf: str, copy: str) -> DataFrame:
    orders, changed = t.table(spark, sf, "orders"), t.sql(spark, sf, copy, "orders")
    tree = checksum_tree(_hashes(orders), _hashes(changed), BUCKETS, 64, SHA_PREFIX, leaf_rows=TREE_LEAF_ROWS)
    return _portable(tree.nodes, "source_hash", "sink_hash")


def hash_tree_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Three changed rows: the tree is followed down to leaves of a few rows."""
    return _tree(spark, sf, t.ORDERS_THREE_CHANGED)


def hash_tree_all_differ(spark: SparkSession, sf: str) -> DataFrame:
    """Every row changed: most buckets differ, and nothing is looked into."""
    return _tree(spark, sf, t.ORDERS_ALL_CHANGED)


def checksum_clean_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows in other partitions, column order and letter case of names."""
    lines = t.table(spark, sf, "lineitem")
    shuffled = lines.select(*[F.col(c).alias(c.upper()) for c in reversed(lines.columns)])
    compared = bucket_compare(
        bucket_checksum(_hashes(lines), BUCKETS, SHA_PREFIX),
        bucket_checksum(_hashes(_dealt_anew(shuffled, 7)), BUCKETS, SHA_PREFIX),
    )
    return compared.agg(
        F.count_if("differs").alias("differing"),
        F.sum("source_count").alias("source_rows"),
        F.sum("sink_count").alias("sink_rows"),
    )


def count_check_orders(spark: SparkSession, sf: str) -> DataFrame:
    return count_check(row_counts(*_orders_pair(spark, sf)), RUN, "APP.ORDERS").drop("duration_ms")


def count_check_footers(spark: SparkSession, sf: str) -> DataFrame:
    """COUNT of two stored tables without reading a column."""
    path = _scratch(spark, "copy")
    t.sql(spark, sf, t.ORDERS_COPY, "orders").write.parquet(path)
    counts = footer_counts(spark, f"{sf}/orders.parquet", path)
    return count_check(counts, RUN, "APP.ORDERS").drop("duration_ms")


def checksum_check_orders(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    diff = checksum_diff(_hashes(source), _hashes(sink), BUCKETS, SHA_PREFIX)
    return checksum_check(diff, RUN, "APP.ORDERS", BUCKETS).drop("duration_ms")


# Row differences ------------------------------------------------------------------


def row_multiplicity_orders(spark: SparkSession, sf: str) -> DataFrame:
    return row_multiplicity(_hashes(t.sql(spark, sf, t.ORDERS_COPY, "orders")))


def row_diff_orders(spark: SparkSession, sf: str) -> DataFrame:
    return row_diff_summary(_pruned_diff(*_orders_pair(spark, sf)))


def row_diff_events(spark: SparkSession, sf: str) -> DataFrame:
    return row_diff_summary(_pruned_diff(*_events_pair(spark, sf)))


def row_diff_documents(spark: SparkSession, sf: str) -> DataFrame:
    return row_diff_summary(_pruned_diff(*_documents_pair(spark, sf)))


def row_diff_unpruned(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    return row_diff_summary(row_diff(_hashes(source), _hashes(sink)))


def row_diff_repeated(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    return row_diff_summary(_pruned_diff(orders, t.sql(spark, sf, t.ORDERS_REPEATED, "orders")))


def row_diff_hot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Few distinct rows with very many copies each."""
    left = _hashes(t.sql(spark, sf, t.HOT_ROWS, "orders"))
    right = _hashes(t.sql(spark, sf, t.HOT_ROWS_COPY, "orders"))
    return row_diff(left, right)


def row_diff_list_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _pruned_diff(*_orders_pair(spark, sf))


def row_diff_check_orders(spark: SparkSession, sf: str) -> DataFrame:
    diff = _pruned_diff(*_orders_pair(spark, sf))
    return row_diff_check(diff, RUN, "APP.ORDERS").drop("duration_ms")


def row_diff_check_counts_ignored(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that differ in number of copies only, judged without counting copies."""
    orders = t.table(spark, sf, "orders")
    diff = _pruned_diff(orders, t.sql(spark, sf, t.ORDERS_REPEATED, "orders"))
    return row_diff_check(diff, RUN, "APP.ORDERS", multiset=False).drop("duration_ms")


def _sample(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    rows = source if kind == ONLY_IN_SOURCE else sink
    sample = diff_sample(rows, _pruned_diff(source, sink), kind, SAMPLE)
    return sample.withColumnsRenamed({HASH: "row_hash", "__row_text": "row_text"})


def diff_sample_source(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf, ONLY_IN_SOURCE)


def diff_sample_sink(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf, ONLY_IN_SINK)


def except_all_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """Surplus rows of each side, from the row diff; EXCEPT ALL must count the same."""
    source, sink = _orders_pair(spark, sf)
    diff = _pruned_diff(source, sink)
    surplus = F.col("src_count") - F.col("sink_count")
    return diff.agg(
        F.sum(F.greatest(surplus, F.lit(0))).alias("source_minus_sink"),
        F.sum(F.greatest(-surplus, F.lit(0))).alias("sink_minus_source"),
    )


# Metadata -------------------------------------------------------------------------


def type_categories(dialect: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        entries = t.sql(spark, sf, t.typed_parts(dialect), "part")
        name = F.col("data_type")
        return entries.select(
            "column_name",
            "data_type",
            type_category(dialect, name, "substring").alias("by_substring"),
            type_category(dialect, name, "exact").alias("by_name"),
        )

    return query


def _part_columns(spark: SparkSession, sf: str, categories: str) -> DataFrame:
    declared = t.sql(spark, sf, t.typed_parts("oracle"), "part")
    landed = t.sql(spark, sf, t.landed_parts(), "part")
    return schema_diff(declared, landed, "oracle", categories)


def schema_diff_parts(spark: SparkSession, sf: str) -> DataFrame:
    return _part_columns(spark, sf, "exact")


def schema_diff_parts_substring(spark: SparkSession, sf: str) -> DataFrame:
    return _part_columns(spark, sf, "substring")


def schema_check_brand(spark: SparkSession, sf: str) -> DataFrame:
    return schema_check(_part_columns(spark, sf, "exact"), RUN, "Brand#2").drop("duration_ms")


def schema_check_all(spark: SparkSession, sf: str) -> DataFrame:
    """One SCHEMA verdict for each table of a dictionary, by one aggregation."""
    tables = t.sql(spark, sf, t.typed_parts("oracle"), "part").select("table_name")
    return schema_checks(_part_columns(spark, sf, "exact"), tables, RUN).drop("duration_ms")


def _inventory(spark: SparkSession, sf: str) -> DataFrame:
    source = t.sql(spark, sf, t.SOURCE_TABLES, "customer", "orders")
    return table_inventory_diff(source, t.sql(spark, sf, t.LAKE_TABLES, "customer", "supplier"))


def inventory_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _inventory(spark, sf).select("table_name", "status", "reason")


def inventory_check(spark: SparkSession, sf: str) -> DataFrame:
    return table_inventory_check(_inventory(spark, sf), RUN).drop("duration_ms")


def catalog_entries(spark: SparkSession, sf: str) -> DataFrame:
    return table_list_entries(t.table_catalog_entries(spark, sf))


def catalog_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return tables_per_database(t.table_catalog_entries(spark, sf))


def lake_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Lay out line items as a lake of one table per flag and status, then list it."""
    base = _scratch(spark, "lake")
    lines = t.table(spark, sf, "lineitem")
    lines.write.partitionBy("l_returnflag", "l_linestatus").parquet(base)
    return list_lake_tables(spark, base).select("table_name", "owner", "table")


def lake_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Write orders as a lake table with lower-case folders and read it back by name."""
    base = _scratch(spark, "lake")
    t.table(spark, sf, "orders").write.parquet(f"{base}/app/orders")
    return scan_lake(spark, base, "APP.ORDERS")


# Verdicts -------------------------------------------------------------------------


def _order_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.sql(spark, sf, t.ORDER_VERDICTS, "orders")
    return rows.withColumn("duration_ms", F.lit(0).cast("bigint"))


def verdict_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary(_order_verdicts(spark, sf), "r1")


def verdict_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    return mismatches(_order_verdicts(spark, sf), "r1")


def verdict_mismatches_shown(spark: SparkSession, sf: str) -> DataFrame:
    """The top of the report, as the command line shows it."""
    return mismatches(_order_verdicts(spark, sf), "r1", rows=MISMATCH_ROWS)


def verdict_mismatch_count(spark: SparkSession, sf: str) -> DataFrame:
    return mismatch_count(_order_verdicts(spark, sf), "r1")


def verdict_store(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends of one run and one of another, then the first run is read back."""
    root = _scratch(spark, "verdicts")
    rows = _order_verdicts(spark, sf)
    write_verdicts(rows.filter("status = 'OK'"), root)
    write_verdicts(rows.filter("status <> 'OK'"), root)
    write_verdicts(rows.withColumn("run_id", F.lit("r2")), root)
    return read_verdicts(spark, root, "r1").drop("duration_ms")


def resumed_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a run whose mismatching tables failed in a first attempt."""
    root, rows = _scratch(spark, "verdicts"), _order_verdicts(spark, sf).filter("run_id = 'r1'")
    failed = rows.filter("status = 'MISMATCH'").withColumn("status", F.lit("ERROR"))
    write_verdicts(failed, root, "1")
    write_verdicts(rows, root, "2")
    return summary(read_verdicts(spark, root, "r1"))


def stored_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of a table list comparison, written beside the verdicts and read back."""
    root = _scratch(spark, "verdicts")
    rows = inventory_diff(spark, sf)
    write_inventory(rows, root, "r1", "TPCH")
    return read_inventory(spark, root, "r1").select(*rows.columns)


def inventory_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Table lists of three attempts, the second of which alone was finished."""
    root, rows = _scratch(spark, "verdicts"), inventory_diff(spark, sf)
    write_inventory(rows.filter("status = 'COMMON'"), root, "r1", "TPCH", "1")
    write_inventory(rows, root, "r1", "TPCH", "2")
    commit_attempt(spark, root, "r1", "TPCH", [CATALOG_TABLE], "2")
    write_inventory(rows.filter("status <> 'COMMON'"), root, "r1", "TPCH", "3")
    return read_inventory(spark, root, "r1").select(*rows.columns)


def compacted_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts appended in several attempts, read back after they were put into one file."""
    root, rows = _scratch(spark, "verdicts"), _order_verdicts(spark, sf).filter("run_id = 'r1'")
    failed = rows.filter("status = 'MISMATCH'").withColumn("status", F.lit("ERROR"))
    write_verdicts(failed, root, "1")
    write_verdicts(rows, root, "2")
    for r in rows.select("db_name").distinct().collect():
        compact_verdicts(spark, root, "r1", r["db_name"])
    return read_verdicts(spark, root, "r1").drop("duration_ms")


def progress_states(spark: SparkSession, sf: str) -> DataFrame:
    return table_states(t.sql(spark, sf, t.PROGRESS_VERDICTS, "orders"))


def progress_pending(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = t.sql(spark, sf, t.PROGRESS_VERDICTS, "orders")
    return pending_tables(t.sql(spark, sf, t.PROGRESS_TABLES, "orders"), verdicts)


# Whole comparisons ----------------------------------------------------------------


def compare_table_orders(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _orders_pair(spark, sf)
    return compare_table(source, sink, RUN, "APP.ORDERS", bucket_fn=SHA_PREFIX).drop("duration_ms")


def compare_table_declared(spark: SparkSession, sf: str) -> DataFrame:
    """Types as an Oracle dictionary declares them, one of them of another category."""
    source, sink = _orders_pair(spark, sf)
    declared = spark.createDataFrame(
        [("APP.ORDERS", name, declared) for name, declared in t.ORDERS_DECLARED.items()],
        "table_name string, column_name string, data_type string",
    )
    return compare_table(
        source, sink, RUN, "APP.ORDERS", source_columns=declared, dialect="oracle", bucket_fn=SHA_PREFIX
    ).drop("duration_ms")


def compare_table_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The row samples that a comparison hands out."""
    source, sink = _orders_pair(spark, sf)
    found: list[DataFrame] = []

    def keep(side: str, rows: DataFrame) -> None:
        shown = rows.withColumnsRenamed({HASH: "row_hash", "__row_text": "row_text"})
        found.append(shown.withColumn("side", F.lit(side)))

    compare_table(source, sink, RUN, "APP.ORDERS", samples=keep, sample_size=SAMPLE)
    return found[0].unionByName(found[1])


def compare_table_frozen_events(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = _events_pair(spark, sf)
    return compare_table(
        source, sink, RUN, "APP.EVENTS", bucket_fn=SHA_PREFIX, reuse="freeze_source"
    ).drop("duration_ms")


def compare_table_clean_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.table(spark, sf, "lineitem")
    return compare_table(lines, _dealt_anew(lines, 5), RUN, "APP.LINEITEM").drop("duration_ms")


def compare_table_common_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The copy lacks one column and has another; only shared columns are hashed."""
    orders = t.table(spark, sf, "orders")
    copy = orders.drop("o_orderpriority").withColumn("loaded_by", F.lit("etl"))
    return compare_table(orders, copy, RUN, "APP.ORDERS", columns="common").drop("duration_ms")


def _orders_suite(spark: SparkSession, sf: str) -> str:
    """The store of a run that compared orders with its changed copy."""
    left, right, root = (_scratch(spark, name) for name in ("snapshot", "lake", "verdicts"))
    orders, copy = _orders_pair(spark, sf)
    orders.write.parquet(f"{left}/app/orders")
    copy.write.parquet(f"{right}/APP/ORDERS")
    settings = SuiteSettings(compare={"bucket_fn": SHA_PREFIX})
    compare_database(spark, ParquetTables(spark, left), right, RUN, root, settings)
    return root


def diff_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every differing row hash that a suite run has stored."""
    return read_diff_rows(spark, _orders_suite(spark, sf), RUN.run_id).drop("run_id", "db_name")


def diff_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Every differing bucket that a suite run has stored."""
    found = read_diff_buckets(spark, _orders_suite(spark, sf), RUN.run_id).drop("run_id", "db_name")
    return _portable(found, "source_hash", "sink_hash")


def compare_database_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A parquet snapshot against a lake: one table differs, one is clean, one was lost,
    one is new and one is empty in the snapshot."""
    left, right = _scratch(spark, "snapshot"), _scratch(spark, "lake")
    orders, copy = _orders_pair(spark, sf)
    customer, nation = t.table(spark, sf, "customer"), t.table(spark, sf, "nation")
    orders.write.parquet(f"{left}/app/orders")
    copy.write.parquet(f"{right}/APP/ORDERS")
    customer.write.parquet(f"{left}/app/customer")
    customer.repartition(3).write.parquet(f"{right}/APP/CUSTOMER")
    nation.write.parquet(f"{left}/app/nation")
    t.table(spark, sf, "supplier").write.parquet(f"{right}/APP/SUPPLIER")
    part = t.table(spark, sf, "part")
    part.filter("p_partkey < 0").write.parquet(f"{left}/app/part")
    part.write.parquet(f"{right}/APP/PART")
    settings = SuiteSettings(compare={"bucket_fn": SHA_PREFIX})
    verdicts = compare_database(
        spark, ParquetTables(spark, left), right, RUN, _scratch(spark, "verdicts"), settings
    )
    return verdicts.drop("duration_ms")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}
    for name in t.COLUMNS:
        kind = "canonical_text" if name in t.TEXT_TABLES else "canonical"
        registered[f"{kind}_{name}"] = canonical(name)
    for name in ("orders", "lineitem", "events", "documents", "pages", "embeddings", "conversations"):
        registered[f"row_fingerprint_{name}"] = row_fingerprint(name)
    registered["bucket_checksum_orders"] = checksum_of("orders")
    registered["bucket_checksum_lineitem"] = checksum_of("lineitem")
    registered["bucket_checksum_documents"] = checksum_of("documents")
    registered["bucket_checksum_xxhash"] = checksum_of("orders", XXHASH64)
    for dialect in t.TYPE_NAMES:
        registered[f"type_category_{dialect}"] = type_categories(dialect)
    registered |= {
        "canonical_decimal": canonical_decimal,
        "canonical_date": canonical_date,
        "canonical_boolean": canonical_boolean,
        "canonical_binary": canonical_binary,
        "canonical_timestamp_instant": canonical_instant,
        "canonical_timestamp_ntz_zone": canonical_ntz_as_instant,
        "canonical_timestamp_micros": canonical_micros,
        "canonical_by_value": canonical_by_value,
        "canonical_exact_strings": canonical_exact_strings,
        "canonical_map": canonical_map,
        "canonical_nested_by_value": canonical_nested_by_value,
        "canonical_nested_fold": canonical_nested_fold,
        "canonical_struct": canonical_struct,
        "canonical_nulls": fingerprint_nulls,
        "checksum_diff_orders": checksum_diff_orders,
        "checksum_diff_xxhash": checksum_diff_xxhash,
        "checksum_refined_orders": checksum_refined_orders,
        "hash_tree_orders": hash_tree_orders,
        "hash_tree_all_differ": hash_tree_all_differ,
        "canonical_decimal_exact": canonical_decimal_exact,
        "canonical_double_exact": canonical_double_exact,
        "count_check_footers": count_check_footers,
        "schema_check_all": schema_check_all,
        "inventory_resumed": inventory_resumed,
        "compacted_verdicts": compacted_verdicts,
        "diff_rows": diff_rows,
        "diff_buckets": diff_buckets,
        "checksum_clean_lineitem": checksum_clean_lineitem,
        "checksum_check_orders": checksum_check_orders,
        "count_check_orders": count_check_orders,
        "row_multiplicity_orders": row_multiplicity_orders,
        "row_diff_orders": row_diff_orders,
        "row_diff_events": row_diff_events,
        "row_diff_documents": row_diff_documents,
        "row_diff_unpruned": row_diff_unpruned,
        "row_diff_repeated": row_diff_repeated,
        "row_diff_hot_rows": row_diff_hot_rows,
        "row_diff_list_orders": row_diff_list_orders,
        "row_diff_check_orders": row_diff_check_orders,
        "row_diff_check_counts_ignored": row_diff_check_counts_ignored,
        "diff_sample_source": diff_sample_source,
        "diff_sample_sink": diff_sample_sink,
        "except_all_equivalence": except_all_equivalence,
        "schema_diff_parts": schema_diff_parts,
        "schema_diff_parts_substring": schema_diff_parts_substring,
        "schema_check_brand": schema_check_brand,
        "table_inventory_diff": inventory_diff,
        "table_inventory_check": inventory_check,
        "table_list_entries": catalog_entries,
        "tables_per_database": catalog_sizes,
        "list_lake_tables": lake_tables,
        "scan_lake": lake_scan,
        "verdict_summary": verdict_summary,
        "verdict_mismatches": verdict_mismatches,
        "verdict_mismatches_shown": verdict_mismatches_shown,
        "verdict_mismatch_count": verdict_mismatch_count,
        "write_read_verdicts": verdict_store,
        "resumed_summary": resumed_summary,
        "inventory_rows": stored_inventory,
        "table_states": progress_states,
        "pending_tables": progress_pending,
        "compare_table_orders": compare_table_orders,
        "compare_table_declared": compare_table_declared,
        "compare_table_samples": compare_table_samples,
        "compare_table_frozen_events": compare_table_frozen_events,
        "compare_table_clean_lineitem": compare_table_clean_lineitem,
        "compare_table_common_columns": compare_table_common_columns,
        "compare_database_snapshot": compare_database_snapshot,
    }
    return registered

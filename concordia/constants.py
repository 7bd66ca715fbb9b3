"""Values shared by all modules."""

from pyspark.sql import types as T

# They decide every row hash, so changing one changes all checksums.
FIELD_SEPARATOR = "\u001e"
NULL_SENTINEL = "\u0001__NULL__\u0001"
DECIMAL_TYPE = "decimal(38,10)"
FLOAT_DIGITS = 10

# Default sizes of the checks and of the text in their verdicts.
CHECKSUM_BUCKETS = 1000
CHECKSUM_REFINEMENT = 64
ROW_SAMPLE = 100
DETAIL_BUCKETS = 20
DETAIL_SAMPLES = 5
DETAIL_TABLES = 50
DETAIL_ERROR_CHARS = 500
SUMMARY_ROWS = 200
MISMATCH_ROWS = 50
TABLE_TIMEOUT_MINUTES = 60
JDBC_FETCH_SIZE = 5000

# Helper columns added next to user columns; the prefix keeps them from clashing.
HASH = "__hash"
BUCKET = "__bucket"

# A list of differing bucket ids up to this length is broadcast (1M ids are a few
# tens of MB once hashed); beyond it the row diff runs without bucket pruning.
BROADCAST_BUCKETS = 1 << 20
# Samples up to this many hashes are broadcast, larger ones are joined by shuffle.
BROADCAST_SAMPLE = 100_000

# Rows one task reads from a database table without a configured split, and the most
# tasks, that is connections, for one such table.
JDBC_ROWS_PER_TASK = 2_000_000
JDBC_MAX_TASKS = 32

# Rows one reduce task of a row diff should count: some 400 MB of hashes and counters.
ROWS_PER_SHUFFLE_TASK = 8_000_000

OK, MISMATCH, ERROR = "OK", "MISMATCH", "ERROR"

READ_SOURCE, READ_SINK = "READ_SOURCE", "READ_SINK"
TABLE_COUNT, SCHEMA, COUNT = "TABLE_COUNT", "SCHEMA", "COUNT"
CHECKSUM, ROW_DIFF, TIMEOUT = "CHECKSUM", "ROW_DIFF", "TIMEOUT"
CATALOG_TABLE = "_CATALOG_"

MISSING_IN_SOURCE, MISSING_IN_SINK = "MISSING_IN_SOURCE", "MISSING_IN_SINK"
EXTRA_IN_SINK, COMMON, SKIPPED = "EXTRA_IN_SINK", "COMMON", "SKIPPED_EMPTY"
PROBE_FAILED = "PROBE_FAILED"

ONLY_IN_SOURCE, ONLY_IN_SINK = "ONLY_IN_SOURCE", "ONLY_IN_SINK"
COUNT_DIFFERS = "COUNT_DIFFERS"

# The columns of the verdict table.
VERDICT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_time", T.StringType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_value", T.StringType()),
        T.StructField("sink_value", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

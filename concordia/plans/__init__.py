from .checks import (
    Run,
    checksum_check,
    count_check,
    footer_counts,
    row_counts,
    row_diff_check,
    schema_check,
    schema_checks,
    table_inventory_check,
)
from .compare_database import (
    JdbcTables,
    ParquetTables,
    SuiteSettings,
    compare_database,
    compare_databases,
)
from .compare_table import compare_table, read_check
from .ledger import pending_tables, table_states
from .summary import mismatch_count, mismatches, summary

__all__ = [
    "JdbcTables",
    "ParquetTables",
    "Run",
    "SuiteSettings",
    "checksum_check",
    "compare_database",
    "compare_databases",
    "compare_table",
    "count_check",
    "footer_counts",
    "mismatch_count",
    "mismatches",
    "pending_tables",
    "read_check",
    "row_counts",
    "row_diff_check",
    "schema_check",
    "schema_checks",
    "summary",
    "table_inventory_check",
    "table_states",
]

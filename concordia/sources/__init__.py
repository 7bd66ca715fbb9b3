from .catalogs import (
    DatabaseConfig,
    load_databases,
    load_table_list,
    table_list_entries,
    tables_per_database,
)
from .jdbc import list_source_columns, list_source_tables, non_empty_tables, scan_jdbc
from .lake import list_lake_tables, scan_lake
from .scratch import checkpointed, files_stamp, frozen_hashes, shared_folder
from .verdict_store import (
    commit_attempt,
    compact_verdicts,
    new_attempt,
    read_diff_buckets,
    read_diff_rows,
    read_inventory,
    read_running,
    read_verdicts,
    write_diff_buckets,
    write_diff_rows,
    write_inventory,
    write_running,
    write_verdicts,
)

__all__ = [
    "DatabaseConfig",
    "checkpointed",
    "commit_attempt",
    "compact_verdicts",
    "files_stamp",
    "frozen_hashes",
    "list_lake_tables",
    "list_source_columns",
    "list_source_tables",
    "load_databases",
    "load_table_list",
    "new_attempt",
    "non_empty_tables",
    "read_diff_buckets",
    "read_diff_rows",
    "read_inventory",
    "read_running",
    "read_verdicts",
    "scan_jdbc",
    "scan_lake",
    "shared_folder",
    "table_list_entries",
    "tables_per_database",
    "write_diff_buckets",
    "write_diff_rows",
    "write_inventory",
    "write_running",
    "write_verdicts",
]

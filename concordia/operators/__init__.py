from .checksum import bucket_checksum, bucket_compare, checksum_diff, checksum_refined
from .hash_tree import ChecksumTree, checksum_tree
from .inventory import inventory_report, table_inventory_diff
from .row_diff import diff_sample, row_diff, row_diff_report, row_diff_summary, row_multiplicity
from .schema_diff import columns_of, schema_diff

__all__ = [
    "ChecksumTree",
    "bucket_checksum",
    "bucket_compare",
    "checksum_diff",
    "checksum_refined",
    "checksum_tree",
    "columns_of",
    "diff_sample",
    "inventory_report",
    "row_diff",
    "row_diff_report",
    "row_diff_summary",
    "row_multiplicity",
    "schema_diff",
    "table_inventory_diff",
]

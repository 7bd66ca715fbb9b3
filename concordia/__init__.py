"""Data parity checks between a source table and its landed copy, on Spark."""

from .functions import CanonicalOptions
from .plans import (
    JdbcTables,
    ParquetTables,
    Run,
    SuiteSettings,
    compare_database,
    compare_databases,
    compare_table,
)

__all__ = [
    "CanonicalOptions",
    "JdbcTables",
    "ParquetTables",
    "Run",
    "SuiteSettings",
    "compare_database",
    "compare_databases",
    "compare_table",
]

"""Type categories: the coarse classes in which declared column types are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC, STRING, DATE = "Numeric", "String", "Date"
BINARY, BOOLEAN, OTHER = "Binary", "Boolean", "Other"

# Ordered substring rules per dialect, the first hit wins.  "=X" must be
# the whole name, "X*" must start it, anything else may occur anywhere in it.
SUBSTRING_RULES = {
    "oracle": [
        (NUMERIC, ["NUMBER", "FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE", "INTEGER"]),
        (STRING, ["CHAR", "CLOB", "VARCHAR", "=LONG", "ROWID"]),
        (DATE, ["DATE", "TIMESTAMP", "INTERVAL"]),
        (BINARY, ["BLOB", "RAW", "BFILE"]),
    ],
    "mysql": [
        (NUMERIC, ["DECIMAL", "NUMERIC", "FLOAT", "DOUBLE", "REAL", "INT", "YEAR"]),
        (STRING, ["CHAR", "TEXT", "ENUM", "SET", "JSON"]),
        (DATE, ["DATE", "TIME", "DATETIME", "TIMESTAMP"]),
        (BINARY, ["BLOB", "BINARY", "VARBINARY"]),
        (BOOLEAN, ["BOOLEAN", "=BOOL", "BIT(1)*"]),
    ],
    "mssql": [
        (
            NUMERIC,
            ["BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "NUMERIC", "MONEY",
             "SMALLMONEY", "FLOAT", "REAL"],
        ),
        (STRING, ["CHAR", "TEXT", "XML", "UNIQUEIDENTIFIER"]),
        (DATE, ["DATE", "TIME", "DATETIME", "SMALLDATETIME"]),
        (BINARY, ["=TIMESTAMP", "BINARY", "VARBINARY", "IMAGE", "ROWVERSION"]),
        (BOOLEAN, ["=BIT"]),
    ],
    "spark": [
        (NUMERIC, ["DECIMAL*", "INT", "LONG", "DOUBLE", "FLOAT", "SHORT", "BYTE"]),
        (STRING, ["STRING"]),
        (DATE, ["DATE", "TIMESTAMP"]),
        (BINARY, ["BINARY"]),
        (BOOLEAN, ["BOOLEAN"]),
    ],
}

# Whole type names, without length or precision.  These avoid the misfires of the
# substring rules (POINT is not a number, array<int> is not a number, a SQL Server
# TIMESTAMP is a row version).
TYPE_NAMES = {
    "oracle": {
        NUMERIC: ["NUMBER", "FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE", "INTEGER"],
        STRING: ["CHAR", "NCHAR", "VARCHAR", "VARCHAR2", "NVARCHAR2", "CLOB", "NCLOB", "LONG",
                 "ROWID", "UROWID"],
        DATE: ["DATE", "TIMESTAMP", "INTERVAL"],
        BINARY: ["BLOB", "RAW", "LONG RAW", "BFILE"],
    },
    "mysql": {
        NUMERIC: ["TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER", "BIGINT", "DECIMAL",
                  "NUMERIC", "FLOAT", "DOUBLE", "REAL", "YEAR"],
        STRING: ["CHAR", "VARCHAR", "TINYTEXT", "TEXT", "MEDIUMTEXT", "LONGTEXT", "ENUM", "SET",
                 "JSON"],
        DATE: ["DATE", "TIME", "DATETIME", "TIMESTAMP"],
        BINARY: ["TINYBLOB", "BLOB", "MEDIUMBLOB", "LONGBLOB", "BINARY", "VARBINARY"],
        BOOLEAN: ["BOOLEAN", "BOOL", "BIT"],
    },
    "mssql": {
        NUMERIC: ["BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "NUMERIC", "MONEY",
                  "SMALLMONEY", "FLOAT", "REAL"],
        STRING: ["CHAR", "NCHAR", "VARCHAR", "NVARCHAR", "TEXT", "NTEXT", "XML",
                 "UNIQUEIDENTIFIER"],
        DATE: ["DATE", "TIME", "DATETIME", "DATETIME2", "SMALLDATETIME", "DATETIMEOFFSET"],
        BINARY: ["TIMESTAMP", "ROWVERSION", "BINARY", "VARBINARY", "IMAGE"],
        BOOLEAN: ["BIT"],
    },
    "spark": {
        NUMERIC: ["TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE"],
        STRING: ["STRING", "CHAR", "VARCHAR"],
        DATE: ["DATE", "TIME", "TIMESTAMP", "TIMESTAMP_NTZ", "INTERVAL"],
        BINARY: ["BINARY"],
        BOOLEAN: ["BOOLEAN"],
    },
}


def _matches(name: Column, rule: str) -> Column:
    if rule.startswith("="):
        return name == rule[1:]
    if rule.endswith("*"):
        return name.startswith(rule[:-1])
    return name.contains(rule)


def _by_substring(dialect: str, name: Column) -> Column:
    category = F.lit(None).cast("string")
    for label, rules in reversed(SUBSTRING_RULES[dialect]):
        hit = F.lit(False)
        for rule in rules:
            hit = hit | _matches(name, rule)
        category = F.when(hit, label).otherwise(category)
    return F.coalesce(category, F.lit(OTHER))


def _by_name(dialect: str, name: Column) -> Column:
    # "TIMESTAMP(6) WITH TIME ZONE" -> "TIMESTAMP", "array<int>" -> "ARRAY"; two-word
    # names such as LONG RAW are looked up before their first word.
    bare = F.trim(F.regexp_replace(F.regexp_replace(name, r"\(.*?\)", ""), r"<.*$", ""))
    first_word = F.split_part(bare, F.lit(" "), F.lit(1))
    names = TYPE_NAMES[dialect].items()
    known = F.create_map(*[F.lit(v) for label, words in names for w in words for v in (w, label)])
    return F.coalesce(F.try_element_at(known, bare), F.try_element_at(known, first_word), F.lit(OTHER))


def type_category(dialect: str, type_name: Column, categories: str = "exact") -> Column:
    """Category of a declared type name.

    ``categories="exact"`` looks up the whole base name, ``"substring"`` applies the
    ordered substring rules.
    """
    key = dialect.strip().lower()
    if key not in SUBSTRING_RULES:
        raise ValueError(f"unsupported database type {dialect!r}")
    if categories not in ("exact", "substring"):
        raise ValueError(f"categories must be 'exact' or 'substring', got {categories!r}")
    name = F.upper(type_name)
    return _by_name(key, name) if categories == "exact" else _by_substring(key, name)

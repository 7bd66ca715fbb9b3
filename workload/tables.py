"""Test tables and the copies they are compared with.

A copy is defined by one SQL text that Spark and DuckDB both run, so both engines see
the same differences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column kinds decide the canonical SQL in oracles.py.
COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "str"},
    "nation": {"n_nationkey": "int", "n_name": "str", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "int", "c_name": "str", "c_nationkey": "int", "c_acctbal": "float",
        "c_mktsegment": "str",
    },
    "supplier": {"s_suppkey": "int", "s_name": "str", "s_nationkey": "int", "s_acctbal": "float"},
    "part": {
        "p_partkey": "int", "p_name": "str", "p_brand": "str", "p_type": "str", "p_size": "int",
        "p_retailprice": "float",
    },
    "orders": {
        "o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "str", "o_totalprice": "float",
        "o_orderdate": "ntz", "o_orderpriority": "str",
    },
    "lineitem": {
        "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int",
        "l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float",
        "l_returnflag": "str", "l_linestatus": "str", "l_shipdate": "ntz",
    },
    "events": {
        "event_id": "int", "ts": "ntz", "user_id": "int", "event_type": "str", "value": "float",
        "props": "str",
    },
    "documents": {
        "doc_id": "int", "text": "str", "lang": "str", "source": "str", "n_chars": "int",
    },
    "embeddings": {"vec_id": "int", "embedding": "floats", "label": "int"},
    "pages": {"page_id": "int", "url": "str", "html": "str"},
    "benchmark": {"item_id": "int", "text": "str"},
    "labels": {"doc_id": "int", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "int", "turn": "int", "role": "str", "text": "str"},
}

# The columns of orders as an Oracle dictionary might declare them; the key of the customer
# is text there.
ORDERS_DECLARED = {
    "O_ORDERKEY": "NUMBER", "O_CUSTKEY": "VARCHAR2", "O_ORDERSTATUS": "CHAR", "O_TOTALPRICE": "NUMBER",
    "O_ORDERDATE": "TIMESTAMP(6)", "O_ORDERPRIORITY": "VARCHAR2",
}

# Tables of free text.
TEXT_TABLES = ["documents", "pages", "benchmark", "conversations"]

ORDERS_COPY = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1.25 ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 5 = 0 THEN concat('  ', lower(o_orderpriority), ' ')
            ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT * FROM orders
WHERE o_orderkey % 101 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0
UNION ALL
SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 103 = 0
"""

_EVENTS_COPY = """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN ts + {second} ELSE ts END AS ts,
       user_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, props
FROM events WHERE event_id % 13 <> 0
"""
EVENTS_COPY = _EVENTS_COPY.format(second="make_dt_interval(0, 0, 0, 1)")
EVENTS_COPY_DUCKDB = _EVENTS_COPY.format(second="to_seconds(1)")

DOCUMENTS_COPY = """
SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN concat(text, '.') ELSE text END AS text,
       lang, source, n_chars
FROM documents WHERE doc_id % 29 <> 0
"""

# Three rows differ, and every row differs.
ORDERS_THREE_CHANGED = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 3)
            THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
"""
ORDERS_ALL_CHANGED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders
"""

# Decimals with fourteen digits behind the point.
LONG_DECIMALS = """
SELECT p_partkey, CAST(concat(CAST(p_size AS VARCHAR(9)), '.', lpad(CAST(p_partkey AS VARCHAR(9)), 14, '0'))
                       AS DECIMAL(38,14)) AS amount
FROM part
"""

# Every row twice, and some rows once more: differs from the table in counts only.
ORDERS_REPEATED = """
SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 101 = 0
"""

# Two columns with few values: each distinct row stands for a large share of the table.
HOT_ROWS = "SELECT o_orderstatus, o_orderpriority FROM orders"
HOT_ROWS_COPY = """
SELECT CASE WHEN o_orderkey = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
FROM orders
"""

# NULLs and empty strings at known places; the test tables hold none.
CUSTOMER_NULLS = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """Run one of the texts above with the named tables as its input."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


# Type names as dictionaries report them, one list per kind of database.
TYPE_NAMES = {
    "oracle": [
        "NUMBER", "NUMBER(10,2)", "FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE", "INTEGER", "CHAR",
        "NCHAR", "VARCHAR2(30)", "NVARCHAR2", "CLOB", "NCLOB", "LONG", "LONG RAW", "ROWID",
        "UROWID", "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE",
        "INTERVAL DAY(2) TO SECOND(6)", "BLOB", "RAW", "BFILE", "XMLTYPE", "SDO_GEOMETRY",
    ],
    "mysql": [
        "decimal", "numeric", "float", "double", "real", "int", "bigint", "tinyint", "smallint",
        "mediumint", "year", "char", "varchar", "text", "longtext", "enum", "set", "json", "date",
        "time", "datetime", "timestamp", "blob", "longblob", "binary", "varbinary", "boolean",
        "bool", "bit", "bit(1)", "point", "multipoint", "geometry",
    ],
    "mssql": [
        "bigint", "int", "smallint", "tinyint", "decimal", "numeric", "money", "smallmoney",
        "float", "real", "char", "nvarchar", "ntext", "xml", "uniqueidentifier", "date", "time",
        "datetime", "datetime2", "smalldatetime", "datetimeoffset", "timestamp", "binary",
        "varbinary", "image", "rowversion", "bit", "sql_variant", "geography",
    ],
    "spark": [
        "tinyint", "smallint", "int", "bigint", "decimal(38,10)", "float", "double", "string",
        "date", "timestamp", "timestamp_ntz", "binary", "boolean", "interval day to second",
        "array<string>", "map<string,int>", "struct<a:int>", "void",
    ],
}


def typed_parts(dialect: str) -> str:
    """One dictionary entry per part: its type is picked from the list by the part key."""
    names = TYPE_NAMES[dialect]
    picks = " ".join(
        f"WHEN {i} THEN '{name}'" for i, name in enumerate(names)
    )
    return (
        "SELECT p_brand AS table_name, concat('c', CAST(p_partkey AS VARCHAR(20))) AS column_name, "
        f"CASE p_partkey % {len(names)} {picks} END AS data_type FROM part"
    )


def landed_parts() -> str:
    """The same entries as landed: some columns lost, some added, types by part size."""
    names = TYPE_NAMES["spark"]
    picks = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return (
        "SELECT lower(p_brand) AS table_name, "
        "concat(CASE WHEN p_partkey % 10 = 3 THEN 'new' ELSE 'C' END, CAST(p_partkey AS VARCHAR(20))) AS column_name, "
        f"CASE (p_partkey + p_size) % {len(names)} {picks} END AS data_type "
        "FROM part WHERE p_partkey % 9 <> 0"
    )


# Table lists of a made-up database: one table per customer; a customer without orders is
# an empty table, and the lake has lost and gained some.
SOURCE_TABLES = """
SELECT concat('crm.', lower(c_name)) AS table_name, max(o_orderkey) IS NOT NULL AS has_rows
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderkey % 3 = 0
GROUP BY c_name
"""
LAKE_TABLES = """
SELECT concat('CRM.', c_name) AS table_name FROM customer WHERE c_custkey % 5 <> 0
UNION ALL
SELECT concat('CRM.', s_name) AS table_name FROM supplier WHERE s_suppkey % 4 = 0
"""

# Verdicts of a made-up run: order counts of every customer before and after, the order
# priority standing for the database.
ORDER_VERDICTS = f"""
SELECT 'r1' AS run_id, '2024-01-01' AS run_time, db_name, table_name, 'COUNT' AS check_type,
       CASE WHEN src = snk THEN 'OK' ELSE 'MISMATCH' END AS status,
       CAST(src AS VARCHAR(20)) AS source_value, CAST(snk AS VARCHAR(20)) AS sink_value,
       CASE WHEN src = snk THEN '' ELSE concat('Mismatch ', CAST(abs(src - snk) AS VARCHAR(20)), ' rows') END AS detail
FROM (
  SELECT db_name, table_name, sum(src) AS src, sum(snk) AS snk FROM (
    SELECT o_orderpriority AS db_name, concat('CUSTOMER.C', CAST(o_custkey AS VARCHAR(20))) AS table_name, 1 AS src, 0 AS snk
    FROM orders
    UNION ALL
    SELECT upper(trim(o_orderpriority)), concat('CUSTOMER.C', CAST(o_custkey AS VARCHAR(20))), 0, 1
    FROM ({ORDERS_COPY}) c
  ) both_sides GROUP BY db_name, table_name
) counted
"""

# Progress of a made-up run over one table per customer and order status.
PROGRESS_VERDICTS = """
SELECT 'r1' AS run_id, o_orderstatus AS db_name,
       concat('CUSTOMER.C', CAST(o_custkey AS VARCHAR(20))) AS table_name,
       CASE o_orderkey % 4 WHEN 0 THEN 'SCHEMA' WHEN 1 THEN 'COUNT' WHEN 2 THEN 'ROW_DIFF' ELSE 'TIMEOUT' END AS check_type,
       CASE o_orderkey % 4 WHEN 3 THEN 'ERROR' WHEN 2 THEN 'MISMATCH' ELSE 'OK' END AS status
FROM orders
"""
PROGRESS_TABLES = """
SELECT DISTINCT 'r1' AS run_id, lower(o_orderstatus) AS db_name,
       concat('customer.c', CAST(o_custkey AS VARCHAR(20))) AS table_name
FROM orders
"""


def table_catalog_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table catalogue records (database, tables[]): one record per order, whose list
    repeats names in different spelling and holds blanks."""
    orders = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("crm.c"), F.col("o_custkey").cast("string"))
    listed = F.array(
        name, F.concat(F.lit(" "), F.upper(name), F.lit("\t")), F.lit(" "), F.lit(None).cast("string")
    )
    return orders.select(
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("database"),
        F.when(F.col("o_orderkey") % 10 != 0, listed).alias("tables"),
    )


TABLE_CATALOG_DUCKDB = """
SELECT DISTINCT upper(o_orderpriority) AS database,
       CASE WHEN named THEN concat('CRM.C', CAST(o_custkey AS VARCHAR)) END AS table_name
FROM (
  SELECT *, TRUE AS named FROM orders WHERE o_orderkey % 10 <> 0
  UNION ALL
  SELECT *, FALSE AS named FROM orders
)
"""

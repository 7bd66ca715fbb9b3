"""Column-list comparison of many tables at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MISMATCH, MISSING_IN_SINK, MISSING_IN_SOURCE
from ..functions.type_category import type_category

_COLUMNS = "table_name string, column_name string, ordinal int, data_type string"


def columns_of(spark: SparkSession, table_name: str, schema: T.StructType) -> DataFrame:
    """(table_name, column_name, ordinal, data_type) of a DataFrame schema."""
    rows = [
        (table_name, f.name, i, f.dataType.simpleString()) for i, f in enumerate(schema.fields, 1)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def schema_diff(
    source_columns: DataFrame,
    sink_columns: DataFrame,
    dialect: str,
    categories: str = "exact",
) -> DataFrame:
    """(table_name, column_name, issue) for every column that is missing or mistyped.

    Inputs are (table_name, column_name, data_type) of any number of tables.  Names match
    without case, types match by category only.  Matching is a full outer match done as
    one aggregation over both lists, which needs one shuffle and no sort.
    """

    def side(df: DataFrame, present: str, kind: str) -> DataFrame:
        # Categories are compared, but a name without type still counts as present.
        return df.select(
            F.upper("table_name").alias("table_name"),
            F.upper("column_name").alias("column_name"),
            type_category(kind, F.col("data_type"), categories).alias(present),
        )

    both = side(source_columns, "source_category", dialect).unionByName(
        side(sink_columns, "sink_category", "spark"), allowMissingColumns=True
    )
    matched = both.groupBy("table_name", "column_name").agg(
        F.max("source_category").alias("source_category"),
        F.max("sink_category").alias("sink_category"),
    )
    issue = (
        F.when(F.col("source_category").isNull(), MISSING_IN_SOURCE)
        .when(F.col("sink_category").isNull(), MISSING_IN_SINK)
        .when(F.col("source_category") != F.col("sink_category"), MISMATCH)
    )
    return matched.select("table_name", "column_name", issue.alias("issue")).filter(
        "issue is not null"
    )

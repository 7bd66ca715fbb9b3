"""Type categories by both rules."""

import pytest
from pyspark.sql import functions as F

from concordia.functions.type_category import SUBSTRING_RULES, TYPE_NAMES, type_category


def categories(spark, dialect, names, mode):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", type_category(dialect, F.col("n"), mode).alias("c")).collect()
    return {r.n: r.c for r in rows}


@pytest.mark.parametrize("dialect", sorted(SUBSTRING_RULES))
def test_every_known_name_has_its_category(spark, dialect):
    for label, names in TYPE_NAMES[dialect].items():
        found = categories(spark, dialect, [n.lower() for n in names], "exact")
        assert set(found.values()) == {label}


@pytest.mark.parametrize(
    "dialect, name, by_substring, by_name",
    [
        ("oracle", "NUMBER(10,2)", "Numeric", "Numeric"),
        ("oracle", "TIMESTAMP(6) WITH LOCAL TIME ZONE", "Date", "Date"),
        ("oracle", "INTERVAL YEAR(2) TO MONTH", "Date", "Date"),
        ("oracle", "LONG", "String", "String"),
        ("oracle", "LONG RAW", "Binary", "Binary"),
        ("oracle", "XMLTYPE", "Other", "Other"),
        ("mysql", "point", "Numeric", "Other"),
        ("mysql", "bit", "Other", "Boolean"),
        ("mysql", "bit(1)", "Boolean", "Boolean"),
        ("mysql", "int unsigned", "Numeric", "Numeric"),
        ("mysql", "geometry", "Other", "Other"),
        ("mssql", "timestamp", "Date", "Binary"),
        ("mssql", "rowversion", "Binary", "Binary"),
        ("mssql", "bit", "Boolean", "Boolean"),
        ("mssql", "datetimeoffset(7)", "Date", "Date"),
        ("spark", "interval day to second", "Numeric", "Date"),
        ("spark", "array<string>", "String", "Other"),
        ("spark", "map<string,int>", "Numeric", "Other"),
        ("spark", "struct<a:date>", "Date", "Other"),
        ("spark", "decimal(10,2)", "Numeric", "Numeric"),
        ("spark", "timestamp_ntz", "Date", "Date"),
        ("spark", None, "Other", "Other"),
    ],
)
def test_rules(spark, dialect, name, by_substring, by_name):
    assert categories(spark, dialect, [name], "substring")[name] == by_substring
    assert categories(spark, dialect, [name], "exact")[name] == by_name


def test_unknown_dialect_and_mode():
    with pytest.raises(ValueError, match="unsupported"):
        type_category("db2", F.lit("INT"))
    with pytest.raises(ValueError, match="categories"):
        type_category("oracle", F.lit("INT"), "loose")

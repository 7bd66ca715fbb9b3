"""Canonical text of single values, and of whole rows."""

import datetime as dt
import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordia.functions.canonical import CanonicalOptions, canonical_columns
from concordia.functions.fingerprint import fingerprint


def text(spark, expression, **options):
    df = spark.range(1).select(F.expr(expression).alias("v"))
    return canonical_columns(df, CanonicalOptions(**options)).first()[0]


GOLDEN = [
    ("'  straße '", "STRASSE"),
    ("'\t a \n'", "\t A \n"),
    ("cast(5 as bigint)", "5"),
    ("cast(-7 as tinyint)", "-7"),
    ("cast(5 as decimal(10,0))", "5.0000000000"),
    ("cast('99999999999999999999999999999999999999' as decimal(38,0))", "9" * 38),
    ("cast(1.00000000005 as decimal(20,11))", "1.0000000001"),
    ("1234567.125D", "1,234,567.1250000000"),
    ("cast(0.1 as float)", "0.1000000015"),
    ("-0.0D", "0.0000000000"),
    ("double('NaN')", "NaN"),
    ("double('Infinity')", "∞"),
    ("5e-11D", "0.0000000000"),
    ("date'2024-02-29'", "2024-02-29"),
    ("timestamp'2024-01-01 00:00:00.123456 UTC'", "1704067200123"),
    ("timestamp'1969-12-31 23:59:59.9995 UTC'", "-1"),
    ("timestamp_ntz'2024-01-01 00:00:00.120'", "2024-01-01 00:00:00.120"),
    ("timestamp_ntz'2024-01-01 00:00:00'", "2024-01-01 00:00:00.000"),
    ("timestamp_ntz'2024-01-01 00:00:00.123456'", "2024-01-01 00:00:00.123"),
    ("true", "1"),
    ("false", "0"),
    ("X'00FF'", "AP8="),
    ("array('x, y', 'z')", '["x, y","z"]'),
    ("array('x', 'y, z')", '["x","y, z"]'),
    ("array(1.5D, -0.0D)", '["1.5000000000","0.0000000000"]'),
    ("map('b', 2, 'a', 1)", '[{"key":"a","value":1},{"key":"b","value":2}]'),
    ("named_struct('d', date'2024-01-01', 'n', map('k', 1.0D))",
     '{"d":"2024-01-01","n":[{"key":"k","value":"1.0000000000"}]}'),
    ("interval '1' day", "INTERVAL '1' DAY"),
    ("cast(0 as decimal(12,2))", "0.0000000000"),
    ("cast(0.0000001 as decimal(12,8))", "0.0000001000"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_golden_values(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = [F.expr(e).alias(f"v{i:03d}") for i, (e, _) in enumerate(GOLDEN)]
        found = canonical_columns(spark.range(1).select(*values)).first()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert list(zip([e for e, _ in GOLDEN], found)) == GOLDEN


def test_null_stays_null(spark):
    types = [
        "string", "int", "decimal(38,0)", "double", "date", "timestamp", "timestamp_ntz", "boolean",
        "binary", "array<double>", "map<string,int>", "struct<a:int>", "void",
    ]
    nulls = [F.lit(None).cast(t).alias(f"v{i}") for i, t in enumerate(types)]
    assert set(canonical_columns(spark.range(1).select(*nulls)).first()) == {None}


def test_long_binary_has_no_line_breaks(spark):
    assert text(spark, "cast(repeat('a', 300) as binary)") == ("YWFh" * 100)


def test_numeric_by_value_gives_one_form(spark):
    forms = {
        text(spark, e, numeric="by_value")
        for e in ("5", "cast(5 as bigint)", "5.0D", "cast(5 as float)", "cast(5 as decimal(10,2))")
    }
    assert forms == {"5.0000000000"}
    assert text(spark, "double('NaN')", numeric="by_value") == "NaN"
    assert text(spark, "1e300D", numeric="by_value").startswith("1,000,000")


def test_large_numbers_by_value_share_one_form(spark):
    forms = {
        text(spark, e, numeric="by_value")
        for e in ("1e30D", "cast('1e30' as decimal(38,0))", "cast('1e30' as decimal(38,5))")
    }
    assert forms == {"1" + "0" * 30}
    assert text(spark, "cast('1e30' as decimal(38,5))") == "1" + "0" * 30 + ".00000"


def test_options_reach_nested_values(spark):
    deep = {"nested": "by_options"}
    for a, b, options in [
        ("array(5)", "array(cast(5 as decimal(10,2)))", {"numeric": "by_value"}),
        ("array('A ')", "array('a')", {}),
        ("array('')", "array(cast(null as string))", {"empty_as_null": True}),
        ("map('b', 5D)", "map('B ', 5)", {"numeric": "by_value"}),
        ("array(map('k', struct(1 as a)))", "array(map('K', struct(1D as A)))", {"numeric": "by_value"}),
        ("named_struct('b', 1, 'A', null)", "named_struct('a', null, 'B', 1)", {}),
    ]:
        assert text(spark, a, **options, **deep) == text(spark, b, **options, **deep), a
    missing, null = (text(spark, f"named_struct({f}'b', 'x')", **deep) for f in ("", "'a', cast(null as string), "))
    assert (missing, null) == ('{"B":"X"}', '{"A":null,"B":"X"}')
    assert text(spark, "array('A ')", strings="exact", **deep) == '["A "]'
    with pytest.raises(ValueError, match="clash"):
        text(spark, "array(named_struct('a', 1, 'A', 2))", **deep)


def test_string_options(spark):
    assert text(spark, "' aB '", strings="exact") == " aB "
    assert text(spark, "''", empty_as_null=True) is None
    assert text(spark, "''") == ""


def test_zone_less_times_can_be_read_as_instants(spark):
    instant = text(spark, "timestamp'2024-01-01 00:00:00.5 America/New_York'")
    local = text(spark, "timestamp_ntz'2024-01-01 00:00:00.5'", ntz_zone="America/New_York")
    assert instant == local


def test_microseconds(spark):
    assert text(spark, "timestamp'2024-01-01 00:00:00.123456 UTC'", ts_precision="us") == "1704067200123456"
    assert text(spark, "timestamp_ntz'2024-01-01 00:00:00.12'", ts_precision="us") == "2024-01-01 00:00:00.120000"


def test_forms_do_not_depend_on_session_zone(spark, table):
    half_hours = spark.range(17568).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("instant"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 30) * id").alias("local"),
        F.expr("date_add(date'2024-01-01', cast(id % 366 as int))").alias("day"),
    )

    def forms():
        return canonical_columns(half_hours).collect()

    utc = forms()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = forms()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
    assert len({r.INSTANT for r in utc}) == len({r.LOCAL for r in utc}) == 17568


def test_names_are_upper_cased_sorted_and_may_hold_dots(spark):
    df = spark.createDataFrame([("1", "2", "3")], ["b.c", "a`x", "Z"])
    assert canonical_columns(df).columns == ["A`X", "B.C", "Z"]
    marked = fingerprint(df).first()
    assert (marked["A`X"], marked["B.C"], marked["Z"]) == ("2", "1", "3")


def test_clashing_and_reserved_names_are_errors(spark):
    with pytest.raises(ValueError, match="clash"):
        canonical_columns(spark.createDataFrame([(1, 2)], ["a", "A"]))
    with pytest.raises(ValueError, match="reserved"):
        fingerprint(spark.createDataFrame([(1,)], ["__hash"]))
    with pytest.raises(ValueError):
        canonical_columns(None)
    with pytest.raises(ValueError):
        CanonicalOptions(strings="loose")


def test_null_and_empty_text_have_different_hashes(spark):
    df = spark.createDataFrame([(None, ""), ("", None)], "a string, b string")
    hashes = [r["__hash"] for r in fingerprint(df).collect()]
    assert [h[:8] for h in hashes] == ["237fd7b7", "9fd6b45d"]


def test_helper_names_of_the_data_are_kept(spark):
    df = spark.createDataFrame([(1, "x")], ["bucket_id", "row_hash"])
    assert fingerprint(df).columns == ["BUCKET_ID", "ROW_HASH", "__hash"]


def test_very_wide_rows(spark):
    names = [f"c{i:03d}" for i in range(400)]
    df = spark.range(50).select(*[(F.col("id") * i).cast("double").alias(n) for i, n in enumerate(names)])
    assert fingerprint(df, keep_columns=False).distinct().count() == 50


def test_floats_print_like_format_number(spark):
    """The short way of printing numbers agrees with the function it replaces."""
    rng = random.Random(1)
    values = [0.0, -0.0, 0.5, 999.9999, 1000.0, -1000.0, 524287.9999, 524288.0, -524287.9999, 1e6]
    values += [0.00005, 0.00004999, 0.0001, -0.0001, 1e-300, 5e-11, 15e-11, 1e22, 123456.00005]
    for digits in range(12):
        for size in (1, 10, 999, 1001, 99999, 524288, 10**7):
            drawn = [round(rng.uniform(-size, size), digits) for _ in range(150)]
            values += drawn + [math.nextafter(v, math.inf) for v in drawn]
    values += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    both = canonical_columns(df.withColumn("w", F.format_number(F.col("v") + F.lit(0.0), 10)),
                             CanonicalOptions(strings="exact"))
    assert both.filter("NOT (V <=> W)").collect() == []
    floats = canonical_columns(df.filter("abs(v) < 1e30").select(F.col("v").cast("float").alias("v")))
    expected = df.filter("abs(v) < 1e30").select(F.format_number(F.col("v").cast("float") + F.lit(0.0), 10))
    assert floats.collect() == expected.collect()


def test_all_types_in_one_row(spark):
    schema = T.StructType(
        [
            T.StructField("s", T.StringType()), T.StructField("i", T.IntegerType()),
            T.StructField("d", T.DecimalType(12, 2)), T.StructField("f", T.DoubleType()),
            T.StructField("t", T.TimestampType()), T.StructField("y", T.DateType()),
        ]
    )
    row = ("a", 1, Decimal("2.50"), 3.5, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1))
    both = spark.createDataFrame([row, row], schema)
    assert fingerprint(both, keep_columns=False).distinct().count() == 1

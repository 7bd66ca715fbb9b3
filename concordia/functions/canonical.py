"""Canonical text of a column: the form in which two copies of a table are compared.

Every builder returns a plain Column expression of built-in functions, so the whole
projection stays inside code generation and reads each input column once.  No form
depends on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DECIMAL_TYPE, FLOAT_DIGITS

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_STRINGS = (T.StringType, T.CharType, T.VarcharType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


@dataclass(frozen=True)
class CanonicalOptions:
    """What counts as "the same value".

    strings        "fold" ignores case and outer spaces, "exact" compares as stored
    empty_as_null  treat '' as NULL (databases that cannot store an empty string)
    numeric        "by_type": 5 and 5.0 differ; "by_value": all numbers share one form
    ts_precision   "ms" cuts instants to milliseconds, "us" keeps microseconds
    ntz_zone       zone in which zone-less timestamps are read, so that they compare
                   with instants; None keeps them as wall-clock text
    nested         "as_stored" keeps texts, whole numbers and fields inside arrays, maps
                   and structs as JSON shows them; "by_options" applies all options at
                   every level, sorts and upper-cases field names and keeps NULL fields
    digits         "ten" rounds decimals and doubles to ten decimals, "exact" keeps all
                   digits: decimals without closing zeros, doubles as the text that reads
                   back as the same value
    """

    strings: str = "fold"
    empty_as_null: bool = False
    numeric: str = "by_type"
    ts_precision: str = "ms"
    ntz_zone: str | None = None
    nested: str = "as_stored"
    digits: str = "ten"

    def __post_init__(self) -> None:
        for name, allowed in (
            ("strings", ("fold", "exact")),
            ("numeric", ("by_type", "by_value")),
            ("ts_precision", ("ms", "us")),
            ("nested", ("as_stored", "by_options")),
            ("digits", ("ten", "exact")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")


DEFAULT_OPTIONS = CanonicalOptions()


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column reference that also works for names holding dots or back-quotes."""
    return F.col(_quote(name))


def _string(c: Column, o: CanonicalOptions) -> Column:
    text = F.nullif(c, F.lit("")) if o.empty_as_null else c
    return F.upper(F.trim(text)) if o.strings == "fold" else text


def _decimal_text(d: Column) -> Column:
    # Without ANSI mode a cast prints zero and tiny decimals as 0E-10.
    text = d.cast("string")
    plain = F.replace(F.format_number(d, FLOAT_DIGITS), F.lit(","), F.lit(""))
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def _exact_decimal_text(d: Column) -> Column:
    """All digits of a decimal, without a point or zeros that say nothing."""
    text = d.cast("string")
    # Without ANSI mode a cast prints tiny decimals with an exponent.
    plain = F.replace(F.format_number(d, 38), F.lit(","), F.lit(""))
    full = F.when(F.contains(text, F.lit("E")), plain).otherwise(text)
    return F.when(F.contains(full, F.lit(".")), F.regexp_replace(full, r"\.?0*$", "")).otherwise(full)


def _exact_float_text(c: Column, o: CanonicalOptions) -> Column:
    """The text of a double that reads back as the same double; -0.0 is 0.0.

    By value, it has the form of decimals, unless it is too large or small for that.
    """
    text = (c.cast("double") + F.lit(0.0)).cast("string")
    if o.numeric == "by_value":
        short = ~F.contains(text, F.lit("E")) & F.contains(text, F.lit("."))
        whole = text.try_cast("decimal(38,0)")
        large = whole.isNotNull() & (whole.cast("double") == c.cast("double"))
        return F.when(short, F.regexp_replace(text, r"\.?0*$", "")).when(large, whole.cast("string")).otherwise(text)
    return text


def _decimal(c: Column, dt: T.DecimalType, o: CanonicalOptions) -> Column:
    if o.digits == "exact":
        return _exact_decimal_text(c)
    whole_digits = dt.precision - dt.scale
    if whole_digits <= 27 or (whole_digits == 28 and dt.scale <= 10):
        return _decimal_text(c.cast(DECIMAL_TYPE))
    # Values too large for the common form keep their own digits.
    own = c.cast("string")
    if o.numeric == "by_value" and dt.scale > 0:
        own = F.regexp_replace(own, r"\.?0*$", "")
    return F.coalesce(_decimal_text(c.try_cast(DECIMAL_TYPE)), own)


def _float(c: Column, o: CanonicalOptions) -> Column:
    if o.digits == "exact":
        return _exact_float_text(c, o)
    # Adding zero turns -0.0 into 0.0.
    grouped = F.format_number(c.cast("double") + F.lit(0.0), FLOAT_DIGITS)
    if o.numeric == "by_value":
        whole = c.try_cast("decimal(38,0)").cast("string")
        return F.coalesce(_decimal_text(c.try_cast(DECIMAL_TYPE)), whole, grouped)
    return grouped


def _short_units(name: str) -> Column:
    """|x| in units of 1/10000 if the double x is the one nearest to such a number.

    NULL for all other x, and from 2^19 on.  Dividing back tests just that, since
    division gives the nearest double.
    """
    return F.expr(
        f"CASE WHEN abs({name}) < 524288D AND rint({name} * 10000D) / 10000D = {name} "
        f"THEN CAST(abs(rint({name} * 10000D)) AS BIGINT) END"
    )


def _short_text(name: str, units: str) -> Column:
    """``format_number(x + 0.0, 10)``, by whole-number arithmetic where units are known.

    format_number takes most of the time of hashing a row.  A short x lies within 2^-35
    of its n/10000, so rounding to 10 digits gives the digits of n/10000 and zeros.
    """
    return F.expr(
        f"CASE WHEN {units} IS NULL THEN format_number({name} + 0D, {FLOAT_DIGITS}) ELSE concat("
        f"IF({name} < 0D, '-', ''), "
        f"IF({units} < 10000000, CAST({units} DIV 10000 AS STRING), "
        f"concat(CAST({units} DIV 10000000 AS STRING), ',', "
        f"substring(CAST({units} DIV 10000 % 1000 + 1000 AS STRING), 2, 3))), "
        f"'.', substring(CAST({units} % 10000 + 10000 AS STRING), 2, 4), "
        f"'{'0' * (FLOAT_DIGITS - 4)}') END"
    )


def _instant(c: Column, o: CanonicalOptions) -> Column:
    units = F.unix_millis(c) if o.ts_precision == "ms" else F.unix_micros(c)
    return units.cast("string")


def _wall_clock(c: Column, o: CanonicalOptions) -> Column:
    text = c.cast("string")
    if o.ntz_zone is not None:
        return _instant(F.concat(text, F.lit(" " + o.ntz_zone)).cast("timestamp"), o)
    # The cast drops trailing zeros of the fraction.  Padding and cutting the text needs
    # no zoned timestamp, which would move times that fall into a clock change.
    digits = 3 if o.ts_precision == "ms" else 6
    zeros = "0" * digits
    padded = F.concat(text, F.when(F.contains(text, F.lit(".")), zeros).otherwise("." + zeros))
    return F.substr(padded, F.lit(1), F.instr(padded, ".") + digits)


def canonical_text(c: Column, dt: T.DataType, options: CanonicalOptions = DEFAULT_OPTIONS) -> Column:
    """Text form of one value of type ``dt``; NULL stays NULL."""
    if isinstance(dt, _STRINGS):
        return _string(c, options)
    if isinstance(dt, _INTEGERS):
        by_value = options.numeric == "by_value" and options.digits == "ten"
        return _decimal_text(c.cast(DECIMAL_TYPE)) if by_value else c.cast("string")
    if isinstance(dt, T.DecimalType):
        return _decimal(c, dt, options)
    if isinstance(dt, _FLOATS):
        return _float(c, options)
    if isinstance(dt, T.DateType):
        return c.cast("string")
    if isinstance(dt, T.TimestampType):
        return _instant(c, options)
    if isinstance(dt, T.TimestampNTZType):
        return _wall_clock(c, options)
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(dt, T.BinaryType):
        return F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))
    if isinstance(dt, _NESTED):
        keep_nulls = {"ignoreNullFields": "false"} if options.nested == "by_options" else None
        return F.to_json(_nested(c, dt, options), keep_nulls)
    return F.trim(c.cast("string"))


def _kept_in_json(dt: T.DataType, o: CanonicalOptions) -> bool:
    """Whether JSON already shows values of this type as the options want them."""
    if isinstance(dt, T.ArrayType):
        return _kept_in_json(dt.elementType, o)
    if o.nested == "as_stored":
        if isinstance(dt, T.StructType):
            return all(_kept_in_json(f.dataType, o) for f in dt.fields)
        return isinstance(dt, _STRINGS + _INTEGERS + (T.BooleanType,))
    if isinstance(dt, _STRINGS):
        return o.strings == "exact" and not o.empty_as_null
    return isinstance(dt, T.BooleanType) or (isinstance(dt, _INTEGERS) and o.numeric == "by_type")


def _nested(c: Column, dt: T.DataType, o: CanonicalOptions) -> Column:
    if _kept_in_json(dt, o):
        return c
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _nested(x, dt.elementType, o))
    if isinstance(dt, T.MapType):
        # Entries in key order: two equal maps give one text.
        return F.array_sort(
            F.transform(
                F.map_entries(c),
                lambda e: F.struct(
                    _nested(e["key"], dt.keyType, o).alias("key"),
                    _nested(e["value"], dt.valueType, o).alias("value"),
                ),
            )
        )
    if isinstance(dt, T.StructType):
        named = [(f.name, f) for f in dt.fields]
        if o.nested == "by_options":
            _check_clashes([f.name for f in dt.fields])
            named = sorted(((f.name.upper(), f) for f in dt.fields), key=lambda n: n[0])
        fields = [_nested(c.getField(f.name), f.dataType, o).alias(name) for name, f in named]
        return F.when(c.isNotNull(), F.struct(*fields))
    return canonical_text(c, dt, o)


def _check_clashes(columns: list[str]) -> None:
    names = [n.upper() for n in columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns clash once upper-cased: {', '.join(clashes)}")


def canonical_names(df: DataFrame) -> list[str]:
    """Upper-cased column names in comparison order; clashes are an error."""
    _check_clashes(df.columns)
    return sorted(n.upper() for n in df.columns)


# With more double columns than this the generated code grows too large for the shorter
# way of printing them to pay off.
_SHORT_NUMBER_COLUMNS = 12

# HotSpot never compiles a method of more bytecode than this.
_COMPILED_METHOD_BYTES = 8000


def compile_wide_rows(spark: SparkSession) -> None:
    """Keep the generated code of wide tables compilable.

    Whole-stage code puts all columns of a row into one method.  From some 35 columns on
    the JVM would only interpret it, which is several times slower;
    with this limit Spark generates many small methods instead.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > _COMPILED_METHOD_BYTES:
        spark.conf.set(key, _COMPILED_METHOD_BYTES)


def canonical_columns(df: DataFrame, options: CanonicalOptions = DEFAULT_OPTIONS) -> DataFrame:
    """All columns as canonical text, names upper-cased and in alphabetical order."""
    if df is None:
        raise ValueError("a DataFrame is required")
    compile_wide_rows(df.sparkSession)
    canonical_names(df)
    fields = sorted(df.schema.fields, key=lambda f: f.name.upper())
    # Units of double columns are computed in a step of their own: they are used several
    # times, and Spark keeps such a projection separate.
    units = {}
    doubles = [f.name for f in fields if isinstance(f.dataType, T.DoubleType)]
    if options.numeric == "by_type" and options.digits == "ten" and 0 < len(doubles) <= _SHORT_NUMBER_COLUMNS:
        units = {name: f"__units_{i}" for i, name in enumerate(doubles)}
        df = df.select("*", *[_short_units(_quote(n)).alias(u) for n, u in units.items()])

    def text(f: T.StructField) -> Column:
        if f.name in units:
            return _short_text(_quote(f.name), units[f.name])
        return canonical_text(quoted(f.name), f.dataType, options)

    return df.select(*[text(f).alias(f.name.upper()) for f in fields])

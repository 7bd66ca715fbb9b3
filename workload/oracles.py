"""DuckDB SQL that recomputes the registered queries on the same tables."""

from __future__ import annotations

from functools import partial

from . import tables as t

_SEPARATOR = "chr(30)"
_NULL = "chr(1) || '__NULL__' || chr(1)"


def _canonical(column: str, kind: str) -> str:
    return {
        # Spark upper-cases ß to SS, DuckDB to ẞ.
        "str": f"replace(upper(trim({column})), 'ẞ', 'SS')",
        "int": f"CAST({column} AS VARCHAR)",
        "float": f"format('{{:,.10f}}', {column} + 0.0)",
        "ntz": f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')",
        "floats": (
            f"'[\"' || array_to_string(list_transform({column}, "
            "lambda x: format('{:,.10f}', x::DOUBLE + 0.0)), '\",\"') || '\"]'"
        ),
    }[kind]


def _canonical_select(name: str, relation: str | None = None) -> str:
    parts = [f"{_canonical(c, kind)} AS {c.upper()}" for c, kind in sorted(t.COLUMNS[name].items())]
    return f"SELECT {', '.join(parts)} FROM {relation or name}"


def _hash(name: str) -> str:
    texts = [f"coalesce({_canonical(c, k)}, {_NULL})" for c, k in sorted(t.COLUMNS[name].items())]
    return f"sha256(concat_ws({_SEPARATOR}, {', '.join(texts)}))"


def _hashes(name: str, relation: str | None = None, alias: str = "row_hash") -> str:
    return f"SELECT {_hash(name)} AS {alias} FROM {relation or name}"


_NUMBER = "cast('0x' || substr(row_hash, 1, 15) AS BIGINT)"


def _checksum(
    hashes: str, count: str = "row_count", total: str = "bucket_hash", buckets: int = 1000
) -> str:
    return (
        f"SELECT CAST({_NUMBER} % {buckets} AS INTEGER) AS bucket_id, count(*) AS {count}, "
        f"CAST(sum(CAST({_NUMBER} AS HUGEINT)) AS VARCHAR) AS {total} FROM ({hashes}) h GROUP BY 1"
    )


def _fine_checksum(hashes: str, count: str, total: str) -> str:
    return _checksum(hashes, count, total, 64_000)


# The primes of XXH64.
_P1, _P2, _P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
_P4, _P5 = 9650029242287828579, 2870177450012600261
_2_64 = 1 << 64


def _wrapped(expression: str) -> str:
    return f"CAST(({expression}) % {_2_64}::UHUGEINT AS UBIGINT)"


def _times(x: str, factor: int) -> str:
    return _wrapped(f"CAST({x} AS UHUGEINT) * {factor}::UHUGEINT")


def _plus(x: str, y: str | int) -> str:
    return _wrapped(f"CAST({x} AS UHUGEINT) + {y}::UHUGEINT")


def _rotated(x: str, bits: int) -> str:
    return _plus(_times(x, 1 << bits), f"({x} >> {64 - bits})")


def _xxhash64(hashes: str) -> str:
    """(row_hash, number): XXH64 with seed 42 of the 64 letters of a row hash, step by step.

    64 bytes are two stripes of four lanes and nothing else.
    """
    letter = "CAST(ascii(substr(row_hash, {}, 1)) AS UBIGINT) * {}::UBIGINT"
    words = {
        f"w{k}": " + ".join(letter.format(8 * k + i + 1, 256**i) for i in range(8)) for k in range(8)
    }
    lanes = [42 + _P1 + _P2, 42 + _P2, 42, 42 - _P1]
    steps = [words]
    steps.append({f"s{i}": _plus(_times(f"w{i}", _P2), lanes[i] % _2_64) for i in range(4)})
    steps.append({f"a{i}": _times(_rotated(f"s{i}", 31), _P1) for i in range(4)})
    steps.append({f"t{i}": _plus(_times(f"w{i + 4}", _P2), f"a{i}") for i in range(4)})
    steps.append({f"b{i}": _times(_rotated(f"t{i}", 31), _P1) for i in range(4)})
    steps.append({f"c{i}": _times(f"b{i}", _P2) for i in range(4)})
    steps.append(
        {f"d{i}": _times(_rotated(f"c{i}", 31), _P1) for i in range(4)}
        | {"h0": _plus(_plus(_rotated("b0", 1), _rotated("b1", 7)), _plus(_rotated("b2", 12), _rotated("b3", 18)))}
    )
    for i in range(4):
        steps.append({f"h{i + 1}": _plus(_times(f"xor(h{i}, d{i})", _P1), _P4)})
    steps.append({"h5": _plus("h4", 64)})
    steps.append({"h6": _times("xor(h5, h5 >> 33)", _P2)})
    steps.append({"h7": _times("xor(h6, h6 >> 29)", _P3)})
    steps.append({"h8": "xor(h7, h7 >> 32)"})
    relation = f"({hashes})"
    for i, step in enumerate(steps):
        relation = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM {relation} x{i})"
    signed = f"CASE WHEN h8 >= {1 << 63}::UBIGINT THEN CAST(h8 AS HUGEINT) - {_2_64}::HUGEINT ELSE h8 END"
    return f"SELECT row_hash, CAST({signed} AS BIGINT) AS number FROM {relation} x"


def _xx_checksum(hashes: str, count: str = "row_count", total: str = "bucket_hash") -> str:
    return (
        f"SELECT CAST((number % 1000 + 1000) % 1000 AS INTEGER) AS bucket_id, count(*) AS {count}, "
        f"CAST(sum(CAST(number AS HUGEINT)) AS VARCHAR) AS {total} FROM ({_xxhash64(hashes)}) h GROUP BY 1"
    )


def _buckets(name: str, copy: str, checksum=_checksum) -> str:
    """Differing buckets of a table and its copy."""
    return f"""
SELECT coalesce(s.bucket_id, k.bucket_id) AS bucket_id, source_count, source_hash, sink_count, sink_hash
FROM ({checksum(_hashes(name), 'source_count', 'source_hash')}) s
FULL JOIN ({checksum(_hashes(name, f'({copy}) c'), 'sink_count', 'sink_hash')}) k USING (bucket_id)
WHERE source_count IS DISTINCT FROM sink_count OR source_hash IS DISTINCT FROM sink_hash"""


def _tree(name: str, copy: str, leaf_rows: int = 16) -> str:
    """Differing buckets level by level, as long as few of them differ and hold many rows."""
    levels, buckets = [], 1000
    while buckets <= 1 << 31:
        levels.append((buckets, _buckets(name, copy, partial(_checksum, buckets=buckets))))
        buckets *= 64
    parts, shown, before = [], [], None
    for i, (buckets, sql) in enumerate(levels):
        parts.append(f"l{i} AS ({sql})")
        parts.append(
            f"n{i} AS (SELECT count(*) AS d, sum(coalesce(source_count, 0) + coalesce(sink_count, 0)) AS touched FROM l{i})"
        )
        looked_at = 1000 if i == 0 else f"64 * (SELECT d FROM n{i - 1})"
        go_on = f"(SELECT touched > {leaf_rows} AND 2 * d <= {looked_at} FROM n{i})"
        parts.append(f"g{i} AS (SELECT coalesce({go_on}, FALSE)" + (f" AND (SELECT ok FROM g{i - 1})" if i else "") + " AS ok)")
        shown.append(
            f"SELECT CAST({i} AS INTEGER) AS level, CAST({buckets} AS BIGINT) AS bucket_count, * FROM l{i}"
            + (f" WHERE (SELECT ok FROM g{i - 1})" if i else "")
        )
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(shown)


def _diff_of(source_hashes: str, sink_hashes: str) -> str:
    return f"""
SELECT *, CASE WHEN sink_count = 0 THEN 'ONLY_IN_SOURCE' WHEN src_count = 0 THEN 'ONLY_IN_SINK'
               ELSE 'COUNT_DIFFERS' END AS diff_kind
FROM (
  SELECT coalesce(s.row_hash, k.row_hash) AS row_hash,
         coalesce(n, 0) AS src_count, coalesce(m, 0) AS sink_count
  FROM (SELECT row_hash, count(*) AS n FROM ({source_hashes}) a GROUP BY 1) s
  FULL JOIN (SELECT row_hash, count(*) AS m FROM ({sink_hashes}) b GROUP BY 1) k USING (row_hash)
) j WHERE src_count <> sink_count"""


def _diff(name: str, copy: str) -> str:
    return _diff_of(_hashes(name), _hashes(name, f"({copy}) c"))


def _diff_summary(diff: str) -> str:
    return f"""
SELECT count(*) FILTER (diff_kind = 'ONLY_IN_SOURCE') AS only_in_source,
       count(*) FILTER (diff_kind = 'ONLY_IN_SINK') AS only_in_sink,
       count(*) FILTER (diff_kind = 'COUNT_DIFFERS') AS count_mismatch
FROM ({diff}) d"""


def _hot_hash() -> str:
    kinds = {"o_orderpriority": "str", "o_orderstatus": "str"}
    texts = ", ".join(f"coalesce({_canonical(c, k)}, {_NULL})" for c, k in kinds.items())
    return f"sha256(concat_ws({_SEPARATOR}, {texts}))"


def _sample(kind: str, relation: str) -> str:
    columns = [c.upper() for c in sorted(t.COLUMNS["orders"])]
    shown = ", ".join(f"coalesce({c}, 'null')" for c in columns)
    return f"""
WITH diff AS ({_diff('orders', t.ORDERS_COPY)}),
wanted AS (SELECT row_hash FROM diff WHERE diff_kind = '{kind}' ORDER BY row_hash LIMIT 100),
side AS (SELECT s.*, {_hash('orders')} AS row_hash FROM {relation} s),
marked AS ({_canonical_select('orders', 'side').replace(' FROM side', ', row_hash FROM side')})
SELECT *, concat_ws('|', row_hash, {shown}) AS row_text
FROM marked WHERE row_hash IN (SELECT row_hash FROM wanted) ORDER BY row_hash LIMIT 100"""


def _verdict(table: str, check: str, status: str, source: str, sink: str, detail: str, rest: str) -> str:
    """One verdict row of database TPCH in run r1, from expressions over ``rest``."""
    return (
        f"SELECT 'r1' AS run_id, '2024-01-01' AS run_time, 'TPCH' AS db_name, '{table}' AS table_name, "
        f"'{check}' AS check_type, {status} AS status, {source} AS source_value, {sink} AS sink_value, "
        f"{detail} AS detail {rest}"
    )


def _plain(table: str, check: str, status: str, source: str = "", sink: str = "", detail: str = "") -> str:
    return _verdict(table, check, *[f"'{v}'" for v in (status, source, sink, detail)], rest="")


def _count_verdict(table: str, source: str, sink: str) -> str:
    return _verdict(
        table, "COUNT",
        "CASE WHEN a = b THEN 'OK' ELSE 'MISMATCH' END", "CAST(a AS VARCHAR)", "CAST(b AS VARCHAR)",
        "CASE WHEN a = b THEN '' ELSE 'Mismatch ' || CAST(abs(a - b) AS VARCHAR) || ' rows' END",
        f"FROM (SELECT (SELECT count(*) FROM {source}) AS a, (SELECT count(*) FROM {sink}) AS b) n",
    )


def _checksum_verdict(table: str, buckets: str) -> str:
    return _verdict(
        table, "CHECKSUM",
        "CASE WHEN n = 0 THEN 'OK' ELSE 'MISMATCH' END", "'1000'", "CAST(1000 - n AS VARCHAR)",
        "CASE WHEN n = 0 THEN '' ELSE CAST(n AS VARCHAR) || ' buckets differ: ' || ids END",
        f"""FROM (SELECT count(*) AS n,
             string_agg(CAST(bucket_id AS VARCHAR), ',' ORDER BY bucket_id) FILTER (rk <= 20) AS ids
             FROM (SELECT bucket_id, row_number() OVER (ORDER BY bucket_id) AS rk FROM ({buckets}) b) r) v""",
    )


def _row_diff_verdict(table: str, diff: str, multiset: bool = True) -> str:
    good = "a = 0 AND b = 0" + (" AND c = 0" if multiset else "")
    return _verdict(
        table, "ROW_DIFF",
        f"CASE WHEN {good} THEN 'OK' ELSE 'MISMATCH' END", "CAST(a AS VARCHAR)", "CAST(b AS VARCHAR)",
        "concat('only_in_source=', a, '|only_in_sink=', b, '|count_mismatch=', c, "
        "'|sample_hashes_src=', src, '|sample_hashes_sink=', snk)",
        f"""FROM (SELECT count(*) FILTER (diff_kind = 'ONLY_IN_SOURCE') AS a,
             count(*) FILTER (diff_kind = 'ONLY_IN_SINK') AS b,
             count(*) FILTER (diff_kind = 'COUNT_DIFFERS') AS c,
             string_agg(row_hash, ',' ORDER BY row_hash) FILTER (diff_kind = 'ONLY_IN_SOURCE' AND rk <= 5) AS src,
             string_agg(row_hash, ',' ORDER BY row_hash) FILTER (diff_kind = 'ONLY_IN_SINK' AND rk <= 5) AS snk
             FROM (SELECT *, row_number() OVER (PARTITION BY diff_kind ORDER BY row_hash) AS rk FROM ({diff}) d) r) v""",
    )


def _compare(name: str, table: str, copy: str) -> str:
    return "\nUNION ALL\n".join(
        [
            _plain(table, "SCHEMA", "OK"),
            _count_verdict(table, name, f"({copy}) c"),
            _checksum_verdict(table, _buckets(name, copy)),
            _row_diff_verdict(table, _diff(name, copy)),
        ]
    )


_SKIPPED = "No checksum differences, row diff skipped"


def _clean(table: str, name: str) -> str:
    return "\nUNION ALL\n".join(
        [
            _plain(table, "SCHEMA", "OK"),
            _count_verdict(table, name, name),
            _plain(table, "CHECKSUM", "OK", "1000", "1000"),
            _plain(table, "ROW_DIFF", "OK", detail=_SKIPPED),
        ]
    )


# Categories restated per type name, first by the ordered substring rules, then by name.
_BY_SUBSTRING = {
    "oracle": [
        ("Numeric", "u LIKE '%NUMBER%' OR u LIKE '%FLOAT%' OR u LIKE '%DOUBLE%' OR u LIKE '%INTEGER%'"),
        ("String", "u LIKE '%CHAR%' OR u LIKE '%CLOB%' OR u = 'LONG' OR u LIKE '%ROWID%'"),
        ("Date", "u LIKE '%DATE%' OR u LIKE '%TIMESTAMP%' OR u LIKE '%INTERVAL%'"),
        ("Binary", "u LIKE '%BLOB%' OR u LIKE '%RAW%' OR u LIKE '%BFILE%'"),
    ],
    "mysql": [
        ("Numeric", "regexp_matches(u, 'DECIMAL|NUMERIC|FLOAT|DOUBLE|REAL|INT|YEAR')"),
        ("String", "regexp_matches(u, 'CHAR|TEXT|ENUM|SET|JSON')"),
        ("Date", "regexp_matches(u, 'DATE|TIME')"),
        ("Binary", "regexp_matches(u, 'BLOB|BINARY')"),
        ("Boolean", "regexp_matches(u, 'BOOLEAN|^BOOL$|^BIT[(]1[)]')"),
    ],
    "mssql": [
        ("Numeric", "regexp_matches(u, 'INT|DECIMAL|NUMERIC|MONEY|FLOAT|REAL')"),
        ("String", "regexp_matches(u, 'CHAR|TEXT|XML|UNIQUEIDENTIFIER')"),
        ("Date", "regexp_matches(u, 'DATE|TIME')"),
        ("Binary", "regexp_matches(u, 'BINARY|IMAGE|ROWVERSION')"),
        ("Boolean", "u = 'BIT'"),
    ],
    "spark": [
        ("Numeric", "regexp_matches(u, '^DECIMAL|INT|LONG|DOUBLE|FLOAT|SHORT|BYTE')"),
        ("String", "u LIKE '%STRING%'"),
        ("Date", "regexp_matches(u, 'DATE|TIMESTAMP')"),
        ("Binary", "u LIKE '%BINARY%'"),
        ("Boolean", "u LIKE '%BOOLEAN%'"),
    ],
}
_BY_NAME = {
    "oracle": [
        ("Numeric", "NUMBER|NUMBER[(]10,2[)]|FLOAT|BINARY_FLOAT|BINARY_DOUBLE|INTEGER"),
        ("String", "CHAR|NCHAR|VARCHAR2[(]30[)]|NVARCHAR2|CLOB|NCLOB|LONG|ROWID|UROWID"),
        ("Date", "DATE|TIMESTAMP.*|INTERVAL.*"),
        ("Binary", "LONG RAW|BLOB|RAW|BFILE"),
    ],
    "mysql": [
        ("Numeric", "DECIMAL|NUMERIC|FLOAT|DOUBLE|REAL|INT|(BIG|TINY|SMALL|MEDIUM)INT|YEAR"),
        ("String", "CHAR|VARCHAR|TEXT|LONGTEXT|ENUM|SET|JSON"),
        ("Date", "DATE|TIME|DATETIME|TIMESTAMP"),
        ("Binary", "BLOB|LONGBLOB|BINARY|VARBINARY"),
        ("Boolean", "BOOLEAN|BOOL|BIT|BIT[(]1[)]"),
    ],
    "mssql": [
        ("Numeric", "(BIG|SMALL|TINY)?INT|DECIMAL|NUMERIC|(SMALL)?MONEY|FLOAT|REAL"),
        ("String", "CHAR|NVARCHAR|NTEXT|XML|UNIQUEIDENTIFIER"),
        ("Date", "DATE|TIME|DATETIME|DATETIME2|SMALLDATETIME|DATETIMEOFFSET"),
        ("Binary", "TIMESTAMP|BINARY|VARBINARY|IMAGE|ROWVERSION"),
        ("Boolean", "BIT"),
    ],
    "spark": [
        ("Numeric", "TINYINT|SMALLINT|INT|BIGINT|DECIMAL[(]38,10[)]|FLOAT|DOUBLE"),
        ("String", "STRING"),
        ("Date", "DATE|TIMESTAMP|TIMESTAMP_NTZ|INTERVAL.*"),
        ("Binary", "BINARY"),
        ("Boolean", "BOOLEAN"),
    ],
}


def _category(dialect: str, type_name: str, exact: bool) -> str:
    u = f"upper({type_name})"
    if exact:
        whens = [f"WHEN regexp_full_match({u}, '{names}') THEN '{label}'" for label, names in _BY_NAME[dialect]]
    else:
        whens = [
            f"WHEN {test.replace('(u,', f'({u},').replace('u LIKE', f'{u} LIKE').replace('u =', f'{u} =')} THEN '{label}'"
            for label, test in _BY_SUBSTRING[dialect]
        ]
    return f"CASE {' '.join(whens)} ELSE 'Other' END"


def _type_categories(dialect: str) -> str:
    return (
        f"SELECT column_name, data_type, {_category(dialect, 'data_type', False)} AS by_substring, "
        f"{_category(dialect, 'data_type', True)} AS by_name FROM ({t.typed_parts(dialect)}) p"
    )


def _schema_diff(exact: bool) -> str:
    return f"""
SELECT table_name, column_name, issue FROM (
  SELECT coalesce(s.table_name, k.table_name) AS table_name,
         coalesce(s.column_name, k.column_name) AS column_name,
         CASE WHEN s.column_name IS NULL THEN 'MISSING_IN_SOURCE'
              WHEN k.column_name IS NULL THEN 'MISSING_IN_SINK'
              WHEN s.category <> k.category THEN 'MISMATCH' END AS issue
  FROM (SELECT upper(table_name) AS table_name, upper(column_name) AS column_name,
               {_category('oracle', 'data_type', exact)} AS category FROM ({t.typed_parts('oracle')}) a) s
  FULL JOIN (SELECT upper(table_name) AS table_name, upper(column_name) AS column_name,
               {_category('spark', 'data_type', exact)} AS category FROM ({t.landed_parts()}) b) k
  ON s.table_name = k.table_name AND s.column_name = k.column_name
) j WHERE issue IS NOT NULL"""


_INVENTORY = f"""
SELECT coalesce(s.table_name, k.table_name) AS table_name, s.table_name IS NOT NULL AS in_source,
       coalesce(has_rows, FALSE) AS filled, k.table_name IS NOT NULL AS in_lake
FROM (SELECT upper(table_name) AS table_name, has_rows FROM ({t.SOURCE_TABLES}) a) s
FULL JOIN (SELECT DISTINCT upper(table_name) AS table_name FROM ({t.LAKE_TABLES}) b) k USING (table_name)"""

_INVENTORY_DIFF = f"""
SELECT table_name,
       CASE WHEN filled AND in_lake THEN 'COMMON' WHEN filled THEN 'MISSING_IN_SINK'
            WHEN in_lake THEN 'EXTRA_IN_SINK' ELSE 'SKIPPED_EMPTY' END AS status,
       CASE WHEN in_lake AND NOT filled THEN
            CASE WHEN in_source THEN 'EMPTY_IN_SOURCE' ELSE 'ABSENT_IN_SOURCE' END END AS reason
FROM ({_INVENTORY}) i"""

_NAMES = "coalesce(array_to_string(list_slice(list_sort(list(table_name) FILTER ({0})), 1, 50), ','), '')"
_INVENTORY_CHECK = f"""
SELECT 'r1' AS run_id, '2024-01-01' AS run_time, 'TPCH' AS db_name, '_CATALOG_' AS table_name,
       'TABLE_COUNT' AS check_type,
       CASE WHEN count(*) FILTER (filled <> in_lake) = 0 THEN 'OK' ELSE 'MISMATCH' END AS status,
       CAST(count(*) FILTER (filled) AS VARCHAR) AS source_value,
       CAST(count(*) FILTER (in_lake) AS VARCHAR) AS sink_value,
       'skipped_empty_in_source=' || {_NAMES.format('in_source AND NOT filled')}
       || '|missing_in_sink=' || {_NAMES.format('filled AND NOT in_lake')}
       || '|extra_in_sink=' || {_NAMES.format('in_lake AND NOT filled')} AS detail
FROM ({_INVENTORY}) i"""

_SCHEMA_CHECK = f"""
SELECT 'r1' AS run_id, '2024-01-01' AS run_time, 'TPCH' AS db_name, 'Brand#2' AS table_name,
       'SCHEMA' AS check_type, CASE WHEN count(*) = 0 THEN 'OK' ELSE 'MISMATCH' END AS status,
       '' AS source_value, '' AS sink_value,
       coalesce(string_agg(column_name || ':' || issue, ';' ORDER BY column_name || ':' || issue), '') AS detail
FROM ({_schema_diff(True)}) d WHERE table_name = 'BRAND#2'"""

_SCHEMA_CHECK_ALL = f"""
SELECT 'r1' AS run_id, '2024-01-01' AS run_time, 'TPCH' AS db_name, table_name, 'SCHEMA' AS check_type,
       CASE WHEN count(issue) = 0 THEN 'OK' ELSE 'MISMATCH' END AS status, '' AS source_value, '' AS sink_value,
       coalesce(string_agg(column_name || ':' || issue, ';' ORDER BY column_name || ':' || issue), '') AS detail
FROM (SELECT DISTINCT upper(table_name) AS table_name FROM ({t.typed_parts('oracle')}) p)
LEFT JOIN ({_schema_diff(True)}) d USING (table_name) GROUP BY table_name"""

_STATES = f"""
SELECT run_id, upper(db_name) AS db_name, upper(table_name) AS table_name,
       CASE WHEN bool_or(check_type = 'ROW_DIFF' AND status <> 'ERROR') THEN 'DONE'
            WHEN bool_or(status = 'ERROR') THEN 'FAILED' ELSE 'IN_PROGRESS' END AS state
FROM ({t.PROGRESS_VERDICTS}) v GROUP BY 1, 2, 3"""

_DECIMAL = "CAST(CAST({0} AS DECIMAL(38,10)) AS VARCHAR)"


def _by_value(column: str, kind: str) -> str:
    return _DECIMAL.format(column) if kind in ("int", "float") else _canonical(column, kind)


_SNAPSHOT_INVENTORY = (
    "skipped_empty_in_source=APP.PART|missing_in_sink=APP.NATION|extra_in_sink=APP.PART,APP.SUPPLIER"
)


def oracle_sql() -> dict[str, str]:
    sql = {}
    for name in t.COLUMNS:
        kind = "canonical_text" if name in t.TEXT_TABLES else "canonical"
        sql[f"{kind}_{name}"] = _canonical_select(name)
    for name in ("orders", "lineitem", "events", "documents", "pages", "embeddings", "conversations"):
        sql[f"row_fingerprint_{name}"] = _hashes(name)
    for name in ("orders", "lineitem", "documents"):
        sql[f"bucket_checksum_{name}"] = _checksum(_hashes(name))
    for dialect in t.TYPE_NAMES:
        sql[f"type_category_{dialect}"] = _type_categories(dialect)

    key = "CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY"
    event = "CAST(event_id AS VARCHAR) AS EVENT_ID"
    sql["canonical_decimal"] = (
        f"SELECT {key}, {_DECIMAL.format('CAST(o_totalprice AS DECIMAL(12,2))')} AS PRICE, "
        f"{_DECIMAL.format('o_orderkey')} AS WHOLE FROM orders"
    )
    sql["canonical_date"] = f"SELECT {key}, strftime(o_orderdate::DATE, '%Y-%m-%d') AS DAY FROM orders"
    sql["canonical_boolean"] = (
        f"SELECT {key}, CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderstatus = 'F' THEN '1' "
        "ELSE '0' END END AS IS_FINAL FROM orders"
    )
    sql["canonical_binary"] = (
        "SELECT CAST(page_id AS VARCHAR) AS PAGE_ID, base64(encode(html)) AS HTML FROM pages"
    )
    sql["canonical_timestamp_instant"] = f"SELECT {event}, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS TS FROM events"
    sql["canonical_timestamp_ntz_zone"] = f"SELECT {event}, CAST(epoch_us(ts) AS VARCHAR) AS TS FROM events"
    sql["canonical_timestamp_micros"] = (
        f"SELECT {event}, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS TS FROM events"
    )
    sql["canonical_by_value"] = "SELECT {} FROM lineitem".format(
        ", ".join(f"{_by_value(c, k)} AS {c.upper()}" for c, k in sorted(t.COLUMNS["lineitem"].items()))
    )
    exact = {
        c: f"nullif({c}, '')" if kind == "str" else _canonical(c, kind)
        for c, kind in sorted(t.COLUMNS["customer"].items())
    }
    sql["canonical_exact_strings"] = "SELECT {} FROM ({}) c".format(
        ", ".join(f"{text} AS {c.upper()}" for c, text in exact.items()), t.CUSTOMER_NULLS
    )
    number = "format('{{:,.10f}}', {0} + 0.0)"
    sql["canonical_map"] = (
        "SELECT CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY, CAST(l_linenumber AS VARCHAR) AS L_LINENUMBER, "
        "'[{\"key\":\"quantity\",\"value\":\"' || " + number.format("l_quantity")
        + " || '\"},{\"key\":\"tax\",\"value\":\"' || " + number.format("l_tax") + " || '\"}]' AS FIGURES, "
        "'{\"l_returnflag\":\"' || l_returnflag || '\",\"l_discount\":\"' || " + number.format("l_discount")
        + " || '\"}' AS PAIR, "
        "'[\"' || l_linestatus || '\",\"' || l_returnflag || '\"]' AS FLAGS FROM lineitem"
    )
    d = _DECIMAL.format
    sql["canonical_nested_by_value"] = (
        f"""SELECT '{{"KEY":"' || {d('l_orderkey')} || '","L_QUANTITY":"' || {d('l_quantity')} || '"}}' AS PAIR, """
        f"""'["' || {d('l_discount')} || '","' || {d('l_tax')} || '"]' AS RATES, """
        f"""'["' || {d('l_linenumber')} || '","' || {d('l_partkey')} || '"]' AS WHOLES FROM lineitem """
        f"""UNION ALL SELECT '{{"LABEL":"' || {d('label')} || '","VEC_ID":"' || {d('vec_id')} || '"}}', """
        f"""'["' || {d('label')} || '"]', '["' || {d('vec_id')} || '"]' FROM embeddings"""
    )
    keys = "SELECT CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY, CAST(l_linenumber AS VARCHAR) AS L_LINENUMBER, "
    sql["canonical_nested_fold"] = keys + (
        """'["' || l_returnflag || '",null,"' || l_linestatus || '"]' AS FLAGS, """
        """'[{"key":"FLAG","value":"' || l_returnflag || '"},{"key":"STATUS","value":"' || l_linestatus || '"}]' """
        "AS BY_NAME FROM lineitem"
    )
    sql["canonical_struct"] = keys + (
        """'{"FLAG":' || flag || ',"INNER":' || coalesce(inner_part, 'null') || ',"KEY":' || l_orderkey || '}' AS WHOLE, """
        "inner_part AS PART FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 "
        """THEN '{"A":' || l_linenumber || ',"Z":' || flag || '}' END AS inner_part """
        """FROM (SELECT *, CASE WHEN l_linenumber % 3 <> 0 THEN '"' || l_returnflag || '"' ELSE 'null' END AS flag """
        "FROM lineitem) f) g"
    )
    sql["canonical_nulls"] = (
        f"SELECT CAST(c_custkey AS VARCHAR) AS C_CUSTKEY, {_hash('customer')} AS row_hash "
        f"FROM ({t.CUSTOMER_NULLS}) c"
    )

    orders_diff = _diff("orders", t.ORDERS_COPY)
    repeated_diff = _diff("orders", t.ORDERS_REPEATED)
    sql["checksum_diff_orders"] = _buckets("orders", t.ORDERS_COPY)
    sql["checksum_diff_xxhash"] = _buckets("orders", t.ORDERS_COPY, checksum=_xx_checksum)
    sql["bucket_checksum_xxhash"] = _xx_checksum(_hashes("orders"))
    sql["checksum_refined_orders"] = _buckets("orders", t.ORDERS_COPY, checksum=_fine_checksum)
    sql["hash_tree_orders"] = _tree("orders", t.ORDERS_THREE_CHANGED)
    sql["hash_tree_all_differ"] = _tree("orders", t.ORDERS_ALL_CHANGED)
    sql["diff_rows"] = f"SELECT 'APP.ORDERS' AS table_name, * FROM ({orders_diff}) d"
    sql["diff_buckets"] = (
        "SELECT 'APP.ORDERS' AS table_name, CAST(0 AS INTEGER) AS level, CAST(1000 AS BIGINT) AS bucket_count, * "
        f"FROM ({_buckets('orders', t.ORDERS_COPY)}) b"
    )
    sql["count_check_footers"] = _count_verdict("APP.ORDERS", "orders", f"({t.ORDERS_COPY}) c")
    sql["schema_check_all"] = _SCHEMA_CHECK_ALL
    sql["inventory_resumed"] = _INVENTORY_DIFF
    sql["compacted_verdicts"] = t.ORDER_VERDICTS
    sql["canonical_decimal_exact"] = (
        "SELECT CAST(p_partkey AS VARCHAR) AS P_PARTKEY, "
        f"regexp_replace(CAST(amount AS VARCHAR), '\\.?0*$', '') AS AMOUNT FROM ({t.LONG_DECIMALS}) d"
    )
    sql["canonical_double_exact"] = (
        "SELECT CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY, CAST(l_linenumber AS VARCHAR) AS L_LINENUMBER, "
        "CAST(l_extendedprice AS VARCHAR) AS L_EXTENDEDPRICE, CAST(l_tax / 3 AS VARCHAR) AS THIRD FROM lineitem"
    )
    sql["checksum_clean_lineitem"] = (
        "SELECT CAST(0 AS BIGINT) AS differing, count(*) AS source_rows, count(*) AS sink_rows FROM lineitem"
    )
    sql["checksum_check_orders"] = _checksum_verdict("APP.ORDERS", _buckets("orders", t.ORDERS_COPY))
    sql["count_check_orders"] = _count_verdict("APP.ORDERS", "orders", f"({t.ORDERS_COPY}) c")
    sql["row_multiplicity_orders"] = (
        f"SELECT row_hash, count(*) AS row_count FROM ({_hashes('orders', f'({t.ORDERS_COPY}) c')}) h GROUP BY 1"
    )
    sql["row_diff_orders"] = sql["row_diff_unpruned"] = _diff_summary(orders_diff)
    sql["row_diff_events"] = _diff_summary(_diff("events", t.EVENTS_COPY_DUCKDB))
    sql["row_diff_documents"] = _diff_summary(_diff("documents", t.DOCUMENTS_COPY))
    sql["row_diff_repeated"] = _diff_summary(repeated_diff)
    sql["row_diff_hot_rows"] = _diff_of(
        f"SELECT {_hot_hash()} AS row_hash FROM ({t.HOT_ROWS}) a",
        f"SELECT {_hot_hash()} AS row_hash FROM ({t.HOT_ROWS_COPY}) b",
    )
    sql["row_diff_list_orders"] = orders_diff
    sql["row_diff_check_orders"] = _row_diff_verdict("APP.ORDERS", orders_diff)
    sql["row_diff_check_counts_ignored"] = (
        "SELECT * REPLACE (coalesce(detail, '') AS detail) FROM ("
        + _row_diff_verdict("APP.ORDERS", repeated_diff, multiset=False) + ") v"
    )
    sql["diff_sample_source"] = _sample("ONLY_IN_SOURCE", "orders")
    sql["diff_sample_sink"] = _sample("ONLY_IN_SINK", f"({t.ORDERS_COPY})")
    canonical = _canonical_select("orders")
    canonical_copy = _canonical_select("orders", f"({t.ORDERS_COPY}) c")
    sql["except_all_equivalence"] = (
        f"SELECT (SELECT count(*) FROM ({canonical} EXCEPT ALL {canonical_copy}) a) AS source_minus_sink, "
        f"(SELECT count(*) FROM ({canonical_copy} EXCEPT ALL {canonical}) b) AS sink_minus_source"
    )

    sql["schema_diff_parts"] = _schema_diff(True)
    sql["schema_diff_parts_substring"] = _schema_diff(False)
    sql["schema_check_brand"] = _SCHEMA_CHECK
    sql["table_inventory_diff"] = _INVENTORY_DIFF
    sql["inventory_rows"] = _INVENTORY_DIFF
    sql["table_inventory_check"] = _INVENTORY_CHECK
    sql["table_list_entries"] = t.TABLE_CATALOG_DUCKDB
    sql["tables_per_database"] = (
        f"SELECT database, count(table_name) AS table_count FROM ({t.TABLE_CATALOG_DUCKDB}) e GROUP BY 1"
    )
    sql["list_lake_tables"] = (
        "SELECT DISTINCT upper('l_returnflag=' || l_returnflag || '.l_linestatus=' || l_linestatus) AS table_name, "
        "'l_returnflag=' || l_returnflag AS owner, 'l_linestatus=' || l_linestatus AS \"table\" FROM lineitem"
    )
    sql["scan_lake"] = "SELECT * FROM orders"

    verdict_columns = "db_name, table_name, check_type, source_value, sink_value, detail"
    sql["verdict_summary"] = (
        f"SELECT db_name, check_type, status, count(*) AS cnt FROM ({t.ORDER_VERDICTS}) v "
        "GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"
    )
    sql["resumed_summary"] = sql["verdict_summary"].replace(") v ", ") v WHERE run_id = 'r1' ")
    found = f"SELECT {verdict_columns} FROM ({t.ORDER_VERDICTS}) v WHERE status = 'MISMATCH'"
    sql["verdict_mismatches"] = found
    sql["verdict_mismatches_shown"] = found + " ORDER BY db_name, table_name, check_type LIMIT 50"
    sql["verdict_mismatch_count"] = f"SELECT count(*) AS mismatches FROM ({found}) f"
    sql["write_read_verdicts"] = t.ORDER_VERDICTS
    sql["table_states"] = _STATES
    sql["pending_tables"] = f"""
SELECT p.run_id, upper(p.db_name) AS db_name, upper(p.table_name) AS table_name
FROM ({t.PROGRESS_TABLES}) p ANTI JOIN (SELECT * FROM ({_STATES}) s WHERE state = 'DONE') d
ON d.db_name = upper(p.db_name) AND d.table_name = upper(p.table_name)"""

    sql["compare_table_orders"] = _compare("orders", "APP.ORDERS", t.ORDERS_COPY)
    sql["compare_table_declared"] = sql["compare_table_orders"].replace(
        _plain("APP.ORDERS", "SCHEMA", "OK"),
        _plain("APP.ORDERS", "SCHEMA", "MISMATCH", detail="O_CUSTKEY:MISMATCH"),
    )
    sql["compare_table_samples"] = (
        f"SELECT *, 'source' AS side FROM ({sql['diff_sample_source']}) a "
        f"UNION ALL SELECT *, 'sink' AS side FROM ({sql['diff_sample_sink']}) b"
    )
    sql["compare_table_frozen_events"] = _compare("events", "APP.EVENTS", t.EVENTS_COPY_DUCKDB)
    sql["compare_table_clean_lineitem"] = _clean("APP.LINEITEM", "lineitem")
    sql["compare_table_common_columns"] = _clean("APP.ORDERS", "orders").replace(
        _plain("APP.ORDERS", "SCHEMA", "OK"),
        _plain(
            "APP.ORDERS", "SCHEMA", "MISMATCH",
            detail="LOADED_BY:MISSING_IN_SOURCE;O_ORDERPRIORITY:MISSING_IN_SINK",
        ),
    )
    sql["compare_database_snapshot"] = "\nUNION ALL\n".join(
        [
            _plain("_CATALOG_", "TABLE_COUNT", "MISMATCH", "3", "4", _SNAPSHOT_INVENTORY),
            _compare("orders", "APP.ORDERS", t.ORDERS_COPY),
            _clean("APP.CUSTOMER", "customer"),
        ]
    )
    return sql

"""Telemetry derived from the driver's tables, and the small catalogs for it.

The telemetry views grow with ``events`` and ``customer``; the catalogs are
message definitions and conversion tables (metadata).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.functions.names import clean_name
from byteloom.functions.types import type_of


# --- fixed values: layouts, conversion tables and lengths of the fixture ----
# (ord, byte, description, size, type, name, id)
LAYOUT_A = [
    (0, "0 [0]", "SID", "1 [0]", "-", "-", "-"),
    (1, "1 [0]", "RecordId", "2 [0]", "-", "-", "-"),
    (2, "3 [0]", "Unit - Bus1 - Charge", "1 [0]", "L", "0 to 100 %", "101"),
    (3, "4 [0]", "Unit - Bus1 - Value", "2 [0]", "L", "0 to 6553.5", "102"),
    (4, "6 [0]", "Unit - Bus1 - Kind", "0 [6]", "L", "0 to 63", "103"),
    (5, "6 [6]", "Unit - Bus1 - Tech", "0 [2]", "T", "Tech", "201"),
    (6, "7 [0]", "Flag A", "0 [1]", "T", "False / True", "202"),
    (7, "7 [1]", "Flag B", "0 [1]", "T", "Lamp Present/Not present", "203"),
    (8, "7 [2]", "Flag C", "0 [1]", "T", "Fault/No Fault", "204"),
    (9, "7 [3]", "Reserved", "0 [5]", "I", "5 Bit", "900"),
    (10, "8 [0]", "Signal limited", "2 [0]", "L", "limited", "104"),
    (11, "8 [0]", "Signal wide", "2 [0]", "L", "wide", "105"),
    (12, "10 [2]", "Serial", "7 [6]", "I", "62 bits", "901"),
    (13, "17 [0]", "Mixed", "1 [4]", "L", "12 bits", "107"),
    (14, "17 [3]", "Mixed shifted", "1 [2]", "L", "absent id", "199"),
    (15, "18 [0]", "State", "1 [0]", "T", "State", "205"),
    (16, "19 [0]", "Mode", "1 [0]", "T", "Mode", "206"),
    (17, "20 [0]", "Reserved", "0 [0]", "I", "zero size", "902"),
    (18, "21 [0]", "Temperature", "1 [0]", "L", "-40 to 87", "108"),
    (19, "22 [0]", "Label first", "1 [0]", "L", "label first", "109"),
    (20, "22 [0]", "Odd maximum", "1 [0]", "L", "odd maximum", "110"),
    (21, "23 [0]", "Plain", "1 [0]", "X", "plain", None),
    (22, "23 [6]", "Bad range", "0 [4]", "T", "bad range", "205"),
    (23, "30 [0]", "Missing byte", "1 [0]", "L", "missing", "101"),
    (24, "23 [0]", "No factor", "1 [0]", "L", "no factor", "111"),
    (25, "23 [0]", "Bad label id", "1 [0]", "T", "bad id", "-"),
    (26, "23 [0]", "No label id", "1 [0]", "T", "no id", None),
    (27, "23 [0]", "Bad linear id", "1 [0]", "L", "bad id", "n/a"),
    (28, "23 [0]", "Overlap", "1 [0]", "L", "overlap", "112"),
]
# The 2024 layout repeats a description in an entry beyond the message.
LAYOUT_A_2024 = LAYOUT_A + [
    (29, "40 [0]", "Unit - Bus1 - Charge", "1 [0]", "L", "0 to 100 %", "101")
]
LAYOUT_B = [
    (0, "0 [0]", "SID", "1 [0]", "-", "-", "-"),
    (1, "1 [0]", "RecordId", "2 [0]", "-", "-", "-"),
    (2, "3 [0]", "Wake reason 1", "1 [0]", "T", "Reasons", "206"),
    (3, "4 [0]", "Wake reason 2", "1 [0]", "T", "Reasons", "205"),
    (4, "5 [0]", "Counter", "3 [0]", "L", "km", "113"),
    (5, "8 [4]", "Nibble", "0 [4]", "L", "0 to 15", "103"),
    (6, "9 [0]", "Unit2 - Bus1 - Charge", "1 [0]", "L", "0 to 100 %", "101"),
    (7, "10 [0]", "Little", "1 [3]", "I", "11 bits", "903"),
]

# (id, row_ord, factor, offset, decimals, units, raw_min, raw_max, encoding)
LINEAR_ROWS = [
    (101, 0, 0.5, 0.0, 1, "%", "$00", "$C8", None),
    (102, 1, 0.1, 0.0, 1, "V", "$0000", "$FFFF", None),
    (103, 2, 1.0, 0.0, 0, None, "$00", "$3F", None),
    (104, 3, 0.25, 0.0, 2, "rpm", "$0000", "$01FE", None),
    (104, 4, None, None, 0, None, "$07FE", "$07FF", "No Signal"),
    (104, 5, None, None, 0, None, "$01FF", "$01FF", "Padded"),
    (105, 6, 0.025, 5.0, 2, "A", "$0000", "$FFFE", None),
    (105, 7, None, None, 0, None, "$1FF", "$1FF", "Single"),
    (107, 8, 0.08, -163.84, 2, "deg/s", "$0000", "$0FFF", None),
    (108, 9, 0.5, -40.0, 0, "C", "$00", "$FF", None),
    (109, 10, None, None, 0, None, "$00", "$0F", "Init"),
    (109, 11, 1.0, 0.0, 0, "mm", "$10", "$7F", None),
    (109, 12, None, None, 0, None, "$80", "$FF", "Late"),
    (110, 13, 2.0, 1.0, 0, None, "$0 ", "3.00E+08", None),
    (111, 14, None, None, 0, None, "$00", "$80", None),
    (112, 15, 3.0, 0.0, 0, None, "$00", "$FF", None),
    (112, 16, None, None, 0, None, "$10", "$40", "Low"),
    (112, 17, None, None, 0, None, "$30", "$60", "High"),
    (112, 18, None, None, 0, None, "$20", "$20", "Point"),
    (112, 19, None, None, 0, None, "$70", "$70", "Alone"),
    (113, 20, 0.1, 0.0, 1, "km", "$000000", "$FFFFFF", None),
]

# (id, row_ord, min, encoding)
ENUM_ROWS = [
    (201, 0, "$00", "Two digits"),
    (201, 1, "$0", "One digit"),
    (201, 2, "$1", "Lead"),
    (201, 3, "$2 ", "Lithium"),
    (205, 4, "$0", "Off"),
    (205, 5, "$04", "Four padded"),
    (205, 6, "$4", "Four"),
    (205, 7, "$0A", "Ten"),
    (205, 8, "$A", "Ten short"),
    (205, 9, "$0B", "Eleven"),
    (205, 10, "$0B", "Eleven again"),
    (206, 11, "$0", "Unknown"),
    (206, 12, "$01", "Door"),
    (206, 13, "$1E", "Timer"),
    (206, 14, "$20", "Remote"),
    (206, 15, "$020", "Never"),
]

# Fields of 8, 9 and 16 bytes, and their tables.
LAYOUT_C = [
    (0, "3 [0]", "Long whole", "8 [0]", "I", "64 bits", "910"),
    (1, "3 [0]", "Longer whole", "9 [0]", "X", "72 bits", None),
    (2, "3 [0]", "Longest whole", "16 [0]", "I", "128 bits", "911"),
    (3, "4 [3]", "Long little", "8 [5]", "I", "69 bits", "912"),
    (4, "5 [0]", "Longer little", "9 [4]", "I", "76 bits", "913"),
    (5, "6 [7]", "Shifted little", "9 [1]", "-", "73 bits", "-"),
    (6, "3 [0]", "Scaled", "8 [0]", "L", "scaled", "121"),
    (7, "3 [0]", "Cut", "9 [0]", "L", "no decimals", "122"),
    (8, "3 [0]", "Limited", "8 [0]", "L", "limit in hex", "123"),
    (9, "3 [0]", "Limited decimal", "8 [0]", "L", "limit in digits", "124"),
    (10, "3 [0]", "Limited short", "8 [0]", "L", "limit below", "125"),
    (11, "3 [0]", "Code", "8 [0]", "T", "Code", "221"),
    (12, "3 [0]", "Yes or no", "8 [0]", "T", "False / True", "222"),
    (13, "3 [0]", "No label id", "8 [0]", "T", "no id", None),
    (14, "3 [0]", "No factor", "8 [0]", "L", "no factor", "126"),
    (15, "11 [0]", "Beyond the end", "16 [0]", "I", "cut tail", "914"),
    (16, "11 [0]", "Little beyond", "15 [1]", "I", "too short", "915"),
    (17, "0 [0]", "Nothing before", "8 [2]", "I", "no byte before", "916"),
]
LINEAR_ROWS_C = [
    (121, 0, 0.5, 10.0, 1, "V", None, None, None),
    (122, 1, 0.25, -3.0, 0, None, None, None, None),
    (123, 2, 1.0, 0.0, 1, None, "$0", "$8FFFFFFFFFFFFFFF", None),
    (123, 3, None, None, 0, None, "$FFFFFFFFFFFFFFFF", "$FFFFFFFFFFFFFFFF", "All bits"),
    (123, 4, None, None, 0, None, "$7000000000000000", "$85FFFFFFFFFFFFFF", "Around the sign"),
    (123, 5, None, None, 0, None, "$8000000000000000", "$8100000000000000", "Hidden"),
    (124, 6, 2.0, 0.0, 0, None, "0", "10000000000000000000", None),
    (125, 7, 1.0, 0.0, 0, None, "$00", "$FFFE", None),
    (126, 8, None, None, 0, None, None, None, None),
]
ENUM_ROWS_C = [
    (221, 0, "$FFFFFFFFFFFFFFFF", "Unset"),
    (221, 1, "$7FFFFFFFFFFFFFFF", "Largest"),
    (222, 2, "$00", "Zero"),
]

FAMILIES = ("AU", "BU", "MA")
YEARS = ("2024", "2025", "2026")
# No tables for this pair; no layout at all for the families FU and HO.
PAIR_WITHOUT_TABLES = ("MA", "2026")

# (family, year, message, length); HO has no entry, FU has 0 for one message
LENGTH_ROWS = [
    (family, year, message, length)
    for family in FAMILIES
    for year in YEARS
    for message, length in (("A", 48), ("B", 24))
] + [("FU", year, message, length) for year in YEARS for message, length in (("A", 48), ("B", 0))]

# (message, description, type, clean_name)
COLUMN_ROWS = [
    ("A", "Unit - Bus1 - Charge", "float", "charge"),
    ("A", "Unit - Bus1 - Value", "float", "level"),
    ("A", "Unit - Bus1 - Kind", "int", "kind"),
    ("A", "Unit - Bus1 - Tech", "string", "tech"),
    ("A", "Signal limited", "float", "signal"),
    ("A", "State", "string", "state"),
    ("A", "Mixed", "float", "mixed"),
    ("A", "Unit - Bus1 - Misspelt", "string", "absent"),
    ("B", "Wake reason 1", "string", "wake_1"),
    ("B", "Counter", "float", "counter"),
    ("B", "Unit2 - Bus1 - Charge", "float", "charge_2"),
]
HEX_COLUMNS = {"A": "msg_a", "B": "msg_b"}
# Types of columns by message and name; (message, description, type, name) of all described fields.
FLAT_TYPES = {"A": {"Unit*": "float", "Mode": "string"}, "B": {"Counter": "float"}}
FLAT_COLUMNS = [
    (message, entry[2], type_of(clean_name(entry[2]), FLAT_TYPES[message]) or "string", clean_name(entry[2]))
    for message, layout in (("A", LAYOUT_A), ("B", LAYOUT_B))
    for entry in layout
    if entry[2] != "Reserved" and entry[2] not in ("SID", "RecordId")
]

FIELD_ROWS = [
    (family, year, message, f"{message}_{family}_{year}", *entry)
    for family in FAMILIES
    for year in YEARS
    for message, layout in (
        ("A", LAYOUT_A_2024 if year == "2024" else LAYOUT_A),
        ("B", LAYOUT_B),
    )
    for entry in layout
]
PAIRS_WITH_TABLES = [
    (family, year)
    for family in FAMILIES
    for year in YEARS
    if (family, year) != PAIR_WITHOUT_TABLES
]


PAIRS = [(family, year) for family in FAMILIES for year in YEARS]
FIELD_ROWS_C = [(*pair, "C", "C_%s_%s" % pair, *entry) for pair in PAIRS for entry in LAYOUT_C]


def _table(spark: SparkSession, rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> DataFrame:
    columns = list(zip(*rows))
    return spark.createDataFrame(
        pa.table(
            {name: pa.array(values, type=kind) for (name, kind), values in zip(schema, columns)}
        )
    )


def layouts(spark: SparkSession, rows: list[tuple] = FIELD_ROWS) -> DataFrame:
    s = pa.string()
    return _table(
        spark,
        rows,
        [("family", s), ("model_year", s), ("message", s), ("layout_name", s), ("ord", pa.int32()),
         ("byte", s), ("description", s), ("size", s), ("type", s), ("name", s), ("id", s)],
    )


def linear_table(spark: SparkSession, rows: list[tuple] = LINEAR_ROWS) -> DataFrame:
    s = pa.string()
    return _table(
        spark,
        [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in rows],
        [("family", s), ("model_year", s), ("id", pa.int64()), ("row_ord", pa.int64()),
         ("factor", pa.float64()), ("offset", pa.float64()), ("decimals", pa.int32()),
         ("units", s), ("raw_min", s), ("raw_max", s), ("encoding_name", s)],
    )


def enum_table(spark: SparkSession, rows: list[tuple] = ENUM_ROWS) -> DataFrame:
    s = pa.string()
    return _table(
        spark,
        [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in rows],
        [("family", s), ("model_year", s), ("id", pa.int64()), ("row_ord", pa.int64()),
         ("min", s), ("encoding_name", s)],
    )


def lengths(spark: SparkSession) -> DataFrame:
    s = pa.string()
    return _table(
        spark,
        LENGTH_ROWS,
        [("family", s), ("model_year", s), ("message", s), ("length", pa.int32())],
    )


def output_columns(spark: SparkSession) -> DataFrame:
    s = pa.string()
    return _table(
        spark, COLUMN_ROWS, [("message", s), ("description", s), ("type", s), ("clean_name", s)]
    )


def _hex(value, digits: int):
    return F.lpad(F.hex(value), digits, "0")


def _dealt(df: DataFrame) -> DataFrame:
    """The test table is one row group, which Spark cannot split: deal its rows out.

    A table of many files is scanned as it is.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= slots else df.repartition(slots)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: scalar signals and two hex messages, some faulty."""
    e, u = F.col("event_id"), F.col("user_id")
    tenths = F.floor(F.col("value") * 10).cast("bigint")
    marks = ["FFFF", "FFFE", "01FF", "07FE", "07FF", "0000"]
    special = F.coalesce(
        F.get(F.array(*[F.lit(m) for m in marks]), (e % 7).cast("int")), _hex(e * 13 % 65536, 4)
    )
    full_a = F.concat(
        F.lit("62A001"),
        _hex(u % 256, 2),
        _hex(tenths % 65536, 4),
        _hex((e * 37 + 11) % 256, 2),
        _hex((e * 101 + 7) % 256, 2),
        special,
        _hex(e * 1000003 + 17, 14),
        _hex((e * 29 + 3) % 256, 2),
        _hex(e % 16, 2),
        _hex(e % 40, 2),
        _hex(e % 3, 2),
        _hex(e * 7919 % 65536, 4),
        _hex(F.floor(F.col("value")).cast("bigint") % 256, 2),
    )
    full_b = F.concat(
        F.lit("622947"),
        _hex(e % 33, 2),
        _hex(e % 13, 2),
        _hex(e * 31 % 16777216, 6),
        _hex((e * 53 + 1) % 256, 2),
        _hex(u % 230, 2),
        _hex(e * 17 % 65536, 4),
    )
    a, b = F.col("full_a"), F.col("full_b")
    return (
        _dealt(spark.read.parquet(f"{sf_dir}/events.parquet"))
        .select(
            "event_id",
            u.alias("vin"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("app_timestamp"),
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
            "event_type",
            F.when(e % 3 != 0, F.col("value")).alias("voltage"),
            F.when(e % 5 == 0, e % 100).alias("key_on"),
            full_a.alias("full_a"),
            full_b.alias("full_b"),
        )
        .select(
            "event_id",
            "vin",
            "app_timestamp",
            "dt",
            "event_type",
            "voltage",
            "key_on",
            F.when(e % 17 == 0, None)
            .when(e % 17 == 1, F.lit("E#1"))
            .when(e % 17 == 2, F.substring(a, 1, 47))
            .when(e % 17 == 3, F.lower(a))
            .when(e % 17 == 4, F.concat(F.substring(a, 1, 20), F.lit("ZZ"), F.substring(a, 23, 26)))
            .when(e % 17 == 5, F.substring(a, 1, 20))
            .when(e % 17 == 6, F.lit(""))
            .otherwise(a)
            .alias("msg_a"),
            F.when(e % 13 == 0, None)
            .when(e % 13 == 1, F.lit("E#3"))
            .when(e % 13 == 2, F.substring(b, 1, 13))
            .otherwise(b)
            .alias("msg_b"),
        )
    )


def long_messages(joined: DataFrame) -> DataFrame:
    """Message C of the joined telemetry: 22 bytes, some shorter, some with other text."""
    e = F.col("event_id")
    digits = F.upper(F.md5(e.cast("string").cast("binary")))
    body = (
        F.when(e % 5 == 0, F.repeat(F.lit("F"), F.lit(32)))
        .when(e % 5 == 1, F.concat(F.lit("7FFFFFFFFFFFFFFF"), F.substring(digits, 17, 16)))
        .when(e % 5 == 2, F.concat(F.lit("00000000000000"), F.substring(digits, 15, 18)))
        .when(e % 5 == 3, F.concat(F.lit("8"), F.substring(digits, 2, 31)))
        .otherwise(digits)
    )
    full = F.concat(F.lit("62C001"), body, F.lower(F.substring(digits, 1, 6)))
    hex_text = (
        F.when(e % 17 == 0, None)
        .when(e % 17 == 1, F.substring(full, 1, 15))
        .when(e % 17 == 2, F.substring(full, 1, 21))
        .when(e % 17 == 3, F.concat(F.substring(full, 1, 9), F.lit("G"), F.substring(full, 11, 34)))
        .when(e % 17 == 4, F.lower(full))
        .otherwise(full)
    )
    return joined.select("event_id", "model_name", "family", "model_year", F.lit("C").alias("message"), hex_text.alias("hex"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle master: vin 7 is missing and vin 11 occurs twice."""
    k = F.col("c_custkey")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.when(k == 7, -7).when(k == 12, 11).otherwise(k).alias("VIN"),
        F.substring("c_mktsegment", 1, 5).alias("MODEL_CODE"),
        (k % 3 + 2024).cast("string").alias("MODEL_YEAR"),
        F.col("c_name").alias("MODEL_NAME"),
    )


# --- the same views as SQL for the oracle ------------------------------------


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values_sql(rows: list[tuple], columns: list[str], casts: dict[str, str] | None = None) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    picked = ", ".join(
        f"CAST({c} AS {casts[c]}) AS {c}" if casts and c in casts else c for c in columns
    )
    return f"SELECT {picked} FROM (VALUES {body}) AS v({', '.join(columns)})"


SQL_TELEMETRY = """
SELECT event_id, vin, app_timestamp, dt, event_type, voltage, key_on,
  CASE WHEN event_id % 17 = 0 THEN NULL
       WHEN event_id % 17 = 1 THEN 'E#1'
       WHEN event_id % 17 = 2 THEN substr(full_a, 1, 47)
       WHEN event_id % 17 = 3 THEN lower(full_a)
       WHEN event_id % 17 = 4 THEN substr(full_a, 1, 20) || 'ZZ' || substr(full_a, 23, 26)
       WHEN event_id % 17 = 5 THEN substr(full_a, 1, 20)
       WHEN event_id % 17 = 6 THEN ''
       ELSE full_a END AS msg_a,
  CASE WHEN event_id % 13 = 0 THEN NULL
       WHEN event_id % 13 = 1 THEN 'E#3'
       WHEN event_id % 13 = 2 THEN substr(full_b, 1, 13)
       ELSE full_b END AS msg_b
FROM (
  SELECT event_id, user_id AS vin,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS app_timestamp,
    strftime(ts, '%Y-%m-%d') AS dt, event_type,
    CASE WHEN event_id % 3 <> 0 THEN value END AS voltage,
    CASE WHEN event_id % 5 = 0 THEN event_id % 100 END AS key_on,
    '62A001' || printf('%02X', user_id % 256)
      || printf('%04X', CAST(floor(value * 10) AS BIGINT) % 65536)
      || printf('%02X', (event_id * 37 + 11) % 256)
      || printf('%02X', (event_id * 101 + 7) % 256)
      || CASE event_id % 7 WHEN 0 THEN 'FFFF' WHEN 1 THEN 'FFFE' WHEN 2 THEN '01FF'
           WHEN 3 THEN '07FE' WHEN 4 THEN '07FF' WHEN 5 THEN '0000'
           ELSE printf('%04X', event_id * 13 % 65536) END
      || printf('%014X', event_id * 1000003 + 17)
      || printf('%02X', (event_id * 29 + 3) % 256)
      || printf('%02X', event_id % 16) || printf('%02X', event_id % 40)
      || printf('%02X', event_id % 3) || printf('%04X', event_id * 7919 % 65536)
      || printf('%02X', CAST(floor(value) AS BIGINT) % 256) AS full_a,
    '622947' || printf('%02X', event_id % 33) || printf('%02X', event_id % 13)
      || printf('%06X', event_id * 31 % 16777216)
      || printf('%02X', (event_id * 53 + 1) % 256) || printf('%02X', user_id % 230)
      || printf('%04X', event_id * 17 % 65536) AS full_b
  FROM events)
"""

SQL_VEHICLES = """
SELECT CASE WHEN c_custkey = 7 THEN -7 WHEN c_custkey = 12 THEN 11 ELSE c_custkey END AS vin,
  substr(c_mktsegment, 1, 2) AS family, CAST(2024 + c_custkey % 3 AS VARCHAR) AS model_year,
  c_name AS model_name
FROM customer
"""

SQL_JOINED = """
SELECT t.*, v.family, v.model_year, v.model_name FROM telemetry t JOIN vehicles v ON t.vin = v.vin
"""

SQL_LENGTHS = values_sql(LENGTH_ROWS, ["family", "model_year", "message", "length"])
SQL_COLUMNS = values_sql(COLUMN_ROWS, ["message", "description", "type", "clean_name"])
SQL_FIELDS = values_sql(
    FIELD_ROWS,
    ["family", "model_year", "message", "layout_name", "ord", "byte", "description", "size",
     "type", "name", "id"],
)
SQL_LINEAR = values_sql(
    [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in LINEAR_ROWS],
    ["family", "model_year", "id", "row_ord", "factor", "offset_b", "decimals", "units",
     "raw_min", "raw_max", "encoding_name"],
    {"factor": "DOUBLE", "offset_b": "DOUBLE"},
)
SQL_ENUM = values_sql(
    [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in ENUM_ROWS],
    ["family", "model_year", "id", "row_ord", "min", "encoding_name"],
)

SQL_LONG_MESSAGES = """
SELECT event_id, model_name, family, model_year, 'C' AS message,
  CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN substr(full_c, 1, 15) WHEN 2 THEN substr(full_c, 1, 21)
    WHEN 3 THEN substr(full_c, 1, 9) || 'G' || substr(full_c, 11, 34) WHEN 4 THEN lower(full_c) ELSE full_c END AS hex
FROM (
  SELECT *, '62C001' || CASE event_id % 5 WHEN 0 THEN repeat('F', 32)
      WHEN 1 THEN '7FFFFFFFFFFFFFFF' || substr(digits, 17, 16)
      WHEN 2 THEN '00000000000000' || substr(digits, 15, 18)
      WHEN 3 THEN '8' || substr(digits, 2, 31) ELSE digits END || lower(substr(digits, 1, 6)) AS full_c
  FROM (SELECT *, upper(md5(CAST(event_id AS VARCHAR))) AS digits FROM joined))
"""
_LAYOUT_COLUMNS = ["family", "model_year", "message", "layout_name", "ord", "byte", "description", "size", "type", "name", "id"]
SQL_LONG_LAYOUTS = values_sql(FIELD_ROWS_C, _LAYOUT_COLUMNS)
SQL_LONG_LINEAR = values_sql(
    [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in LINEAR_ROWS_C],
    ["family", "model_year", "id", "row_ord", "factor", "offset_b", "decimals", "units", "raw_min", "raw_max", "encoding_name"],
    {"factor": "DOUBLE", "offset_b": "DOUBLE"},
)
SQL_LONG_ENUM = values_sql(
    [(*pair, *row) for pair in PAIRS_WITH_TABLES for row in ENUM_ROWS_C],
    ["family", "model_year", "id", "row_ord", "min", "encoding_name"],
)

"""Hand-computed vectors, random layouts against the slow statement, equal renderings."""

import random
import tempfile

import pytest
import spec
from pyspark.sql import functions as F

from byteloom.operators import catalog as cat
from byteloom.operators.catalog import compile_catalog, label_sets
from byteloom.operators.decode import (
    WideColumn,
    decode_array,
    decode_long,
    decode_wide,
    envelope,
    join_fields,
)
from byteloom.functions import wholes
from byteloom.functions.numbers import float_text
from byteloom.operators.flatten import field_positions, flatten_messages
from byteloom.plans import fixtures as fx
from byteloom.plans.session import tune

LAYOUT_SCHEMA = (
    "family string, model_year string, message string, layout_name string, ord int, byte string, "
    "description string, size string, type string, name string, id string"
)
LINEAR_SCHEMA = (
    "family string, model_year string, id bigint, row_ord bigint, factor double, offset double, "
    "decimals int, units string, raw_min string, raw_max string, encoding_name string"
)
ENUM_SCHEMA = (
    "family string, model_year string, id bigint, row_ord bigint, min string, encoding_name string"
)
MESSAGE_SCHEMA = "n int, family string, model_year string, message string, hex string"


def catalog_of(spark, entries, linear=(), enum=(), **options):
    layouts = [("F", "1", "A", "L", i, *entry) for i, entry in enumerate(entries)]
    return compile_catalog(
        spark.createDataFrame(layouts, LAYOUT_SCHEMA),
        spark.createDataFrame([("F", "1", *row) for row in linear], LINEAR_SCHEMA),
        spark.createDataFrame([("F", "1", *row) for row in enum], ENUM_SCHEMA),
        **{"dedup": "all", **options},
    ).stored(tempfile.mkdtemp(prefix="byteloom-test-"))


def messages_of(spark, texts):
    rows = [(i, "F", "1", "A", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def values(spark, entries, texts, linear=(), enum=(), **options):
    catalog = catalog_of(spark, entries, linear, enum, **options)
    rows = decode_long(messages_of(spark, texts), catalog).orderBy("n", "ord").collect()
    return [row.value for row in rows]


L1 = (1, 0, 0.1, 0.0, 1, "V", "$00", "$FF", None)
VECTORS = [
    ("B6", ("0 [2]", "d", "0 [3]", "I", "", "1"), "5"),
    ("0E10", ("0 [0]", "d", "2 [0]", "I", "", "1"), "3600"),
    ("F00A", ("0 [4]", "d", "0 [0]", "I", "", "1"), "175"),
    ("2A0F", ("1 [0]", "d", "1 [4]", "I", "", "1"), "2575"),
    ("00100E", ("1 [0]", "d", "2 [1]", "I", "", "1"), "3600"),
    ("C8", ("0 [0]", "d", "1 [0]", "L", "", "1"), "20.0"),
    ("4F", ("0 [0]", "d", "1 [0]", "L", "", "2"), "0"),
    ("07FF", ("0 [0]", "d", "2 [0]", "L", "", "3"), "No Signal"),
    ("FFFF", ("0 [0]", "d", "2 [0]", "L", "", "4"), "Invalid/Not Available"),
    ("01FF", ("0 [0]", "d", "2 [0]", "L", "", "5"), "Out of Range/Invalid"),
    ("FFFF", ("0 [0]", "d", "2 [0]", "L", "", "5"), "Invalid/Sensor Error"),
    ("FFFE", ("0 [0]", "d", "2 [0]", "L", "", "5"), "Not Initialized"),
    ("04", ("0 [0]", "d", "1 [0]", "T", "", "10"), "Four"),
    ("01", ("0 [0]", "d", "1 [0]", "T", "False / True", "11"), "True"),
    ("0A", ("0 [0]", "d", "1 [0]", "T", "other", "11"), "0xA (No match)"),
    ("00", ("9 [0]", "d", "1 [0]", "I", "", "1"), "Error: Byte 9 not available in DDT string"),
    ("ZZ", ("0 [0]", "d", "1 [0]", "I", "", "1"),
     "Error: invalid literal for int() with base 16: 'ZZ'"),
    ("00", ("0 [0]", "d", "1 [4]", "I", "", "1"), "Error: Cannot expand backward beyond byte 0"),
    ("00", (None, "d", None, "I", "", "1"), "0"),
]
LINEAR = [
    L1,
    (2, 1, 0.5, -40.0, 0, None, "$00", "$FF", None),
    (3, 2, 1.0, 0.0, 0, None, "$0000", "$0700", None),
    (3, 3, None, None, 0, None, "$07FE", "$07FF", "No Signal"),
    (4, 4, 1.0, 0.0, 0, None, "$0000", "$FFFE", None),
    (5, 5, 1.0, 0.0, 0, None, "$0000", "$01FE", None),
    (5, 6, None, None, 0, None, "$01FF", "$01FF", "Padded"),
]
ENUM = [(10, 0, "$04", "Four padded"), (10, 1, "$4", "Four")]


def test_vectors(spark):
    """Every vector's text through every vector's field; its own pair is known."""
    catalog = catalog_of(spark, [entry for _, entry, _ in VECTORS], LINEAR, ENUM)
    rows = decode_long(messages_of(spark, [text for text, _, _ in VECTORS]), catalog)
    got = {row.n: row.value for row in rows.filter("n = ord").collect()}
    assert got == {i: expected for i, (_, _, expected) in enumerate(VECTORS)}


def test_code_digits_of_the_inspector(spark):
    enum = [(10, 0, "$A", "one"), (10, 1, "$0A", "two"), (10, 2, "$04", "four")]
    entry = ("0 [0]", "d", "1 [0]", "T", "", "10")
    assert values(spark, [entry], ["0A", "04"], (), enum) == ["one", "four"]
    assert values(spark, [entry], ["0A", "04"], (), enum, hex_mode="strict") == [
        "two",
        "0x4 (No match)",
    ]


def test_last_entry_of_a_description_wins_even_if_it_fails(spark):
    entries = [("0 [0]", "same", "1 [0]", "I", "", "1"), ("9 [0]", "same", "1 [0]", "I", "", "1")]
    assert values(spark, entries, ["07"], dedup="last")[0].startswith("Error: ")
    assert values(spark, entries, ["07"], dedup="first") == ["7"]


def labels_by_search(sets, value):
    """Label of a value in the pieces of a label set."""
    at = sum(start <= value for start in sets.starts)
    return sets.names[at - 1] if at else None


def test_overlapping_ranges_belong_to_the_first_row(spark):
    rows = [
        ("F", "1", 1, 0, None, None, 0, None, "$10", "$40", "low"),
        ("F", "1", 1, 1, None, None, 0, None, "$30", "$60", "high"),
        ("F", "1", 1, 2, None, None, 0, None, "$00", "$FF", "rest"),
    ]
    linear = spark.createDataFrame(rows, LINEAR_SCHEMA)
    [sets] = label_sets(linear, spark.createDataFrame([], ENUM_SCHEMA)).collect()
    assert sets.starts == sorted(set(sets.starts)) and sets.big_starts is None
    for v in range(256):
        assert labels_by_search(sets, v) == ("low" if 16 <= v <= 64 else "high" if 48 <= v <= 96 else "rest")
    assert labels_by_search(sets, 256) is None


def test_random_ranges_equal_a_scan_in_file_order(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        low = rng.randrange(0, 3000)
        high = low + rng.choice([0, 0, 1, 5, 70, 900])
        rows.append(("F", "1", i % 3, i, None, None, 0, None, f"${low:02X}", f"${high:02X}", f"n{i}"))
    sets = {s.id_number: s for s in label_sets(spark.createDataFrame(rows, LINEAR_SCHEMA), spark.createDataFrame([], ENUM_SCHEMA)).collect()}
    for key in range(3):
        for value in range(0, 4000, 7):
            hits = [r[10] for r in rows if r[2] == key and int(r[8][1:], 16) <= value <= int(r[9][1:], 16)]
            assert labels_by_search(sets[key], value) == (hits[0] if hits else None)


def test_random_layouts_equal_the_slow_statement(spark):
    rng = random.Random(7)
    entries, shapes = [], []
    for i in range(150):
        p, b = rng.randrange(0, 12), rng.randrange(0, 9)
        n, k = rng.choice([(0, rng.randrange(1, 9)), (rng.randrange(1, 8), 0), (0, 0),
                           (rng.randrange(1, 7), rng.randrange(1, 8))])
        shapes.append((p, b, n, k))
        entries.append((f"{p} [{b}]", f"f{i}", f"{n} [{k}]", "I", "", "1"))
    texts = ["".join(rng.choice("0123456789abcdefABCDEF") for _ in range(rng.randrange(0, 30)))
             for _ in range(40)]
    texts += [t[:5] + "g" + t[6:] for t in texts if len(t) > 8] + ["é1" * 8, "E#1"]
    rows = decode_long(messages_of(spark, texts), catalog_of(spark, entries)).collect()
    assert len(rows) == len(texts) * len(entries)
    for row in rows:
        assert row.raw == spec.read(texts[row.n], *shapes[row.ord]), (row, shapes[row.ord])
        assert (row.error is None) == (row.raw is not None)


def test_inserted_bits_are_read_back(spark):
    rng = random.Random(3)
    fields, position = [], 0
    while position < 64:
        width = min(rng.randrange(1, 5), 8 - position % 8)
        fields.append((position // 8, position % 8, width))
        position += width
    entries = [(f"{p} [{b}]", f"f{p}.{b}", f"0 [{k}]", "I", "", "1") for p, b, k in fields]
    wanted, texts = [], []
    for _ in range(20):
        data = bytearray(8)
        numbers = [rng.randrange(2**k) for _, _, k in fields]
        for (p, b, _), number in zip(fields, numbers):
            data[p] |= number << b
        wanted += [str(number) for number in numbers]
        texts.append(data.hex())
    assert values(spark, entries, texts) == wanted


def test_rounding_and_number_text_equal_numpy(spark):
    rng = random.Random(5)
    scales = [(0.1, 0.0, 1), (0.025, 5.0, 2), (0.0625, 0.0, 3), (0.08, -163.84, 2), (0.5, -40.0, 0),
              (12345.678, 0.0, 2), (0.00001, 0.0, 5), (1.0, 0.0, 1)]
    linear = [(i, i, m, o, d, None, None, None, None) for i, (m, o, d) in enumerate(scales)]
    entries = [("0 [0]", f"f{i}", "2 [0]", "L", "", str(i)) for i in range(len(scales))]
    raws = [rng.randrange(65536) for _ in range(300)] + [0, 1, 2, 5, 9, 10, 50, 65535]
    got = values(spark, entries, [f"{raw:04X}" for raw in raws], linear)
    assert got == [spec.rounded(raw, *scale) for raw in raws for scale in scales]


def test_float_text_has_python_form(spark):
    numbers = [0.0, 20.0, 0.1, 1e-5, 2.5e-7, 0.00012, 9999999.0, 1e7, 12345678.9, 1e15, 1e16, -3.25e20]
    rows = spark.createDataFrame([(n,) for n in numbers], "x double").select(float_text(F.col("x")))
    assert [row[0] for row in rows.collect()] == [repr(n) for n in numbers]


@pytest.fixture(scope="module")
def wide_case(spark, tmp_path_factory):
    tune(spark)
    catalog = compile_catalog(
        fx.layouts(spark), fx.linear_table(spark), fx.enum_table(spark)
    ).stored(str(tmp_path_factory.mktemp("catalog")))
    described = catalog.fields.select("message", "description").distinct().collect()
    columns = [
        WideColumn(m, d, ("string", "double", "int")[i % 3], f"c{i}")
        for i, (m, d) in enumerate(sorted(tuple(r) for r in described))
    ]
    telemetry = fx.telemetry(spark, "/root/testdata/sf0.001").withColumns(
        {
            "family": F.get(F.array(*[F.lit(f) for f in ("AU", "MA", "HO")]), (F.col("vin") % 3).cast("int")),
            "model_year": (F.col("event_id") % 3 + 2024).cast("string"),
        }
    )
    return telemetry, catalog, columns


def test_wide_by_expression_equals_wide_by_array(wide_case):
    telemetry, catalog, columns = wide_case
    names = ["event_id", *[c.name for c in columns]]
    by_expression = decode_wide(telemetry, catalog, columns, fx.HEX_COLUMNS).select(*names)
    by_array = decode_wide(telemetry, catalog, columns, fx.HEX_COLUMNS, limit=0).select(*names)
    assert by_expression.exceptAll(by_array).isEmpty()
    assert by_array.exceptAll(by_expression).isEmpty()


def test_wide_decode_neither_shuffles_nor_joins_fields(spark, wide_case, capsys):
    telemetry, catalog, columns = wide_case
    decode_wide(
        spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
            "event_id", "props AS msg_a", "event_type AS family", "event_type AS model_year"
        ),
        catalog,
        columns[:12],
        {"A": "msg_a"},
    ).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan


def test_array_form_has_no_shuffle_of_messages(spark, wide_case, capsys):
    _, catalog, _ = wide_case
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_id", "props AS hex", "event_type AS family", "event_type AS model_year", "'A' AS message"
    )
    assert catalog.small
    decode_array(events, catalog).explain()
    plan = capsys.readouterr().out
    messages_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in messages_side and "Exchange" not in messages_side


def test_envelopes_tell_why(spark):
    catalog = catalog_of(spark, [("0 [0]", "d", "1 [0]", "I", "", "1")])
    rows = [
        (0, "F", "1", "A", "07"),
        (1, "F", "1", "A", ""),
        (2, "F", "1", "A", None),
        (3, "X", "1", "A", "07"),
        (4, "F", "1", "B", "07"),
    ]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    mapped = messages.filter("message = 'A'").select("family", "model_year", "message")
    text = envelope(messages, catalog, "envelope", mapped=mapped).orderBy("n").collect()
    reasons = [r[0] for r in spark.createDataFrame([(t.envelope,) for t in text], "e string")
               .select(F.get_json_object("e", "$.error")).collect()]
    assert reasons == [
        None,
        "Empty DDT string",
        "Empty DDT string",
        "Structure file not found: X/1/DDT_BCM_A_X_1.json",
        "DDT file mapping not found for B",
    ]
    quiet = {r.n: r.envelope is not None for r in envelope(messages, catalog).collect()}
    assert quiet == {0: True, 1: True, 2: False, 3: False, 4: False}


def test_flatten_takes_every_described_field_of_the_layouts(spark):
    entries = [
        ("0 [0]", "Bus - Volt", "1 [0]", "L", "", "1"),
        ("1 [0]", "Reserved", "1 [0]", "I", "", "1"),
        ("1 [0]", "Count", "1 [0]", "I", "", "1"),
    ]
    catalog = catalog_of(spark, entries, [L1])
    positions = {r.description: r.position for r in field_positions(catalog).collect()}
    assert positions == {"Bus - Volt": 0, "Count": 2}
    rows = spark.createDataFrame([("F", "1", "C807")], "family string, model_year string, m string")
    flat = flatten_messages(rows, catalog, {"A": "m"}, {"A": {"Bus*": "float"}})
    assert flat.select("Bus__Volt", "Count").collect() == [(20.0, "7")]


def test_large_float_text_is_the_shortest(spark):
    rng = random.Random(13)
    numbers = [rng.choice([-1, 1]) * rng.randrange(2**56, 2 ** rng.randrange(60, 400)) / 2 for _ in range(3000)]
    numbers += [1e16, 2.0**63, 2.0**64 - 2048, 1e23, 9.999999999999999e22, 1.7976931348623157e308]
    rows = spark.createDataFrame([(n,) for n in numbers], "x double").select(wholes.large_float_text(F.col("x")))
    assert [row[0] for row in rows.collect()] == [repr(n) for n in numbers]


def test_whole_numbers_of_any_width(spark):
    rng = random.Random(17)
    numbers = [0, 1, 2**63 - 1, 2**63, 2**64 - 1, 2**64, 10**9, 10**38, 2**128 - 1] + [
        rng.randrange(2 ** rng.randrange(1, 400)) for _ in range(300)
    ]
    rows = spark.createDataFrame([(i, f"{n:020x}", str(n)) for i, n in enumerate(numbers)], "i int, h string, d string")
    whole = wholes.normal(F.col("h"))
    got = rows.select(
        "i", whole.alias("w"), wholes.decimal_text(whole).alias("d"), wholes.to_bigint(whole).alias("n"),
        wholes.sortable(whole).alias("s"), wholes.of_decimal(F.col("d")).alias("o"), wholes.to_double(whole).alias("f"),
    ).orderBy("i").collect()
    for row, n in zip(got, numbers):
        assert (row.w, row.d, row.f) == (f"{n:X}", str(n), float(n))
        assert row.n == (n if n < 2**63 else None)
        assert row.o == (f"{n:X}" if n < 10**38 else None)
    assert [r.i for r in sorted(got, key=lambda r: r.s)] == sorted(range(len(numbers)), key=lambda i: (numbers[i]))


def test_whole_part_of_large_doubles(spark):
    numbers = [0.0, -0.75, 5.9, 2.0**62, -(2.0**63), 2.0**63, 2.0**64 - 2048, 1e22, -1.5e30, 3.3e200]
    rows = spark.createDataFrame([(n,) for n in numbers], "x double").select(wholes.double_text(F.col("x")))
    assert [row[0] for row in rows.collect()] == [str(int(n)) for n in numbers]


def test_wide_layouts_equal_the_slow_statement(spark):
    """Random fields of up to 20 bytes, in the long, the array and the wide form."""
    rng = random.Random(19)
    shapes = []
    for _ in range(60):
        n, k = rng.choice([(rng.randrange(6, 21), 0), (rng.randrange(6, 20), rng.randrange(1, 12))])
        shapes.append((rng.randrange(0, 12), rng.randrange(0, 9), n, k))
    entries = [(f"{p} [{b}]", f"f{i}", f"{n} [{k}]", "I", "", "1") for i, (p, b, n, k) in enumerate(shapes)]
    texts = ["".join(rng.choice("0123456789abcdefABCDEF") for _ in range(rng.randrange(20, 80))) for _ in range(25)]
    texts += [t[:30] + "g" + t[31:] for t in texts[:5]] + ["F" * 70, "0" * 70, "7" + "F" * 69]
    catalog = catalog_of(spark, entries)
    messages = messages_of(spark, texts)
    want = {
        (i, j): spec.read(text, *shape) for i, text in enumerate(texts) for j, shape in enumerate(shapes)
    }
    for row in decode_long(messages, catalog).collect():
        number = want[row.n, row.ord]
        assert (row.raw is None) == (number is None or number >= 2**63)
        assert row.raw_big == (str(number) if number is not None and number >= 2**63 else None)
        assert (row.error is None) == (number is not None) and (number is None or row.value == str(number))
        assert row.num == (None if number is None else float(number))
    arrays = {r.n: r.decoded for r in decode_array(messages, catalog).collect()}
    columns = [WideColumn("A", f"f{j}", "string", f"f{j}") for j in range(len(shapes))]
    wide = {r.n: r for r in decode_wide(messages.withColumnRenamed("hex", "h"), catalog, columns, {"A": "h"}).collect()}
    for (i, j), number in want.items():
        record = arrays[i][j]
        assert record.decoded_value == wide[i][f"f{j}"]
        if number is not None:
            assert record.decoded_value == str(number) and (record.raw_big is None) == (number < 2**63)


def test_ten_thousand_ranges_of_one_id(spark):
    """Found by halving: no list of ranges is walked for a message."""
    ranges = [(1, 0, 1.0, 0.0, 0, None, "$0000", "$FFFF", None)]
    ranges += [(1, 1 + i, None, None, 0, None, f"${6 * i:04X}", f"${6 * i + 3:04X}", f"n{i}") for i in range(10_000)]
    catalog = catalog_of(spark, [("0 [0]", "d", "2 [0]", "L", "", "1")], ranges)
    raws = list(range(0, 65536, 41)) + [59997, 59998, 65535]
    decoded = decode_long(messages_of(spark, [f"{raw:04X}" for raw in raws]), catalog)
    got = {r.n: r.value for r in decoded.collect()}
    for i, raw in enumerate(raws):
        assert got[i] == (f"n{raw // 6}" if raw % 6 < 4 and raw // 6 < 10_000 else str(raw))
    assert "lambda" not in decoded._jdf.queryExecution().optimizedPlan().toString()


def test_rows_do_not_carry_the_largest_table(spark):
    """Steps of the search may copy a row; it holds the starts of blocks and one block, whatever the table's size."""
    ranges = [(1, 0, 1.0, 0.0, 0, None, "$0000", "$FFFF", None)]
    ranges += [(1, 1 + i, None, None, 0, None, f"${4 * i:04X}", f"${4 * i + 2 + i % 2:04X}", None if i % 5 == 0 else f"n{9000 - i}") for i in range(3000)]
    ranges += [(2, 0, 1.0, 0.0, 0, None, "$0000", "$FFFF", None), (2, 1, None, None, 0, None, "$05", "$07", "few")]
    entries = [("0 [0]", "many", "2 [0]", "L", "", "1"), ("0 [0]", "two", "2 [0]", "L", "", "2"), ("0 [0]", "plain", "2 [0]", "I", "", "1")]
    catalog = catalog_of(spark, entries, ranges)
    messages = messages_of(spark, [f"{raw:04X}" for raw in range(0, 13000, 7)] + ["12", "ZZZZ", None])
    joined = join_fields(messages, catalog)
    lists = [c for c, kind in joined.dtypes if kind.startswith("array<") and c not in ("hex_bytes", "big_starts", "big_names")]
    longest = joined.select(F.greatest(*[F.max(F.coalesce(F.size(c), F.lit(0))) for c in lists], F.lit(0))).first()[0]
    assert longest <= 300 < catalog.facts["starts"]
    got = {(r.n, r.description): r.value for r in decode_long(messages, catalog).collect()}
    for i, raw in enumerate(range(0, 13000, 7)):
        # Odd ranges end where the next one begins.
        labelled = raw % 4 < 3 + raw // 4 % 2 and raw // 4 < 3000 and raw // 4 % 5
        assert got[i, "many"] == (f"n{9000 - raw // 4}" if labelled else str(raw))
        assert got[i, "two"] == ("few" if 5 <= raw <= 7 else str(raw)) and got[i, "plain"] == str(raw)
    # A table that is joined by a shuffle gives the same.
    shuffled = cat.FieldCatalog(catalog.fields, catalog.empty)
    shuffled.__dict__["facts"] = catalog.facts.asDict() | {"size": 2**40}
    assert got == {(r.n, r.description): r.value for r in decode_long(messages, shuffled).collect()}


def test_ranges_behind_earlier_ones_are_left_out(spark):
    """Of ranges that begin at one value those stay that reach beyond all earlier rows."""
    rng = random.Random(5)
    rows = [("F", "1", 1, i, None, None, 0, None, f"${rng.randrange(4) * 16:02X}", f"${rng.randrange(64, 120):02X}", f"n{i}") for i in range(300)]
    rows += [("F", "1", 1, 400, None, None, 0, None, "$00", "$XY", "no range"), ("F", "1", 1, None, None, None, 0, None, "$20", "$22", "first")]
    linear = spark.createDataFrame(rows, LINEAR_SCHEMA)
    no_codes = spark.createDataFrame([], ENUM_SCHEMA)
    assert cat.label_spans(linear, no_codes).count() < 80
    [sets] = label_sets(linear, no_codes).collect()
    ranges = [(r[3] if r[3] is not None else -1, int(r[8][1:], 16), int(r[9][1:], 16), r[10]) for r in rows if r[9] != "$XY"]
    for v in range(130):
        assert labels_by_search(sets, v) == min(((o, n) for o, low, high, n in ranges if low <= v <= high), default=(0, None))[1]

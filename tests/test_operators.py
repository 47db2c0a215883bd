"""Ordered, keyed and reshaping operators against brute force on skewed rows."""

import random

import pytest
from pyspark.sql import functions as F

from byteloom.functions.names import clean_name, message_columns
from byteloom.functions.types import cast_text, type_of
from byteloom.operators import flatten, lookup, reshape, summary, timeline, validate
from byteloom.sinks import tables
from byteloom.sources import catalogs
from byteloom.sources import telemetry as tel

SCHEMA = "vin string, app_timestamp string, tie int, a int, b string"


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows in one vehicle, ties, missing keys and times."""
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        vin = rng.choice(["hot", "v1", "v2", None, f"v{rng.randrange(40)}"])
        time = rng.choice(
            [None, f"2024-01-{rng.randrange(1, 4):02} {rng.randrange(24):02}:{rng.randrange(60):02}:00",
             "2024-01-02 10:00:00"]
        )
        a = rng.choice([None, None, rng.randrange(9)])
        rows.append((vin, time, i, a, rng.choice([None, "x", "y"])))
    return rows


def by_time(row):
    return (row[1] is not None, row[1] or "", row[2])


def test_forward_fill(spark, skewed):
    expected, last = {}, {}
    for row in sorted(skewed, key=by_time):
        for i in (3, 4):
            if row[i] is not None:
                last[row[0], i] = row[i]
        expected[row[2]] = (last.get((row[0], 3)), last.get((row[0], 4)))
    for unit in ("day", "hour", "second"):
        filled = timeline.forward_fill(
            spark.createDataFrame(skewed, SCHEMA), ["a", "b"], tiebreak=["tie"], unit=unit
        )
        got = {r.tie: (r.a_reference, r.b_reference) for r in filled.collect()}
        assert got == expected


def test_forward_fill_of_timestamps(spark, skewed):
    text = spark.createDataFrame(skewed, SCHEMA)
    from_text = timeline.forward_fill(text, ["a"], tiebreak=["tie"])
    from_time = timeline.forward_fill(tel.parse_time(text), ["a"], tiebreak=["tie"])
    pick = ["tie", "a_reference"]
    assert from_text.select(*pick).exceptAll(from_time.select(*pick)).isEmpty()


def test_row_chunks(spark, skewed):
    chunked = timeline.row_chunks(
        spark.createDataFrame(skewed, SCHEMA), 7, tiebreak=["tie"], groups=["vin"]
    )
    seen, expected = {}, {}
    for row in sorted(skewed, key=by_time):
        seen[row[0]] = seen.get(row[0], 0) + 1
        expected[row[2]] = (seen[row[0]] - 1) // 7
    assert {r.tie: r.chunk for r in chunked.collect()} == expected


def test_first_per_group_limits_before_the_shuffle(spark, skewed, capsys):
    frame = spark.createDataFrame(skewed, SCHEMA)
    first = timeline.first_per_group(frame, 5, group="vin", tiebreak=["tie"], required="a")
    kept = {}
    for row in sorted((r for r in skewed if r[3] is not None), key=by_time):
        kept.setdefault(row[0], []).append(row[2])
    assert sorted(r.tie for r in first.collect()) == sorted(t for v in kept.values() for t in v[:5])
    first.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_zip_of_lines_keeps_the_shorter_sequence(spark):
    lines = [
        ("f", 0, "10"), ("f", 1, "11,62A,x"), ("f", 2, ",62B"), ("f", 3, "12,plain,y"),
        ("f", 4, ""), ("f", 5, "13,null,z"), ("g", 0, ",62C,q"),
    ]
    frame = spark.createDataFrame(lines, "file string, pos int, line string")
    zipped = reshape.zip_log_lines(frame, ["c1", "c2"], "file", "pos", F.floor(F.col("pos") / 2))
    got = sorted(tuple(r) for r in zipped.collect())
    assert got == [("f", 1, 10, "62A", "x"), ("f", 2, 11, "62B", ""), ("f", 3, 12, "null", "z"),
                   ]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(30).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    salted = lookup.lookup_join(big, small, ["k"], how, small=False)
    plain = lookup.lookup_join(big, small, ["k"], how, small=True)
    assert salted.exceptAll(plain.select(*salted.columns)).isEmpty()
    assert plain.select(*salted.columns).exceptAll(salted).isEmpty()


def test_broadcast_is_refused_beyond_the_limits(spark):
    assert lookup.fits_broadcast(spark.range(10))
    assert not lookup.fits_broadcast(spark.range(10), rows=9)
    assert not lookup.fits_broadcast(spark.range(10), size=20)


def test_validity_flags_are_never_null(spark):
    rows = [("A", "1", None), ("A", "1", "E#1"), ("A", "1", "1234"), ("B", "1", "1234"), (None, None, "1234")]
    frame = spark.createDataFrame(rows, "family string, model_year string, m string")
    lengths = spark.createDataFrame(
        [("A", "1", "M", 4)], "family string, model_year string, message string, length int"
    )
    flagged = validate.with_validity(frame, lengths, {"M": "m"}).collect()
    assert sorted(r.M_is_valid for r in flagged) == [False] * 4 + [True]
    assert all(r.M_is_valid == (r.family == "A" and r.m == "1234") for r in flagged)


def test_names_and_types(spark):
    assert clean_name("IBS3 - IBS_Slow1 - IBS3_SOC") == "IBS3__IBS_Slow1__IBS3_SOC"
    assert message_columns(["vin", "DIAG_BCM_A001", "DIAG_X"]) == {"A001": "DIAG_BCM_A001"}
    assert type_of("abc", {"a*": "float", "abc": "int"}) == "float"
    assert type_of("abc", {"*bc": "float"}) is None
    text = spark.createDataFrame([("85.0",), ("x",), ("-3",), (None,)], "t string")
    assert [r[0] for r in text.select(cast_text(F.col("t"), "int")).collect()] == [85, None, -3, None]


def test_union_by_position_refuses_other_widths(spark):
    with pytest.raises(ValueError):
        reshape.union_all_by_position([spark.range(1), spark.range(1).withColumn("x", F.lit(1))])


def test_quality_report_without_decoded_columns(spark):
    frame = spark.createDataFrame([("A", "1")], "family string, model_year string")
    report = summary.quality_report(frame).first()
    assert report.decoded_columns == 0 and report.success_rate is None


def test_flattened_column_types():
    columns = flatten.flattened_columns(
        [("A", "x - y"), ("A", "z")], {"A": {"x__y": "float"}}
    )
    assert [(c.name, c.type) for c in columns] == [("x__y", "float"), ("z", "string")]


def test_definition_files(spark, tmp_path):
    folder = tmp_path / "DT" / "2025"
    folder.mkdir(parents=True)
    (folder / "DDT_BCM_A001_DT_2025.json").write_text(
        '{"name": "n", "entries": [\n{"byte": "0 [0]", "description": "d", "size": "1 [0]",'
        ' "type": "L", "name": "x", "id": "5"},\n{"description": "e", "type": "T", "default_value": "9"}]}'
    )
    (folder / "conv_L_BCM_DT_2025.csv").write_text(
        "ID,Description,Size,Factor (m),Offset (b),Type,Decimal Places,Units,Scaled Min,Scaled Max,"
        'Raw Min,Raw Max,Encoding Name\n5,"a, b",1 [0],0.5,-1,Unsigned,inf,V,0,1,$0 ,3.00E+08,\n'
        "5,x,1 [0],,,,,,,,$10,$20,Label\n"
    )
    root = str(tmp_path)
    layouts = catalogs.load_layouts(spark, root).orderBy("ord").collect()
    assert [(r.family, r.model_year, r.message, r.ord, r.description, r.id) for r in layouts] == [
        ("DT", "2025", "A001", 0, "d", "5"), ("DT", "2025", "A001", 1, "e", None)]
    linear = catalogs.linear_tables(spark, root).orderBy("row_ord").collect()
    assert [(r.family, r.id, r.row_ord, r.factor, r.decimals, r.encoding_name) for r in linear] == [
        ("DT", 5, 0, 0.5, 0, None), ("DT", 5, 1, None, 0, "Label")]
    inventory = {tuple(r) for r in catalogs.artefact_inventory(spark, root).collect()}
    assert inventory == {("DT", "2025", "A001"), ("DT", "2025", "linear")}


def test_expected_lengths(spark):
    lengths = catalogs.length_catalog(spark)
    row = lengths.filter("family = 'DT' AND model_year = '2024' AND message = 'A001'").collect()
    assert [r.length for r in row] == [184]


def test_log_lines_have_file_order(spark, tmp_path):
    (tmp_path / "log.csv").write_text("h,a\n1,x\n\n2,y\n")
    rows = tel.log_lines(spark, str(tmp_path)).orderBy("file", "block", "position").collect()
    assert [r.line for r in rows] == ["h,a", "1,x", "", "2,y"]


def test_tables_are_replaced_with_their_columns(spark):
    tables.overwrite_table(spark.range(3).withColumn("old", F.lit(1)), "replaced")
    tables.overwrite_table(spark.range(2), "replaced")
    assert tel.scan(spark, "replaced").columns == ["id"]
    assert tel.scan(spark, "replaced", ["id"]).count() == 2
    spark.sql("DROP TABLE replaced")


def test_scratch_folder_is_below_the_named_one(spark, tmp_path):
    class Named:
        class conf:
            @staticmethod
            def get(name, default):
                return "/shared/checkpoints" if name == "spark.checkpoint.dir" else default

    assert tables.scratch_folder(Named).startswith("/shared/checkpoints/")
    assert tables.scratch_folder(Named) != tables.scratch_folder(Named)


def test_fill_and_chunks_across_a_clock_change(spark):
    """Instants decide the order: 01:59 EDT comes before 01:05 EST of the same night."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from byteloom.operators import timeline

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = 1730610000  # 2024-11-03 01:00 EDT
        rows = [(i, start + i * 131, float(i) if i % 4 == 0 else None) for i in range(60)]
        frame = spark.createDataFrame(rows, "i int, s bigint, a double").select(
            "i", F.timestamp_seconds("s").alias("app_timestamp"), "a", F.lit("v").alias("vin")
        )
        whole = Window.partitionBy("vin").orderBy("app_timestamp").rowsBetween(Window.unboundedPreceding, 0)
        want = {r.i: r.x for r in frame.withColumn("x", F.last("a", True).over(whole)).collect()}
        for unit in ("day", "hour", "minute", "second"):
            got = {r.i: r.a_reference for r in timeline.forward_fill(frame, ["a"], unit=unit).collect()}
            assert got == want, unit
            chunks = timeline.row_chunks(frame, 7, groups=["vin"], unit=unit)
            assert {r.i: r.chunk for r in chunks.collect()} == {i: i // 7 for i in range(60)}, unit
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_repeated_catalog_keys_are_refused(spark):
    import pytest

    from byteloom.operators.catalog import compile_catalog
    from byteloom.plans import fixtures as fx

    layouts = fx.layouts(spark)
    with pytest.raises(ValueError, match="more than once"):
        compile_catalog(layouts.union(layouts.limit(1)), fx.linear_table(spark), fx.enum_table(spark))


def test_bounds_of_many_digits(spark):
    from pyspark.sql import functions as F

    from byteloom.functions.convert import hex_bound

    texts = ["$FF", "00000000000000000001F", "7FFFFFFFFFFFFFFF", "$8000000000000000", "FFFFFFFFFFFFFFFFFFFF", "xyz", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", hex_bound(F.col("t")).alias("exact"), hex_bound(F.col("t"), upper=True).alias("upper")
    )
    top = 2**63 - 1
    assert [(r.exact, r.upper) for r in rows.collect()] == [
        (255, 255), (31, 31), (top, top), (None, top), (None, top), (None, None), (None, None)
    ]


def test_checks_without_message_columns(spark):
    from byteloom.operators import validate
    from byteloom.plans import fixtures as fx

    rows = spark.createDataFrame([("MA", "2025")], "family string, model_year string")
    assert validate.any_length_matches(rows, fx.lengths(spark), {"A": "absent"}).collect() == rows.collect()
    assert validate.with_length_columns(rows, fx.lengths(spark), {"A": "absent"}).columns[-1] == validate.ALL_VALID


def test_date_by_pattern(spark):
    from byteloom.operators.reshape import add_date

    rows = spark.createDataFrame([("11-03-2024",), ("2024-11-03",), (None,)], "app_timestamp string")
    got = [r.dt and str(r.dt) for r in add_date(rows, pattern="MM-dd-yyyy").collect()]
    assert got == ["2024-11-03", None, None]


def test_buckets_follow_the_data(spark):
    """One vehicle with all rows in one second is cut into many buckets; a small one stays whole."""
    from pyspark.sql import functions as F

    from byteloom.operators import timeline

    rows = spark.range(20_000).select(
        F.lit("2024-01-01 00:00:00").alias("app_timestamp"),
        F.when(F.col("id") < 50, 2).otherwise(1).alias("vin"),
        "id",
        F.when(F.col("id") % 1000 == 7, F.col("id")).alias("x"),
    )
    cut = timeline.with_buckets(rows, ["vin"], ["app_timestamp", "id"], None, 500)
    by_vin = {r.vin: r.n for r in cut.groupBy("vin").agg(F.count_distinct("_bucket").alias("n")).collect()}
    assert by_vin[2] == 1 and by_vin[1] >= 20
    sizes = [r["count"] for r in cut.filter("vin = 1").groupBy("_bucket").count().collect()]
    assert max(sizes) < 2500
    ends = cut.filter("vin = 1").groupBy("_bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("_bucket").collect()
    assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))
    filled = timeline.forward_fill(rows, ["x"], tiebreak=["id"], unit=None, rows_per_bucket=500)
    wrong = filled.filter((F.col("vin") == 1) & (F.col("id") >= 1007)).filter(
        F.col("x_reference") != F.floor((F.col("id") - 7) / 1000) * 1000 + 7
    )
    assert wrong.count() == 0


def test_stored_stage_prunes_days_and_joins_in_place(spark):
    import uuid

    from byteloom.operators import vehicles as veh
    from byteloom.sinks import tables
    from byteloom.sources import telemetry as tel

    name = uuid.uuid4().hex
    rows = spark.range(400).selectExpr("id AS vin", "concat('2024-01-0', 1 + id % 9) AS dt", "id * 2 AS x")
    tables.write_stage(rows, f"rows_{name}", buckets=4, order=["x"])
    tables.write_stage(spark.range(0, 400, 2).selectExpr("id AS vin", "'MA' AS family"), f"veh_{name}", buckets=4, day=None)
    window = tel.date_window(tel.scan(spark, f"rows_{name}"), "2024-01-03", "2024-01-05")
    joined = veh.join_stored(window, tel.scan(spark, f"veh_{name}"))
    assert sorted(r.vin for r in joined.collect()) == [i for i in range(0, 400, 2) if i % 9 in (2, 3)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_partitions_are_replaced_and_columns_added(spark):
    import uuid

    from byteloom.sinks import tables

    table = f"t_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1, "a", "2024"), (2, "b", "2024"), (3, "b", "2025")], "x int, family string, year string")
    tables.overwrite_partitions(rows, table, ["family", "year"])
    again = spark.createDataFrame([(9, "new", "b", "2024")], "x int, note string, family string, year string")
    tables.overwrite_partitions(again, table, ["family", "year"])
    got = sorted(tuple(r) for r in spark.table(table).select("x", "family", "year", "note").collect())
    assert got == [(1, "a", "2024", None), (3, "b", "2025", None), (9, "b", "2024", "new")]


def test_csv_cells(spark):
    from byteloom.sources.catalogs import csv_cells

    lines = ['a,b', '', ',', '"x, y",z', 'say ""hi"",2', '"he said ""hi""",,"",end', 'long ' * 5000 + ',"' + 'q""' * 20000 + '"']
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = [r[0] for r in rows.orderBy("i").select(csv_cells(rows.line)).collect()]
    assert got[:6] == [["a", "b"], [None], [None, None], ["x, y", "z"], ['say ""hi""', "2"], ['he said "hi"', None, "", "end"]]
    assert got[6] == ["long " * 5000, 'q"' * 20000]


def test_layouts_without_entries_are_told_apart(spark):
    from pyspark.sql import functions as F

    from byteloom.operators.catalog import compile_catalog
    from byteloom.operators.decode import envelope
    from byteloom.plans import fixtures as fx

    pair = "'MA' AS family, '2025' AS model_year"
    bare = spark.sql(
        f"SELECT {pair}, 'E' AS message, 'E_MA' AS layout_name, CAST(NULL AS INT) AS ord, CAST(NULL AS STRING) AS byte, "
        "NULL AS description, NULL AS size, NULL AS type, NULL AS name, NULL AS id"
    )
    catalog = compile_catalog(fx.layouts(spark).union(bare), fx.linear_table(spark), fx.enum_table(spark))
    messages = spark.sql(f"SELECT {pair}, m AS message, '62' AS hex FROM VALUES ('E'), ('Q') AS v(m)")
    told = {r.message: r.error for r in envelope(messages, catalog, "envelope").select(
        "message", F.get_json_object("envelope", "$.error").alias("error")).collect()}
    assert told["E"] != told["Q"] and "E" in told["E"]
    assert {r.envelope for r in envelope(messages, catalog, "null").collect()} == {None}

"""The stateless decode gives the same rows on a stream and on a batch."""

from byteloom.operators.decode import decode_long
from byteloom.plans import queries as plans
from byteloom.streaming.incremental import append_stream, decode_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    catalog = plans.field_catalog(spark, dedup="all")
    source = str(tmp_path / "in")
    plans.messages(spark, SF).write.parquet(source)
    batch = spark.read.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    out = str(tmp_path / "out")
    query = append_stream(decode_stream(stream, catalog), out, str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    expected, got = decode_long(batch, catalog), spark.read.parquet(out)
    assert got.count() == expected.count()
    assert got.select(*expected.columns).exceptAll(expected).isEmpty()


def _in_three_batches(spark, tmp_path):
    """Rows of many vehicles in three files; times overlap between files by less than the delay."""
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(
        "id",
        (F.col("id") % 7).alias("vin"),
        F.concat(F.lit("f"), F.col("id") % 2).alias("family"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 10 + F.pmod(F.xxhash64("id"), F.lit(240))).alias("app_timestamp"),
        F.when(F.col("id") % 5 == 1, F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 11 == 3, F.concat(F.lit("t"), "id")).alias("t"),
    )
    end = spark.sql(
        "SELECT -1L AS id, 99L AS vin, 'end' AS family, timestamp_seconds(1800000000) AS app_timestamp, "
        "CAST(NULL AS DOUBLE) AS x, CAST(NULL AS STRING) AS t"
    )
    path = str(tmp_path / "rows")
    for no in range(3):
        rows.filter((F.col("id") >= no * 1000) & (F.col("id") < (no + 1) * 1000)).coalesce(1).write.mode("append").parquet(path)
    late = rows.filter("id = 5").withColumn("id", F.lit(-5).cast("bigint"))
    end.coalesce(1).write.mode("append").parquet(path)
    late.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return rows, stream


def _run(stream, tmp_path, name):
    out = str(tmp_path / name)
    query = append_stream(stream, out, str(tmp_path / f"{name}-checkpoint"))
    assert query.awaitTermination(240)
    return stream.sparkSession.read.parquet(out)


def test_fill_on_a_stream_equals_the_batch(spark, tmp_path):
    from byteloom.operators.timeline import forward_fill
    from byteloom.streaming.stateful import fill_stream

    rows, stream = _in_three_batches(spark, tmp_path)
    got = _run(fill_stream(stream, ["x", "t"], tiebreak=["id"]), tmp_path, "filled")
    want = forward_fill(rows, ["x", "t"], tiebreak=["id"])
    # The row of the last file lies behind the watermark: it is late and left out.
    assert sorted(map(tuple, got.filter("vin < 99").collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_first_rows_of_a_stream_equal_the_batch(spark, tmp_path):
    from byteloom.operators.timeline import first_per_group
    from byteloom.streaming.stateful import first_of_stream

    rows, stream = _in_three_batches(spark, tmp_path)
    got = _run(first_of_stream(stream, 40, tiebreak=["id"]), tmp_path, "first").filter("family <> 'end'")
    want = first_per_group(rows, 40, tiebreak=["id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))

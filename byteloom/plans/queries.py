"""Queries over the driver's tables, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.fixed_values import DATE_FORMAT, ENUM_FILE, LAYOUT_FILE, LINEAR_FILE
from byteloom.functions.hexbits import bracket_part, position_part
from byteloom.functions.names import clean_name_column, message_columns
from byteloom.operators import catalog as cat
from byteloom.operators import decode as dec
from byteloom.operators import flatten, inspect, reshape, summary, timeline, validate
from byteloom.operators import vehicles as veh
from byteloom.plans import fixtures as fx
from byteloom.plans.batch import decode_batch
from byteloom.plans.session import tune
from byteloom.sinks import tables as sinks
from byteloom.sources import catalogs as src
from byteloom.sources import telemetry as tel

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

KEY = ("event_id", "model_name")
PAIR = ("family", "model_year")
COLUMNS = [dec.WideColumn(*row) for row in fx.COLUMN_ROWS]
COLUMN_NAMES = [c.name for c in COLUMNS]
TIEBREAK = ("event_id", "model_name")


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return make(tune(spark), sf)

    _QUERIES[make.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs -----------------------------------------------------------


def joined(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry with the family and model year of its vehicle."""
    return veh.join_vehicles(
        fx.telemetry(spark, sf), veh.vehicle_master(fx.vehicles(spark, sf))
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.unpivot_messages(joined(spark, sf), [*KEY, *PAIR], fx.HEX_COLUMNS)


@lru_cache(maxsize=16)
def field_catalog(spark: SparkSession, **options) -> cat.FieldCatalog:
    """Compiled once per session and kept: it is the same for every query."""
    return cat.compile_catalog(
        fx.layouts(spark), fx.linear_table(spark), fx.enum_table(spark), **options
    ).stored(f"{sinks.scratch_folder(spark)}/catalog")


def long_rows(spark: SparkSession, sf: str, **options) -> DataFrame:
    options.setdefault("dedup", "all")
    return dec.decode_long(messages(spark, sf), field_catalog(spark, **options))


def part(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet")


def second_of_day(time: Column) -> Column:
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def lower_names(df: DataFrame, old: list[str]) -> DataFrame:
    return df.select(*KEY, *[F.col(c).alias(c.lower()) for c in old])


# --- scans, projections, filters ---------------------------------------------


@query
def scan_projection(spark, sf):
    return veh.select_messages(
        fx.telemetry(spark, sf),
        ["event_id", "vin", "app_timestamp"],
        {"msg_a": "DIAG_BCM_A", "msg_b": "DIAG_BCM_B"},
    )


@query
def date_window(spark, sf):
    rows = tel.date_window(fx.telemetry(spark, sf), "2024-01-05", "2024-01-20")
    return rows.select("event_id", "vin", "dt")


@query
def date_from(spark, sf):
    rows = tel.date_window(fx.telemetry(spark, sf), "2024-01-25", "")
    return rows.select("event_id", "vin", "dt")


@query
def parse_time(spark, sf):
    parsed = reshape.add_date(tel.parse_time(fx.telemetry(spark, sf)), "day")
    return parsed.select(
        "event_id",
        second_of_day(F.col("app_timestamp")).alias("seconds"),
        F.col("day").cast("string").alias("day"),
    )


@query
def date_by_pattern(spark, sf):
    """A date from text in a given form; other text gives NULL."""
    text = F.when(F.col("event_id") % 4 == 0, F.col("app_timestamp")).otherwise(F.date_format(F.col("dt").cast("date"), "MM-dd-yyyy"))
    rows = fx.telemetry(spark, sf).select("event_id", text.alias("seen"))
    dated = reshape.add_date(rows, "day", "seen", DATE_FORMAT)
    return dated.select("event_id", F.col("day").cast("string").alias("day"))


@query
def discovered_messages(spark, sf):
    """The columns that are named after messages, found by their names and turned into rows."""
    rows = fx.telemetry(spark, sf).select(
        "event_id", F.col("msg_a").alias("DIAG_BCM_A001"), F.col("msg_b").alias("DIAG_BCM_B_2"),
        F.col("vin").alias("DIAG_only"), F.col("dt").alias("BCM_DIAG_x"),
    )
    return reshape.unpivot_messages(rows, ["event_id"], message_columns(rows.columns))


@query
def sample_row(spark, sf):
    """One row that satisfies a predicate, here that of the last event."""
    rows = fx.telemetry(spark, sf)
    last = rows.agg(F.max("event_id")).first()[0]
    return timeline.sample_row(rows, F.col("event_id") == last).select("event_id", "vin", "dt")


@query
def join_vehicle(spark, sf):
    return joined(spark, sf).select("event_id", "vin", *PAIR, "model_name")


@query
def any_message_present(spark, sf):
    return validate.any_message_present(fx.telemetry(spark, sf), fx.HEX_COLUMNS).select("event_id")


@query
def validity_flags(spark, sf):
    flagged = validate.with_validity(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    names = [f"{m}_{part}" for m in "AB" for part in ("actual_len", "reference_len", "is_valid")]
    return lower_names(flagged, names)


@query
def all_valid(spark, sf):
    flagged = validate.with_validity(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    return validate.all_messages_valid(flagged, ["A", "B"]).select(*KEY)


@query
def any_length_ok(spark, sf):
    return validate.any_length_matches(
        joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS
    ).select(*KEY)


@query
def length_columns(spark, sf):
    checked = validate.apply_length_filter(
        joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS, filter_invalid=False
    )
    names = ["valid_length_A", "has_valid_length_A", "valid_length_B", "has_valid_length_B"]
    return lower_names(checked.withColumn("all_valid", F.col(validate.ALL_VALID)),
                       [*names, "all_valid"])


@query
def valid_rows(spark, sf):
    return validate.apply_length_filter(
        joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS
    ).select(*KEY, "msg_a", "msg_b")


@query
def prepare_family(spark, sf):
    return validate.prepare_family(
        joined(spark, sf), "MA", "2025", fx.lengths(spark), fx.HEX_COLUMNS
    ).select(*KEY)


@query
def prepare_unknown(spark, sf):
    return validate.prepare_family(
        joined(spark, sf), "HO", "2025", fx.lengths(spark), fx.HEX_COLUMNS
    ).select(*KEY)


@query
def quality_marks(spark, sf):
    marked = validate.with_quality_marks(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    return marked.select(
        *KEY,
        F.col("goodDiagInput_A").alias("mark_a"),
        F.col("goodDiagInput_B").alias("mark_b"),
    )


@query
def filter_totals(spark, sf):
    checked = validate.with_length_columns(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    return validate.filter_totals(checked, F.col(validate.ALL_VALID))


@query
def length_stats(spark, sf):
    stats = validate.length_stats(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    return stats.withColumnsRenamed(
        {"valid_A_count": "valid_a_count", "valid_B_count": "valid_b_count"}
    )


@query
def family_filter(spark, sf):
    rows = reshape.of_families(joined(spark, sf), ["MA", "BU"])
    return rows.filter(F.col("model_year") == "2025").select(*KEY, "family")


@query
def not_null_message(spark, sf):
    return fx.telemetry(spark, sf).filter(F.col("msg_a").isNotNull()).select("event_id", "msg_a")


@query
def clean_names(spark, sf):
    name = F.concat("p_name", F.lit(" - "), "p_brand", F.lit("."), "p_type")
    return part(spark, sf).select("p_partkey", clean_name_column(name).alias("clean_name"))


@query
def cast_columns(spark, sf):
    text = fx.telemetry(spark, sf).select(
        "event_id",
        F.col("vin").cast("string").alias("vin"),
        F.col("voltage").cast("string").alias("voltage"),
        "event_type",
        "app_timestamp",
    )
    types = {"vin": "int", "voltage": "double", "event_type": "float", "app_timestamp": "timestamp",
             "not_there": "int"}
    cast = reshape.cast_columns(text, types)
    seconds = second_of_day(F.col("app_timestamp"))
    return cast.withColumn("seconds", seconds).drop("app_timestamp")


@query
def run_columns(spark, sf):
    return summary.with_run_columns(fx.telemetry(spark, sf)).select(
        "event_id", "pipeline_version", "config_version"
    )


@query
def positions(spark, sf):
    text = F.when(F.col("p_partkey") % 10 == 0, F.col("p_size").cast("string")).otherwise(
        F.concat("p_size", F.lit(" ["), F.col("p_partkey") % 8, F.lit("]"))
    )
    return part(spark, sf).select(
        "p_partkey",
        position_part(text, "0 [0]").alias("byte_pos"),
        bracket_part(text, "0 [0]").alias("bit_pos"),
    )


# --- counts and key sets -----------------------------------------------------


@query
def family_counts(spark, sf):
    return summary.counts_by_pair(joined(spark, sf))


@query
def families(spark, sf):
    return summary.families(joined(spark, sf))


@query
def sample_counts(spark, sf):
    sample = timeline.first_per_group(joined(spark, sf), 50, tiebreak=TIEBREAK, required="msg_a")
    return summary.counts_by_family(sample)


@query
def keys_in_both(spark, sf):
    return reshape.keys_in_both(joined(spark, sf), fx.layouts(spark), PAIR)


@query
def missing_artefacts(spark, sf):
    inventory = (
        fx.layouts(spark)
        .select(*PAIR, F.col("message").alias("artefact"))
        .union(fx.linear_table(spark).select(*PAIR, F.lit("linear")))
        .union(fx.enum_table(spark).select(*PAIR, F.lit("enum")))
    )
    found = cat.missing_artefacts(joined(spark, sf), inventory, ["linear", "enum", "A"])
    return found.withColumn("missing", F.array_join("missing", ","))


@query
def artefact_inventory(spark, sf):
    """Definition files of a tree that also holds kept copies and files of another year's folder."""
    root = sinks.scratch_folder(spark)
    k = F.col("p_partkey")
    year = (k % 3 + 2024).cast("string")
    folder = F.when(k % 5 == 0, F.concat(year, F.lit("-hold"))).when(k % 7 == 0, F.lit("2030")).otherwise(year)
    names = [LINEAR_FILE, ENUM_FILE, LAYOUT_FILE.replace("{message}", "A001"), LAYOUT_FILE.replace("{message}", "B001")]
    family = F.substring("p_type", 1, 2)
    file = F.lit(None).cast("string")
    for no, name in enumerate(names):
        named = F.format_string(name.format(ecu="BCM", family="%1$s", year="%2$s"), family, year)
        file = F.when((k / 11).cast("int") % 4 == no, named).otherwise(file)
    # As many rows as there are definition files, not parts.
    paths = part(spark, sf).select(F.concat_ws("/", family, folder, file).alias("path")).distinct().collect()
    sinks.touch_files(spark, [f"{root}/{row.path}" for row in paths])
    return src.artefact_inventory(spark, root)


# --- time --------------------------------------------------------------------


@query
def forward_fill(spark, sf):
    filled = timeline.forward_fill(
        fx.telemetry(spark, sf), ["voltage", "key_on"], tiebreak=["event_id"]
    )
    return filled.select(
        "event_id", "vin", "voltage", "key_on", "voltage_reference", "key_on_reference"
    )


@query
def forward_fill_minute(spark, sf):
    """The same by instants and minutes."""
    rows = tel.parse_time(fx.telemetry(spark, sf))
    filled = timeline.forward_fill(rows, ["voltage", "key_on"], tiebreak=["event_id"], unit="minute")
    return filled.select(
        "event_id", "vin", "voltage", "key_on", "voltage_reference", "key_on_reference"
    )


@query
def forward_fill_by_data(spark, sf):
    """The same with buckets sized by the data, whatever the spread over time."""
    filled = timeline.forward_fill(
        fx.telemetry(spark, sf), ["voltage", "key_on"], tiebreak=["event_id"], unit=None, rows_per_bucket=200
    )
    return filled.select("event_id", "vin", "voltage", "key_on", "voltage_reference", "key_on_reference")


@query
def row_chunks_by_data(spark, sf):
    chunked = timeline.row_chunks(joined(spark, sf), 100, tiebreak=TIEBREAK, unit=None, rows_per_bucket=200)
    return chunked.select(*KEY, *PAIR, "chunk")


@query
def first_n_large(spark, sf):
    """More rows of a group than a task keeps before the shuffle."""
    return timeline.first_per_group(joined(spark, sf), 1500, tiebreak=TIEBREAK).select(*KEY, "family")


@query
def first_n_per_family(spark, sf):
    return timeline.first_per_group(
        joined(spark, sf), 50, tiebreak=TIEBREAK, required="msg_a", members=["AU", "MA", "FU"]
    ).select(*KEY, "family")


@query
def union_of_samples(spark, sf):
    return timeline.first_per_group(
        joined(spark, sf), 100, tiebreak=TIEBREAK, members=["AU", "MA"]
    ).select(*KEY, "family")


@query
def row_chunks(spark, sf):
    chunked = timeline.row_chunks(joined(spark, sf), 100, tiebreak=TIEBREAK)
    return chunked.select(*KEY, *PAIR, "chunk")


@query
def sort_by_time(spark, sf):
    rows = fx.telemetry(spark, sf).select("event_id", "app_timestamp")
    return timeline.sort_by_time(rows, tiebreak=["event_id"])


@query
def first_rows(spark, sf):
    rows = fx.telemetry(spark, sf).select("event_id", "app_timestamp")
    return timeline.first_rows(rows, 50, ["app_timestamp", "event_id"])


def _log_lines(spark, sf) -> DataFrame:
    e = F.col("event_id")
    stamp = (e + 1700000000000).cast("string")
    a, b = F.coalesce("msg_a", F.lit("")), F.coalesce("msg_b", F.lit(""))
    comma = F.lit(",")
    line = (
        F.when(e % 9 == 0, stamp)
        .when(e % 9 == 1, F.concat(comma, a, comma, b))
        .when(e % 9 == 2, F.concat(stamp, comma, F.coalesce("msg_a", F.lit("null"))))
        .otherwise(F.concat(stamp, comma, a, comma, b))
    )
    return fx.telemetry(spark, sf).select(
        F.col("event_type").alias("file"), e.alias("position"), line.alias("line")
    )


@query
def zip_log_lines(spark, sf):
    bucket = F.floor(F.col("position") / 1000).cast("bigint")
    return reshape.zip_log_lines(
        _log_lines(spark, sf), ["msg_a", "msg_b"], "file", "position", bucket
    )


@query
def zip_log_files(spark, sf):
    """The same from text files: lines in the order (block, position) of their file."""
    path = f"{sinks.scratch_folder(spark)}/logs"
    cut = F.floor(F.col("position") / 5000)
    lines = _log_lines(spark, sf).withColumn("_cut", cut).repartition("file", "_cut")
    lines.sortWithinPartitions("file", "_cut", "position").drop("position").write.partitionBy("file", "_cut").text(path)
    read = tel.log_lines(spark, path).withColumns(
        {
            "_cut": F.regexp_extract("file", "_cut=([^/]+)/", 1).cast("bigint"),
            "file": F.regexp_extract("file", "file=([^/]+)/", 1),
        }
    )
    return reshape.zip_log_lines(read, ["msg_a", "msg_b"], "file", ["_cut", "block", "position"], F.col("_cut"))


# --- decode --------------------------------------------------------------------


@query
def unpivot_messages(spark, sf):
    return messages(spark, sf)


@query
def decode_long(spark, sf):
    return long_rows(spark, sf).select(
        *KEY, *PAIR, "message", "ord", "description", "value", "error", "raw"
    )


@query
def decode_records(spark, sf):
    decoded = dec.decode_array(messages(spark, sf), field_catalog(spark))
    # The outer form: for the plain one the optimizer adds a filter on the
    # size of the array and so computes the array twice.
    records = decoded.select(*KEY, "message", F.explode_outer("decoded").alias("r")).filter(
        F.col("r").isNotNull()
    )
    names = ["ord", "description", "decoded_value", "raw_position", "size", "msg_type", "msg_id",
             "raw_value", "units"]
    return records.select(*KEY, "message", *[F.col(f"r.{n}").alias(n) for n in names])


@query
def decode_first_wins(spark, sf):
    return long_rows(spark, sf, dedup="first").select(*KEY, "message", "description", "value")


def _by_shape(spark, sf, condition: Column) -> DataFrame:
    shape = {
        "_n": position_part(F.col("size"), "1 [0]"),
        "_k": bracket_part(F.col("size"), "1 [0]"),
    }
    layouts = fx.layouts(spark).withColumns(shape).filter(condition).drop("_n", "_k")
    catalog = cat.compile_catalog(
        layouts, fx.linear_table(spark), fx.enum_table(spark), dedup="all"
    ).stored(f"{sinks.scratch_folder(spark)}/catalog")
    long = dec.decode_long(messages(spark, sf), catalog)
    return long.select(*KEY, "message", "ord", "raw", "error")


@query
def decode_bits(spark, sf):
    return _by_shape(spark, sf, (F.col("_n") == 0) & (F.col("_k") > 0))


@query
def decode_whole(spark, sf):
    return _by_shape(spark, sf, (F.col("_n") > 0) & (F.col("_k") == 0))


@query
def decode_mixed(spark, sf):
    return _by_shape(spark, sf, (F.col("_n") > 0) == (F.col("_k") > 0))


@lru_cache(maxsize=4)
def long_catalog(spark: SparkSession) -> cat.FieldCatalog:
    return cat.compile_catalog(
        fx.layouts(spark, fx.FIELD_ROWS_C),
        fx.linear_table(spark, fx.LINEAR_ROWS_C),
        fx.enum_table(spark, fx.ENUM_ROWS_C),
    ).stored(f"{sinks.scratch_folder(spark)}/catalog")


@query
def decode_long_fields(spark, sf):
    """Fields of 8, 9 and 16 bytes with the digits of their raw values."""
    long = dec.decode_long(fx.long_messages(joined(spark, sf)), long_catalog(spark))
    digits = F.coalesce(F.col("raw").cast("string"), F.col("raw_big"))
    return long.select(*KEY, "ord", "description", digits.alias("raw"), "value", "error", "num")


@query
def decode_long_fields_forms(spark, sf):
    """The same fields from the array form and from the wide form, as text."""
    rows, catalog = fx.long_messages(joined(spark, sf)), long_catalog(spark)
    arrays = dec.decode_array(rows, catalog).select(*KEY, F.explode_outer("decoded").alias("r"))
    records = arrays.filter(F.col("r").isNotNull()).select(
        F.lit("array").alias("form"), *KEY, F.col("r.description").alias("description"), F.col("r.decoded_value").alias("value")
    )
    names = {entry[2]: f"c{i}" for i, entry in enumerate(fx.LAYOUT_C)}
    columns = [dec.WideColumn("C", description, "string", name) for description, name in names.items()]
    wide = dec.decode_wide(rows.withColumnRenamed("hex", "msg_c"), catalog, columns, {"C": "msg_c"})
    text = wide.withColumnsRenamed({name: d for d, name in names.items()}).unpivot(
        list(KEY), list(names), "description", "value"
    )
    filled = text.filter(F.col("value").isNotNull())
    return records.union(filled.select(F.lit("wide"), *KEY, "description", "value"))


def _of_type(long: DataFrame, kind: str) -> DataFrame:
    return long.filter((F.col("msg_type") == kind) & F.col("error").isNull()).select(
        *KEY, "message", "ord", "raw", "value"
    )


@query
def linear_values(spark, sf):
    return _of_type(long_rows(spark, sf), "L")


@query
def linear_values_many_ranges(spark, sf):
    """A label range of one id for every part, most of them overlapping."""
    pair = [F.lit("MA").alias("family"), F.lit("2025").alias("model_year")]
    low = F.col("p_partkey") * 7 % 65536
    ranges = part(spark, sf).select(
        *pair, F.lit(300).cast("bigint").alias("id"), F.col("p_partkey").cast("bigint").alias("row_ord"),
        F.lit(0.1).alias("factor"), F.lit(0.0).alias("offset"), F.lit(1).alias("decimals"), F.lit(None).cast("string").alias("units"),
        F.format_string("$%04X", low).alias("raw_min"), F.format_string("$%04X", low + F.col("p_size")).alias("raw_max"),
        F.col("p_name").alias("encoding_name"),
    )
    entry = ("MA", "2025", "A", "Ranges", 0, "4 [0]", "Ranged", "2 [0]", "L", "ranged", "300")
    catalog = cat.compile_catalog(
        fx.layouts(spark, [entry]), ranges, fx.enum_table(spark, fx.ENUM_ROWS_C)
    ).stored(f"{sinks.scratch_folder(spark)}/catalog")
    return _of_type(dec.decode_long(messages(spark, sf), catalog), "L")


@query
def enum_values(spark, sf):
    return _of_type(long_rows(spark, sf), "T")


@query
def enum_strict(spark, sf):
    long = long_rows(spark, sf, hex_mode="strict", require_tables=True)
    return _of_type(long, "T")


@query
def field_errors(spark, sf):
    long = long_rows(spark, sf).filter(F.col("error").isNotNull())
    return long.groupBy("message", "description", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def decode_null_mode(spark, sf):
    text = dec.envelope(messages(spark, sf), field_catalog(spark), "null")
    return text.select(
        *KEY,
        "message",
        F.col("envelope").isNotNull().alias("decoded"),
        F.get_json_object("envelope", "$.name").alias("name"),
    )


@query
def decode_envelope_mode(spark, sf):
    text = dec.envelope(messages(spark, sf), field_catalog(spark), "envelope")
    return text.select(
        *KEY, *PAIR, "message", F.get_json_object("envelope", "$.error").alias("error")
    )


@query
def decode_tables_required(spark, sf):
    catalog = field_catalog(spark, require_tables=True)
    decoded = dec.decode_array(messages(spark, sf), catalog)
    return decoded.select(*KEY, "message", F.col("decoded").isNotNull().alias("decoded"))


# --- flatten -------------------------------------------------------------------


@query
def flatten_wide(spark, sf):
    wide = dec.decode_wide(joined(spark, sf), field_catalog(spark), COLUMNS, fx.HEX_COLUMNS)
    return wide.select(*KEY, *PAIR, *COLUMN_NAMES)


@query
def flatten_wide_array(spark, sf):
    """The wide form of a catalog too large for expressions: the same values."""
    wide = dec.decode_wide(joined(spark, sf), field_catalog(spark), COLUMNS, fx.HEX_COLUMNS, limit=0)
    return wide.select(*KEY, *PAIR, *COLUMN_NAMES)


@query
def decode_when_valid(spark, sf):
    """A message is decoded where its own length is right; rows stay."""
    flagged = validate.with_validity(joined(spark, sf), fx.lengths(spark), fx.HEX_COLUMNS)
    flags = {m: f"{m}_is_valid" for m in fx.HEX_COLUMNS}
    wide = dec.decode_wide(flagged, field_catalog(spark), COLUMNS, fx.HEX_COLUMNS, when=flags)
    return wide.select(*KEY, *COLUMN_NAMES)


@query
def flatten_pivot(spark, sf):
    names = fx.output_columns(spark).select("message", "description", "clean_name")
    wanted = F.broadcast(names)
    long = long_rows(spark, sf, dedup="last").join(wanted, ["message", "description"], "left")
    pivoted = flatten.pivot_long(long, [*KEY, *PAIR], COLUMN_NAMES, "clean_name")
    return pivoted.select(
        *KEY, *PAIR, *[dec.cast_text(F.col(c.name), c.type).alias(c.name) for c in COLUMNS]
    )


def _with_text(spark, sf, shape: str, **options) -> DataFrame:
    rows = joined(spark, sf)
    catalog = field_catalog(spark, **options)
    for message, column in fx.HEX_COLUMNS.items():
        view = rows.withColumns({"message": F.lit(message), "hex": F.col(column)})
        text = dec.envelope(view, catalog, "null", shape)
        rows = text.withColumnRenamed("envelope", f"json_{message}").drop("message", "hex")
    return rows


@query
def flatten_json_map(spark, sf):
    rows = _with_text(spark, sf, "map")
    for m in fx.HEX_COLUMNS:
        parsed = rows.withColumn(f"map_{m}", flatten.parse_map(F.col(f"json_{m}")))
        rows = flatten.columns_from_map(parsed, f"map_{m}", [c for c in COLUMNS if c.message == m])
    return rows.select(*KEY, *PAIR, *COLUMN_NAMES)


@query
def flatten_json_list(spark, sf):
    rows = _with_text(spark, sf, "list", dedup="all")
    for m in fx.HEX_COLUMNS:
        parsed = rows.withColumn(f"list_{m}", flatten.parse_list(F.col(f"json_{m}")))
        rows = flatten.columns_from_list(
            parsed, f"list_{m}", [c for c in COLUMNS if c.message == m]
        )
    return rows.select(*KEY, *PAIR, *COLUMN_NAMES)


@query
def flatten_by_position(spark, sf):
    rows = _with_text(spark, sf, "list", dedup="all")
    picked = [(3, COLUMNS[1]), (15, COLUMNS[5])]
    return flatten.columns_by_position(rows, "json_A", picked).select(*KEY, *PAIR, "level", "state")


@query
def props_json(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    parsed = events.withColumn("m", F.from_json("props", "map<string, string>"))
    return parsed.select(
        "event_id",
        F.try_element_at("m", F.lit("k")).try_cast("int").alias("k"),
        F.to_json("m").alias("again"),
    )


@query
def flatten_by_position_all(spark, sf):
    """Every output column of both messages, by the position that the layouts give it."""
    rows = _with_text(spark, sf, "list", dedup="all")
    at = {(r.message, r.description): r.position for r in flatten.field_positions(field_catalog(spark, dedup="all")).filter(
        "family = 'MA' AND model_year = '2025'").collect()}
    for m in fx.HEX_COLUMNS:
        known = [(at[m, c.description], c) for c in COLUMNS if c.message == m and (m, c.description) in at]
        rows = flatten.columns_by_position(rows, f"json_{m}", known)
    return rows.select(*KEY, *PAIR, *[c for c in COLUMN_NAMES if c != "absent"])


@query
def flatten_messages(spark, sf):
    """A column for every described field of the layouts."""
    flat = flatten.flatten_messages(joined(spark, sf), field_catalog(spark), fx.HEX_COLUMNS, fx.FLAT_TYPES)
    return flat.select(*KEY, *[F.col(name) for _, _, _, name in fx.FLAT_COLUMNS])


@query
def described_fields(spark, sf):
    """Descriptions and positions of the layouts whose family and year occur in the data."""
    fields = flatten.field_positions(field_catalog(spark, dedup="all"))
    return fields.join(reshape.keys_in_both(joined(spark, sf), fx.layouts(spark), PAIR), list(PAIR)).drop("units")


@query
def envelope_bodies(spark, sf):
    """Every record of the JSON texts, read back, with what stands around the records."""
    record = ", ".join(f"{name}: {'bigint' if name == 'raw_value' else 'string'}" for name in dec.RECORD)
    outer = "code string, name string, vehicle_family string, model_year string, ddt_type string"
    text = dec.envelope(messages(spark, sf), field_catalog(spark, dedup="all"), "null", "list")
    parsed = text.select(*KEY, F.from_json("envelope", f"{outer}, decoded_values array<struct<{record}>>").alias("e"))
    opened = parsed.select(*KEY, "e", F.posexplode("e.decoded_values").alias("ord", "r"))
    names = ("code", "name", "vehicle_family", "model_year", "ddt_type")
    return opened.select(
        *KEY, "ord", *[F.col(f"e.{n}").alias(n) for n in names],
        *[F.col(f"r.{n}").alias(n) for n in dec.RECORD if n != "raw_big"],
    )


@query
def envelope_reasons(spark, sf):
    """All reasons why a message has no values: empty, not mapped, no layout, a layout without entries."""
    every = messages(spark, sf)
    third = every.filter("message = 'A'").withColumn("message", F.lit("E"))
    fourth = every.filter("message = 'B'").withColumn("message", F.lit("U"))
    bare = fx.layouts(spark, [(*pair, "E", "Empty", *[None] * 7) for pair in fx.PAIRS])
    catalog = cat.compile_catalog(
        fx.layouts(spark).union(bare), fx.linear_table(spark), fx.enum_table(spark)
    ).stored(f"{sinks.scratch_folder(spark)}/catalog")
    known = every.union(third).select(*PAIR, "message").distinct()
    text = dec.envelope(every.union(third).union(fourth), catalog, "envelope", mapped=known)
    return text.select(*KEY, "message", F.get_json_object("envelope", "$.error").alias("error"))


# --- unions --------------------------------------------------------------------


@query
def union_by_name(spark, sf):
    rows = fx.telemetry(spark, sf)
    return reshape.union_all_by_name(
        [rows.select("event_id", c) for c in ("msg_a", "msg_b", "voltage")]
    )


@query
def union_by_position(spark, sf):
    rows = fx.telemetry(spark, sf)
    return reshape.union_all_by_position(
        [rows.select("event_id", F.col("msg_a").alias("hex")), rows.select("event_id", "msg_b")]
    )


@query
def union_bag(spark, sf):
    rows = fx.telemetry(spark, sf).select("event_id", "vin")
    return reshape.union_all_by_name([rows, rows])


# --- summaries and inspection --------------------------------------------------


def _decoded_table(spark, sf) -> DataFrame:
    texts = dec.wide_envelopes(joined(spark, sf), field_catalog(spark), fx.HEX_COLUMNS, "envelope")
    return texts.select("vin", *PAIR, "event_id", "decoded_A", "decoded_B").withColumnRenamed(
        "event_id", "row_key"
    )


@query
def error_counts(spark, sf):
    return summary.error_counts(_decoded_table(spark, sf).drop("row_key"))


@query
def decoding_summary(spark, sf):
    table = _decoded_table(spark, sf).withColumn("other", F.lit(1)).drop("vin")
    return summary.decoding_summary(table)


@query
def quality_report(spark, sf):
    return summary.quality_report(_decoded_table(spark, sf))


@query
def inspect_fields(spark, sf):
    view = inspect.inspect_fields(long_rows(spark, sf))
    return view.select(
        *KEY, "message", "ord", "description", "value", "raw_position", "size", "msg_type", "msg_id",
        "raw_value", "raw_hex", "binary",
    )


@query
def inspect_bytes(spark, sf):
    view = inspect.inspect_bytes(messages(spark, sf), field_catalog(spark, dedup="all"))
    return view.select(
        *KEY,
        "message",
        "byte_index",
        "raw_hex",
        "binary",
        F.array_join("decoded_values", "|").alias("decoded_values"),
        F.array_join("descriptions", "|").alias("descriptions"),
    )


@query
def batch_decode(spark, sf):
    decoded = decode_batch(
        fx.telemetry(spark, sf),
        veh.vehicle_master(fx.vehicles(spark, sf)),
        fx.lengths(spark),
        field_catalog(spark),
        COLUMNS,
        fx.HEX_COLUMNS,
        fill=["voltage"],
        tiebreak=["event_id"],
    )
    return decoded.select(
        *KEY, *PAIR, "voltage_reference", "charge", "level", "state", "counter"
    )


# --- sinks: written and read back ----------------------------------------------


@query
def sink_overwrite(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/table"
    rows = fx.telemetry(spark, sf).select("event_id", "vin", "msg_a")
    sinks.write_path(rows.select("event_id"), path, "true")
    sinks.write_path(rows, path, "true")
    return tel.scan(spark, path)


@query
def sink_append_merge(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/table"
    rows = fx.telemetry(spark, sf)
    sinks.write_path(rows.select("event_id", "vin", "msg_a"), path, True)
    sinks.write_path(rows.select("event_id", "vin", "msg_b"), path, "false")
    return sinks.read_merged(spark, path)


@query
def sink_with_summary(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/table"
    sinks.save_with_summary(joined(spark, sf).select("vin", *PAIR, "event_id"), path)
    return spark.read.parquet(f"{path}_summary")


@query
def sink_decoded_with_summary(spark, sf):
    """Errors are counted while the decoded texts are written."""
    path = f"{sinks.scratch_folder(spark)}/table"
    sinks.save_with_summary(_decoded_table(spark, sf).withColumn("other", F.lit(1)).drop("vin"), path)
    return spark.read.parquet(f"{path}_summary")


@query
def sink_rows_with_metadata(spark, sf):
    """The written rows themselves, with their run columns."""
    path = f"{sinks.scratch_folder(spark)}/table"
    sinks.save_with_summary(joined(spark, sf).select("vin", *PAIR, *KEY), path, "c7")
    stamped = F.col("processing_timestamp").isNotNull().alias("stamped")
    return spark.read.parquet(path).select("vin", *PAIR, *KEY, "pipeline_version", "config_version", stamped)


@query
def report_body(spark, sf):
    return summary.report_body(summary.decoding_summary(_decoded_table(spark, sf)))


@query
def report_body_without_errors(spark, sf):
    return summary.report_body(summary.decoding_summary(joined(spark, sf).select(*PAIR, "event_id")))


@query
def table_overwrite_partition(spark, sf):
    """The partitions of one family and year are replaced, with a new column; the others stay."""
    table = f"byteloom_{uuid.uuid4().hex}"
    rows = joined(spark, sf).select(*KEY, "msg_a", *PAIR)
    sinks.overwrite_partitions(rows, table, PAIR)
    again = rows.filter("family = 'MA' AND model_year = '2025'").withColumn("run", F.lit("second"))
    sinks.overwrite_partitions(again.drop("msg_a"), table, PAIR)
    return tel.scan(spark, table, [*KEY, *PAIR, "msg_a", "run"])


@query
def stage_by_day(spark, sf):
    """A stage stored by day and vehicle: the window reads its days, the join needs no shuffle."""
    name = uuid.uuid4().hex
    sinks.write_stage(
        fx.telemetry(spark, sf).select("event_id", "vin", "app_timestamp", "dt", "msg_a"),
        f"byteloom_rows_{name}", buckets=8, order=["app_timestamp"],
    )
    sinks.write_stage(veh.vehicle_master(fx.vehicles(spark, sf)), f"byteloom_vehicles_{name}", buckets=8, day=None)
    window = tel.date_window(tel.scan(spark, f"byteloom_rows_{name}"), "2024-01-05", "2024-01-20")
    return veh.join_stored(window, tel.scan(spark, f"byteloom_vehicles_{name}")).select(*KEY, "dt", "family", "msg_a")


@query
def report_lines(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/report"
    sinks.write_report(
        summary.decoding_summary(joined(spark, sf).select(*PAIR, "event_id")), path
    )
    return spark.read.text(path)


@query
def stage_table(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/stage"
    sinks.write_path(joined(spark, sf), path, True)
    return tel.scan(spark, path, [*KEY, "family", "msg_a"])


# --- sources: files derived from the tables, read back --------------------------


def _write_csv(rows: DataFrame, path: str) -> None:
    """Bounded files: rows of a file in key order, 500 keys a file."""
    (
        rows.withColumn("_cut", F.floor(F.col("p_partkey") / 500))
        .repartition("_file", "_cut")
        .sortWithinPartitions("_file", "_cut", "p_partkey")
        .drop("p_partkey")
        .write.partitionBy("_file", "_cut")
        .option("header", True)
        .csv(path)
    )


def _pair_file(template: str) -> Column:
    family = F.substring("p_type", 1, 2)
    year = (F.col("p_partkey") % 3 + 2024).cast("string")
    pattern = template.format(ecu="BCM", family="%s", year="%s")
    return F.format_string(pattern, family, year)


@query
def linear_csv(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/csv"
    k = F.col("p_partkey")
    rows = part(spark, sf).select(
        "p_partkey",
        F.concat(F.lit(" "), "p_size").alias("ID"),
        F.col("p_retailprice").alias("Factor (m)"),
        F.when(k % 4 != 0, -1.5).alias("Offset (b)"),
        F.when(k % 5 == 0, F.lit("inf")).when(k % 5 > 1, F.lit("3.0")).alias("Decimal Places"),
        F.col("p_brand").alias("Units"),
        F.lit("$00").alias("Raw Min"),
        F.concat(F.lit("$"), F.lpad(F.hex(k % 65536), 4, "0")).alias("Raw Max"),
        F.when(k % 7 == 0, F.col("p_name")).alias("Encoding Name"),
        _pair_file(LINEAR_FILE).alias("_file"),
    )
    _write_csv(rows, path)
    rows = src.linear_tables(spark, path, glob="*.csv", tree=False)
    return rows.drop("description", "size", "value_type", "scaled_min", "scaled_max")


@query
def enum_csv(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/csv"
    k = F.col("p_partkey")
    rows = part(spark, sf).select(
        "p_partkey",
        F.col("p_size").alias("ID"),
        F.concat(F.lit("$"), F.hex(k % 300)).alias("Min"),
        F.col("p_name").alias("Encoding Name"),
        _pair_file(ENUM_FILE).alias("_file"),
    )
    _write_csv(rows, path)
    return src.enum_tables(spark, path, glob="*.csv", tree=False)


@query
def layout_from_csv(spark, sf):
    """Layout rows to documents, written as JSON and read back as entries."""
    k = F.col("p_partkey")
    folder = sinks.scratch_folder(spark)
    rows = part(spark, sf).select(
        F.concat("p_brand", F.lit("-"), F.floor(k / 500)).alias("file"),
        k.alias("ord"),
        F.concat("p_size", F.lit(" ["), k % 8, F.lit("]")).alias("byte"),
        F.col("p_name").alias("description"),
        F.lit("1 [0]").alias("size"),
        F.lit("L").alias("type"),
        F.col("p_type").alias("name"),
        k.cast("string").alias("id"),
        F.when(k % 3 == 0, F.concat(F.lit("d"), "p_size")).otherwise("").alias("default_value"),
    )
    documents = src.entries_document(rows, ["file"], "file")
    sinks.write_layouts(documents, f"{folder}/documents")
    read = (
        spark.read.schema(src.LAYOUT_SCHEMA)
        .json(f"{folder}/documents")
        .withColumn("message", F.substring("name", 7, 10))
        .select("message", "entries")
    )
    return src.explode_entries(read)


@query
def layout_legacy_csv(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/csv"
    k = F.col("p_partkey")
    rows = part(spark, sf).select(
        "p_partkey",
        F.concat("p_size", F.lit(" [0]")).alias("ByteBit"),
        F.col("p_name").alias("ByteBit_Description"),
        F.lit("1 [0]").alias("Size"),
        F.col("p_type").alias("Type"),
        k.cast("string").alias("Name"),
        (k % 4).alias("_file"),
    )
    _write_csv(rows, path)
    read = src.layout_csv(spark, path)
    return read.select(
        (F.col("id").cast("bigint") % 4).alias("part_no"),
        "ord", "byte", "description", "size", "type", "name", "id",
    )


@query
def layout_mixed_csv(spark, sf):
    """One folder of current, default-valued and legacy files, each read by its own header."""
    path = f"{sinks.scratch_folder(spark)}/csv"
    k = F.col("p_partkey")
    base = part(spark, sf).select(
        "p_partkey",
        F.concat("p_size", F.lit(" [0]")).alias("ByteBit"),
        F.col("p_name").alias("ByteBit_Description"),
        F.lit("1 [0]").alias("Size"),
        F.lit("L").alias("Type"),
        F.col("p_type").alias("Name"),
        k.cast("string").alias("ID"),
        F.when(k % 6 == 1, F.concat(F.lit("d"), k)).alias("Default_Value"),
        (k % 3).alias("_file"),
    )
    _write_csv(base.filter(k % 3 == 0).drop("Default_Value"), f"{path}/current")
    # Seventy more columns in front: files are read by their own header, whatever its length.
    padded = [F.lit(f"pad, {i}").alias(f"Pad {i}") for i in range(70)]
    _write_csv(base.filter(k % 3 == 1).select(*padded, "*"), f"{path}/valued")
    legacy = base.filter(k % 3 == 2).drop("Default_Value", "Type")
    _write_csv(legacy.withColumnsRenamed({"Name": "Type", "ID": "Name"}), f"{path}/legacy")
    return src.layout_csv(spark, path).drop("file", "ord")


@query
def layout_tree(spark, sf):
    """Layout documents of a tree that also holds a kept copy and a file of another year."""
    root = sinks.scratch_folder(spark)
    k = F.col("p_partkey")
    entry = F.struct(
        F.lit("0 [0]").alias("byte"), F.col("p_name").alias("description"), F.lit("1 [0]").alias("size"),
        F.lit("L").alias("type"), F.col("p_type").alias("name"), k.cast("string").alias("id"),
    )
    rows = part(spark, sf).groupBy((k % 5).alias("no")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(k, entry.alias("entry")))), lambda e: e["entry"]).alias("entries")
    )
    documents = rows.select(F.to_json(F.struct(F.lit("n").alias("name"), "entries")).alias("value"), "no")
    for no, folder, name in (
        (0, "MA/2025", "DDT_BCM_A001_MA_2025.json"),
        (1, "MA/2025", "DDT_BCM_B001_MA_2025.json"),
        (2, "MA/2025-hold", "DDT_BCM_A001_MA_2025.json"),
        (3, "MA/2026", "DDT_BCM_A001_MA_2025.json"),
        (4, "FU/2026", "DDT_BCM_A001_FU_2026.json"),
    ):
        sinks.write_text_file(documents.filter(F.col("no") == no).select("value"), f"{root}/{folder}/{name}")
    return src.load_layouts(spark, root).select(
        "family", "model_year", "message", "layout_name", "ord", "description", "name", "id"
    )


@query
def config_documents(spark, sf):
    """Configuration documents, one per part, read as relational metadata."""
    path = f"{sinks.scratch_folder(spark)}/config"
    k = F.col("p_partkey")
    column = F.struct(
        F.lit("float").alias("type"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("clean_name")
    )
    version = F.create_map(
        F.substring("p_type", 1, 2),
        F.create_map((k % 3 + 2024).cast("string"), F.struct(F.col("p_size").alias("length"))),
    )
    message = F.struct(
        F.concat(F.lit("c"), k).alias("column_name"),
        F.lit("BCM").alias("ecu"),
        F.create_map("p_name", column).alias("columns"),
        version.alias("versions"),
    )
    document = F.struct(F.create_map(F.concat(F.lit("M"), k), message).alias("diagnostic_messages"))
    part(spark, sf).select(F.to_json(document).alias("value")).write.text(path)
    config = src.load_config(spark, path, wholetext=False)
    return src.config_columns(config).join(src.config_lengths(config), "message")


@query
def message_log(spark, sf):
    path = f"{sinks.scratch_folder(spark)}/log"
    e = F.col("event_id")
    rows = fx.telemetry(spark, sf).select((e + 1700000000000).alias("timestamp_ms"), "msg_a", "msg_b")
    rows.write.option("header", True).csv(path)
    log = tel.message_log(spark, path)
    long = log.unpivot(["timestamp_ms", "app_timestamp"], ["msg_a", "msg_b"], "message", "hex")
    return long.select(
        "timestamp_ms", F.unix_timestamp("app_timestamp").alias("seconds"), "message", "hex"
    )

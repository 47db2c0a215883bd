"""Field catalog: layouts and conversion tables prepared for decoding.

Everything that depends only on a layout or a table is settled here, once per
field, so that the per-message work is a join and arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from byteloom.functions.convert import CONVERSION, ENUM, LINEAR, conversion_plan, whole_bound
from byteloom.functions.hexbits import READING, bracket_part, position_part, reading_plan
from byteloom.functions.wholes import LARGEST, sortable, to_bigint
from byteloom.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS

LAYOUT = ("family", "model_year", "message")
TABLE = ("family", "model_year")

DESCRIPTIVE = ("ord", "description", "raw_position", "size", "type", "name", "id")
LABELS = ("starts", "names", "big_starts", "big_names")
FIELD_COLUMNS = (*DESCRIPTIVE, *READING, *CONVERSION, *LABELS)


@dataclass(frozen=True)
class FieldCatalog:
    """Compiled layouts: one row per (family, model_year, message, ord).

    A row says how to read the field and how to convert it; ``starts`` and
    ``names`` are the label pieces of its raw values.  Rows and lists are
    message definitions: they do not grow with the telemetry.
    """

    fields: DataFrame
    #: Layouts without entries: (family, model_year, message, layout_name).
    empty: tuple[tuple, ...] = ()

    def stored(self, path: str) -> "FieldCatalog":
        """Write the compiled rows and read them back.

        Plans that use the catalog then hold a small scan instead of the joins
        that compiled it, and a lost executor costs no recompilation.
        """
        self.fields.write.mode("overwrite").parquet(path)
        schema = self.fields.schema
        return FieldCatalog(self.fields.sparkSession.read.schema(schema).parquet(path), self.empty)

    @cached_property
    def facts(self) -> Row:
        """Measured once, in one pass: rows, bytes, pieces of the largest label tables, wide fields."""
        texts = ("description", "name", "fixed_text", "early_error", "short_error")
        width = F.lit(500) + sum(F.coalesce(F.length(c), F.lit(0)) for c in texts)
        pieces = F.coalesce(F.aggregate("names", F.lit(0), lambda n, x: n + 8 + F.coalesce(F.length(x), F.lit(0))), F.lit(0))
        size = {name: F.coalesce(F.max(F.size(name)), F.lit(0)).alias(name) for name in ("starts", "big_starts")}
        return self.fields.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum((width + pieces).cast("bigint")), F.lit(0)).alias("size"),
            *size.values(),
            *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("wide", "large")],
        ).first()

    @property
    def small(self) -> bool:
        return self.facts["n"] <= BROADCAST_ROWS and self.facts["size"] <= BROADCAST_BYTES

    def only(self, requested: Iterable[tuple[str, str]]) -> "FieldCatalog":
        """Catalog of the requested (message, description) pairs."""
        by_message: dict[str, list[str]] = {}
        for message, description in requested:
            by_message.setdefault(message, []).append(description)
        wanted = F.lit(False)
        for message, descriptions in by_message.items():
            wanted = wanted | (
                (F.col("message") == message) & F.col("description").isin(descriptions)
            )
        return FieldCatalog(self.fields.filter(wanted), self.empty)

    def packed(self) -> DataFrame:
        """One row per layout with its ordered fields; layouts without entries have none."""
        field = F.struct(*FIELD_COLUMNS)
        packed = self.fields.groupBy(*LAYOUT).agg(
            F.first("layout_name").alias("layout_name"),
            F.array_sort(F.collect_list(field), lambda a, b: a["ord"] - b["ord"]).alias("fields"),
        )
        if not self.empty:
            return packed
        names = [*LAYOUT, "layout_name"]
        bare = self.fields.sparkSession.createDataFrame(
            list(self.empty), ", ".join(f"{name} string" for name in names)
        )
        return packed.unionByName(
            bare.withColumn("fields", F.array().cast(packed.schema["fields"].dataType))
        )

    def rows(self, limit: int) -> list[Row] | None:
        """Compiled rows on the driver, or None beyond ``limit`` rows."""
        if "_rows" not in self.__dict__:
            rows = self.fields.limit(limit + 1).collect()
            if len(rows) > limit:
                return None
            # All rows: kept for later plans.
            self.__dict__["_rows"] = rows
        rows = self.__dict__["_rows"]
        return rows if len(rows) <= limit else None


def compile_catalog(
    layouts: DataFrame,
    linear: DataFrame,
    enumeration: DataFrame,
    dedup: str = "last",
    hex_mode: str = "both",
    require_tables: bool = False,
) -> FieldCatalog:
    """Prepare layouts (family, model_year, message, layout_name, ord, ...).

    dedup -- which entry of a repeated description stays: 'last', 'first', 'all'
    hex_mode -- digits an enumeration code may have: 'both' or 'strict'
    require_tables -- drop layouts whose family/year lacks one of the tables

    Tables with a repeated key are refused: which row counts would be chance.
    A row without ``ord`` stands for a layout without entries.
    """
    empty = layouts.filter(F.col("ord").isNull()).select(*LAYOUT, "layout_name").distinct().collect()
    layouts = layouts.filter(F.col("ord").isNotNull())
    tables_l = linear.select(*TABLE).distinct().withColumn("_has_linear", F.lit(True))
    tables_t = enumeration.select(*TABLE).distinct().withColumn("_has_enum", F.lit(True))
    for what, table, unique in (
        ("layout entries", layouts, [*LAYOUT, "ord"]),
        ("linear rows", linear, [*TABLE, "id", "row_ord"]),
        ("enumeration rows", enumeration, [*TABLE, "id", "row_ord"]),
    ):
        twice = repeated_keys(table, unique).first()
        if twice is not None:
            raise ValueError(f"{what} occur more than once: {twice.asDict()}")
    if require_tables:
        layouts = layouts.join(tables_l, list(TABLE), "left_semi").join(
            tables_t, list(TABLE), "left_semi"
        )
    key = [*TABLE, "type", "id_number"]
    first_rows = (
        linear.groupBy(*TABLE, F.col("id").alias("id_number"))
        .agg(
            F.min_by(
                F.struct("factor", "offset", "decimals", "units", "raw_max"), "row_ord"
            ).alias("row")
        )
        .withColumn("type", F.lit(LINEAR))
    )
    has_table = F.when(F.col("type") == LINEAR, F.col("_has_linear")).when(
        F.col("type") == ENUM, F.col("_has_enum")
    )
    parsed = (
        deduplicate(parse_positions(layouts), dedup)
        .join(tables_l, list(TABLE), "left")
        .join(tables_t, list(TABLE), "left")
        .withColumn("_table", has_table.isNotNull() & F.col("id").isNotNull())
        .withColumn("id_number", F.when(F.col("_table"), F.trim("id").try_cast("bigint")))
        .join(first_rows, key, "left")
        .join(label_sets(linear, enumeration, hex_mode), key, "left")
    )
    state = (
        F.when(~F.col("_table"), F.lit("raw"))
        .when(F.col("id_number").isNull(), F.lit("bad_id"))
        .when((F.col("type") == LINEAR) & F.col("row").isNull(), F.lit("raw"))
        .otherwise(F.lit("row"))
    )
    reading = reading_plan(
        F.col("byte_pos"), F.col("bit_pos"), F.col("byte_size"), F.col("bit_size")
    )
    conversion = conversion_plan(
        F.col("type"), F.col("name"), F.col("id"), F.col("state"), F.col("row"),
        F.greatest(F.col("byte_size"), F.lit(1)) * 8 + F.col("bit_size"),
    )
    return FieldCatalog(
        parsed.withColumn("state", state).select(
            *LAYOUT,
            "layout_name",
            *DESCRIPTIVE,
            *[reading[name].alias(name) for name in READING],
            *[conversion[name].alias(name) for name in CONVERSION],
            *LABELS,
        ),
        tuple(map(tuple, empty)),
    )


def parse_positions(layouts: DataFrame) -> DataFrame:
    """``"N [b]"`` texts of a layout as integers, defaults filled in."""
    return layouts.withColumns(
        {
            "description": F.coalesce("description", F.lit("Unknown")),
            "type": F.coalesce("type", F.lit("")),
            "raw_position": F.coalesce("byte", F.lit("0 [0]")),
            "byte_pos": position_part(F.col("byte"), "0 [0]"),
            "bit_pos": bracket_part(F.col("byte"), "0 [0]"),
            "byte_size": position_part(F.col("size"), "1 [0]"),
            "bit_size": bracket_part(F.col("size"), "1 [0]"),
            "size": F.coalesce("size", F.lit("1 [0]")),
        }
    )


def deduplicate(layouts: DataFrame, dedup: str) -> DataFrame:
    """Keep one entry per description of a layout.

    Which entry wins is a property of the layout, so messages need no
    per-row grouping.
    """
    if dedup == "all":
        return layouts
    order = F.col("ord").desc() if dedup == "last" else F.col("ord").asc()
    window = Window.partitionBy(*LAYOUT, "description").orderBy(order)
    return (
        layouts.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def label_spans(linear: DataFrame, enumeration: DataFrame, hex_mode: str = "both") -> DataFrame:
    """Raw values and ranges with a label: (key, low, high, label, row_ord); ends are sortable texts.

    A range is left out where an earlier row begins with it and reaches as far:
    it names nothing.  Of many ranges that begin at one value few stay.
    """
    columns = [*TABLE, "type", "id_number", "low", "high", "label", "row_ord"]
    encodings = linear.filter(F.col("encoding_name").isNotNull()).select(
        *TABLE,
        F.lit(LINEAR).alias("type"),
        F.col("id").alias("id_number"),
        "row_ord",
        F.trim("raw_min").alias("low_text"),
        F.trim("raw_max").alias("high_text"),
        F.col("encoding_name").alias("label"),
    ).withColumns(
        {"low": sortable(whole_bound(F.col("low_text"))), "high": sortable(whole_bound(F.col("high_text")))}
    )
    # A single value is compared as text with the two-digit form of the raw
    # value, so a padded text such as $01FF never matches.
    single = (F.col("low_text") == F.col("high_text")) & F.col("low_text").rlike(
        r"^\$([0-9A-F]{2}|[1-9A-F][0-9A-F]{2,})$"
    )
    valid = single | ((F.col("low_text") != F.col("high_text")) & (F.col("low") <= F.col("high")))
    # Rows that are no range have no end; the window comes first, so that the texts are read once.
    earlier = Window.partitionBy(*TABLE, "type", "id_number", "low").orderBy("row_ord", "label").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        encodings.withColumn("high", F.when(valid, F.col("high")))
        .withColumn("_reached", F.max("high").over(earlier))
        .filter(F.col("high").isNotNull() & (F.col("_reached").isNull() | (F.col("_reached") < F.col("high"))))
    )
    return enumeration_codes(enumeration, hex_mode).select(*columns).union(spans.select(*columns))


def label_pieces(spans: DataFrame) -> DataFrame:
    """Disjoint pieces (key, cut, label) of overlapping spans; the first row keeps a piece.

    A piece begins at its cut and ends before the next one of its key: a
    sortable text with "0" for the number itself, "1" for what follows it.  A
    piece that no span covers has a NULL label.  Every span is spread over
    blocks of 1, 2, 4, ... pieces, two of a size at most, and every piece asks
    the blocks that hold it: n log n rows for n spans, whatever they overlap.
    """
    key = [*TABLE, "type", "id_number"]
    ends = spans.select(
        "*", F.concat("low", F.lit("0")).alias("from"), F.concat("high", F.lit("1")).alias("to")
    )
    cuts = ends.select(*key, F.explode(F.array("from", "to")).alias("cut")).distinct()
    by_key = Window.partitionBy(*key)
    numbered = cuts.select(
        *key,
        "cut",
        (F.row_number().over(by_key.orderBy("cut")) - 1).alias("no"),
        F.count(F.lit(1)).over(by_key).alias("n"),
    )
    places = numbered.select(*key, "cut", "no")
    placed = (
        ends.join(places.withColumnsRenamed({"cut": "from", "no": "a"}), [*key, "from"])
        .join(places.withColumnsRenamed({"cut": "to", "no": "b"}), [*key, "to"])
        .withColumn("level", F.explode(F.sequence(F.lit(0), _log2(F.col("b") - F.col("a")))))
    )
    width = F.call_function("shiftleft", F.lit(1), F.col("level"))
    left, right = F.ceil(F.col("a") / width), F.floor(F.col("b") / width)
    blocks = (
        placed.select(*key, "level", "label", "row_ord", left.alias("left"), right.alias("right"))
        .select(
            *key,
            "level",
            F.struct("row_ord", "label").alias("owner"),
            F.explode(
                F.array_compact(
                    F.array(
                        F.when((F.col("left") < F.col("right")) & (F.col("left") % 2 == 1), F.col("left")),
                        F.when((F.col("left") < F.col("right")) & (F.col("right") % 2 == 1), F.col("right") - 1),
                    )
                )
            ).alias("block"),
        )
        .groupBy(*key, "level", "block")
        .agg(F.min("owner").alias("owner"))
    )
    asking = numbered.withColumn("level", F.explode(F.sequence(F.lit(0), _log2(F.col("n"))))).withColumn(
        "block", F.floor(F.col("no") / F.call_function("shiftleft", F.lit(1), F.col("level")))
    )
    return (
        asking.join(blocks, [*key, "level", "block"], "left")
        .groupBy(*key, "cut")
        .agg(F.min("owner")["label"].alias("label"))
    )


def _log2(n: Column) -> Column:
    return (F.length(F.bin(n.cast("bigint"))) - 1).cast("int")


def label_sets(linear: DataFrame, enumeration: DataFrame, hex_mode: str = "both") -> DataFrame:
    """Per (family, model_year, type, id_number): starts and names of the label pieces.

    ``starts`` are bigints; where a label reaches beyond 63 bits ``big_starts``
    are the same cuts, all as sortable texts.
    """
    key = [*TABLE, "type", "id_number"]
    whole = F.expr("substr(cut, 7, length(cut) - 7)")
    number = to_bigint(whole)
    after = F.right("cut", F.lit(1)).cast("int")
    pieces = label_pieces(label_spans(linear, enumeration, hex_mode)).withColumn(
        "start", F.when((number < LARGEST) | (after == 0), number + after)
    )
    # The order of the cuts is also that of the numbers below 2**63.
    listed = pieces.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("cut", "start", "label"))).alias("all"))
    narrow = F.filter("all", lambda p: p["start"].isNotNull())
    # What follows the largest bigint is no raw value of 63 bits, nor does a piece begin there.
    big = F.exists("all", lambda p: p["start"].isNull() & (p["cut"] != f"{16:06d}{LARGEST:X}1"))
    return listed.select(
        *key,
        F.transform(narrow, lambda p: p["start"]).alias("starts"),
        F.transform(narrow, lambda p: p["label"]).alias("names"),
        F.when(big, F.transform("all", lambda p: p["cut"])).alias("big_starts"),
        F.when(big, F.transform("all", lambda p: p["label"])).alias("big_names"),
    )


def enumeration_codes(enumeration: DataFrame, hex_mode: str = "both") -> DataFrame:
    """Enumeration rows by the raw value whose code text they hold.

    'both': below 16 the one-digit code comes before the two-digit one.
    'strict': one digit up to 9, two digits above, both for zero.
    """
    text = F.trim("min")
    whole = F.when(
        text.rlike(r"^\$([0-9A-F]|[0-9A-F]{2}|[1-9A-F][0-9A-F]{2,})$"), whole_bound(text)
    )
    short, one_digit = F.length(text) == 2, F.length("whole") == 1
    if hex_mode == "both":
        rank = F.when(short, F.lit(0)).when(one_digit, F.lit(1)).otherwise(F.lit(0))
    else:
        to_nine = F.col("whole").rlike("^[0-9]$")
        rank = F.when(short & to_nine, F.lit(0)).when(~short & ((F.col("whole") == "0") | ~to_nine), F.lit(1))
    return (
        enumeration.withColumn("whole", whole)
        .withColumn("_rank", rank)
        .filter(F.col("whole").isNotNull() & F.col("_rank").isNotNull())
        .groupBy(*TABLE, F.col("id").alias("id_number"), "whole")
        .agg(
            F.min_by(F.struct("encoding_name"), F.struct("_rank", "row_ord")).alias("hit"),
            F.min("row_ord").alias("row_ord"),
        )
        .select(
            *TABLE,
            F.lit(ENUM).alias("type"),
            "id_number",
            sortable(F.col("whole")).alias("low"),
            sortable(F.col("whole")).alias("high"),
            # An empty label reads as not-a-number in the message record.
            F.coalesce("hit.encoding_name", F.lit("NaN")).alias("label"),
            "row_ord",
        )
    )


def undefined_columns(requested: DataFrame, fields: DataFrame) -> DataFrame:
    """Requested (message, description) pairs that no layout defines."""
    return requested.join(
        fields.select("message", "description").distinct(), ["message", "description"], "left_anti"
    )


def repeated_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in a catalog table."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_artefacts(combinations: DataFrame, inventory: DataFrame, required: list[str]) -> DataFrame:
    """Per (family, model_year): the required artefacts the inventory lacks."""
    needed = combinations.select(*TABLE).distinct().withColumn(
        "artefact", F.explode(F.array(*[F.lit(name) for name in required]))
    )
    have = inventory.select(*TABLE, "artefact").distinct().withColumn("_have", F.lit(True))
    missing = F.when(F.col("_have").isNull(), F.col("artefact"))
    return (
        needed.join(have, [*TABLE, "artefact"], "left")
        .groupBy(*TABLE)
        .agg(F.sort_array(F.collect_list(missing)).alias("missing"))
        .withColumn("valid", F.size("missing") == 0)
    )

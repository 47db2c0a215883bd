"""Decode hex messages through a field catalog.

Three renderings of one set of rules:

``decode_long``   one row per (message, field); join and codegen arithmetic
``decode_array``  one row per message with an array of field records; no
                  shuffle, since the records of a message are built in place
``decode_wide``   one typed column per requested field; no join on fields and
                  no shuffle, the catalog rows become literals of the plan
"""

from __future__ import annotations

from dataclasses import dataclass
from types import SimpleNamespace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from byteloom import fixed_values as fixed
from byteloom.functions.choice import choose
from byteloom.functions.convert import (
    ENUM,
    LINEAR,
    SCALED,
    big_number,
    big_text,
    failed_text,
    numeric_value,
    text_value,
)
from byteloom.functions.hexbits import Message, extract_error, is_readable, raw_value, wide_value
from byteloom.functions.intervals import advanced, known_label, powers, searched
from byteloom.functions.types import TYPE_NAMES, cast_text
from byteloom.functions.wholes import decimal_text, let, sortable, to_bigint
from byteloom.operators.catalog import FIELD_COLUMNS, LAYOUT, FieldCatalog
from byteloom.operators.lookup import BROADCAST_BYTES, lookup_join

WIDE_EXPRESSION_LIMIT = 2_000
#: Label pieces that a row of the long form carries at most; of larger tables it gets the block that it needs.
PIECES_IN_ROW = 256


def with_message_columns(messages: DataFrame, hex_column: str = "hex") -> DataFrame:
    return messages.withColumns(Message.columns(F.col(hex_column)))


def _names(get: Any, catalog: FieldCatalog) -> SimpleNamespace:
    """A field's definition as columns; what no field of the catalog has is left out of the plan."""
    absent = {name: False for name in ("wide", "large") if not catalog.facts[name]}
    return SimpleNamespace(**{name: get(name) for name in FIELD_COLUMNS} | absent)


# --- rules over one field ----------------------------------------------------


def whole_of(m: Message, f: Any) -> Column:
    """Hex text of a wide field, NULL for others."""
    return choose([(f.wide, lambda: wide_value(m, f))], lambda: F.lit(None).cast("string"))


def raw_of(m: Message, f: Any, whole: Column) -> Column:
    """Raw integer; NULL where it has more than 63 bits."""
    return choose([(f.wide, lambda: to_bigint(whole))], lambda: raw_value(m, f))


def label_of(f: Any, raw: Column, big: Column, pieces: int, big_pieces: int) -> Column | None:
    """Label of the raw value in the catalog's pieces."""
    label = searched(f.starts, f.names, raw, pieces) if pieces else None
    if f.wide is False or not big_pieces:
        return label
    beyond = searched(f.big_starts, f.big_names, _cut(big), big_pieces)
    return F.when(big.isNotNull(), beyond).otherwise(label)


def _cut(big: Column) -> Column:
    return F.concat(sortable(big), F.lit("0"))


def number_of(f: Any, raw: Column, big: Column, label: Any) -> Column:
    number = numeric_value(raw, f, label)
    return number if f.wide is False else F.when(big.isNotNull(), big_number(big, f, label)).otherwise(number)


def text_of(f: Any, raw: Column, big: Column, label: Any, num: Column) -> Column:
    text = text_value(raw, f, label, num)
    return text if f.wide is False else F.when(big.isNotNull(), big_text(big, f, label, num)).otherwise(text)


def shows_raw(f: Any) -> Any:
    """Records show the raw value of table-driven types with an id."""
    if isinstance(f.type, Column):
        return f.type.isin(LINEAR, ENUM) & f.id.isNotNull()
    return f.type in (LINEAR, ENUM) and f.id is not None


# --- long form -------------------------------------------------------------


def join_fields(messages: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Messages with a layout, one row per field (other messages drop out)."""
    filled = messages.filter(F.col("hex").isNotNull())
    fields = catalog.fields
    if width := block_width(catalog):
        # Only the first start of each block; a row would else be as long as the largest table.
        first = F.when(F.col("no") % width == 0, F.col("piece.starts"))
        heads = label_pieces_of(catalog).groupBy(*LAYOUT, "ord").agg(F.sort_array(F.collect_list(first)).alias("starts"))
        fields = fields.drop("starts", "names").join(heads, [*LAYOUT, "ord"], "left")
    return lookup_join(with_message_columns(filled), fields, LAYOUT, small=catalog.small)


def block_width(catalog: FieldCatalog) -> int | None:
    """Label pieces of a block, about the root of the largest table; None where tables are not cut into blocks."""
    pieces = catalog.facts["starts"]
    return 1 << (pieces.bit_length() // 2 - 1) if pieces > PIECES_IN_ROW else None


def label_pieces_of(catalog: FieldCatalog) -> DataFrame:
    """(family, model_year, message, ord, no, piece): a row for each label piece of a field."""
    return catalog.fields.select(*LAYOUT, "ord", F.posexplode(F.arrays_zip("starts", "names")).alias("no", "piece"))


def label_blocks(catalog: FieldCatalog, width: int) -> DataFrame:
    """(family, model_year, message, ord, _block, _starts, names): the label pieces of a field in blocks of ``width``."""
    block = F.floor(F.col("no") / width).cast("int").alias("_block")
    # By number: a piece between two whole numbers begins with the next one's start.
    piece = F.struct("no", "piece.starts", "piece.names")
    pieces = label_pieces_of(catalog).groupBy(*LAYOUT, "ord", block).agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return pieces.select(*LAYOUT, "ord", "_block", F.col("pieces.starts").alias("_starts"), F.col("pieces.names").alias("names"))


def with_place(rows: DataFrame, starts: str, pieces: int) -> DataFrame:
    """Add ``_at``: how many of at most ``pieces`` starts are not above the raw value."""
    rows = rows.withColumn("_at", F.lit(0))
    for step in powers(pieces) if pieces else ():
        rows = rows.withColumn("_at", advanced(F.col(starts), F.col("raw"), F.col("_at"), step))
    return rows


def decode_fields(joined: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Add error, raw, raw_big, label, num and value to joined (message, field) rows.

    The steps are separate projections so that no step is computed twice; the
    search for a label is a projection for each halving of the largest table.
    Steps may copy a row, so it carries no large table: the starts of its blocks
    are searched first, then the one block that a join adds.
    """
    field = _names(F.col, catalog)
    message = Message.joined()
    readable = F.col("error").isNull()
    raw, big, label = F.col("raw"), F.col("_big"), F.col("label")
    rows = joined.withColumn("error", extract_error(message, field))
    if field.wide is False:
        rows = rows.withColumn("_big", F.lit(None).cast("string"))
        rows = rows.withColumn("raw", F.when(readable, raw_value(message, field)))
    else:
        rows = rows.withColumn("_big", F.when(readable, whole_of(message, field)))
        rows = rows.withColumn("raw", F.when(readable, raw_of(message, field, big)))
        rows = rows.withColumn("_big", F.when(raw.isNull(), big))
    pieces, width = catalog.facts["starts"], block_width(catalog)
    if width:
        rows = with_place(rows, "starts", -(-pieces // width)).withColumn("_block", F.col("_at") - 1).drop("starts")
        # A table beyond the bound for a broadcast is joined by a shuffle.
        small = catalog.facts["size"] <= BROADCAST_BYTES
        rows = lookup_join(rows, label_blocks(catalog, width), [*LAYOUT, "ord", "_block"], "left", small=small)
        rows = with_place(rows, "_starts", width)
    else:
        rows = with_place(rows, "starts", pieces)
    found = F.get("names", F.col("_at") - 1)
    if field.wide is not False and catalog.facts["big_starts"]:
        beyond = searched(F.col("big_starts"), F.col("big_names"), _cut(big), catalog.facts["big_starts"])
        found = F.when(big.isNotNull(), beyond).otherwise(found)
    return (
        rows.withColumn("label", found)
        .withColumn("num", F.when(readable, number_of(field, raw, big, label)))
        .withColumn(
            "value",
            F.when(readable, text_of(field, raw, big, label, F.col("num"))).otherwise(
                failed_text(F.col("error"))
            ),
        )
        .withColumn("raw_value", F.when(shows_raw(field), raw))
        .withColumn("raw_big", F.when(big.isNotNull(), decimal_text(big)))
    )


def decode_long(messages: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """messages(family, model_year, message, hex, ...) -> one row per field.

    ``raw`` is the raw value of up to 63 bits, ``raw_big`` the decimal digits
    of a larger one.
    """
    return decode_fields(join_fields(messages, catalog), catalog).select(
        *messages.columns,
        "ord",
        "description",
        "value",
        "num",
        "error",
        "raw",
        "raw_position",
        "size",
        F.col("type").alias("msg_type"),
        F.col("id").alias("msg_id"),
        "raw_value",
        "units",
        "raw_big",
    )


# --- array form ------------------------------------------------------------
#: What a record says besides its position in the layout.
RECORD = (
    "description", "decoded_value", "raw_position", "size", "msg_type", "msg_id", "raw_value", "units", "raw_big",
)


def decode_array(messages: DataFrame, catalog: FieldCatalog) -> DataFrame:
    """Add ``layout_name`` and ``decoded``: the ordered field records.

    ``decoded`` is NULL for messages without a layout and for NULL hex.
    """
    message = Message.joined()

    def named(item: Column) -> SimpleNamespace:
        return _names(lambda name: item["f"][name], catalog)

    def kept(item: Column, *names: str) -> list[Column]:
        return [item[name].alias(name) for name in names]

    def read(field: Column) -> Column:
        f = _names(lambda name: field[name], catalog)
        error = extract_error(message, f)
        return F.struct(field.alias("f"), error.alias("error"), whole_of(message, f).alias("whole"))

    def numbered(item: Column) -> Column:
        raw = F.when(item["error"].isNull(), raw_of(message, named(item), item["whole"]))
        return F.struct(*kept(item, "f", "error", "whole"), raw.alias("raw"))

    def labelled(item: Column) -> Column:
        f = named(item)
        big = F.when(item["error"].isNull() & item["raw"].isNull(), item["whole"])
        label = label_of(f, item["raw"], big, catalog.facts["starts"], catalog.facts["big_starts"])
        return F.struct(
            *kept(item, "f", "error", "raw"),
            big.alias("big"),
            (F.lit(None).cast("string") if label is None else label).alias("label"),
        )

    def counted(item: Column) -> Column:
        num = number_of(named(item), item["raw"], item["big"], item["label"])
        return F.struct(
            *kept(item, "f", "error", "raw", "big", "label"), F.when(item["error"].isNull(), num).alias("num")
        )

    def recorded(item: Column) -> Column:
        f = named(item)
        text = text_of(f, item["raw"], item["big"], item["label"], item["num"])
        made = {
            "description": f.description,
            "decoded_value": F.when(item["error"].isNotNull(), failed_text(item["error"])).otherwise(text),
            "raw_position": f.raw_position, "size": f.size, "msg_type": f.type, "msg_id": f.id,
            "raw_value": F.when(shows_raw(f), item["raw"]), "units": f.units,
            "raw_big": F.when(item["big"].isNotNull(), decimal_text(item["big"])),
        }
        return F.struct(
            f.ord.alias("ord"), *[made[name].alias(name) for name in RECORD], *kept(item, "num", "error")
        )

    joined = lookup_join(with_message_columns(messages), catalog.packed(), LAYOUT, "left", small=catalog.small)
    records = F.col("fields")
    for step in (read, numbered, labelled, counted, recorded):
        records = F.transform(records, step)
    return joined.withColumn("decoded", F.when(F.col("hex").isNotNull(), records)).drop(
        "fields", "hex_bytes", "hex_length", "hex_clean"
    )


# --- message envelopes -------------------------------------------------------


def record_json(record: Column) -> Column:
    return F.struct(*[record[name].alias(name) for name in RECORD])


def envelope(messages: DataFrame, catalog: FieldCatalog, on_error: str = "null",
             shape: str = "map", mapped: DataFrame | None = None) -> DataFrame:
    """Add ``envelope``: the decoded message as JSON text.

    on_error -- 'null': messages that cannot be decoded give NULL;
                'envelope': they give a JSON text naming the reason
    shape -- 'map' keys the records by description, 'list' keeps their order
    mapped -- (family, model_year, message) known to have a layout file name;
              only used to tell an unmapped message from a missing layout
    """
    decoded = decode_array(messages, catalog)
    values = (
        F.map_from_entries(
            F.transform("decoded", lambda r: F.struct(r["description"], record_json(r)))
        )
        if shape == "map"
        else F.transform("decoded", record_json)
    )
    body = F.to_json(
        F.struct(
            F.col("hex").alias("code"),
            F.coalesce("layout_name", F.lit("Unknown")).alias("name"),
            values.alias("decoded_values"),
            F.col("family").alias("vehicle_family"),
            F.col("model_year").alias("model_year"),
            F.col("message").alias("ddt_type"),
        )
    )
    good = F.when(F.size("decoded") > 0, body)
    own = ("decoded", "layout_name", "_mapped")
    if on_error == "null":
        return decoded.withColumn("envelope", good).drop(*own)
    if mapped is not None:
        known = mapped.select(*LAYOUT).distinct().withColumn("_mapped", F.lit(True))
        decoded = lookup_join(decoded, known, LAYOUT, "left")
        unmapped = F.col("_mapped").isNull()
    else:
        unmapped = F.lit(False)
    file_name = F.concat_ws(
        "/",
        "family",
        "model_year",
        layout_file_name(F.col("message"), F.col("family"), F.col("model_year")),
    )
    reason = (
        F.when(F.coalesce("hex", F.lit("")) == "", F.lit(fixed.EMPTY_MESSAGE))
        .when(unmapped, F.format_string(fixed.UNMAPPED_MESSAGE, "message"))
        .when(F.col("layout_name").isNull(), F.format_string(fixed.LAYOUT_NOT_FOUND, file_name))
        .when(F.size("decoded") == 0, F.format_string(fixed.EMPTY_LAYOUT, "message"))
    )
    failed = F.to_json(F.struct(reason.alias("error")))
    return decoded.withColumn(
        "envelope", F.when(reason.isNotNull(), failed).otherwise(good)
    ).drop(*own)


def layout_file_name(message: Column, family: Column, model_year: Column, ecu: str = "BCM") -> Column:
    pattern = fixed.LAYOUT_FILE.format(
        ecu=ecu, message="%1$s", family="%2$s", model_year="%3$s", year="%3$s"
    )
    return F.format_string(pattern, message, family, model_year)


# --- wide form ---------------------------------------------------------------


@dataclass(frozen=True)
class WideColumn:
    """Output column ``name`` = field ``description`` of ``message``, typed."""

    message: str
    description: str
    type: str
    name: str


def decode_wide(
    df: DataFrame,
    catalog: FieldCatalog,
    columns: list[WideColumn],
    hex_columns: dict[str, str],
    limit: int = WIDE_EXPRESSION_LIMIT,
    when: dict[str, str] | None = None,
) -> DataFrame:
    """Add one typed column per requested field of the wide messages of ``df``.

    Needs family and model_year columns; ``hex_columns`` maps message to hex
    column.  Unknown descriptions give NULL columns.  ``when`` maps a message to
    a flag column: where it is not true, the message's columns are NULL and the
    row stays.  The requested part of the catalog is turned into expressions
    when it has at most ``limit`` rows, otherwise the array form is used; the
    values are the same.
    """
    if when:
        gated, hex_columns = _gated(df, hex_columns, when)
        helpers = [c for c in gated.columns if c not in df.columns]
        return decode_wide(gated, catalog, columns, hex_columns, limit).drop(*helpers)
    wanted = catalog.only((c.message, c.description) for c in columns)
    rows = wanted.rows(limit)
    if rows is None:
        return _wide_by_array(df, wanted, columns, hex_columns)
    return _wide_by_expression(df, rows, columns, hex_columns)


def _gated(
    df: DataFrame, hex_columns: dict[str, str], when: dict[str, str]
) -> tuple[DataFrame, dict[str, str]]:
    """Hex columns that are NULL where the flag of their message is not true."""
    own = {m: f"_when_{m}" for m in hex_columns if m in when}
    gated = df.withColumns({own[m]: F.when(F.col(when[m]), F.col(hex_columns[m])) for m in own})
    return gated, hex_columns | own


def _wide_by_expression(df, rows, columns, hex_columns) -> DataFrame:
    # Of entries with one description the first counts, as in the array form.
    firsts: dict[tuple, Row] = {}
    for f in rows:
        key = (f.family, f.model_year, f.message, f.description)
        if key not in firsts or f.ord < firsts[key].ord:
            firsts[key] = f
    rows = list(firsts.values())
    # Equal definitions of several families and years share one expression.
    groups: dict[tuple, dict[str, list]] = {}
    for f in rows:
        definition = repr([f[name] for name in FIELD_COLUMNS if name != "ord"])
        groups.setdefault((f.message, f.description), {}).setdefault(definition, []).append(f)

    # Each (family, year) pair is replaced by one number, compared per column.
    pairs = sorted({(f.family, f.model_year) for f in rows})
    pair_no = F.lit(-1)
    if pairs:
        pair_no = F.coalesce(
            F.try_element_at(
                F.create_map(
                    *[
                        F.lit(x)
                        for no, (family, year) in enumerate(pairs)
                        for x in (f"{family}\u0001{year}", no)
                    ]
                ),
                F.concat(F.col("family"), F.lit("\u0001"), F.col("model_year").cast("string")),
            ),
            F.lit(-1),
        )
    number_of = {pair: no for no, pair in enumerate(pairs)}

    stage1: dict[str, Column] = {"_pair": pair_no}
    messages: dict[str, Message] = {}
    for no, (message, column) in enumerate(hex_columns.items()):
        parts = Message.columns(F.col(column))
        names = {key: f"_m{no}_{key}" for key in parts}
        stage1.update({names[key]: parts[key] for key in parts})
        messages[message] = Message(
            F.col(column),
            F.col(names["hex_bytes"]),
            F.col(names["hex_length"]),
            F.col(names["hex_clean"]),
        )
    prepared = df.withColumns(stage1)

    # One projection per step, so that no step is computed twice.
    checks, raws, bigs, labels, values = ({} for _ in range(5))
    for no, c in enumerate(columns):
        value = None
        m = messages.get(c.message)
        definitions = groups.get((c.message, c.description), {}) if m is not None else {}
        for k, owners in enumerate(definitions.values()):
            f = owners[0]
            here = F.col("_pair").isin(
                sorted({number_of[(o.family, o.model_year)] for o in owners})
            )
            # Only text columns show why a field cannot be read.
            as_text = TYPE_NAMES[c.type.lower()] == "string"
            ok = extract_error(m, f) if as_text else is_readable(m, f)
            checks[f"_e{no}_{k}"] = F.when(here, ok)
            error_k, raw_k, big_k = F.col(f"_e{no}_{k}"), F.col(f"_r{no}_{k}"), None
            if f.wide:
                readable = error_k.isNull() if as_text else error_k
                checks[f"_w{no}_{k}"] = F.when(here, wide_value(m, f))
                raws[f"_r{no}_{k}"] = F.when(readable, to_bigint(F.col(f"_w{no}_{k}")))
                big_k = F.col(f"_b{no}_{k}")
                bigs[f"_b{no}_{k}"] = F.when(readable & raw_k.isNull(), F.col(f"_w{no}_{k}"))
            else:
                checks[f"_r{no}_{k}"] = F.when(here, raw_value(m, f))
            label = literal_label(f, raw_k, big_k)
            if label is not None:
                labels[f"_l{no}_{k}"] = F.when(here, label)
                label = F.col(f"_l{no}_{k}")
            result = typed_value(f, raw_k, big_k, error_k, label, c.type)
            result = F.when(here & m.hex.isNotNull(), result)
            value = result if value is None else F.coalesce(value, result)
        values[c.name] = value if value is not None else cast_text(F.lit(None).cast("string"), c.type)
    for step in (checks, raws, bigs, labels, values):
        prepared = prepared.withColumns(step) if step else prepared
    return prepared.drop(*stage1, *checks, *raws, *bigs, *labels)


def literal_label(f: Row, raw: Column, big: Column | None) -> Column | None:
    """Label search with the table's pieces as literals."""
    label = known_label(f.starts, f.names, raw) if f.starts else None
    if big is None or not f.big_starts:
        return label
    return F.when(big.isNotNull(), known_label(f.big_starts, f.big_names, _cut(big))).otherwise(label)


def literal_number(f: Row, raw: Column, big: Column | None, label: Column | None) -> Column:
    number = numeric_value(raw, f, label)
    return number if big is None else F.when(big.isNotNull(), big_number(big, f, label)).otherwise(number)


def literal_text(f: Row, raw: Column, big: Column | None, label: Column | None, num: Column) -> Column:
    def text(n: Column) -> Column:
        narrow = text_value(raw, f, label, n)
        return narrow if big is None else F.when(big.isNotNull(), big_text(big, f, label, n)).otherwise(narrow)

    return let(num, text) if f.large else text(num)


def typed_value(
    f: Any, raw: Column, big: Column | None, check: Column, label: Column | None, kind: str
) -> Column:
    """Typed result of one field.

    ``check`` is the error text for text columns, else whether the field can be
    read: a failed field is text and so no value of another type.
    """
    target = TYPE_NAMES[kind.lower()]
    num = literal_number(f, raw, big, label)
    if target == "string":
        return F.when(check.isNull(), literal_text(f, raw, big, label, num)).otherwise(
            failed_text(check)
        )
    if target == "double" and f.kind <= SCALED:
        value = num if label is None else F.coalesce(num, label.try_cast("double"))
    else:
        value = cast_text(literal_text(f, raw, big, label, num), kind)
    return F.when(check, value)


def _wide_by_array(df, catalog, columns, hex_columns) -> DataFrame:
    def picked(c: WideColumn) -> Column:
        hits = F.filter("decoded", lambda r: r["description"] == F.lit(c.description))
        return cast_text(F.get(hits, F.lit(0))["decoded_value"], c.type)

    result = df
    for message, column in hex_columns.items():
        view = result.withColumns({"message": F.lit(message), "hex": F.col(column)})
        decoded = {c.name: picked(c) for c in columns if c.message == message}
        result = (
            decode_array(view, catalog)
            # One element: keeps the optimizer from repeating the array for every column.
            .withColumn("decoded", F.explode_outer(F.array("decoded")))
            .withColumns(decoded)
            .drop("decoded", "message", "hex", "layout_name")
        )
    absent = {
        c.name: cast_text(F.lit(None).cast("string"), c.type)
        for c in columns
        if c.message not in hex_columns
    }
    return result.withColumns(absent) if absent else result


def wide_envelopes(
    df: DataFrame,
    catalog: FieldCatalog,
    hex_columns: dict[str, str],
    on_error: str = "null",
    when: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``decoded_<message>``: the envelope of each wide message column.

    With ``when`` a message is decoded where its flag column is true.
    """
    if when:
        gated, hex_columns = _gated(df, hex_columns, when)
        helpers = [c for c in gated.columns if c not in df.columns]
        return wide_envelopes(gated, catalog, hex_columns, on_error).drop(*helpers)
    result = df
    for message, column in hex_columns.items():
        view = result.withColumns({"message": F.lit(message), "hex": F.col(column)})
        result = (
            envelope(view, catalog, on_error)
            .withColumnRenamed("envelope", f"decoded_{message}")
            .drop("message", "hex")
        )
    return result

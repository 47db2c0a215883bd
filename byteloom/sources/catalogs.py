"""Layouts, conversion tables, expected lengths and configuration as tables.

Family, year and message of a file come from its path, so one scan reads the
files of all families and years.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from byteloom import fixed_values as fixed

# --- fixed values: schemas of the layout and configuration documents -------
ENTRY = (
    "struct<byte:string,description:string,size:string,type:string,name:string,id:string,"
    "default_value:string>"
)
LAYOUT_SCHEMA = f"name string, entries array<{ENTRY}>"
CONFIG_SCHEMA = (
    "diagnostic_messages map<string, struct<column_name:string, ecu:string,"
    "columns:map<string, struct<type:string, clean_name:string>>,"
    "versions:map<string, map<string, struct<length:int>>>>>"
)


def _pattern(template: str, ecu: str) -> str:
    """Regular expression of a file name with its parts as groups, in order."""
    return template.replace(".", r"\.").format(
        ecu=ecu, message="([^_/]+)", family="([^_/]+)", year="([^_/]+)"
    )


def _in_place(df: DataFrame, path: Column, tree: bool) -> DataFrame:
    """Files whose folders are those their name says: <family>/<year>/<file>.

    Copies kept in other folders, and files of another year, are not read.
    """
    if not tree:
        return df
    folder = r"/([^/]+)/([^/]+)/[^/]+$"
    return df.filter(
        (F.regexp_extract(path, folder, 1) == F.col("family"))
        & (F.regexp_extract(path, folder, 2) == F.col("model_year"))
    )


def csv_cells(line: Column) -> Column:
    """Cells of a CSV line: quoted cells may hold commas and doubled quotes; an empty cell is NULL."""
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'(\s*"(?:[^"]++|"")*+"[^,]*|[^,]*),'), F.lit(1))

    def plain(cell: Column) -> Column:
        inside = F.regexp_extract(cell, r'^\s*"((?:[^"]++|"")*+)"', 1)
        quoted = cell.rlike(r'^\s*"(?:[^"]++|"")*+"')
        return F.when(quoted, F.replace(inside, F.lit('""'), F.lit('"'))).when(cell != "", cell)

    return F.transform(found, plain)


def _read_csv(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """CSV files below ``root``: cells as text, each file's own header, and the row's place.

    The files may have any number of columns, different ones in any order; see
    :func:`_text`.  A cell ends with its line.  Files are definition tables, so
    one file is one window partition.
    """
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root)
        .filter(F.trim("value") != "")
        .select(
            csv_cells(F.replace("value", F.lit("\ufeff"), F.lit(""))).alias("_cells"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
    )
    window = Window.partitionBy("_path").orderBy("_block", "_line")
    plain = F.transform("_cells", F.trim)
    return (
        rows.withColumns(
            {
                "_header": F.first(plain).over(window),
                "row_ord": (F.row_number().over(window) - 2).cast("bigint"),
            }
        )
        .filter(F.col("row_ord") >= 0)
    )


def _text(name: str) -> Column:
    """Cell of the named column; NULL where the file has no such column."""
    return F.get("_cells", (F.array_position("_header", F.lit(name)) - 1).cast("int"))


def _number(name: str) -> Column:
    return F.trim(_text(name)).try_cast("double")


def whole_number(value: Column) -> Column:
    """Infinite, missing or odd text counts as 0."""
    read = F.trim(value).try_cast("double")
    finite = read.isNotNull() & ~F.isnan(read) & (F.abs(read) != F.lit(float("inf")))
    return F.when(finite, read.try_cast("int")).otherwise(F.lit(0))


def linear_tables(
    spark: SparkSession, root: str, ecu: str = "BCM", glob: str | None = None, tree: bool = True
) -> DataFrame:
    """Linear conversion rows of all families and years below ``root``.

    With ``tree`` only files in <root>/<family>/<year>/ count.
    """
    glob = glob or fixed.LINEAR_FILE.format(ecu=ecu, family="*", year="*")
    raw = _read_csv(spark, root, glob)
    named = _pattern(fixed.LINEAR_FILE, ecu)
    rows = raw.select(
        F.regexp_extract("_path", named, 1).alias("family"),
        F.regexp_extract("_path", named, 2).alias("model_year"),
        F.trim(_text("ID")).try_cast("bigint").alias("id"),
        "row_ord",
        _number("Factor (m)").alias("factor"),
        _number("Offset (b)").alias("offset"),
        whole_number(_text("Decimal Places")).alias("decimals"),
        _text("Units").alias("units"),
        _text("Raw Min").alias("raw_min"),
        _text("Raw Max").alias("raw_max"),
        _text("Encoding Name").alias("encoding_name"),
        _text("Description").alias("description"),
        _text("Size").alias("size"),
        _text("Type").alias("value_type"),
        _number("Scaled Min").alias("scaled_min"),
        _number("Scaled Max").alias("scaled_max"),
        "_path",
    )
    return _in_place(rows, F.col("_path"), tree).drop("_path")


def enum_tables(
    spark: SparkSession, root: str, ecu: str = "BCM", glob: str | None = None, tree: bool = True
) -> DataFrame:
    """Enumeration rows of all families and years below ``root``; ``tree`` as for linear tables."""
    glob = glob or fixed.ENUM_FILE.format(ecu=ecu, family="*", year="*")
    raw = _read_csv(spark, root, glob)
    named = _pattern(fixed.ENUM_FILE, ecu)
    rows = raw.select(
        F.regexp_extract("_path", named, 1).alias("family"),
        F.regexp_extract("_path", named, 2).alias("model_year"),
        F.trim(_text("ID")).try_cast("bigint").alias("id"),
        "row_ord",
        _text("Min").alias("min"),
        _text("Encoding Name").alias("encoding_name"),
        "_path",
    )
    return _in_place(rows, F.col("_path"), tree).drop("_path")


def layout_documents(spark: SparkSession, root: str, ecu: str = "BCM", tree: bool = True) -> DataFrame:
    """Layout documents below ``root``: (family, model_year, message, name, entries).

    With ``tree`` only files in <root>/<family>/<year>/ count.
    """
    glob = fixed.LAYOUT_FILE.format(ecu=ecu, message="*", family="*", year="*")
    named = _pattern(fixed.LAYOUT_FILE, ecu)
    path = F.col("_metadata.file_path")
    rows = (
        spark.read.schema(LAYOUT_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .json(root)
        .select(
            F.regexp_extract(path, named, 2).alias("family"),
            F.regexp_extract(path, named, 3).alias("model_year"),
            F.regexp_extract(path, named, 1).alias("message"),
            F.coalesce("name", F.lit("Unknown")).alias("layout_name"),
            "entries",
            path.alias("_path"),
        )
    )
    return _in_place(rows, F.col("_path"), tree).drop("_path")


def explode_entries(documents: DataFrame) -> DataFrame:
    """One row per layout entry, with its position; a document without entries gives one row without."""
    keep = [c for c in documents.columns if c != "entries"]
    exploded = documents.select(*keep, F.posexplode_outer("entries").alias("ord", "entry"))
    return exploded.select(*keep, "ord", "entry.*")


def load_layouts(spark: SparkSession, root: str, ecu: str = "BCM", tree: bool = True) -> DataFrame:
    return explode_entries(layout_documents(spark, root, ecu, tree))


def layout_csv(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Rows of layout CSV files: the current and the legacy column set.

    The legacy files have no ID header: their Type column holds the name and
    their Name column the id.
    """
    raw = _read_csv(spark, root, glob)
    legacy = F.array_position("_header", F.lit("ID")) == 0
    return raw.select(
        F.regexp_extract("_path", "([^/]+)$", 1).alias("file"),
        F.col("row_ord").cast("int").alias("ord"),
        _text("ByteBit").alias("byte"),
        _text("ByteBit_Description").alias("description"),
        _text("Size").alias("size"),
        F.when(~legacy, _text("Type")).alias("type"),
        F.when(legacy, _text("Type")).otherwise(_text("Name")).alias("name"),
        F.when(legacy, _text("Name")).otherwise(_text("ID")).alias("id"),
        _text("Default_Value").alias("default_value"),
    )


def entries_document(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Layout rows to one document per key: (keys, name, entries).

    An entry has a default value only if the row has one.
    """
    default = F.when(F.col("default_value") != "", F.col("default_value"))
    entry = F.struct(
        "ord",
        F.struct(
            "byte", "description", "size", "type", "name", "id", default.alias("default_value")
        ).alias("entry"),
    )
    return (
        rows.groupBy(*keys)
        .agg(F.collect_list(entry).alias("_entries"))
        .select(
            *keys,
            F.col(name).alias("layout_name"),
            F.transform(F.sort_array("_entries"), lambda e: e["entry"]).alias("entries"),
        )
    )


def load_config(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """Messages of configuration documents, one row per message.

    A file holds one document, or one per line without ``wholetext``.
    """
    return (
        spark.read.option("wholetext", wholetext)
        .text(path)
        .select(F.explode(F.from_json("value", CONFIG_SCHEMA)["diagnostic_messages"]))
        .select(
            F.col("key").alias("message"),
            F.col("value.column_name").alias("column_name"),
            F.col("value.ecu").alias("ecu"),
            F.col("value.columns").alias("columns"),
            F.col("value.versions").alias("versions"),
        )
    )


def config_columns(config: DataFrame) -> DataFrame:
    """(message, description, type, clean_name) of a configuration."""
    return config.select("message", F.explode("columns").alias("description", "column")).select(
        "message", "description", "column.type", "column.clean_name"
    )


def config_lengths(config: DataFrame) -> DataFrame:
    """(family, model_year, message, length) of a configuration."""
    return (
        config.select("message", F.explode("versions").alias("family", "years"))
        .select("message", "family", F.explode("years").alias("model_year", "version"))
        .select("family", "model_year", "message", F.col("version.length").alias("length"))
    )


def length_catalog(
    spark: SparkSession,
    lengths: Mapping[str, Mapping[str, Mapping[str, int]]] = fixed.EXPECTED_LENGTHS,
) -> DataFrame:
    """Nested family -> year -> message -> length as a table."""
    rows = [
        (family, str(year), message, length)
        for family, years in lengths.items()
        for year, messages in years.items()
        for message, length in messages.items()
    ]
    return spark.createDataFrame(
        rows, "family string, model_year string, message string, length int"
    )


def artefact_inventory(spark: SparkSession, root: str, ecu: str = "BCM", tree: bool = True) -> DataFrame:
    """(family, model_year, artefact) of the definition files below ``root``.

    Artefacts are 'linear', 'enum' and the message of each layout.  Files are
    listed, not opened; those count that the loaders would read: with ``tree``
    only files in <root>/<family>/<year>/.
    """
    path = F.col("_path")
    layout, linear, enum = (
        f"/{_pattern(t, ecu)}$" for t in (fixed.LAYOUT_FILE, fixed.LINEAR_FILE, fixed.ENUM_FILE)
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        F.col("path").alias("_path")
    )
    by_kind = {linear: (1, 2, F.lit("linear")), enum: (1, 2, F.lit("enum")),
               layout: (2, 3, F.regexp_extract(path, layout, 1))}

    def part(of: Callable[[str, tuple], Column]) -> Column:
        return F.coalesce(*[F.when(path.rlike(pattern), of(pattern, kind)) for pattern, kind in by_kind.items()])

    named = files.select(
        "_path",
        part(lambda pattern, kind: F.regexp_extract(path, pattern, kind[0])).alias("family"),
        part(lambda pattern, kind: F.regexp_extract(path, pattern, kind[1])).alias("model_year"),
        part(lambda _, kind: kind[2]).alias("artefact"),
    )
    return _in_place(named.filter(F.col("artefact").isNotNull()), path, tree).drop("_path")

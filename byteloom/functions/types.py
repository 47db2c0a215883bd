"""Type names of configuration files and casts that never fail a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: type names and their Spark types ----------------------
TYPE_NAMES = {
    "string": "string",
    "str": "string",
    "int": "int",
    "integer": "int",
    "float": "double",
    "double": "double",
    "bool": "boolean",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "date": "date",
}


def cast_text(value: Column, kind: str) -> Column:
    """Typed reading of text; text that is no such value gives NULL."""
    target = TYPE_NAMES[kind.lower()]
    if target == "string":
        return value.cast("string")
    if target == "int":
        # "85.0" reads as 85: the fraction of decimal text is cut off.
        whole = F.regexp_replace(F.trim(value.cast("string")), r"^([+-]?\d+)\.\d*$", "$1")
        return whole.try_cast("int")
    return value.try_cast(target)


def type_of(name: str, types: Mapping[str, str]) -> str | None:
    """Type by exact name or by the prefix before a trailing ``*``; first wins."""
    for pattern, kind in types.items():
        if pattern == name or (pattern.endswith("*") and name.startswith(pattern[:-1])):
            return kind if kind.lower() in TYPE_NAMES else None
    return None

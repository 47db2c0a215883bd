"""Column names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """Other characters than letters, digits, ``_`` become ``_``; pairs merge once."""
    return re.sub("[^a-zA-Z0-9_]", "_", name).replace("__", "_")


def clean_name_column(name: Column) -> Column:
    return F.replace(
        F.regexp_replace(name, "[^a-zA-Z0-9_]", "_"), F.lit("__"), F.lit("_")
    )


def message_of_column(name: str, prefix: str = "DIAG_") -> str | None:
    """``DIAG_<unit>_<message>`` -> ``<message>``."""
    parts = name.split("_", 2)
    return parts[2] if name.startswith(prefix) and len(parts) == 3 else None


def message_columns(columns: list[str], prefix: str = "DIAG_") -> dict[str, str]:
    """Message -> column for the columns named after messages."""
    found = {message_of_column(name, prefix): name for name in columns}
    found.pop(None, None)
    return found

"""The whole batch: window, fill, join, check, decode, in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from byteloom.operators.catalog import FieldCatalog
from byteloom.operators.decode import WideColumn, decode_wide
from byteloom.operators.timeline import forward_fill
from byteloom.operators.validate import all_messages_valid, any_message_present, with_validity
from byteloom.operators.vehicles import join_vehicles
from byteloom.sources.telemetry import date_window


def decode_batch(
    telemetry: DataFrame,
    master: DataFrame,
    lengths: DataFrame,
    catalog: FieldCatalog,
    columns: list[WideColumn],
    hex_columns: dict[str, str],
    fill: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    start: str | None = None,
    end: str | None = None,
    unit: str = "hour",
) -> DataFrame:
    """Typed columns of the messages of all rows whose messages are all valid.

    The fill runs before the join: the join keeps or drops whole vehicles, so
    the filled values are the same, and the fill's shuffle meets fewer columns.
    """
    rows = date_window(telemetry, start, end).filter(F.col("vin").isNotNull())
    if fill:
        rows = forward_fill(rows, fill, tiebreak=tiebreak, unit=unit)
    rows = any_message_present(join_vehicles(rows, master), hex_columns)
    valid = all_messages_valid(with_validity(rows, lengths, hex_columns), list(hex_columns))
    return decode_wide(valid, catalog, columns, hex_columns)

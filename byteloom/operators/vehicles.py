"""Vehicle master: projection and join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from byteloom.operators.lookup import lookup_join


def vehicle_master(
    master: DataFrame,
    vin: str = "VIN",
    model_code: str = "MODEL_CODE",
    model_year: str = "MODEL_YEAR",
    model_name: str = "MODEL_NAME",
) -> DataFrame:
    """Canonical columns; the family is the first two letters of the model code."""
    return master.select(
        F.col(vin).alias("vin"),
        F.substring(model_code, 1, 2).alias("family"),
        F.col(model_year).cast("string").alias("model_year"),
        F.col(model_name).alias("model_name"),
    )


def join_vehicles(telemetry: DataFrame, master: DataFrame) -> DataFrame:
    """Inner join on vin; several master rows of a vin multiply its telemetry.

    The master grows with the fleet: it is broadcast only while its measured
    size allows, otherwise both sides are shuffled by vin and the adaptive skew
    join splits a hot vehicle.
    """
    return lookup_join(telemetry, master, ["vin"])


def join_stored(telemetry: DataFrame, master: DataFrame) -> DataFrame:
    """The same of two stages stored by vin in equal buckets: each bucket is joined in place."""
    return telemetry.join(master.hint("merge"), ["vin"])


def select_messages(df: DataFrame, keep: list[str], aliases: dict[str, str]) -> DataFrame:
    """Pruned projection with renamed message columns (old name -> new name)."""
    return df.select(*keep, *[F.col(old).alias(new) for old, new in aliases.items()])

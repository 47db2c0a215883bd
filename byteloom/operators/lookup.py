"""Joins of a large side with a side that is usually small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Measure at most ``rows + 1`` rows of a lookup side."""
    width = F.length(F.to_json(F.struct("*")))
    measured = (
        df.limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size"))
        .first()
    )
    return measured["n"] <= rows and measured["size"] <= size


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join ``big`` with ``lookup`` on equal keys (and an extra condition).

    A lookup whose measured size is small is broadcast: no shuffle of ``big``
    and no skew.  A larger one is shuffled by the keys; the adaptive skew join
    splits the rows of a hot key over many tasks.  ``small`` passes on an
    earlier measurement.
    """
    if small is None:
        small = fits_broadcast(lookup)
    return _join(big, F.broadcast(lookup) if small else lookup, list(keys), how, condition)


def _join(
    big: DataFrame, lookup: DataFrame, keys: list[str], how: str, condition: Column | None
) -> DataFrame:
    if condition is None:
        return big.join(lookup, keys, how)
    # Key columns of the lookup get their own names, so that the extra
    # condition can name columns of both sides.
    renamed = lookup.withColumnsRenamed({key: f"_lookup_{key}" for key in keys})
    matched = condition
    for key in keys:
        matched = (F.col(key) == F.col(f"_lookup_{key}")) & matched
    joined = big.join(renamed, matched, how)
    return joined.drop(*[f"_lookup_{key}" for key in keys])

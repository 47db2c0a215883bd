"""Conditionals whose inputs may be columns or plain Python values.

A field definition comes from a joined catalog row (columns), a lambda
variable (columns) or a collected row (plain values).  Writing the rules once
over both keeps the three renderings equal; plain conditions are settled while
the plan is built, so a known field yields only the branch it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def known(value: Any) -> Any:
    """True when the value is present."""
    return value.isNotNull() if isinstance(value, Column) else value is not None


def missing(value: Any) -> Any:
    return value.isNull() if isinstance(value, Column) else value is None


def choose(
    branches: Sequence[tuple[Any, Callable[[], Any]]],
    otherwise: Callable[[], Any] = lambda: None,
) -> Column:
    """First branch whose condition holds; thunks of dead branches never run."""
    chain = None
    for condition, make in branches:
        if condition is False:
            continue
        if condition is True:
            otherwise = make
            break
        value = as_column(make())
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    last = as_column(otherwise())
    return last if chain is None else chain.otherwise(last)


def shift_left(value: Any, bits: Any) -> Any:
    if not isinstance(value, Column) and not isinstance(bits, Column):
        return value << bits
    return F.call_function("shiftleft", as_column(value).cast("bigint"), as_column(bits))


def shift_right(value: Column, bits: Any) -> Column:
    """Unsigned shift, so a value using bit 63 keeps its magnitude."""
    if not isinstance(bits, Column) and bits == 0:
        return value
    return F.call_function("shiftrightunsigned", value, as_column(bits))

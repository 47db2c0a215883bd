"""Labels of raw values: sorted starts of disjoint pieces, searched by halving.

``starts[i]`` begins a piece that ends before ``starts[i + 1]``; ``names[i]``
is its label, NULL where no table row covers it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Known tables up to this size become nested conditions, larger ones literal arrays.
TREE = 64


def powers(size: int) -> list[int]:
    """Steps of a search among ``size`` starts: powers of two, large ones first."""
    return [1 << i for i in reversed(range(max(size, 1).bit_length()))]


def advanced(starts: Column, value: Column, at: Column, step: Any) -> Column:
    """``at`` starts are not above the value; so are ``step`` more if the last of them is not."""
    return at + F.when(F.get(starts, at + (step - 1)) <= value, step).otherwise(0)


def searched(starts: Column, names: Column, value: Column, size: int) -> Column:
    """Label of the value among at most ``size`` starts, in one expression."""
    steps = F.array(*[F.lit(s) for s in powers(size)])
    at = F.aggregate(steps, F.lit(0), lambda at, step: advanced(starts, value, at, step))
    return F.get(names, at - 1)


def known_label(starts: Sequence, names: Sequence[str | None], value: Column) -> Column:
    """Label of the value in a table known while the plan is built."""
    if len(starts) > TREE:
        texts = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        return searched(F.array(*[F.lit(s) for s in starts]), texts, value, len(starts))
    by_count = [None, *names]

    def tree(low: int, high: int) -> Column:
        """Label when ``low`` to ``high`` starts are not above the value."""
        if len(set(by_count[low : high + 1])) == 1:
            return F.lit(by_count[low]).cast("string")
        middle = (low + high) // 2
        return F.when(value < F.lit(starts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(starts))

"""Null-aware predicates over column lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def same_values(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    """TRUE when every pair is equal, NULL counting as equal to NULL (``<=>``).

    Never NULL itself, so ``~same_values(...)`` is a safe change test: a
    tracked column that is NULL on both sides is *unchanged*.
    """
    if len(left) != len(right):
        raise ValueError("same_values needs two lists of equal length")
    if not left:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [_c(a).eqNullSafe(_c(b)) for a, b in zip(left, right)])


def any_null(cols: Sequence[str | Column]) -> Column:
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def all_null(cols: Sequence[str | Column]) -> Column:
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [_c(c).isNull() for c in cols])

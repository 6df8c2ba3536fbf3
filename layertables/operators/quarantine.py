"""Quarantine: set aside rows that cannot be loaded, each with a reason.

One flag column is computed once; ``valid`` and ``quarantine`` are two
filters of the same flagged frame, so Catalyst pushes each filter to the
scan and no row is ever lost between them:
``count(valid) + count(quarantine) == count(input)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layertables.functions.predicates import any_null
from layertables.functions.time import parse_time, time_type_of

REASON = "quarantine_reason"

# The reasons a row is quarantined.
NULL_KEY = "null_key"
MISSING_DATES = "missing_dates"
UNPARSEABLE_DATES = "unparseable_dates"
MALFORMED_ROW = "malformed_row"
NULL_REQUIRED = "null_required"


class Split(NamedTuple):
    """A valid/quarantine pair. Also indexable by name: ``split["valid"]``."""

    valid: DataFrame
    quarantine: DataFrame

    def __getitem__(self, item):  # type: ignore[override]
        if isinstance(item, str):
            return getattr(self, item)
        return tuple.__getitem__(self, item)


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def reason_column(
    df: DataFrame,
    *,
    keys: Sequence[str] | str | None = None,
    date_columns: Sequence[str] | None = None,
    time_type=None,
    fmt: str | None = None,
    corrupt_column: str | None = None,
) -> Column:
    """The first applicable reason, or NULL for a loadable row.

    Order: malformed source line, NULL natural key, no date at all, dates
    present but none parseable.
    """
    keys = _as_list(keys)
    dates = [c for c in _as_list(date_columns) if c]
    branches: list[tuple[Column, str]] = []
    if corrupt_column and corrupt_column in df.columns:
        branches.append((F.col(corrupt_column).isNotNull(), MALFORMED_ROW))
    if keys:
        branches.append((any_null(keys), NULL_KEY))
    if dates:
        tt = time_type if time_type is not None else time_type_of(df.schema[dates[0]].dataType)
        raw_null = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in dates])
        parsed = [parse_time(c, df.schema[c].dataType, tt, fmt) for c in dates]
        branches.append((raw_null, MISSING_DATES))
        branches.append((F.coalesce(*parsed).isNull() if len(parsed) > 1 else parsed[0].isNull(), UNPARSEABLE_DATES))
    if not branches:
        return F.lit(None).cast("string")
    expr = None
    for cond, reason in branches:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def split_by_reason(flagged: DataFrame, reason: str = REASON) -> Split:
    valid = flagged.filter(F.col(reason).isNull()).drop(reason)
    quarantine = flagged.filter(F.col(reason).isNotNull())
    return Split(valid, quarantine)


def separate_quarantine_records(
    df: DataFrame,
    effective_from_column: str | None = None,
    effective_from_fallback_column: str | None = None,
    *,
    keys: Sequence[str] | str | None = None,
    time_type=None,
    fmt: str | None = None,
    corrupt_column: str | None = None,
) -> Split:
    """Split rows into valid and quarantined.

    A row is quarantined when it has a NULL natural key (if ``keys`` given),
    when every configured date column is NULL, or when none of them parses.
    Each date column works alone; with no date column and no key, every row
    is valid. The quarantine frame keeps all input columns plus
    ``quarantine_reason``.
    """
    flagged = df.withColumn(
        REASON,
        reason_column(
            df,
            keys=keys,
            date_columns=[effective_from_column, effective_from_fallback_column],
            time_type=time_type,
            fmt=fmt,
            corrupt_column=corrupt_column,
        ),
    )
    return split_by_reason(flagged)


def quarantine_summary(tables: Mapping[str, DataFrame], reason: str = REASON) -> DataFrame:
    """Quarantined rows per table and reason, with per-table and grand totals.

    One ``rollup`` over the tagged union: rows where ``quarantine_reason`` is
    NULL are per-table totals, the row where both are NULL is the grand total.
    """
    if not tables:
        raise ValueError("quarantine_summary needs at least one table")
    tagged = [
        df.select(F.lit(name).alias("table_name"), F.col(reason).alias("quarantine_reason"))
        for name, df in tables.items()
    ]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return u.rollup("table_name", "quarantine_reason").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))

"""Time parsing and the open-interval sentinel.

Malformed strings never abort a job: every parse uses try-semantics and
yields NULL, which the quarantine step then reports with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the end of an open validity interval, "valid until further notice".
OPEN_END = "9999-12-31"

_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_type(t: T.DataType | str) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    name = t.strip().lower()
    return {
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
        "timestamp_ltz": T.TimestampType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }[name]


def time_type_of(dtype: T.DataType, default: T.DataType | str = "timestamp") -> T.DataType:
    """The time type a column resolves to: itself if it already is a time type,
    ``default`` for strings and anything else."""
    return dtype if isinstance(dtype, _TIME_TYPES) else _as_type(default)


def open_end(dtype: T.DataType | str) -> Column:
    """``DATE/TIMESTAMP '9999-12-31'`` of the given time type (constant-folded)."""
    return F.lit(OPEN_END).cast(_as_type(dtype))


def parse_time(col: str | Column, source: T.DataType, target: T.DataType | str, fmt: str | None = None) -> Column:
    """Turn ``col`` (of type ``source``) into ``target`` without ever failing.

    Strings are parsed with ``try_cast`` (or ``try_to_timestamp`` when a
    format is given); time types are cast. Unparseable values become NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    target = _as_type(target)
    if isinstance(source, T.StringType):
        if fmt is not None:
            parsed = F.try_to_timestamp(c, F.lit(fmt))
            return parsed.cast(target)
        return c.try_cast(target)
    if isinstance(source, _TIME_TYPES):
        return c if source == target else c.cast(target)
    return c.try_cast(target)

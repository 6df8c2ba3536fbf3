"""Content-derived 60-bit keys.

``content_key`` is deterministic across runs, partitionings, session time zones
and engines: the same parts give the same BIGINT in Spark and in any SQL engine
that has ``md5``. The hashed text is injective: every part is written as its length,
a colon and its text, NULL as a mark that no length can be, so neither
separators inside a value nor the text "<null>" can make two rows look alike.
Equivalent SQL (DuckDB), for a text, integer or date part ``a``::

    coalesce(length(CAST(a AS VARCHAR)) || ':' || CAST(a AS VARCHAR), '-')

Times count as microseconds since 1970 (``epoch_us``). The text form of
floating-point numbers differs between engines; leave them out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands for NULL; no part begins with it.
NULL_MARK = "-"


def part_text(c: Column, dt: T.DataType | None = None) -> Column:
    """One part of the hashed text."""
    if isinstance(dt, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(dt, T.TimestampNTZType):
        # Wall-clock times are read as UTC.
        c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def content_key(parts: Sequence[str | Column], df: DataFrame | None = None) -> Column:
    """First 60 bits of ``md5`` over the text of ``parts``, as BIGINT (never NULL).
    ``df`` gives the types of named parts, by which times are recognised."""
    if not parts:
        raise ValueError("content_key needs at least one column")
    types = {} if df is None else {f.name: f.dataType for f in df.schema.fields}
    text = [part_text(F.col(p), types.get(p)) if isinstance(p, str) else part_text(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat(*text)), 1, 15), 16, 10).cast("bigint")

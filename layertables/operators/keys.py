"""Surrogate keys.

The key of a version is a hash of its content (natural key, start and
tracked values), so it is the same on every run, for every partitioning and
for every executor that recomputes it; facts that already point at a
version keep pointing at it. No shuffle, no driver round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layertables.functions.hashing import content_key
from layertables.operators.history import IS_CURRENT, VALID_FROM, VALID_TO, _orderable


def add_surrogate_key(df: DataFrame, key_column_name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Add a BIGINT, never-NULL key as the first column.

    ``columns`` are the hashed parts; by default every column except
    ``effective_to`` and ``is_current``, which change when a version closes
    and therefore must not change its key. Rows with equal parts share a
    key: pass the natural key, ``effective_from`` and the tracked columns for
    a history (those are unique per version after a merge).
    """
    parts = list(columns) if columns else [c for c in df.columns if c not in (VALID_TO, IS_CURRENT, key_column_name)]
    keyed = df.withColumn(key_column_name, content_key(parts, df))
    return keyed.select(key_column_name, *[c for c in df.columns if c != key_column_name])


#: Rows that one task numbers, on average.
DENSE_ROWS = 500_000
_DENSE_SAMPLE = 0.01
_SUPER = 1024
_KB, _KS, _KH = "__lt_kb", "__lt_ks", "__lt_kh"


def dense_buckets(df: DataFrame, *, rows: int = DENSE_ROWS, buckets: int | None = None) -> DataFrame:
    """Adds the group in which a row is numbered: a bucket by the hash of the whole row, as many as
    give ``rows`` rows each, and inside it a part: rows repeated over ``rows`` times are dealt to parts of their own.

    Repeated rows are found in a sample and then counted exactly, so the groups depend on the
    rows alone, not on how they are dealt."""
    hashed = [f.name for f in df.schema.fields if _orderable(f.dataType)]
    u = df.withColumn(_KH, F.xxhash64(*hashed))
    total = df.count() if buckets is None else 0
    u = u.withColumn(_KB, F.pmod(_KH, F.lit(buckets or max(1, -(-total // rows)))))
    if total <= rows:
        return u.withColumn(_KS, F.lit(0)).drop(_KH)
    slim = u.select(_KH)
    seen = slim.sample(False, _DENSE_SAMPLE, 17).groupBy(_KH).count().filter(F.col("count") > rows * _DENSE_SAMPLE / 2)
    hot = slim.join(seen.select(_KH), _KH, "left_semi").groupBy(_KH).agg(F.count("*").alias("n")).filter(F.col("n") > rows)
    hot = hot.select(_KH, F.ceil(F.col("n") / rows).alias("parts"))
    # Repeats of one row are alike, so any deal of them will do.
    part = F.when(F.col("parts").isNotNull(), 1 + F.pmod(F.monotonically_increasing_id(), F.col("parts"))).otherwise(0)
    return u.join(hot, _KH, "left").withColumn(_KS, part).drop("parts", _KH)


def add_dense_key(
    df: DataFrame, key_column_name: str, order: Sequence[str], existing: DataFrame | None = None, *, buckets: int | None = None
) -> DataFrame:
    """Add a gapless BIGINT key, unique per row, as the first column: for
    dimensions so large that 60 hashed bits could collide.

    Rows are spread over groups of about :data:`DENSE_ROWS` (see :func:`dense_buckets`; ``buckets`` sets
    their number), numbered inside them by ``order`` and then all other columns, and each group begins
    behind the counts of those before it, which are added up in two levels. So no task
    sees more than its group, and the same rows get the same keys on every run.
    With ``existing`` (a table that has the key column), numbers go on behind its
    greatest key: stored keys never change."""
    n, base, row = "__lt_n", "__lt_base", "__lt_row"
    u = dense_buckets(df, buckets=buckets)
    sizes = u.groupBy(_KB, _KS).agg(F.count(F.lit(1)).alias(n)).withColumn("__lt_kg", F.floor(F.col(_KB) / _SUPER))
    above = Window.orderBy("__lt_kg").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__lt_kg").orderBy(_KB, _KS).rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("__lt_kg").agg(F.sum(n).alias(n))
    groups = groups.select("__lt_kg", F.coalesce(F.sum(n).over(above), F.lit(0)).alias("__lt_above"))
    bases = sizes.withColumn(base, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(groups, "__lt_kg")
    bases = bases.select(_KB, _KS, (F.col(base) + F.col("__lt_above")).alias(base))
    if existing is not None:
        top = existing.agg(F.coalesce(F.max(key_column_name), F.lit(0)).alias("__lt_top"))
        bases = bases.crossJoin(F.broadcast(top)).withColumn(base, F.col(base) + F.col("__lt_top")).drop("__lt_top")  # one row
    by = [*order, *[f.name for f in df.schema.fields if f.name not in order and _orderable(f.dataType)]]
    u = u.withColumn(row, F.row_number().over(Window.partitionBy(_KB, _KS).orderBy(*by)))
    u = u.join(bases, [_KB, _KS]).withColumn(key_column_name, (F.col(base) + F.col(row)).cast("bigint"))
    return u.select(key_column_name, *[c for c in df.columns if c != key_column_name])


def history_key_columns(keys: Sequence[str], tracked: Sequence[str]) -> list[str]:
    """The parts that identify one version of a history."""
    return [*keys, VALID_FROM, *tracked]


def key_uniqueness(df: DataFrame, key_column_name: str) -> DataFrame:
    """One row: ``n_rows``, ``n_keys`` (distinct), ``n_null_keys`` — a uniqueness check
    in one aggregate (partial aggregation before the shuffle)."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_distinct(key_column_name).cast("bigint").alias("n_keys"),
        F.sum(F.col(key_column_name).isNull().cast("int")).cast("bigint").alias("n_null_keys"),
    )

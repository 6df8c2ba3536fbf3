"""Hot keys: natural keys that hold so many rows that one task could not
process them in time.

Keyed windows (history merge, as-of join) normally put all rows of a key
into one task. A key holding a large share of the table is instead split
into time buckets: the boundaries are approximate quantiles of its time
column, so every bucket gets a similar number of rows, and each operator
stitches results across bucket seams with a small per-(key, bucket)
summary.

Detection is a sampled count over the key and time columns only (parquet
reads just those columns). It runs only when Catalyst's size estimate of
the input is above ``min_input_bytes``; below that a single task handles any
key and no extra pass is made. Results never depend on it. Every hot key is
split: a key can only be hot when its sampled count reaches ``hot_rows *
sample_fraction``, so there are at most rows / ``hot_rows`` of them; the list is
collected and turned back into a local relation, so bucket assignment is a
constant, deterministic on every retry. A key gets as many buckets as keep
each near ``bucket_rows`` rows, ``MAX_BUCKETS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOUNDS = "__lt_bounds"
BUCKET = "__lt_bkt"


@dataclass(frozen=True)
class SkewSpec:
    """When and how hot keys are split."""

    hot_rows: int = 4_000_000
    sample_fraction: float = 0.01
    bucket_rows: int = 1_000_000
    min_input_bytes: int = 1 << 30
    seed: int = 17


# Buckets of a key at most.
MAX_BUCKETS = 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (no job runs)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - an unknown estimate means "assume big"
        return 1 << 62


def broadcast_threshold(spark) -> int:
    """Bytes up to which Spark broadcasts a side of a join (0: never)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    return max(0, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw)) if not raw.lstrip("-").isdigit() else int(raw))


def hot_key_bounds(
    df: DataFrame, keys: Sequence[str], time_col: str, spec: SkewSpec | None, size: int | None = None
) -> DataFrame | None:
    """``(keys..., __lt_bounds)`` for every hot key, or ``None`` when there is none.

    ``__lt_bounds`` is the sorted array of bucket boundaries (times). ``size`` is the
    size estimate of ``df`` where the caller has one. Keys are counted first; quantiles are
    taken of the hot ones alone.
    """
    if spec is None or (estimated_bytes(df) if size is None else size) < spec.min_input_bytes:
        return None
    s = df.select(*keys, time_col).filter(F.col(time_col).isNotNull())
    for k in keys:
        s = s.filter(F.col(k).isNotNull())
    if spec.sample_fraction < 1:
        s = s.sample(withReplacement=False, fraction=spec.sample_fraction, seed=spec.seed)
    threshold = max(1, math.ceil(spec.hot_rows * spec.sample_fraction))
    counts = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("__lt_n")).filter(F.col("__lt_n") >= threshold).collect()
    if not counts:
        return None
    key_fields = [df.schema[k] for k in keys]
    hot = df.sparkSession.createDataFrame(
        [tuple(r) for r in counts], T.StructType([*key_fields, T.StructField("__lt_n", T.LongType(), False)])
    )
    per_bucket = max(1, math.ceil(spec.bucket_rows * spec.sample_fraction))
    # As many quantiles as the hottest key needs; other keys use every n-th of them.
    grid = min(MAX_BUCKETS, max(2, -(-max(r["__lt_n"] for r in counts) // per_bucket)))
    pct = [i / grid for i in range(1, grid)]
    step = F.greatest(F.lit(1), F.floor(F.lit(grid) * per_bucket / F.col("__lt_n"))).cast("int")
    agg = (
        s.join(hot.select(*keys), list(keys), "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(time_col, pct, 10_000).alias(BOUNDS))
        .join(hot, list(keys))
        .withColumn("__lt_step", step)
        .withColumn(BOUNDS, F.filter(BOUNDS, lambda _, i: (i + 1) % F.col("__lt_step") == 0))
        .select(*keys, F.sort_array(F.array_distinct(BOUNDS)).alias(BOUNDS))
    )
    rows = agg.collect()
    if not rows:
        return None
    tt = df.schema[time_col].dataType
    schema = T.StructType(key_fields + [T.StructField(BOUNDS, T.ArrayType(tt), False)])
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def tag_buckets(df: DataFrame, bounds: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """Add ``__lt_bkt``: the bucket of a hot key's row (number of boundaries at
    or before its time; rows without a time go to bucket 0), NULL for all
    other keys. Spark broadcasts the bounds where they are below its threshold."""
    b = F.col(BOUNDS)
    t = F.col(time_col)
    bucket = F.when(b.isNotNull(), F.size(F.filter(b, lambda x: x <= t)))
    return df.join(bounds, list(keys), "left").withColumn(BUCKET, bucket).drop(BOUNDS)

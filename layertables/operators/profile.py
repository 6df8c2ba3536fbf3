"""Drift of values: profiles of a load's columns, kept with it and compared with the next one's.

A profile has a row a column: rows, NULLs, a sketch of the distinct values (HyperLogLog) and,
for numbers, dates and times, a sketch of their distribution (KLL). All are Spark's own
aggregates with a partial step, one pass over the data; profiles of parts merge into the
profile of the whole, so a table's profile needs no second look at old loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "column_name string, n_rows bigint, n_null bigint, distinct_sketch binary, values_sketch binary"
# Quantiles at which two distributions are compared.
_GRID = [k / 100 for k in range(101)]


def _number(name: str, t: T.DataType) -> Column | None:
    """The column as a number whose order is that of the values."""
    c = F.col(name)
    if isinstance(t, T.NumericType):
        return c.cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return None


def profile(df: DataFrame, columns: list[str] | None = None, *, log_k: int = 14, k: int = 800) -> DataFrame:
    """One row a column (nested, map and binary columns: counts and NULLs only). ``log_k`` and ``k`` are
    the sizes of the sketches: errors near ``1.04 / sqrt(2 ** log_k)`` and ``2.3 / k``."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs, none = [], F.lit(None).cast("binary")
    for i, f in enumerate(fields):
        c, t = F.col(f.name), f.dataType
        plain = not isinstance(t, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)) and type(t).__name__ != "VariantType"
        number = _number(f.name, t)
        aggs += [
            F.count(c).alias(f"c{i}"),
            (F.hll_sketch_agg(c.cast("string"), F.lit(log_k)) if plain else F.first(none)).alias(f"d{i}"),
            # NaN has no place in an order.
            (F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(k)) if number is not None else F.first(none)).alias(f"v{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("n_null"),
            F.col(f"d{i}").alias("distinct_sketch"),
            F.col(f"v{i}").alias("values_sketch"),
        )
        for i, f in enumerate(fields)
    ]
    if not rows:
        raise ValueError("a profile needs one column or more")
    return df.agg(F.count(F.lit(1)).alias("n"), *aggs).select(F.inline(F.array(*rows)))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of all rows that the given profiles (unioned) were made of."""
    return profiles.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_union_agg("distinct_sketch", F.lit(True)).alias("distinct_sketch"),
        F.kll_merge_agg_double("values_sketch").alias("values_sketch"),
    )


@dataclass(frozen=True)
class Limits:
    """What counts as a shift."""

    null_share: float = 0.05  # change of the share of NULLs
    distinct: float = 1.5  # factor between the numbers of distinct values, either way
    distance: float = 0.1  # greatest difference of the two distribution functions


def _quantiles(sketch: Column) -> Column:
    there = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(there, F.kll_sketch_get_quantile_double(F.when(there, sketch), F.array(*[F.lit(x) for x in _GRID])))


def _distance(a: Column, b: Column) -> Column:
    """Greatest difference of two distribution functions, given by their quantiles."""
    share = lambda q, x: F.size(F.filter(q, lambda y: y <= x))
    apart = lambda q: F.array_max(F.transform(q, lambda x: F.abs(share(a, x) - share(b, x))))
    return F.greatest(apart(a), apart(b)) / F.lit(float(len(_GRID)))


def compare_profiles(before: DataFrame, after: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row a column that both have: counts and NULLs before and after, estimated distinct values,
    ``distance`` of the distributions (NULL where there is none), ``shifted``, and ``reasons``."""
    def side(p: DataFrame, mark: str) -> DataFrame:
        return p.select(
            "column_name",
            *[F.col(c).alias(f"{c}_{mark}") for c in ("n_rows", "n_null")],
            F.hll_sketch_estimate("distinct_sketch").alias(f"distinct_{mark}"),
            _quantiles(F.col("values_sketch")).alias(f"q_{mark}"),
        )

    both = side(before, "before").join(side(after, "after"), "column_name").withColumn("distance", _distance(F.col("q_before"), F.col("q_after")))
    null_share = lambda m: F.try_divide(F.col(f"n_null_{m}"), F.col(f"n_rows_{m}"))
    more, less = F.greatest("distinct_before", "distinct_after"), F.least("distinct_before", "distinct_after")
    reasons = {
        "nulls": F.abs(null_share("before") - null_share("after")) > limits.null_share,
        "distinct": more > less * limits.distinct,
        "distribution": F.col("distance") > limits.distance,
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in reasons.items()]))
    both = both.withColumn("reasons", F.array_join(found, ",")).withColumn("shifted", F.col("reasons") != "")
    marks = [f"{c}_{m}" for c in ("n_rows", "n_null", "distinct") for m in ("before", "after")]
    return both.select("column_name", *marks, "distance", "shifted", "reasons")

"""As-of (temporal) join: attach to every fact the dimension version valid at
the fact's time, ``dim.effective_from <= fact.ts < dim.effective_to``, as a
LEFT join: facts without a version (or with a NULL key or time) keep NULLs.

One meaning, whatever the plan: a version is in force until its own end or the
start of its key's next version, whichever comes first (of versions with one
start, the one that ends last counts; further ties go to the greatest values). So
each fact matches at most one version and the fact row count is preserved, also
when intervals overlap; for disjoint ones, as the history merge makes them, this is
the plain definition. A version whose end is NULL is open.

Two plans, chosen by ``method``, with the same rows:

* ``"join"``: the dimension's ends are cut at the next start by one keyed window, then
  an equi join on the key with the range as a residual condition. With a
  broadcast dimension no fact row is shuffled.
* ``"window"``: facts and versions are unioned, hash-partitioned once on the
  key and sorted by time; each fact takes the last version that started at
  or before it (``last(..., ignorenulls)`` over a running frame) and keeps
  it if the fact is before the version's end. Linear in facts + versions,
  whatever the number of versions per key. Hot keys are split into time
  buckets (see :mod:`layertables.operators.skew`); each bucket receives the
  last version of the buckets before it, computed from the dimension alone.
* ``"auto"`` (default): ``"join"`` when Catalyst estimates the needed dimension
  columns below Spark's broadcast threshold, else ``"window"``. No job runs.

A slice of facts (a day, say) needs few of the versions. With ``prune=True`` the least and
greatest fact time of every key bucket are taken first, in one pass over the facts'
key and time, and versions that no fact of their bucket can fall into are left out before the
join; the overall bounds are plain comparisons that reach the dimension's files. Rows
are the same: versions that start after the last fact never matter, and those that end before
the first one are left out only where ``disjoint=True`` says that the versions of a key
do not overlap (as in every merged history), since an overlapping one could cut another short.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layertables.functions.predicates import any_null
from layertables.functions.time import open_end
from layertables.operators.history import VALID_FROM, VALID_TO, _orderable
from layertables.operators.skew import BOUNDS, BUCKET, SkewSpec, broadcast_threshold, estimated_bytes, hot_key_bounds, tag_buckets

_P = "__lt_d_"
_T = "__lt_t"
_KIND = "__lt_kind"
_PAY = "__lt_pay"
_GOT = "__lt_got"
_LASTV = "__lt_lastv"
_B, _LO, _HI = "__lt_b", "__lt_lo", "__lt_hi"
METHODS = ("auto", "join", "window")


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: str | Sequence[str],
    fact_time: str,
    dim_keys: str | Sequence[str] | None = None,
    columns: Sequence[str] | dict[str, str] = (),
    *,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    method: str = "auto",
    skew: SkewSpec | None = SkewSpec(),
    prune: bool = False,
    disjoint: bool = False,
) -> DataFrame:
    """LEFT as-of join. Returns all fact columns plus the requested dimension
    columns (a list, or a ``{dim_column: output_name}`` mapping).

    The fact time is cast to the dimension's time type when they differ
    (e.g. a TIMESTAMP fact against DATE validity compares its day).
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    fk = _as_list(fact_keys)
    dk = _as_list(dim_keys) if dim_keys is not None else fk
    if len(fk) != len(dk):
        raise ValueError("fact_keys and dim_keys must have the same length")
    wanted = dict(columns) if isinstance(columns, dict) else {c: c for c in columns}
    clash = [o for o in wanted.values() if o in fact.columns]
    if clash:
        raise ValueError(f"output columns already in fact: {clash}")

    tt = dim.schema[valid_from].dataType
    ft = fact.schema[fact_time].dataType
    t = F.col(fact_time) if ft == tt else F.col(fact_time).cast(tt)
    needed = list(dict.fromkeys([*dk, valid_from, valid_to, *wanted]))
    if prune:
        dim = prune_versions(dim, fact, fk, t, dk, valid_from, valid_to, disjoint=disjoint)
    if method == "auto":
        small = estimated_bytes(dim.select(*needed)) <= broadcast_threshold(fact.sparkSession)
        method = "join" if small else "window"
    if method == "window":
        return _asof_window(fact, dim, fk, dk, t, wanted, valid_from, valid_to, skew)
    # Unique names on the dimension side: safe even when both sides share lineage.
    dim = dim.withColumn(valid_to, _end(dim, valid_to))
    d = _in_force(dim.select(*[F.col(c).alias(_P + c) for c in needed]), [_P + k for k in dk], _P + valid_from, _P + valid_to)
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(_P + k) for f, k in zip(fk, dk)])
    cond = cond & (t >= F.col(_P + valid_from)) & (t < F.col(_P + valid_to))
    return fact.join(d, cond, "left").select(*fact.columns, *[F.col(_P + c).alias(o) for c, o in wanted.items()])


def _end(dim: DataFrame, valid_to: str) -> Column:
    """The end of a version, the open one where it is NULL."""
    return F.coalesce(F.col(valid_to), open_end(dim.schema[valid_to].dataType))


#: Key buckets whose time bounds are taken apart; as many rows reach the driver.
PRUNE_BUCKETS = 64


def prune_versions(
    dim: DataFrame,
    fact: DataFrame,
    fact_keys: str | Sequence[str],
    fact_time: str | Column,
    dim_keys: str | Sequence[str] | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    *,
    disjoint: bool = False,
) -> DataFrame:
    """The versions that the facts can need (see the module text). Runs one job, over
    the facts' key and time."""
    fk = _as_list(fact_keys)
    dk = _as_list(dim_keys) if dim_keys is not None else fk
    t = (F.col(fact_time) if isinstance(fact_time, str) else fact_time).cast(dim.schema[valid_from].dataType)
    alike = [F.col(f).cast(dim.schema[k].dataType) for f, k in zip(fk, dk)]
    place = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(PRUNE_BUCKETS)).cast("int")
    slim = fact.select(place(alike).alias("b"), t.alias("t")).filter(F.col("t").isNotNull())
    bounds = slim.groupBy("b").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect()
    if not bounds:
        return dim.limit(0)
    lo, hi = min(r["lo"] for r in bounds), max(r["hi"] for r in bounds)
    start, end = F.col(valid_from), F.col(valid_to)
    out = dim.filter(start <= F.lit(hi))
    if disjoint:
        out = out.filter(end.isNull() | (end > F.lit(lo)))
    # The same by bucket: a constant table of at most PRUNE_BUCKETS rows.
    kind = dim.schema[valid_from].dataType
    schema = T.StructType([T.StructField(_B, T.IntegerType()), T.StructField(_LO, kind), T.StructField(_HI, kind)])
    table = dim.sparkSession.createDataFrame([tuple(r) for r in bounds], schema)
    near = F.col(_HI) >= start
    if disjoint:
        near = near & (end.isNull() | (end > F.col(_LO)))
    out = out.withColumn(_P + "b", place([F.col(k) for k in dk]))
    return out.join(F.broadcast(table), (F.col(_P + "b") == F.col(_B)) & near, "left_semi").drop(_P + "b")


def _rank(dim: DataFrame, first: list[str]) -> list[str]:
    """Columns that decide between versions of one start, the least first."""
    return first + [c for c in dim.columns if c not in first and _orderable(dim.schema[c].dataType)]


def _in_force(d: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """One version per key and start, each ending at the next start at the latest."""
    d = d.filter(~any_null([*keys, start]))
    order = _rank(d, [end])
    w = Window.partitionBy(*keys).orderBy(F.col(start), *[F.col(c) for c in order if c not in keys and c != start])
    nxt = F.lead(start).over(w)
    d = d.withColumn(_T, nxt).filter(F.col(_T).isNull() | (F.col(_T) > F.col(start)))
    return d.withColumn(end, F.least(F.col(end), F.coalesce(F.col(_T), F.col(end)))).drop(_T)


def _asof_window(fact, dim, fk, dk, t, wanted, valid_from, valid_to, skew) -> DataFrame:
    keys = [f"__lt_k{i}" for i in range(len(fk))]
    f = fact.withColumns({**{k: F.col(c) for k, c in zip(keys, fk)}, _T: t, _KIND: F.lit(1)})
    # NULL keys or times never match; they skip the shuffle (and cannot form
    # one giant NULL group).
    unmatched = f.filter(any_null([*keys, _T]))
    f = f.filter(~any_null([*keys, _T]))
    names = list(wanted)
    pay = F.struct(
        F.col(valid_from).alias("f"), _end(dim, valid_to).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]
    )
    d = dim.select(
        *[F.col(c).alias(k) for k, c in zip(keys, dk)], F.col(valid_from).alias(_T), F.lit(0).alias(_KIND), pay.alias(_PAY)
    ).filter(~any_null([*keys, _T]))
    u = f.unionByName(d, allowMissingColumns=True)

    bounds = hot_key_bounds(u, keys, _T, skew)
    if bounds is None:
        matched = _running_last(u.repartition(*keys), keys)
    else:
        tagged = tag_buckets(u, bounds, keys, _T)
        cold = _running_last(tagged.filter(F.col(BUCKET).isNull()).drop(BUCKET).repartition(*keys), keys)
        hot = tagged.filter(F.col(BUCKET).isNotNull())
        part = [*keys, BUCKET]
        # Last version of every hot (key, bucket), from the dimension rows only.
        last_in = hot.filter(F.col(_KIND) == 0).groupBy(*part).agg(
            F.max_by(_PAY, F.struct(F.col(_T), *_payload_order(hot))).alias(_LASTV)
        )
        every = bounds.select(*keys, F.explode(F.sequence(F.lit(0), F.size(BOUNDS))).alias(BUCKET))
        carry = (
            every.join(last_in, part, "left")
            .withColumn(
                _LASTV,
                F.last(_LASTV, ignorenulls=True).over(
                    Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
                ),
            )
            .filter(F.col(_LASTV).isNotNull())
            .select(*part, F.col(_LASTV).getField("f").alias(_T), F.lit(0).alias(_KIND), F.col(_LASTV).alias(_PAY))
        )
        hot = hot.unionByName(carry, allowMissingColumns=True)
        matched = cold.unionByName(_running_last(hot.repartition(*part), part).drop(BUCKET))
    got = F.col(_GOT)
    ok = got.isNotNull() & (F.col(_T) < got.getField("t"))
    out_m = matched.select(*fact.columns, *[F.when(ok, got.getField(f"c{i}")).alias(wanted[c]) for i, c in enumerate(names)])
    out_u = unmatched.select(*fact.columns, *[F.lit(None).cast(dim.schema[c].dataType).alias(wanted[c]) for c in names])
    return out_m.unionByName(out_u)


def _payload_order(u: DataFrame) -> list:
    """The end first, then the other payload columns that have an order."""
    fields = [f for f in u.schema[_PAY].dataType.fields if f.name != "f" and _orderable(f.dataType)]
    return [F.col(_PAY).getField(f.name) for f in fields]


def _running_last(u: DataFrame, part: Sequence[str]) -> DataFrame:
    """For every fact: the last version at or before its time in ``part``
    (versions sort before facts of the same time; of two versions with one
    start the longer one is last, so a zero-length correction never wins)."""
    w = Window.partitionBy(*part).orderBy(F.col(_T), F.col(_KIND), *_payload_order(u))
    got = F.last(_PAY, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return u.withColumn(_GOT, got).filter(F.col(_KIND) == 1)


@dataclass(frozen=True)
class AsOf:
    """One dimension lookup of a fact table."""

    dim: DataFrame
    fact_keys: str | Sequence[str]
    fact_time: str
    columns: Sequence[str] | dict[str, str]
    dim_keys: str | Sequence[str] | None = None
    valid_from: str = VALID_FROM
    valid_to: str = VALID_TO
    method: str = "auto"
    prune: bool = False
    disjoint: bool = False


def build_fact(fact: DataFrame, lookups: Sequence[AsOf], select: Sequence[str] | None = None) -> DataFrame:
    """Chain as-of lookups onto a fact table and project the output columns."""
    out = fact
    for lk in lookups:
        out = asof_join(
            out,
            lk.dim,
            lk.fact_keys,
            lk.fact_time,
            lk.dim_keys,
            lk.columns,
            valid_from=lk.valid_from,
            valid_to=lk.valid_to,
            method=lk.method,
            prune=lk.prune,
            disjoint=lk.disjoint,
        )
    return out.select(*select) if select else out

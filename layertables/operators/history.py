"""SCD2 history: validity columns, the history merge and its views.

A history row is a business row plus ``effective_from``, ``effective_to``
(half-open ``[from, to)``, open end ``9999-12-31``) and ``is_current``.

The merge is one keyed pass instead of a chain of joins: history and batch
are unioned, hash-partitioned once on the natural key, and every later step
is a window *within* that key, so the one exchange and one sort serve all
of them (no join of the history). A batch row opens a version only when
its tracked values differ null-safely from the row just before it in time,
which covers new, changed, unchanged, late, repeated and replayed rows with
one rule:

* batch rows are first reduced to one per (key, effective_from) by a
  declared tie-break, in the same sort; of keys found hot they are reduced by an
  aggregate that is combined before its exchange, so that very many rows
  repeated for one key and date never meet in one task;
* a surviving batch row whose (key, effective_from, tracked values) is
  already stored is a replay and is dropped (after the tie-break, so a
  rerun picks the same row and changes nothing);
* a batch row that starts inside a stored interval ends with it at the
  latest, so a late row never reopens a closed key;
* order each key by (effective_from, source, effective_to, tracked) and keep
  a batch row when it is the first of its key, differs from its
  predecessor, or follows a gap;
* ``effective_to = least(effective_to, next effective_from)``, so a closed
  version always ends exactly where its successor starts and existing gaps
  stay.

Batch rows with a NULL key are not loadable and left out (``apply_scd2``
quarantines them); stored ones are passed on. A stored version whose end is NULL is open.

:func:`merge_changes` gives the same merge as the rows that it inserts, closes and
deletes; :func:`apply_changes` brings them into a stored history.

For a large history and a small batch (the daily case: the history's size
estimate is at least ``split_ratio`` times the batch's, and the batch keys are
below Spark's broadcast threshold) the history is first split by a semi/anti
join on the batch keys; only history rows of touched keys are shuffled. Rows
are the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layertables.functions.predicates import any_null
from layertables.functions.time import open_end, parse_time, time_type_of
from layertables.operators.quarantine import Split, separate_quarantine_records
from layertables.operators.skew import BUCKET, SkewSpec, broadcast_threshold, estimated_bytes, hot_key_bounds, tag_buckets

VALID_FROM = "effective_from"
VALID_TO = "effective_to"
IS_CURRENT = "is_current"
VALIDITY = (VALID_FROM, VALID_TO, IS_CURRENT)

MISSING_KEY_POLICIES = ("keep", "close", "drop")
STRATEGIES = ("auto", "window", "split")

# "auto" splits only when the history is estimated this many times the batch.
SPLIT_RATIO = 4.0

_SRC = "__lt_src"
_RN = "__lt_rn"
_PRESENT = "__lt_present"
_REPLAY = "__lt_replay"
_PREV = "__lt_prev"
_PREV_T = "__lt_prev_t"
_PREV_TO = "__lt_prev_to"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- H1


def resolve_effective_from(
    df: DataFrame,
    effective_from_column: str | None = None,
    effective_from_fallback_column: str | None = None,
    effective_from_ts: Any = None,
    *,
    time_type: T.DataType | str | None = None,
    fmt: str | None = None,
    now: Any = None,
) -> DataFrame:
    """Add ``effective_from``, ``effective_to`` (open end) and ``is_current``.

    ``effective_from`` is the first of: the parsed ``effective_from_column``,
    the parsed fallback column, ``effective_from_ts``; without any of them it is ``now``, the
    time of the run (by default the query's start time). Each column works alone. Unparseable strings count as missing (they are
    quarantined before a merge, see :func:`apply_scd2`). ``time_type``
    defaults to the first column's type when it is a date/timestamp, else
    TIMESTAMP.
    """
    cols = [c for c in (effective_from_column, effective_from_fallback_column) if c]
    if time_type is None:
        time_type = time_type_of(df.schema[cols[0]].dataType) if cols else T.TimestampType()
    tt = time_type_of(T.NullType(), time_type)
    parts = [parse_time(c, df.schema[c].dataType, tt, fmt) for c in cols]
    if effective_from_ts is not None:
        parts.append((effective_from_ts if isinstance(effective_from_ts, Column) else F.lit(effective_from_ts)).cast(tt))
    if not parts:
        parts.append((F.current_timestamp() if now is None else F.lit(now)).cast(tt))
    start = parts[0] if len(parts) == 1 else F.coalesce(*parts)
    return df.withColumns({VALID_FROM: start, VALID_TO: open_end(tt), IS_CURRENT: F.lit(True)})


# --------------------------------------------------------------------------- views (H3)


def current_view(history: DataFrame) -> DataFrame:
    """Open versions only (one per key)."""
    return history.filter(F.col(IS_CURRENT))


def closed_view(history: DataFrame) -> DataFrame:
    """Closed versions only."""
    return history.filter(~F.col(IS_CURRENT))


def as_of_view(history: DataFrame, at: Any) -> DataFrame:
    """The version of every key valid at ``at`` (half-open intervals)."""
    t = at if isinstance(at, Column) else F.lit(at).cast(history.schema[VALID_FROM].dataType)
    return history.filter((F.col(VALID_FROM) <= t) & (t < F.col(VALID_TO)))


# --------------------------------------------------------------------------- merge (H2 H4 H5 H6)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def default_tie_break(df: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> list[Column]:
    """Least row first: tracked columns, then the other business columns,
    each ascending with NULLs first. Deterministic for any input."""
    rest = [c for c in df.columns if c not in keys and c not in tracked and c not in VALIDITY and not c.startswith("__lt_")]
    cols = [c for c in list(tracked) + rest if _orderable(df.schema[c].dataType)]
    return [F.col(c).asc_nulls_first() for c in cols]


def _prepare(incoming: DataFrame, existing: DataFrame | None) -> tuple[DataFrame, DataFrame | None, list[str], T.DataType]:
    if VALID_FROM not in incoming.columns:
        raise ValueError(f"incoming needs a '{VALID_FROM}' column; call resolve_effective_from first")
    tt = incoming.schema[VALID_FROM].dataType
    if existing is not None and VALID_FROM in existing.columns:
        stored = existing.schema[VALID_FROM].dataType
        if isinstance(stored, T.DateType) and not isinstance(tt, (T.DateType, T.NullType)):
            raise ValueError(
                f"the history keeps {VALID_FROM} as DATE; a batch of {tt.simpleString()} would lose its times: "
                "widen the history or cast the batch"
            )
        tt = stored
    to = F.coalesce(F.col(VALID_TO).cast(tt), open_end(tt)) if VALID_TO in incoming.columns else open_end(tt)
    inc = incoming.withColumns({VALID_FROM: F.col(VALID_FROM).cast(tt), VALID_TO: to, IS_CURRENT: F.lit(True)})
    if existing is not None and not existing.columns:
        existing = None
    if existing is not None:
        missing = [c for c in VALIDITY if c not in existing.columns]
        if missing:
            raise ValueError(f"existing history lacks {missing}")
        existing = existing.withColumns({VALID_TO: F.coalesce(F.col(VALID_TO).cast(tt), open_end(tt))})
        base = [c for c in existing.columns if c not in VALIDITY]
        base += [c for c in inc.columns if c not in VALIDITY and c not in base]
    else:
        base = [c for c in inc.columns if c not in VALIDITY]
    return inc, existing, base + list(VALIDITY), tt


_RNW = "__lt_rnw"
_LAST = "__lt_last"
_LEAD = "__lt_lead"
_HASB = "__lt_hasb"
_KEEP1 = "__lt_keep1"
_NEXT = "__lt_next"
_PRES_K = "__lt_pres_k"
_IN_TO = "__lt_in_to"
_PICK = "__lt_pick"
_ORDER_TO = "__lt_order_to"
_CARRIED = "__lt_carried"
_OLD_TO = "__lt_old_to"
_GONE = "__lt_gone"


def _one_per_date(inc: DataFrame, keys: list[str], tracked: list[str], tie_break: Sequence[Column] | None) -> DataFrame:
    """The tie-break as an aggregate: one batch row per (key, effective_from)."""
    at = [*keys, VALID_FROM]
    rest = [c for c in inc.columns if c not in at]
    if tie_break is not None:
        w = Window.partitionBy(*at).orderBy(*tie_break)
        return inc.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    # The default order is the order of structs: ascending, NULLs first.
    order = [VALID_TO, *tracked, *[c for c in rest if c not in tracked and c not in VALIDITY]]
    order = [c for c in order if c in rest and _orderable(inc.schema[c].dataType)]
    pick = F.min_by(F.struct(*rest), F.struct(*order))
    return inc.groupBy(*at).agg(pick.alias(_PICK)).select(*[c if c in at else F.col(f"{_PICK}.{c}").alias(c) for c in inc.columns])


def _carry_ends(u: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_IN_TO``: the end of the last stored version in the buckets before."""
    part = [*keys, BUCKET]
    ends = u.filter(F.col(_SRC) == 0).groupBy(*part).agg(F.max_by(VALID_TO, F.struct(VALID_FROM, VALID_TO)).alias(_IN_TO))
    every = u.select(*part).distinct().join(ends, part, "left")
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return u.join(every.withColumn(_IN_TO, F.last(_IN_TO, ignorenulls=True).over(before)), part, "left")


def _local_pass(
    u: DataFrame, part: list[str], tracked: list[str], tie: list[Column], missing_keys: str, single: bool = False
) -> DataFrame:
    """The merge inside one partition group ``part`` (the key, or key and
    time bucket): tie-break, replay drop, ends of late rows, collapse, next start. Every window
    partitions by ``part`` plus more, so the one exchange on ``part`` serves
    all of them. Adds ``_RNW`` (position), ``_LAST`` (last row before the
    collapse), ``_LEAD`` (next kept start) and ``_HASB`` (group has batch rows).
    ``_IN_TO``, if there, is the end of the last stored version before the group.
    ``single``: batch rows only (first load), so no source order and no replays."""
    src = F.col(_SRC)
    vals = F.struct(*[F.col(t) for t in tracked])
    # One total order per key. Every window below partitions by a prefix of
    # (part, effective_from, src) and orders by the rest of it, so all of them
    # are served by one sort after the one exchange. (With one source the
    # constant src is left out: Catalyst would fold it out of some orders only.)
    srcs = [] if single else [_SRC]
    u = u.withColumn(_ORDER_TO, F.col(VALID_TO))
    order = [F.col(VALID_FROM).asc(), *[F.col(c).asc() for c in srcs], F.col(_ORDER_TO).asc(), *tie]
    w_day = Window.partitionBy(*part, VALID_FROM).orderBy(*order[1:])
    w = Window.partitionBy(*part).orderBy(*order)

    if missing_keys != "keep":
        u = u.withColumn(_HASB, F.max(F.when(src >= 1, 1).otherwise(0)).over(Window.partitionBy(*part)))
        u = u.filter(src < 2)

    # The tie-break: one batch row per (key, effective_from).
    same = Window.partitionBy(*part, VALID_FROM, *srcs).orderBy(*order[1 + len(srcs) :])
    u = u.withColumn(_RN, F.row_number().over(same)).filter((src == 0) | (F.col(_RN) == 1)).drop(_RN)

    if not single:
        # Replay: the batch's row for (key, effective_from) is already stored.
        day = w_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        u = u.withColumn(_REPLAY, F.first(F.when(src == 1, vals), ignorenulls=True).over(day))
        stored = F.max(F.when((src == 0) & vals.eqNullSafe(F.col(_REPLAY)), 1)).over(day)
        u = u.withColumn(_REPLAY, (src == 1) & (F.coalesce(stored, F.lit(0)) == 1)).filter(~F.col(_REPLAY))

        # A batch row inside a stored interval ends with it at the latest.
        inside = F.last(F.when(src == 0, F.col(VALID_TO)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        if _IN_TO in u.columns:
            inside = F.coalesce(inside, F.col(_IN_TO))
        u = u.withColumn(_PREV_TO, inside)
        late = (src == 1) & (F.col(_PREV_TO) > F.col(VALID_FROM))
        u = u.withColumn(VALID_TO, F.when(late, F.least(F.col(VALID_TO), F.col(_PREV_TO))).otherwise(F.col(VALID_TO)))

    # Collapse: a batch row survives only if it starts a new run of values.
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    u = u.withColumns(
        {
            _PREV: F.lag(F.lit(1)).over(w),
            _PREV_T: F.lag(vals).over(w),
            _PREV_TO: F.lag(VALID_TO).over(w),
            _RNW: F.row_number().over(w),
            _LAST: F.last(F.struct(vals.alias("v"), F.col(VALID_TO).alias("t"))).over(whole),
        }
    )
    keep = (src == 0) | F.col(_PREV).isNull() | ~vals.eqNullSafe(F.col(_PREV_T)) | (F.col(_PREV_TO) < F.col(VALID_FROM))
    return u.filter(keep).withColumn(_LEAD, F.lead(VALID_FROM).over(w))


def _finish(u: DataFrame, next_start: Column, present: Column | None, end: Column, missing_keys: str, close_at: Column | None) -> DataFrame:
    """Close each version where its successor starts; existing gaps stay. ``_GONE`` marks
    versions that the policy for missing keys removes."""
    u = u.withColumn(VALID_TO, F.least(F.col(VALID_TO), F.coalesce(F.col(_LEAD), next_start, end)))
    if missing_keys == "close":
        absent_open = (present == 0) & (F.col(VALID_TO) == end)
        u = u.withColumn(VALID_TO, F.when(absent_open, F.greatest(F.col(VALID_FROM), close_at)).otherwise(F.col(VALID_TO)))
    gone = (present == 0) & (F.col(VALID_TO) == end) if missing_keys == "drop" else F.lit(False)
    return u.withColumns({_GONE: gone, IS_CURRENT: F.col(VALID_TO) == end})


def _result(u: DataFrame, out_cols: list[str], changes: bool) -> DataFrame:
    """The merged rows, or only those that the merge inserts, closes or deletes."""
    if not changes:
        return u.filter(~F.col(_GONE)).select(*out_cols)
    kind = (
        F.when(F.col(_SRC) == 1, F.lit(INSERT))
        .when(F.col(_GONE), F.lit(DELETE))
        .when(~F.col(VALID_TO).eqNullSafe(F.col(_OLD_TO)), F.lit(CLOSE))
    )
    return u.select(*out_cols, kind.alias(CHANGE), F.col(_OLD_TO).alias(PREVIOUS_TO)).filter(F.col(CHANGE).isNotNull())


def _hot_pass(
    u: DataFrame,
    keys: list[str],
    tracked: list[str],
    tie: list[Column],
    end: Column,
    missing_keys: str,
    close_at: Column | None,
    single: bool = False,
) -> DataFrame:
    """Hot keys, partitioned by (key, time bucket). Only the first row of a
    bucket (whose predecessor is the last row of the previous non-empty
    bucket) and the last kept row (whose successor starts in a later bucket)
    need outside information; a one-row-per-bucket summary, windowed per key
    and broadcast back, provides it."""
    part = [*keys, BUCKET]
    present = None
    if missing_keys != "keep":
        # Presence is a matter of the key, not of the bucket (a listed key may have no row left).
        present = u.filter(F.col(_SRC) >= 1).groupBy(*keys).agg(F.lit(1).alias(_PRES_K))
    if not single:
        u = _carry_ends(u, keys)
    loc = _local_pass(u.repartition(*part), part, tracked, tie, missing_keys, single)
    vals = F.struct(*[F.col(t) for t in tracked])
    first_rows = loc.filter(F.col(_RNW) == 1).select(
        *part, VALID_FROM, _SRC, vals.alias("__lt_v1"), _LAST, F.col(_LEAD).alias("__lt_f2")
    )
    wk = Window.partitionBy(*keys).orderBy(BUCKET)
    prev = F.lag(_LAST).over(wk)
    keep1 = (
        (F.col(_SRC) == 0)
        | prev.isNull()
        | ~F.col("__lt_v1").eqNullSafe(prev.getField("v"))
        | (prev.getField("t") < F.col(VALID_FROM))
    )
    summary = first_rows.withColumn(_KEEP1, keep1).select(
        *part,
        _KEEP1,
        F.first(F.when(F.col(_KEEP1), F.col(VALID_FROM)).otherwise(F.col("__lt_f2")), ignorenulls=True)
        .over(wk.rowsBetween(1, Window.unboundedFollowing))
        .alias(_NEXT),
    )
    out = loc.join(summary, part, "left").filter((F.col(_RNW) != 1) | F.col(_KEEP1))
    if present is not None:
        out = out.join(present, keys, "left").withColumn(_PRES_K, F.coalesce(_PRES_K, F.lit(0)))
    return _finish(out, F.col(_NEXT), F.col(_PRES_K) if present is not None else None, end, missing_keys, close_at)


def _window_merge(
    hist: DataFrame | None,
    inc: DataFrame,
    keys: list[str],
    tracked: list[str],
    tie: list[Column],
    out_cols: list[str],
    tt: T.DataType,
    missing_keys: str,
    close_at: Column | None,
    present: DataFrame | None,
    skew: SkewSpec | None = None,
    size: int | None = None,
    changes: bool = False,
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    end = open_end(tt)
    none = F.lit(None).cast(tt)
    parts = [inc.withColumns({_SRC: F.lit(1), _OLD_TO: none})]
    if hist is not None:
        parts.insert(0, hist.withColumns({_SRC: F.lit(0), _OLD_TO: F.col(VALID_TO)}))
    if present is not None and missing_keys != "keep":
        parts.append(present.select(*keys).withColumn(_SRC, F.lit(2)))
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    present_col = F.col(_HASB) if missing_keys != "keep" else None
    single = len(parts) == 1
    bounds = hot_key_bounds(u, keys, VALID_FROM, skew, size)
    if bounds is None:
        # The one exchange: every window partitions by the key (plus more).
        loc = _local_pass(u.repartition(*keys), keys, tracked, tie, missing_keys, single)
        return _result(_finish(loc, none, present_col, end, missing_keys, close_at), out_cols, changes)
    tagged = tag_buckets(u, bounds, keys, VALID_FROM)
    cold = tagged.filter(F.col(BUCKET).isNull()).drop(BUCKET)
    loc = _local_pass(cold.repartition(*keys), keys, tracked, tie, missing_keys, single)
    normal = _result(_finish(loc, none, present_col, end, missing_keys, close_at), out_cols, changes)
    hot = tagged.filter(F.col(BUCKET).isNotNull())
    one = _one_per_date(hot.filter(F.col(_SRC) == 1), keys, tracked, tie_break)
    hot = one if single else hot.filter(F.col(_SRC) != 1).unionByName(one)
    hot = _hot_pass(hot, keys, tracked, tie, end, missing_keys, close_at, single)
    return normal.unionByName(_result(hot, out_cols, changes))


def _untouched(hist: DataFrame, tt: T.DataType, missing_keys: str, close_at: Column | None) -> DataFrame:
    """History rows of keys absent from the batch, under the missing-key policy."""
    end = open_end(tt)
    hist = hist.withColumns({_SRC: F.lit(0), _OLD_TO: F.col(VALID_TO), _GONE: F.lit(False)})
    if missing_keys == "close":
        hist = hist.withColumn(
            VALID_TO, F.when(F.col(VALID_TO) == end, F.greatest(F.col(VALID_FROM), close_at)).otherwise(F.col(VALID_TO))
        ).withColumn(IS_CURRENT, F.col(VALID_TO) == end)
    elif missing_keys == "drop":
        hist = hist.withColumn(_GONE, F.col(VALID_TO) == end)
    return hist


def merge_scd2(
    incoming_df: DataFrame,
    existing_df: DataFrame | None,
    scd2_key: str | Sequence[str],
    track_columns: Sequence[str],
    *,
    missing_keys: str = "keep",
    close_at: Any = None,
    present_keys: DataFrame | None = None,
    tie_break: Sequence[Column] | None = None,
    strategy: str = "auto",
    split_ratio: float = SPLIT_RATIO,
    skew: SkewSpec | None = SkewSpec(),
) -> DataFrame:
    """Merge a batch (with ``effective_from``) into a history; return the full history.

    * new key → inserted once; changed tracked values (NULL-safe) → previous
      version closed at the new ``effective_from``; unchanged → nothing;
    * a late row is placed at its point in time; repeated or replayed
      batches change nothing;
    * keys absent from the batch: ``missing_keys="keep"`` (default) leaves
      them, ``"close"`` ends their open version at ``close_at``, ``"drop"``
      removes their open version;
    * ``present_keys`` lists keys that are in the source batch although none
      of their rows is loadable (e.g. quarantined), so they are not "absent";
    * ``existing_df`` may be ``None`` or empty (first load): same code path.

    Schema evolution: columns on one side only are filled with NULL.

    ``skew`` sets when a key is hot enough to be split into time buckets
    (see :mod:`layertables.operators.skew`); ``None`` turns detection off.
    """
    return _merge(
        incoming_df, existing_df, scd2_key, track_columns, missing_keys, close_at, present_keys, tie_break, strategy, split_ratio, skew, False
    )


def merge_changes(
    incoming_df: DataFrame,
    existing_df: DataFrame | None,
    scd2_key: str | Sequence[str],
    track_columns: Sequence[str],
    *,
    missing_keys: str = "keep",
    close_at: Any = None,
    present_keys: DataFrame | None = None,
    tie_break: Sequence[Column] | None = None,
    strategy: str = "auto",
    split_ratio: float = SPLIT_RATIO,
    skew: SkewSpec | None = SkewSpec(),
) -> DataFrame:
    """The merge of :func:`merge_scd2` as change rows instead of the full history.

    Columns of the history as they are after the merge, ``change`` (``insert``: a new version;
    ``close``: a stored version whose end moved; ``delete``: a stored version that
    ``missing_keys="drop"`` removes) and ``previous_effective_to`` (the stored end; NULL for
    an insert). Untouched versions yield no row, so the result grows with the batch.
    ``apply_changes(history, merge_changes(batch, history, ...))`` equals the full merge.
    """
    return _merge(
        incoming_df, existing_df, scd2_key, track_columns, missing_keys, close_at, present_keys, tie_break, strategy, split_ratio, skew, True
    )


def _merge(
    incoming_df, existing_df, scd2_key, track_columns, missing_keys, close_at, present_keys, tie_break, strategy, split_ratio, skew, changes
) -> DataFrame:
    keys = _as_list(scd2_key)
    tracked = list(track_columns or [])
    if not keys:
        raise ValueError("scd2_key is required")
    if not tracked:
        raise ValueError("track_columns must name at least one column")
    if missing_keys not in MISSING_KEY_POLICIES:
        raise ValueError(f"missing_keys must be one of {MISSING_KEY_POLICIES}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if missing_keys == "close" and close_at is None:
        raise ValueError("missing_keys='close' needs close_at")

    inc, hist, out_cols, tt = _prepare(incoming_df, existing_df)
    close_col = None if close_at is None else (close_at if isinstance(close_at, Column) else F.lit(close_at)).cast(tt)
    tie = list(tie_break) if tie_break is not None else default_tie_break(inc, keys, tracked)
    for c in out_cols:
        if hist is not None and c not in hist.columns:
            hist = hist.withColumn(c, F.lit(None).cast(inc.schema[c].dataType))

    # Only loadable rows. An order of one's own ranks rows before their ends do: a window of its own.
    inc = inc.filter(~any_null(keys))
    if tie_break is not None:
        inc = _one_per_date(inc, keys, tracked, tie_break)
    if present_keys is not None:
        present_keys = present_keys.select(*keys).filter(~any_null(keys))
    batch_keys = inc.select(*keys)
    if present_keys is not None:
        batch_keys = batch_keys.unionByName(present_keys)

    # Every input is estimated once; each estimate optimises a plan.
    auto = hist is not None and strategy == "auto"
    inc_size = estimated_bytes(incoming_df) if auto or skew is not None else 0
    hist_size = estimated_bytes(existing_df) if hist is not None and (auto or skew is not None) else 0
    use_split = hist is not None and strategy == "split"
    if auto:
        # Splitting pays when the batch touches a small part of the history
        # (the daily case); Catalyst's size estimates decide that without a job,
        # and both ways give the same rows.
        use_split = hist_size >= split_ratio * inc_size and estimated_bytes(batch_keys) <= broadcast_threshold(inc.sparkSession)
    size = inc_size + hist_size
    rest = [tie_break] if tie_break is not None else [None]
    if not use_split:
        return _window_merge(
            hist, inc, keys, tracked, tie, out_cols, tt, missing_keys, close_col, present_keys, skew, size, changes, *rest
        )

    # Spark broadcasts the keys where they are below its threshold.
    batch_keys = batch_keys.distinct()
    touched = hist.join(batch_keys, keys, "left_semi")
    merged = _window_merge(touched, inc, keys, tracked, tie, out_cols, tt, "keep", None, None, skew, size, changes, *rest)
    if changes and missing_keys == "keep":
        return merged
    untouched = _untouched(hist.join(batch_keys, keys, "left_anti"), tt, missing_keys, close_col)
    return merged.unionByName(_result(untouched, out_cols, changes))


# --------------------------------------------------------------------------- change rows

CHANGE = "change"
PREVIOUS_TO = "previous_effective_to"
# Kinds of change rows.
INSERT, CLOSE, DELETE = "insert", "close", "delete"


def apply_changes(history: DataFrame | None, changes: DataFrame, scd2_key: str | Sequence[str], track_columns: Sequence[str]) -> DataFrame:
    """The history after the change rows of one merge (see :func:`merge_changes`).

    A stored version is recognised by key, start, tracked values (NULL-safe) and the end it had
    before the merge; its other columns stay as stored. Versions that are already as a change
    row wants them stay, and an insert that is already stored is not added again, so changes
    that were applied in part, or twice, give the same history. A history of ``None`` is empty."""
    keys, tracked = _as_list(scd2_key), list(track_columns)
    cols = [c for c in changes.columns if c not in (CHANGE, PREVIOUS_TO)]
    inserts = changes.filter(F.col(CHANGE) == INSERT).select(*cols)
    if history is None or not history.columns:
        return inserts
    tt = changes.schema[VALID_TO].dataType
    history = history.withColumn(VALID_TO, F.coalesce(F.col(VALID_TO).cast(tt), open_end(tt)))
    for f in changes.schema.fields:
        if f.name in cols and f.name not in history.columns:
            history = history.withColumn(f.name, F.lit(None).cast(f.dataType))
    named = lambda c: f"__lt_c_{c}"
    ident = [VALID_FROM, *tracked]
    moved = changes.filter(F.col(CHANGE) != INSERT).select(
        *[F.col(c).alias(named(c)) for c in [*keys, *ident, VALID_TO]], F.col(PREVIOUS_TO).alias(_OLD_TO), F.col(CHANGE).alias(named(CHANGE))
    )
    # Stored rows without a key can be closed or deleted as missing, so keys match NULL-safely too.
    on = [F.col(c).eqNullSafe(F.col(named(c))) for c in [*keys, *ident]] + [F.col(VALID_TO) == F.col(_OLD_TO)]
    out = history.join(moved, reduce(lambda a, b: a & b, on), "left")
    kind = F.col(named(CHANGE))
    out = out.filter(kind.isNull() | (kind != DELETE))
    to = F.when(kind == CLOSE, F.col(named(VALID_TO))).otherwise(F.col(VALID_TO))
    out = out.withColumn(VALID_TO, to).withColumn(IS_CURRENT, F.when(kind == CLOSE, to == open_end(tt)).otherwise(F.col(IS_CURRENT)))
    out = out.select(*[c for c in history.columns])
    # Inserts that are there already (by key, start, end and tracked values) are left out.
    there = history.select(*[F.col(c).alias(named(c)) for c in [*keys, *ident, VALID_TO]])
    on = [F.col(c).eqNullSafe(F.col(named(c))) for c in [*keys, *ident, VALID_TO]]
    new = inserts.join(there, reduce(lambda a, b: a & b, on), "left_anti")
    return out.unionByName(new, allowMissingColumns=True)


def replay_changes(history: DataFrame | None, runs: Sequence[DataFrame], scd2_key: str | Sequence[str], track_columns: Sequence[str]) -> DataFrame:
    """The history after the change rows of several merges, oldest first."""
    for changes in runs:
        history = apply_changes(history, changes, scd2_key, track_columns)
    return history


# --------------------------------------------------------------------------- key sets


def new_keys(incoming_df: DataFrame, existing_df: DataFrame, scd2_key: str | Sequence[str]) -> DataFrame:
    """Batch rows whose key has no open version (anti join)."""
    keys = _as_list(scd2_key)
    return incoming_df.join(current_view(existing_df).select(*keys), keys, "left_anti")


def changed_versions(
    incoming_df: DataFrame, existing_df: DataFrame, scd2_key: str | Sequence[str], track_columns: Sequence[str]
) -> DataFrame:
    """Open versions that a batch row changes (NULL-safe), each once (semi join:
    no fan-out when a key repeats in the batch)."""
    keys = _as_list(scd2_key)
    cur = current_view(existing_df)
    b = incoming_df.select(
        *[F.col(k).alias(f"__lt_bk_{k}") for k in keys], *[F.col(t).alias(f"__lt_b_{t}") for t in track_columns]
    )
    cond = [F.col(k) == F.col(f"__lt_bk_{k}") for k in keys]
    diff = ~reduce(lambda x, y: x & y, [F.col(t).eqNullSafe(F.col(f"__lt_b_{t}")) for t in track_columns])
    return cur.join(b, reduce(lambda x, y: x & y, cond) & diff, "left_semi")


# --------------------------------------------------------------------------- change classes

CHANGE_TYPE = "change_type"
# Change classes of a batch row.
NEW, CHANGED, UNCHANGED, DUPLICATE = "new", "changed", "unchanged", "duplicate"


def classify_changes(
    incoming_df: DataFrame,
    existing_df: DataFrame | None,
    scd2_key: str | Sequence[str],
    track_columns: Sequence[str],
    *,
    tie_break: Sequence[Column] | None = None,
    skew: SkewSpec | None = SkewSpec(),
) -> DataFrame:
    """Every batch row with ``change_type``: ``new`` (key not in the history),
    ``changed`` (opens a version), ``unchanged`` (equal to the version it falls
    into, or a replay) or ``duplicate`` (lost the per-(key, date) tie-break).

    One keyed exchange and one pass over history and batch; nothing is joined
    except, for hot keys, the per-bucket summary. Batch rows with a NULL key are
    classified among themselves.
    """
    keys = _as_list(scd2_key)
    tracked = list(track_columns)
    inc, hist, out_cols, tt = _prepare(incoming_df, existing_df)
    tie = list(tie_break) if tie_break is not None else default_tie_break(inc, keys, tracked)
    parts = [inc.withColumn(_SRC, F.lit(1))]
    if hist is not None:
        parts.insert(0, hist.withColumn(_SRC, F.lit(0)))
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    in_cols = list(incoming_df.columns)
    bounds = hot_key_bounds(u, keys, VALID_FROM, skew)
    if bounds is None:
        return _classify_pass(u.repartition(*keys), keys, keys, tracked, tie, in_cols, None)
    tagged = tag_buckets(u, bounds, keys, VALID_FROM)
    cold = tagged.filter(F.col(BUCKET).isNull()).drop(BUCKET)
    hot = _carry_ends(tagged.filter(F.col(BUCKET).isNotNull()), keys).withColumnRenamed(_IN_TO, _CARRIED)
    part = [*keys, BUCKET]
    return _classify_pass(cold.repartition(*keys), keys, keys, tracked, tie, in_cols, None).unionByName(
        _classify_pass(hot.repartition(*part), part, keys, tracked, tie, in_cols, part)
    )


def _classify_pass(
    u: DataFrame,
    part: list[str],
    keys: list[str],
    tracked: list[str],
    tie: list[Column],
    in_cols: list[str],
    hot_part: list[str] | None,
) -> DataFrame:
    src = F.col(_SRC)
    vals = F.struct(*[F.col(t) for t in tracked])
    order = [F.col(VALID_FROM).asc(), src.asc(), F.col(VALID_TO).asc(), *tie]
    w_dup = Window.partitionBy(*part, VALID_FROM, _SRC).orderBy(*order[2:])
    w_day = Window.partitionBy(*part, VALID_FROM).orderBy(*order[1:])
    w = Window.partitionBy(*part).orderBy(*order)
    day = w_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = w.rowsBetween(Window.unboundedPreceding, -1)

    # Label in place; nothing is filtered before the end, so one pass serves all classes.
    u = u.withColumns(
        {
            _RN: F.row_number().over(w_dup),
            _HASB: F.max(F.when(src == 0, 1).otherwise(0)).over(Window.partitionBy(*part)),
            _REPLAY: F.first(F.when(src == 1, vals), ignorenulls=True).over(day),
            _IN_TO: F.last(F.when(src == 0, F.col(VALID_TO)), ignorenulls=True).over(running),
        }
    )
    if _CARRIED in u.columns:
        u = u.withColumn(_IN_TO, F.coalesce(_IN_TO, _CARRIED))
    first = (src == 1) & (F.col(_RN) == 1)
    stored = F.max(F.when((src == 0) & vals.eqNullSafe(F.col(_REPLAY)), 1)).over(day)
    u = u.withColumn(_REPLAY, first & (F.coalesce(stored, F.lit(0)) == 1))
    alive = (src == 0) | (first & ~F.col(_REPLAY))
    # A version inside a stored interval ends with it (see the merge).
    to = F.when((src == 1) & (F.col(_IN_TO) > F.col(VALID_FROM)), F.least(F.col(VALID_TO), F.col(_IN_TO))).otherwise(F.col(VALID_TO))
    row = F.when(alive, F.struct(vals.alias("v"), to.alias("t")))
    u = u.withColumn(_PREV, F.last(row, ignorenulls=True).over(running))
    opens = F.col(_PREV).isNull() | ~vals.eqNullSafe(F.col(_PREV)["v"]) | (F.col(_PREV)["t"] < F.col(VALID_FROM))
    present = F.col(_HASB) == 1
    if hot_part is not None:
        # The first live row of a bucket: its predecessor is the last live row of the
        # previous non-empty bucket; presence is per key, not per bucket. Ends of
        # stored versions reach in from there too.
        u = u.withColumn(_LAST, F.last(row, ignorenulls=True).over(whole))
        tail = u.groupBy(*hot_part).agg(F.first(_LAST).alias(_LAST), F.max(_HASB).alias(_HASB))
        wk = Window.partitionBy(*keys).orderBy(BUCKET)
        tail = tail.select(
            *hot_part,
            F.last(_LAST, ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias(_NEXT),
            F.max(_HASB).over(Window.partitionBy(*keys)).alias(_PRES_K),
        )
        u = u.join(tail, hot_part, "left")
        prev = F.coalesce(F.col(_PREV), F.col(_NEXT))
        opens = prev.isNull() | ~vals.eqNullSafe(prev["v"]) | (prev["t"] < F.col(VALID_FROM))
        present = F.col(_PRES_K) == 1
    kind = (
        F.when(F.col(_RN) > 1, F.lit(DUPLICATE))
        .when(F.col(_REPLAY), F.lit(UNCHANGED))
        .when(~present, F.lit(NEW))
        .when(opens, F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    return u.filter(src == 1).select(*in_cols, kind.alias(CHANGE_TYPE))


def change_counts(classified: DataFrame) -> DataFrame:
    """Rows per change class (one partial+final aggregate)."""
    return classified.groupBy(CHANGE_TYPE).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# --------------------------------------------------------------------------- apply (H7)


@dataclass
class Batch:
    """A batch ready to be merged: loadable rows with validity columns, rows set aside, and the keys
    of those (they are in the feed, so not "missing")."""

    valid: DataFrame
    quarantine: DataFrame
    present: DataFrame


def prepare_batch(
    incoming_df: DataFrame,
    scd2_key: str | Sequence[str],
    effective_from_ts: Any = None,
    effective_from_column: str | None = None,
    effective_from_fallback_column: str | None = None,
    *,
    time_type: T.DataType | str | None = None,
    fmt: str | None = None,
    corrupt_column: str | None = None,
    now: Any = None,
) -> Batch:
    """Quarantine split → validity columns. A batch that already carries validity
    columns is taken as is (never restamped). Rows with a NULL key, no date or no
    parseable date are quarantined with a reason."""
    keys = _as_list(scd2_key)
    has_validity = VALID_FROM in incoming_df.columns
    split = separate_quarantine_records(
        incoming_df,
        None if has_validity else effective_from_column,
        None if has_validity else effective_from_fallback_column,
        keys=keys,
        time_type=time_type,
        fmt=fmt,
        corrupt_column=corrupt_column,
    )
    valid = split.valid
    if corrupt_column and corrupt_column in valid.columns:
        valid = valid.drop(corrupt_column)
    if not has_validity:
        valid = resolve_effective_from(
            valid, effective_from_column, effective_from_fallback_column, effective_from_ts, time_type=time_type, fmt=fmt, now=now
        )
    return Batch(valid, split.quarantine, split.quarantine.filter(~any_null(keys)).select(*keys))


def apply_scd2(
    incoming_df: DataFrame,
    existing_df: DataFrame | None,
    scd2_key: str | Sequence[str],
    track_columns: Sequence[str],
    effective_from_ts: Any = None,
    effective_from_column: str | None = None,
    effective_from_fallback_column: str | None = None,
    *,
    time_type: T.DataType | str | None = None,
    fmt: str | None = None,
    missing_keys: str = "keep",
    close_at: Any = None,
    tie_break: Sequence[Column] | None = None,
    strategy: str = "auto",
    corrupt_column: str | None = None,
    skew: SkewSpec | None = SkewSpec(),
    now: Any = None,
) -> Split:
    """Quarantine split → validity columns → merge. Returns ``Split(valid, quarantine)``.

    ``valid`` is the full merged history. A batch that already carries
    validity columns is merged as is (never restamped). Rows with a NULL key,
    no date or no parseable date are quarantined with a reason; their keys
    still count as present for ``missing_keys``.
    """
    batch = prepare_batch(
        incoming_df,
        scd2_key,
        effective_from_ts,
        effective_from_column,
        effective_from_fallback_column,
        time_type=time_type,
        fmt=fmt,
        corrupt_column=corrupt_column,
        now=now,
    )
    history = merge_scd2(
        batch.valid,
        existing_df,
        scd2_key,
        track_columns,
        missing_keys=missing_keys,
        close_at=close_at,
        present_keys=batch.present if missing_keys != "keep" else None,
        tie_break=tie_break,
        strategy=strategy,
        skew=skew,
    )
    return Split(history, batch.quarantine)

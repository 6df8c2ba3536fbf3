"""Load types as DataFrame operations: what the table should contain after a
load, given the incoming frame and the existing table.

* ``overwrite`` — the incoming rows;
* ``append``    — existing rows plus incoming rows (written in append mode);
* ``scd1``      — keyed upsert: existing rows whose key is not in the batch,
  plus the latest batch row per key (without keys: a full overwrite);
* ``scd2``      — history merge (:func:`layertables.operators.history.apply_scd2`), also
  of a batch that has validity columns; with ``full_history`` such a batch is the
  whole history and replaces the table as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layertables.functions.predicates import any_null
from layertables.operators.history import VALID_FROM, _orderable, apply_scd2
from layertables.operators.quarantine import separate_quarantine_records

LOAD_TYPES = ("overwrite", "scd1", "scd2", "append")


@dataclass(frozen=True)
class LoadSpec:
    load_type: str = "overwrite"
    keys: Sequence[str] | str | None = None
    tracked: Sequence[str] = ()
    latest_by: Sequence[Column | str] = ()
    effective_from_column: str | None = None
    effective_from_fallback_column: str | None = None
    effective_from_ts: Any = None
    missing_keys: str = "keep"
    close_at: Any = None
    full_history: bool = False
    options: dict = field(default_factory=dict)

    def check(self) -> None:
        """Validate before any Spark work."""
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"no load type {self.load_type!r}; there are {', '.join(LOAD_TYPES)}")
        if self.load_type == "scd2":
            if not self.keys:
                raise ValueError("load_type='scd2' needs keys (the natural key)")
            if not self.tracked:
                raise ValueError("load_type='scd2' needs tracked columns")


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``latest_by`` order (give DESC columns for
    'latest'). Without an order, the row with the greatest values wins.

    When ``latest_by`` is empty or names columns (greatest wins, NULL last),
    this is a ``max_by`` aggregate: partial aggregation before the shuffle,
    so a key with very many rows never lands whole in one task. Ties are
    broken by the remaining columns. Sort expressions use a keyed window."""
    if all(isinstance(c, str) for c in latest_by):
        cols = list(df.columns)
        rank = [*latest_by, *[c for c in cols if c not in keys and c not in latest_by]]
        rank = [c for c in rank if _orderable(df.schema[c].dataType)]
        best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in rank]))
        return df.groupBy(*keys).agg(best.alias("__lt_best")).select("__lt_best.*")
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in latest_by]
    if not order:
        order = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__lt_rn", F.row_number().over(w)).filter("__lt_rn = 1").drop("__lt_rn")


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str] | str, latest_by: Sequence[Column | str] = ()) -> DataFrame:
    """SCD1: existing rows of untouched keys ∪ the latest batch row per key. Batch
    rows with a NULL key are left out (:func:`plan_load` quarantines them)."""
    ks = _as_list(keys)
    incoming = incoming.filter(~any_null(ks))
    latest = latest_per_key(incoming, ks, latest_by)
    if existing is None:
        return latest
    kept = existing.join(incoming.select(*ks).distinct(), ks, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


@dataclass
class Planned:
    """The frame to write, the write mode, and any quarantined rows."""

    df: DataFrame
    mode: str
    quarantine: DataFrame | None = None


def plan_load(incoming: DataFrame, existing: DataFrame | None, spec: LoadSpec, now: Any = None) -> Planned:
    """What a load writes, and how. ``now`` is the time of the run, for rows without a date."""
    spec.check()
    t = spec.load_type
    if t == "overwrite":
        return Planned(incoming, "overwrite")
    if t == "append":
        return Planned(incoming, "append")
    if t == "scd1":
        if not spec.keys:
            return Planned(incoming, "overwrite")
        # Rows without a key can't be matched on a later run: they are set aside.
        split = separate_quarantine_records(incoming, keys=spec.keys)
        return Planned(upsert(existing, split.valid, spec.keys, spec.latest_by), "overwrite", split.quarantine)
    if spec.full_history and VALID_FROM in incoming.columns:
        return Planned(incoming, "overwrite")
    res = apply_scd2(
        incoming,
        existing,
        spec.keys,
        spec.tracked,
        spec.effective_from_ts,
        spec.effective_from_column,
        spec.effective_from_fallback_column,
        missing_keys=spec.missing_keys,
        close_at=spec.close_at,
        **{"now": now, **spec.options},
    )
    return Planned(res.valid, "overwrite", res.quarantine)

"""A stored history that a merge rewrites in part.

Layout: ``path/lt_state=open|closed/lt_bucket_of_N=<hash of the key>/lt_run=<run>/``, plain
parquet partitions that any reader understands. A merge

* reads the open versions of the buckets that the batch names, and closed versions only
  of keys that need them: a late row, or a key that has no open version;
* computes change rows (:func:`layertables.operators.history.merge_changes`), whose number
  grows with the batch;
* replaces the open partitions of changed buckets by Spark's dynamic partition
  overwrite, and writes versions that it closes as new partitions of this run. Closed
  partitions, the bulk of an old history, are only rewritten where a late row splits a closed version.

So a daily batch costs what it touches. Where the keys of a batch are spread over all
buckets (more changed keys than buckets), all open partitions are rewritten and the closed ones still stay.

Safety: what replaces partitions is first written beside the table, complete with the
list of partitions that end up empty, and only then put in place. A merge that stops
after that point is finished by :func:`recover_partitions`, which can run any number of times; one that
stops before leaves the table as it was. Reading a table that waits for that is an
error. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layertables.functions.predicates import any_null, same_values
from layertables.functions.time import open_end
from layertables.operators.history import (
    CHANGE,
    INSERT,
    PREVIOUS_TO,
    VALID_FROM,
    VALID_TO,
    _as_list,
    apply_changes,
    merge_changes,
    merge_scd2,
)
from layertables.session import scratch_path
from layertables.sources.tables import _hadoop, _siblings, path_exists, read_table

STATE, RUN = "lt_state", "lt_run"
OPEN, CLOSED = "open", "closed"
_BUCKET = re.compile(r"lt_bucket_of_(\d+)$")
BUCKETS = 256
_PART = ".part-"


def _bucket_column(n: int) -> str:
    return f"lt_bucket_of_{n}"


def _layout(df: DataFrame) -> tuple[str, int]:
    """The bucket column of a stored history and the number of buckets."""
    for c in df.columns:
        m = _BUCKET.match(c)
        if m:
            return c, int(m.group(1))
    raise ValueError("not a partitioned history: it has no bucket column")


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _placed(df: DataFrame, keys: Sequence[str], n: int, run: int) -> DataFrame:
    is_open = F.col(VALID_TO) == open_end(df.schema[VALID_TO].dataType)
    return df.withColumns(
        {
            STATE: F.when(is_open, OPEN).otherwise(CLOSED),
            _bucket_column(n): _bucket(keys, n),
            RUN: F.when(is_open, 0).otherwise(F.lit(run)).cast("int"),
        }
    )


def _partitioned(df: DataFrame, n: int) -> DataFrame:
    """Few files a partition: rows are dealt by partition, and adaptive execution splits large ones."""
    return df.hint("rebalance", STATE, _bucket_column(n), RUN)


def is_partitioned(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a partitioned history."""
    if not path_exists(spark, path):
        return bool(_siblings(spark, path, _PART))
    fs, p = _hadoop(spark, path)
    return any(f.getPath().getName().startswith(f"{STATE}=") for f in fs.listStatus(p))


def create_history(history: DataFrame, path: str, scd2_key: str | Sequence[str], *, buckets: int = BUCKETS) -> None:
    """Store ``history`` (a full one, as the merge returns it) in partitions at a new ``path``."""
    spark, keys = history.sparkSession, _as_list(scd2_key)
    if path_exists(spark, path) and (not _is_empty(spark, path)):
        raise ValueError(f"{path} exists already; merge into it")
    tt = history.schema[VALID_TO].dataType
    h = history.withColumn(VALID_TO, F.coalesce(F.col(VALID_TO), open_end(tt)))
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    rows = _partitioned(_placed(h, keys, buckets, 0), buckets)
    rows.write.partitionBy(STATE, _bucket_column(buckets), RUN).parquet(staged)
    fs, live = _hadoop(spark, path)
    fs.delete(live, True)  # absent, or without any partition
    if not fs.rename(_hadoop(spark, staged)[1], live):
        raise OSError(f"could not move {staged} to {path}")


def _is_empty(spark: SparkSession, path: str) -> bool:
    """A partitioned history all of whose versions have gone."""
    return not path_exists(spark, path) or (is_partitioned(spark, path) and not partitions(spark, path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    waiting = [x for x in _siblings(spark, path, _PART) if path_exists(spark, f"{x}/emptied/_SUCCESS")]
    if waiting:
        raise OSError(f"{path}: a merge stopped while {waiting[0]} was put in place; call recover_partitions first")
    return read_table(spark, path, merge_schema=True)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history at ``path``, partitioned or plain, without partition columns."""
    if not is_partitioned(spark, path):
        return read_table(spark, path)
    df = _stored(spark, path)
    return df.drop(STATE, RUN, _layout(df)[0])


def partitions(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(state, bucket, run)`` of every partition, from the file names alone."""
    fs, root = _hadoop(spark, path)
    out = []
    for s in fs.listStatus(root):
        if not s.isDirectory() or not s.getPath().getName().startswith(f"{STATE}="):
            continue
        for b in fs.listStatus(s.getPath()):
            for r in fs.listStatus(b.getPath()):
                value = [x.getPath().getName().split("=")[1] for x in (s, b, r)]
                out.append((value[0], int(value[1]), int(value[2])))
    return sorted(out)


@dataclass(frozen=True)
class Merged:
    """What a partial merge did: change rows by kind, and the partitions that it replaced."""

    run: int
    inserted: int
    closed: int
    deleted: int
    replaced: list[tuple[str, int, int]]


def _needs_closed(batch: DataFrame, open_rows: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Keys whose merge depends on closed versions: without an open one, or with a row that is
    not after its start (unless it only repeats the open version)."""
    named = lambda c: f"__lt_o_{c}"
    cur = open_rows.select(*[F.col(c).alias(named(c)) for c in [*keys, VALID_FROM, *tracked]])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(named(k)) for k in keys])
    start = F.col(named(VALID_FROM))
    repeat = (F.col(VALID_FROM) == start) & same_values(tracked, [named(t) for t in tracked])
    alone = start.isNull() | ((F.col(VALID_FROM) <= start) & ~repeat)
    return batch.join(cur, on, "left").filter(alone).select(*keys).distinct()


def merge_history(
    batch: DataFrame,
    path: str,
    scd2_key: str | Sequence[str],
    track_columns: Sequence[str],
    *,
    missing_keys: str = "keep",
    close_at: Any = None,
    present_keys: DataFrame | None = None,
    buckets: int = BUCKETS,
    changes_path: str | None = None,
) -> Merged:
    """Merge a batch (with ``effective_from``) into the partitioned history at ``path``.

    Same rows as overwriting the table with :func:`merge_scd2`. The first load creates the table with
    ``buckets`` key buckets. ``changes_path`` keeps the change rows of this run as a table for
    readers that follow the history (see :func:`layertables.operators.history.replay_changes`)."""
    spark, keys, tracked = batch.sparkSession, _as_list(scd2_key), list(track_columns)
    recover_partitions(spark, path)
    batch = batch.filter(~any_null(keys))
    if _is_empty(spark, path):
        changes = merge_changes(batch, None, keys, tracked) if changes_path else None
        if changes is not None:
            changes.write.mode("overwrite").parquet(changes_path)
        create_history(merge_scd2(batch, None, keys, tracked), path, keys, buckets=buckets)
        parts = partitions(spark, path)
        return Merged(0, read_table(spark, path).count(), 0, 0, parts)

    stored = _stored(spark, path)
    at, n = _layout(stored)
    there = partitions(spark, path)
    run = max((r for _, _, r in there), default=0) + 1
    # Equal keys must hash alike.
    cast = {k: F.col(k).cast(stored.schema[k].dataType) for k in keys}
    batch = batch.withColumns(cast)
    if present_keys is not None:
        present_keys = present_keys.select(*keys).withColumns(cast)

    # At most n numbers reach the driver; they prune the partitions that are read.
    bucket_of = lambda df: [r[0] for r in df.select(_bucket(keys, n).alias("b")).distinct().collect()]
    touched = bucket_of(batch)
    if missing_keys == "keep":
        open_rows = stored.filter((F.col(STATE) == OPEN) & F.col(at).isin(touched))
    else:
        open_rows = stored.filter(F.col(STATE) == OPEN)
    late = scratch_path(spark, "late-keys")
    _needs_closed(batch, open_rows.filter(F.col(at).isin(touched)), keys, tracked).write.parquet(late)
    late_keys = spark.read.schema(batch.select(*keys).schema).parquet(late)
    late_buckets = bucket_of(late_keys)
    closed_rows = stored.filter((F.col(STATE) == CLOSED) & F.col(at).isin(late_buckets)).join(late_keys, keys, "left_semi")
    existing = open_rows.unionByName(closed_rows).drop(STATE, RUN, at)

    kept = changes_path or scratch_path(spark, "changes")
    merge_changes(
        batch, existing, keys, tracked, missing_keys=missing_keys, close_at=close_at, present_keys=present_keys
    ).write.mode("overwrite").parquet(kept)
    changes = read_table(spark, kept)
    end = open_end(changes.schema[VALID_TO].dataType)
    was_open, was_closed = F.col(PREVIOUS_TO) == end, F.col(PREVIOUS_TO) < end
    touches = [
        F.col(CHANGE),
        _bucket(keys, n).alias("b"),
        F.coalesce(was_open | (F.col(VALID_TO) == end), F.lit(False)).alias("o"),
        F.coalesce(was_closed, F.lit(False)).alias("c"),
    ]
    found = changes.groupBy(*touches).count().collect()  # a few rows a bucket
    if not found:
        return Merged(run, 0, 0, 0, [])
    counts: dict[str, int] = {}
    for r in found:
        counts[r[CHANGE]] = counts.get(r[CHANGE], 0) + r["count"]
    open_b = sorted({r["b"] for r in found if r["o"]})
    closed_b = sorted({r["b"] for r in found if r["c"]})
    # Open versions of changed buckets as they will be: still open, or closed by this run.
    before = stored.filter((F.col(STATE) == OPEN) & F.col(at).isin(open_b)).drop(STATE, RUN, at)
    after = _placed(apply_changes(before, changes.filter(F.col(CHANGE).eqNullSafe(INSERT) | was_open), keys, tracked), keys, n, run)
    if closed_b:
        split = stored.filter((F.col(STATE) == CLOSED) & F.col(at).isin(closed_b)).drop(STATE)
        split = apply_changes(split, changes.filter(was_closed), keys, tracked).withColumn(STATE, F.lit(CLOSED))
        after = after.unionByName(split, allowMissingColumns=True)
    live = {(OPEN, b, 0) for b in open_b} | {p for p in there if p[0] == CLOSED and p[1] in set(closed_b)}

    staged = f"{path.rstrip('/')}{_PART}{uuid.uuid4().hex[:12]}"
    _partitioned(after, n).write.partitionBy(STATE, at, RUN).parquet(f"{staged}/data")
    new = set(partitions(spark, f"{staged}/data"))
    emptied = sorted(p for p in live - new if p in set(there))
    rows = spark.createDataFrame([(*p, at) for p in emptied], "state string, bucket int, run int, name string")
    rows.coalesce(1).write.parquet(f"{staged}/emptied")  # from here on the merge will be finished
    recover_partitions(spark, path)
    return Merged(run, counts.get("insert", 0), counts.get("close", 0), counts.get("delete", 0), sorted(new | set(emptied)))


def recover_partitions(spark: SparkSession, path: str) -> str:
    """Put in place what a stopped merge left beside the table: ``"completed"``. What
    was not yet whole is removed (``"cleaned"``); ``"none"`` if nothing was there."""
    done = "none"
    fs, _ = _hadoop(spark, path)
    for staged in _siblings(spark, path, _PART):
        if path_exists(spark, f"{staged}/emptied/_SUCCESS"):
            if partitions(spark, f"{staged}/data"):
                df = read_table(spark, f"{staged}/data", merge_schema=True)
                at, n = _layout(df)
                writer = _partitioned(df, n).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(STATE, at, RUN).parquet(path)
            for r in read_table(spark, f"{staged}/emptied").collect():
                fs.delete(_hadoop(spark, f"{path}/{STATE}={r['state']}/{r['name']}={r['bucket']}/{RUN}={r['run']}")[1], True)
            done = "completed"
        elif done == "none":
            done = "cleaned"
        fs.delete(_hadoop(spark, staged)[1], True)
    return done


def compact_closed(spark: SparkSession, path: str, bucket_numbers: Sequence[int] | None = None) -> list[tuple[str, int, int]]:
    """Fold the closed partitions of every run into one a bucket (run 0), for the given buckets or
    all. Merges add a small partition a run and bucket; folding them now and then keeps the
    number of files down. Returns the partitions that went."""
    recover_partitions(spark, path)
    stored = _stored(spark, path)
    at, n = _layout(stored)
    wanted = None if bucket_numbers is None else set(bucket_numbers)
    runs: dict[int, list[int]] = {}
    for state, b, r in partitions(spark, path):
        if state == CLOSED and (wanted is None or b in wanted):
            runs.setdefault(b, []).append(r)
    folded = {b: rs for b, rs in runs.items() if rs != [0]}
    if not folded:
        return []
    rows = stored.filter((F.col(STATE) == CLOSED) & F.col(at).isin(list(folded))).withColumn(RUN, F.lit(0))
    staged = f"{path.rstrip('/')}{_PART}{uuid.uuid4().hex[:12]}"
    _partitioned(rows, n).write.partitionBy(STATE, at, RUN).parquet(f"{staged}/data")
    gone = [(CLOSED, b, r) for b, rs in sorted(folded.items()) for r in rs if r]
    emptied = spark.createDataFrame([(*p, at) for p in gone], "state string, bucket int, run int, name string")
    emptied.coalesce(1).write.parquet(f"{staged}/emptied")
    recover_partitions(spark, path)
    return gone

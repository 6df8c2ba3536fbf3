"""Parquet tables at the edges: optional reads and safe writes.

Writes return the row count observed *during* the write (``observe``), so a
table is never scanned a second time just to log how many rows it has.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layertables.functions.predicates import same_values

WRITE_MODES = ("overwrite", "append")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, *, merge_schema: bool = False) -> DataFrame:
    r = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


# Error classes of a path that is not there or holds no data file.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A frame without rows that Catalyst knows to be empty (size 0)."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).filter(F.lit(False)).select(*cols)


def read_table_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, merge_schema: bool = False
) -> DataFrame | None:
    """The table at ``path``, or an empty frame of ``schema`` when the path is
    missing or holds no data files (``None`` when no schema is given).
    Works on any filesystem URI Spark can read. Any other error is raised; so is an
    interrupted swap (see :func:`recover_swap`), which must not pass for a first load."""
    try:
        df = spark.read.option("mergeSchema", merge_schema).parquet(path)
        df.schema  # forces the listing / footer read
        return df
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] not in _ABSENT:
            raise
    left = _siblings(spark, path, ".old-")
    if left:
        raise OSError(f"{path} is missing but {left[0]} is there: a swap was interrupted; call recover_swap first")
    return None if schema is None else empty_frame(spark, schema)


ROW_HASH = "lt_row_hash"
_ROW_BUCKET = re.compile(r"(lt_rows_of_(\d+))=(\d+)$")


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's non-NULL columns by name: their order and missing ones do not matter."""
    one = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))), F.lit(0).cast("bigint"))
    return reduce(lambda a, b: a.bitwiseXOR(b), [one(c) for c in sorted(df.columns)])


def _row_partitions(spark: SparkSession, path: str) -> dict[int, tuple[str, str]]:
    """Folder and partition column by bucket, from the folder names."""
    if not path_exists(spark, path):
        return {}
    fs, p = _hadoop(spark, path)
    out = {}
    for f in fs.listStatus(p):
        m = _ROW_BUCKET.search(f.getPath().getName())
        if m:
            out[int(m.group(3))] = (f.getPath().toString(), m.group(1))
    return out


def _row_bucket(spark: SparkSession, path: str) -> str | None:
    """The partition column of a table whose rows are partitioned by their hash."""
    return next((name for _, name in _row_partitions(spark, path).values()), None)


def stored_candidates(df: DataFrame, path: str) -> DataFrame | None:
    """Rows of a hashed table (see :func:`append_new`) that can equal one of ``df``: only
    partitions that ``df`` falls into are opened, and only rows of an equal hash are kept."""
    spark = df.sparkSession
    there = _row_partitions(spark, path)
    n = int(_ROW_BUCKET.search(next(iter(there.values()))[0]).group(2)) if there else 0
    if not n:
        return None
    hashes = df.select(_row_hash(df).alias(ROW_HASH))
    # At most n numbers reach the driver.
    wanted = [r[0] for r in hashes.select(F.pmod(ROW_HASH, F.lit(n)).alias("b")).distinct().collect()]
    folders = [there[b][0] for b in sorted(wanted) if b in there]
    if not folders:
        return None
    # Spark broadcasts the hashes where they are small, and beyond that may filter by a Bloom filter of its own.
    return spark.read.option("mergeSchema", True).parquet(*folders).join(hashes.distinct(), ROW_HASH, "left_semi")


def _append_hashed(df: DataFrame, path: str, at: str) -> dict[str, Any]:
    n = int(at.rsplit("_", 1)[1])
    new, stored = df, stored_candidates(df, path)
    if stored is not None:
        new = _not_stored(df, stored.drop(ROW_HASH, at))
    hashed = new.withColumn(ROW_HASH, _row_hash(new)).withColumn(at, F.pmod(ROW_HASH, F.lit(n)).cast("int"))
    return write_table(hashed.hint("rebalance", at), path, "append", partition_by=[at])


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`append_new` wrote, with all columns any append brought."""
    df = read_table(spark, path, merge_schema=True)
    return df.drop(*[c for c in df.columns if c == ROW_HASH or c.startswith("lt_rows_of_")])


def append_new(df: DataFrame, path: str, *, buckets: int | None = None) -> dict[str, Any]:
    """Append only rows not already stored at ``path`` (exact, NULL-safe match
    on every column of either side, a missing one counting as NULL), so re-running
    a load does not duplicate them and a new column makes a new row. Tables whose
    columns grew are read with ``read_table(..., merge_schema=True)``.

    With ``buckets``, a new table is partitioned by a hash of the row, and each append then
    reads only the partitions that its own rows fall into, a part of the table that shrinks with the
    batch; stored rows are matched on the 64-bit hash first. The hash takes the columns that are not
    NULL, by name, so it stays the same when columns are added. A table keeps the number
    of buckets it was made with; read it with :func:`read_appended`."""
    at = _row_bucket(df.sparkSession, path)
    if at or (buckets and read_table_or_empty(df.sparkSession, path) is None):
        return _append_hashed(df, path, at or f"lt_rows_of_{buckets}")

    existing = read_table_or_empty(df.sparkSession, path, merge_schema=True)
    return write_table(df if existing is None else _not_stored(df, existing), path, "append")


def _not_stored(df: DataFrame, existing: DataFrame) -> DataFrame:
    cols = [*df.columns, *[c for c in existing.columns if c not in df.columns]]
    types = {f.name: f.dataType for f in [*existing.schema.fields, *df.schema.fields]}
    side = lambda d: [F.col(c) if c in d.columns else F.lit(None).cast(types[c]).alias(c) for c in cols]
    ex = existing.select(*side(existing)).toDF(*[f"__lt_x_{c}" for c in cols])
    return df.select(*side(df)).join(ex, same_values(cols, [f"__lt_x_{c}" for c in cols]), "left_anti").select(*df.columns)


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def reads_path(df: DataFrame, path: str) -> bool:
    """True when the plan of ``df`` scans ``path`` or something under it. Compares
    the root paths of the plan's relations, not their files."""
    spark = df.sparkSession
    _, q = _hadoop(spark, path)
    root = q.toString().rstrip("/") + "/"
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        paths = relation.location().rootPaths()
        for k in range(paths.size()):
            _, fq = _hadoop(spark, paths.apply(k).toString())
            if (fq.toString().rstrip("/") + "/").startswith(root):
                return True
    return False


def _siblings(spark: SparkSession, path: str, mark: str) -> list[str]:
    fs, p = _hadoop(spark, path)
    parent = p.getParent()
    if not fs.exists(parent):
        return []
    head = p.getName() + mark
    return sorted(f.getPath().toString() for f in fs.listStatus(parent) if f.getPath().getName().startswith(head))


def recover_swap(spark: SparkSession, path: str) -> str:
    """Finish or undo a staged overwrite that stopped half-way; returns what was
    done (``"none"``, ``"completed"``, ``"restored"``, ``"cleaned"``).

    No live table: the staged one, which was complete before the old one was moved
    aside, takes its place, or else the old one comes back. With a live table,
    what is left beside it is removed."""
    fs, live = _hadoop(spark, path)
    old, staged = _siblings(spark, path, ".old-"), _siblings(spark, path, ".staging-")
    complete = [x for x in staged if fs.exists(_hadoop(spark, f"{x}/_SUCCESS")[1])]
    done = "none"
    if not fs.exists(live) and old:
        source = complete[-1] if complete else old[-1]
        if not fs.rename(_hadoop(spark, source)[1], live):
            raise OSError(f"could not move {source} to {path}")
        done = "completed" if complete else "restored"
    if fs.exists(live):
        for x in [*_siblings(spark, path, ".old-"), *_siblings(spark, path, ".staging-")]:
            fs.delete(_hadoop(spark, x)[1], True)
            done = "cleaned" if done == "none" else done
    return done


def write_table(df: DataFrame, path: str, mode: str = "overwrite", *, partition_by: list[str] | None = None) -> dict[str, Any]:
    """Write ``df`` as parquet; returns ``{"rows": n}`` observed during the write.

    ``overwrite`` of an existing table is staged: the result is written next to
    the target, then swapped in by two renames. The old table is kept until the new one is
    in place, so a plan may read its own target, and a write that stops half-way
    leaves the old table. On object stores a rename is a copy and the swap is not atomic.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if not path_exists(df.sparkSession, path) and _siblings(df.sparkSession, path, ".old-"):
        raise OSError(f"{path}: a swap was interrupted; call recover_swap first")
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    staged = mode == "overwrite" and path_exists(df.sparkSession, path)
    target = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}" if staged else path
    w = observed.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    if staged:
        spark = df.sparkSession
        fs, live = _hadoop(spark, path)
        _, new = _hadoop(spark, target)
        _, old = _hadoop(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
        if not fs.rename(live, old):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(new, live):
            fs.rename(old, live)
            raise OSError(f"could not move staged table into {path}")
        fs.delete(old, True)
    return dict(obs.get)

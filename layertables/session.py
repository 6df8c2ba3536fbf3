"""Scratch space in the folder that a cluster's machines share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master gets a fresh folder under
    the system temp dir, registered so that ``DataFrame.checkpoint()`` uses the same
    place; on a cluster that is an error, since machines would write to their own disks.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
            d = tempfile.mkdtemp(prefix="layertables-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path inside the shared folder; removed by
    :func:`clean_scratch`, at the latest when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(clean_scratch)
    _SCRATCH[path] = spark
    return path


def clean_scratch() -> None:
    """Remove all scratch paths handed out so far. Frames read from them end here."""
    while _SCRATCH:
        path, spark = _SCRATCH.popitem()
        with contextlib.suppress(Exception):  # the session may have ended
            if spark.sparkContext._jsc is None:
                continue
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

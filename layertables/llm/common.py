"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from layertables.session import scratch_path

#: A key with more than one in so many of the rows is hot; so there are fewer hot keys than this.
HOT_KEYS = 10_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand whole texts to Python in batches of at most ``rows`` rows. A value
    that the user has already lowered stays."""
    if int(spark.conf.get(_BATCH, "10000")) > rows:
        spark.conf.set(_BATCH, str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def written_to(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` into the shared folder and read it back; also its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts lineage and
    survives the loss of any executor."""
    return written_to(df, name)[0]


def unwritten(spark: SparkSession, path: str) -> None:
    """Remove what :func:`written_to` wrote, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def spread_join(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``small``, which has one row for every ``key`` of ``rows``.
    The fewer than :data:`HOT_KEYS` rows of ``small`` for hot keys are broadcast, so rows of one key
    never meet in a task in numbers that grow with its share; all others are shuffled, however small Spark takes them to be. ``rows`` is
    read three times and should be written."""
    most = rows.count() / HOT_KEYS
    hot = rows.groupBy(key).count().filter(F.col("count") > most).select(key)
    hot = F.broadcast(written(small.join(F.broadcast(hot), key, "left_semi"), "hot"))
    rest = rows.join(hot, key, "left_anti").join(small.hint("merge"), key)
    return rows.join(hot, key).unionByName(rest)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def crc_of_id_py(value) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode())


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column as Python strings, null as the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array | list]]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from a batch to columns. ``make`` runs once
    a task, for what is loaded or compiled there; columns of the batch whose
    names are in ``schema`` pass through unless the function returns them."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for b in batches:
            fn = fn or make()
            got = fn(b)
            cols = []
            for f in target:
                c = got[f.name] if f.name in got else b.column(f.name)
                cols.append(c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type))
            yield pa.RecordBatch.from_arrays(cols, names=target.names)

    return df.mapInArrow(run, schema)

"""Raw CSV feeds under a declared schema.

Columns are bound **by header name**, not by position: the executors read each file's
header (one pass of small tasks that stop at the first line), a file-ordered schema
is built from the declared types, and the result is projected to the declared order. Files
with different headers in one feed are read in one scan: every line is parsed
by its own file's header. Every row is kept: empty
fields become NULL, case is kept, and a line whose values do not fit the
declared types is captured whole in a corrupt-record column (PERMISSIVE mode)
so it can be quarantined instead of silently becoming NULLs.

Lines are scanned as text and parsed by an expression, so the raw line is at hand,
with its quotes. A line that equals its file's header line is a header wherever it
stands (concatenated files). A quoted field cannot span lines there; ``multi_line=True`` reads such
feeds with Spark's own reader, which takes a whole file in one task.
"""

from __future__ import annotations

import csv as _csv
import logging
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layertables.session import scratch_path
from layertables.sources.schema import schema_from_fields, validate_schema

CORRUPT = "_corrupt_record"
_log = logging.getLogger(__name__)
_LINE = "__lt_line"
_HEAD = "__lt_head"


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in fields)


def _typed(c, t: T.DataType, date_format: str | None, timestamp_format: str | None):
    if isinstance(t, T.StringType):
        return c
    if isinstance(t, T.BooleanType):  # as a CSV reader: no "yes", "1" or "t"
        low = F.lower(F.trim(c))
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if isinstance(t, T.DateType) and date_format:
        return F.try_to_timestamp(c, F.lit(date_format)).cast(t)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)) and timestamp_format:
        return F.try_to_timestamp(c, F.lit(timestamp_format)).cast(t)
    return c.try_cast(t)


# One file a task, and few lines handed over at once: a task ends at its first line.
_ONE_FILE = {
    "spark.sql.files.maxPartitionBytes": str(64 << 30),
    "spark.sql.files.openCostInBytes": str(64 << 30),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}
#: Different headers of one feed that are plausible; more means that the files have none.
MAX_HEADERS = 1000


def header_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line``: the first line of every file of a feed, as it stands there; empty files have no row.

    Read by the executors, one short task a file, and kept in scratch space. Works on any
    filesystem and compression that Spark reads."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                if b.column("at")[0].as_py() == 0:  # else a later part of a very large file
                    yield b.slice(0, 1).select(["file", "line"])
                return

    meta = {"file": F.col("_metadata.file_path"), "at": F.col("_metadata.file_block_start"), "line": F.col("value")}
    lines = spark.read.text(path).select(*[c.alias(n) for n, c in meta.items()]).mapInArrow(first, "file string, line string")
    kept = {k: spark.conf.get(k, None) for k in _ONE_FILE}
    out = scratch_path(spark, "headers")
    try:
        for k, v in _ONE_FILE.items():
            spark.conf.set(k, v)
        lines.write.parquet(out)
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema("file string, line string").parquet(out)


def _headers(heads: DataFrame) -> list[str]:
    """The different header lines, in a fixed order."""
    found = [r[0] for r in heads.filter("line != ''").select("line").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(found) > MAX_HEADERS:
        raise ValueError(f"over {MAX_HEADERS} different first lines: do the files have headers?")
    return sorted(found)


def header_names(line: str | None, sep: str = ",", quote: str = '"') -> tuple[str, ...]:
    """Column names of a header line."""
    if not line:
        return ()
    return tuple(h.strip() for h in next(_csv.reader([line.lstrip("\ufeff")], delimiter=sep, quotechar=quote)))


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the first line of one file (or of some file of a feed)."""
    rows = spark.read.text(path).limit(1).collect()
    return list(header_names(rows[0][0] if rows else None, sep))


def read_csv_declared(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | list,
    *,
    corrupt_column: str | None = CORRUPT,
    shared_header: bool = False,
    sep: str = ",",
    date_format: str | None = None,
    timestamp_format: str | None = None,
    quote: str = '"',
    escape: str = "\\",
    headers: DataFrame | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Declared-schema scan of header CSV files, bound by header name.

    ``shared_header=True`` reads only some file's header and assumes the
    rest agree; ``headers`` gives a :func:`header_table` that is there already. Declared
    columns that a file lacks are NULL; undeclared columns are not returned (see
    :func:`header_drift`). With ``corrupt_column`` (default
    ``_corrupt_record``) malformed lines are kept and flagged. ``multi_line=True`` is for feeds
    with line breaks inside quotes: Spark's reader then takes every header line that is not a file's first
    as data, and all files of the feed must share their columns' order.
    """
    declared = schema_from_fields(schema)
    if shared_header or multi_line:
        line = spark.read.text(path).limit(1).collect()
        heads, found = None, [line[0][0]] if line and line[0][0] else []
    else:
        heads = header_table(spark, path) if headers is None else headers
        found = _headers(heads)
    if not found:  # only empty files
        if not spark.read.text(path).inputFiles():
            raise FileNotFoundError(f"no files under {path}")
        out = declared if not corrupt_column else declared.add(corrupt_column, T.StringType())
        return spark.createDataFrame([], out)

    types = {f.name: f.dataType for f in declared.fields}
    options = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    if multi_line:
        names = header_names(found[0], sep, quote)
        reader = spark.read.options(**options).option("header", True).option("multiLine", True)
        df = reader.schema(_ddl(_text_fields(names, corrupt_column))).csv(path)
        return df.select(*_declared(df, "", names, types, corrupt_column, corrupt_column, date_format, timestamp_format))

    value = F.col("value")
    data = spark.read.text(path)
    if len(found) > 1:
        data = data.withColumn("file", F.col("_metadata.file_path")).join(heads.withColumnRenamed("line", _HEAD), "file")
    else:
        data = data.withColumn(_HEAD, F.lit(found[0]))
    bom = F.lit("\ufeff")
    data = data.filter((F.ltrim(F.col(_HEAD), bom) != F.ltrim(value, bom)) & (F.trim(value) != ""))
    # Every field is read as text and typed by a projection, so a value
    # that does not fit its declared type is detected whatever columns a
    # later query needs (a parser would skip pruned columns).
    parsed = [
        F.from_csv(F.when(F.col(_HEAD) == h, value), _ddl(_text_fields(header_names(h, sep, quote), corrupt_column)), options).alias(f"__lt_r{i}")
        for i, h in enumerate(found)
    ]
    df = data.select(value.alias(_LINE), _HEAD, *parsed)
    by_header = [
        _declared(df, f"__lt_r{i}.", header_names(h, sep, quote), types, corrupt_column, _LINE, date_format, timestamp_format)
        for i, h in enumerate(found)
    ]
    if len(found) == 1:
        return df.select(*by_header[0])
    names = [*types, *([corrupt_column] if corrupt_column else [])]
    cols = []
    for k, n in enumerate(names):
        pick = reduce(lambda a, i: F.when(F.col(_HEAD) == found[i], by_header[i][k]).otherwise(a), range(len(found)), F.lit(None))
        cols.append(pick.alias(n))
    return df.select(*cols)


def _text_fields(names, corrupt_column: str | None) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in [*names, *([corrupt_column] if corrupt_column else [])]]


def _declared(df, prefix, header, types, corrupt_column, raw, date_format, timestamp_format) -> list:
    """The declared columns of lines under one header, and the raw line where it is malformed."""
    field = lambda n: F.col(f"{prefix}`{n}`")
    typed = {n: _typed(field(n), t, date_format, timestamp_format) for n, t in types.items() if n in header}
    cols = [typed[n].alias(n) if n in typed else F.lit(None).cast(t).alias(n) for n, t in types.items()]
    if corrupt_column:
        bad = [field(n).isNotNull() & typed[n].isNull() for n in typed]
        misfit = reduce(lambda a, b: a | b, bad) if bad else F.lit(False)
        line = F.col(raw)
        if raw == corrupt_column:  # Spark's reader keeps the record only where it could not parse it
            line = F.coalesce(line, F.concat_ws(",", *[field(n) for n in header]))
        cols.append(F.when(field(corrupt_column).isNotNull() | misfit, line).alias(corrupt_column))
    return cols


def header_drift(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | list,
    sep: str = ",",
    headers: DataFrame | None = None,
) -> dict:
    """Drift of the *actual* header against the declared schema (all as strings,
    since CSV carries no types): missing and extra columns per header."""
    declared = schema_from_fields(schema)
    result = {"is_valid": True, "missing_columns": [], "extra_columns": []}
    for line in _headers(header_table(spark, path) if headers is None else headers):
        h = header_names(line, sep)
        st = T.StructType([T.StructField(n, declared[n].dataType if n in declared.names else T.StringType()) for n in h])
        v = validate_schema(st, declared)
        result["missing_columns"] += [c for c in v["missing_columns"] if c not in result["missing_columns"]]
        result["extra_columns"] += [c for c in v["extra_columns"] if c not in result["extra_columns"]]
    result["is_valid"] = not result["missing_columns"]
    return result


def ingest(
    spark: SparkSession,
    feeds: Mapping[str, tuple[str, T.StructType | str | list]],
    output_path: str,
    *,
    corrupt_column: str | None = CORRUPT,
) -> dict[str, dict]:
    """Raw → bronze: scan each feed under its declared schema and write it to
    ``{output_path}/{table}`` (overwrite). One Spark job per feed; the row
    count comes from the write itself. Headers are read once, and drift is logged
    as a warning."""
    from layertables.sources.tables import write_table

    out = {}
    for table, (path, schema) in feeds.items():
        heads = header_table(spark, path)
        drift = header_drift(spark, path, schema, headers=heads)
        if drift["missing_columns"] or drift["extra_columns"]:
            _log.warning("%s: missing columns %s, extra columns %s", table, drift["missing_columns"], drift["extra_columns"])
        df = read_csv_declared(spark, path, schema, corrupt_column=corrupt_column, headers=heads)
        out[table] = {"drift": drift, **write_table(df, f"{output_path.rstrip('/')}/{table}")}
    return out

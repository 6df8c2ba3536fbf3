"""Declared schemas and drift reports.

A schema is declared, never inferred: a field list (``name``/``type``/
``nullable``), a YAML file holding one, or any Spark DDL string. Drift is
reported, never raised.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# The declared type names of a field list (case-insensitive).
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# Drift finding kinds.
MISSING_COLUMN = "missing_column"
EXTRA_COLUMN = "extra_column"
TYPE_MISMATCH = "type_mismatch"


def parse_type(name: str | T.DataType) -> T.DataType:
    """A declared type name, or anything Spark's DDL parser accepts
    (``decimal(12,2)``, ``array<string>``, ``timestamp_ntz``...)."""
    if isinstance(name, T.DataType):
        return name
    if not isinstance(name, str) or not name.strip():
        raise ValueError(f"invalid type: {name!r}")
    key = name.strip().lower()
    if key in TYPE_NAMES:
        return TYPE_NAMES[key]
    try:
        return T.DataType.fromDDL(name)
    except Exception as e:  # noqa: BLE001 - re-raised with context
        raise ValueError(f"unknown type: {name!r}") from e


def schema_from_fields(fields: str | Iterable[Any]) -> T.StructType:
    """``StructType`` from a DDL string, or from a list of ``{name, type,
    nullable}`` mappings or ``(name, type[, nullable])`` tuples. An empty
    list, an unnamed field and an unknown type are rejected."""
    if isinstance(fields, T.StructType):
        return fields
    if isinstance(fields, str):
        st = T.StructType.fromDDL(fields) if hasattr(T.StructType, "fromDDL") else T.DataType.fromDDL(fields)
        if not isinstance(st, T.StructType) or not st.fields:
            raise ValueError("a declared schema needs one field or more")
        return st
    out = []
    for f in fields:
        if isinstance(f, Mapping):
            name, typ, nullable = f.get("name"), f.get("type"), f.get("nullable", True)
        else:
            name, typ, nullable = (list(f) + [True])[:3]
        if not name:
            raise ValueError("every field needs a name")
        out.append(T.StructField(str(name), parse_type(typ), bool(nullable)))
    if not out:
        raise ValueError("a declared schema needs one field or more")
    return T.StructType(out)


def load_schema_from_yaml(path: str) -> T.StructType:
    """Read ``{table: ..., fields: [{name, type, nullable}, ...]}`` from YAML."""
    import yaml  # optional dependency, only needed for YAML declarations

    with open(path) as fh:
        raw = yaml.safe_load(fh)
    if not isinstance(raw, Mapping) or "fields" not in raw:
        raise ValueError(f"{path}: expected a mapping with 'fields'")
    return schema_from_fields(raw["fields"])


def _schema_of(x: DataFrame | T.StructType) -> T.StructType:
    return x if isinstance(x, T.StructType) else x.schema


def schema_findings(actual: DataFrame | T.StructType, expected: DataFrame | T.StructType | str) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, issue, expected_type, actual_type)`` in expected order, then extras.

    Types are compared in full (decimal precision/scale, element types), not
    by class; nullability is ignored because file sources make every field
    nullable.
    """
    exp = schema_from_fields(expected) if isinstance(expected, str) else _schema_of(expected)
    act = _schema_of(actual)
    a = {f.name: f.dataType for f in act.fields}
    e = {f.name: f.dataType for f in exp.fields}
    out: list[tuple[str, str, str | None, str | None]] = []
    for name, et in e.items():
        if name not in a:
            out.append((name, MISSING_COLUMN, et.simpleString(), None))
        elif a[name] != et:
            out.append((name, TYPE_MISMATCH, et.simpleString(), a[name].simpleString()))
    for name, at in a.items():
        if name not in e:
            out.append((name, EXTRA_COLUMN, None, at.simpleString()))
    return out


def validate_schema(df: DataFrame | T.StructType, expected_schema: T.StructType | str) -> dict:
    """Lenient check: ``{is_valid, missing_columns, type_mismatches, extra_columns}``.
    ``type_mismatches`` maps a column to ``{expected, actual}``. Never raises."""
    found = schema_findings(df, expected_schema)
    missing = [c for c, k, _, _ in found if k == MISSING_COLUMN]
    mism = {c: {"expected": et, "actual": at} for c, k, et, at in found if k == TYPE_MISMATCH}
    extra = [c for c, k, _, _ in found if k == EXTRA_COLUMN]
    return {
        "is_valid": not missing and not mism,
        "missing_columns": missing,
        "type_mismatches": mism,
        "extra_columns": extra,
    }


def drift_report(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Drift findings as a DataFrame, profiled against the data.

    Columns: ``column_name, issue, expected_type, actual_type, bad_values``.
    For a type mismatch ``bad_values`` counts the non-NULL values that would
    not survive a cast to the expected type (one aggregate pass over the
    data, partial aggregation before the shuffle); it is NULL for missing and
    extra columns.
    """
    found = schema_findings(df, expected)
    exp = schema_from_fields(expected) if isinstance(expected, str) else expected
    etypes = {f.name: f.dataType for f in exp.fields}
    counts = []
    for i, (col, issue, _, _) in enumerate(found):
        if issue != TYPE_MISMATCH:
            counts.append(F.lit(None).cast("bigint").alias(f"b{i}"))
            continue
        c = F.col(col)
        try:
            bad = c.isNotNull() & c.try_cast(etypes[col]).isNull()
            df.select(bad).schema  # analysis only: is the cast possible at all?
        except AnalysisException:
            bad = c.isNotNull()
        counts.append(F.sum(bad.cast("int")).cast("bigint").alias(f"b{i}"))
    if not found:
        return df.limit(0).select(
            F.lit(None).cast("string").alias("column_name"),
            F.lit(None).cast("string").alias("issue"),
            F.lit(None).cast("string").alias("expected_type"),
            F.lit(None).cast("string").alias("actual_type"),
            F.lit(None).cast("bigint").alias("bad_values"),
        )
    prof = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(col).alias("column_name"),
                F.lit(issue).alias("issue"),
                F.lit(et).cast("string").alias("expected_type"),
                F.lit(at).cast("string").alias("actual_type"),
                F.col(f"b{i}").alias("bad_values"),
            )
            for i, (col, issue, et, at) in enumerate(found)
        ]
    )
    return prof.select(F.inline(rows))

"""Sources and sinks: declared schemas, CSV feeds, parquet tables."""

from layertables.sources.csv import CORRUPT, csv_header, header_drift, ingest, read_csv_declared
from layertables.sources.schema import (
    drift_report,
    load_schema_from_yaml,
    parse_type,
    schema_findings,
    schema_from_fields,
    validate_schema,
)
from layertables.sources.tables import path_exists, read_table, read_table_or_empty, write_table

__all__ = [
    "CORRUPT",
    "csv_header",
    "drift_report",
    "header_drift",
    "ingest",
    "load_schema_from_yaml",
    "parse_type",
    "path_exists",
    "read_csv_declared",
    "read_table",
    "read_table_or_empty",
    "schema_findings",
    "schema_from_fields",
    "validate_schema",
    "write_table",
]

"""Cleaning rules: drop rows with NULLs in listed columns, upper- and
lower-case listed columns. One filter (pushed to the scan) and one
projection, whatever the number of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layertables.operators.quarantine import NULL_REQUIRED, REASON, Split


@dataclass(frozen=True)
class CleaningRules:
    drop_null_columns: Sequence[str] = ()
    uppercase_columns: Sequence[str] = ()
    lowercase_columns: Sequence[str] = ()

    @classmethod
    def from_mapping(cls, m: Mapping) -> "CleaningRules":
        return cls(
            tuple(m.get("drop_null_columns", ()) or ()),
            tuple(m.get("uppercase_columns", ()) or ()),
            tuple(m.get("lowercase_columns", ()) or ()),
        )


def _rules(r: CleaningRules | Mapping) -> CleaningRules:
    return r if isinstance(r, CleaningRules) else CleaningRules.from_mapping(r)


def recase(df: DataFrame, rules: CleaningRules | Mapping) -> DataFrame:
    """Upper then lower: a column in both lists ends lower-case."""
    r = _rules(rules)
    cases = {c: F.upper(F.col(c)) for c in r.uppercase_columns}
    cases.update({c: F.lower(F.col(c)) for c in r.lowercase_columns})
    return df.withColumns(cases) if cases else df


def apply_cleaning_rules(df: DataFrame, rules: CleaningRules | Mapping) -> DataFrame:
    """Drop rows with a NULL in any ``drop_null_columns``, then re-case."""
    r = _rules(rules)
    if r.drop_null_columns:
        df = df.na.drop(how="any", subset=list(r.drop_null_columns))
    return recase(df, r)


def clean_with_quarantine(df: DataFrame, rules: CleaningRules | Mapping) -> Split:
    """Like :func:`apply_cleaning_rules`, but rows that a drop rule removes are
    returned in ``quarantine`` with reason ``null_required:<column>`` instead of
    vanishing."""
    r = _rules(rules)
    reason = F.lit(None).cast("string")
    for c in reversed(list(r.drop_null_columns)):
        reason = F.when(F.col(c).isNull(), F.lit(f"{NULL_REQUIRED}:{c}")).otherwise(reason)
    flagged = df.withColumn(REASON, reason)
    valid = recase(flagged.filter(F.col(REASON).isNull()).drop(REASON), r)
    return Split(valid, flagged.filter(F.col(REASON).isNotNull()))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` exactly (case-sensitive)."""
    return df.filter(F.col(column) == F.lit(value))

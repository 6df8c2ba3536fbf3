"""Quarantine, cleaning, surrogate keys, as-of join, schema drift."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import D, OPEN, rows
from layertables.operators.asof import AsOf, asof_join, build_fact
from layertables.operators.clean import (
    CleaningRules,
    apply_cleaning_rules,
    clean_with_quarantine,
    filter_equals,
)
from layertables.operators.history import merge_scd2
from layertables.operators.keys import add_surrogate_key, history_key_columns, key_uniqueness
from layertables.operators.quarantine import quarantine_summary, separate_quarantine_records
from layertables.sources.schema import drift_report, load_schema_from_yaml, schema_from_fields, validate_schema


def test_quarantine_needs_both_dates_missing(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", None), (2, None, "2020-01-01"), (3, None, None)], "id int, a string, b string"
    )
    s = separate_quarantine_records(df, "a", "b")
    assert rows(s.valid, "id") == [(1,), (2,)]
    assert rows(s.quarantine, "id", "quarantine_reason") == [(3, "missing_dates")]
    assert s["valid"].count() == 2


def test_quarantine_without_columns_keeps_everything(spark):
    df = spark.createDataFrame([(1, None)], "id int, a string")
    s = separate_quarantine_records(df)
    assert s.valid.count() == 1 and s.quarantine.count() == 0


def test_quarantine_summary_rollup(spark):
    a = spark.createDataFrame([(1, "null_key"), (2, "null_key"), (3, "missing_dates")], "id int, quarantine_reason string")
    b = spark.createDataFrame([(1, "null_key")], "id int, quarantine_reason string")
    s = quarantine_summary({"a": a, "b": b})
    assert rows(s, "table_name", "quarantine_reason", "n_rows") == [
        (None, None, 4),
        ("a", None, 3),
        ("a", "missing_dates", 1),
        ("a", "null_key", 2),
        ("b", None, 1),
        ("b", "null_key", 1),
    ]


def test_cleaning_order_drop_upper_lower(spark):
    df = spark.createDataFrame([(1, "Ann", "Mixed"), (2, None, "x"), (3, "bo", None)], "id int, name string, seg string")
    rules = CleaningRules(drop_null_columns=("name",), uppercase_columns=("name", "seg"), lowercase_columns=("seg",))
    out = apply_cleaning_rules(df, rules)
    assert rows(out) == [(1, "ANN", "mixed"), (3, "BO", None)]
    split = clean_with_quarantine(df, rules)
    assert rows(split.quarantine, "id", "quarantine_reason") == [(2, "null_required:name")]
    assert rows(split.valid) == rows(out)
    # Mapping form of the rules, as in a config file.
    assert rows(apply_cleaning_rules(df, {"drop_null_columns": ["name"]}), "id") == [(1,), (3,)]


def test_simple_transformations(spark):
    df = spark.createDataFrame([(1, "Alice", "active"), (2, "bob", "Active")], "id int, name string, status string")
    assert rows(filter_equals(df, "status", "active"), "id") == [(1,)]  # exact case


def _hist(spark):
    b = spark.createDataFrame(
        [(1, "a", D("2020-01-01")), (1, "b", D("2020-02-01")), (2, "c", D("2020-01-15"))],
        "id int, name string, effective_from date",
    )
    return merge_scd2(b, None, "id", ["name"])


def test_surrogate_key_first_bigint_unique_stable(spark):
    h = _hist(spark)
    k = add_surrogate_key(h, "sk", history_key_columns(["id"], ["name"]))
    assert k.columns[0] == "sk"
    assert isinstance(k.schema["sk"].dataType, T.LongType)
    assert rows(key_uniqueness(k, "sk")) == [(3, 3, 0)]
    # Stable: independent of partitioning and of the run.
    again = add_surrogate_key(h.repartition(3), "sk", history_key_columns(["id"], ["name"]))
    assert rows(k, "sk", "id", "name") == rows(again, "sk", "id", "name")


@pytest.mark.parametrize("method", ["auto", "join", "window"])
def test_asof_half_open_and_unmatched_kept(spark, method):
    h = add_surrogate_key(_hist(spark), "sk", history_key_columns(["id"], ["name"]))
    f = spark.createDataFrame(
        [(10, 1, D("2020-01-31")), (11, 1, D("2020-02-01")), (12, 1, D("2019-12-31")), (13, 9, D("2020-03-01")), (14, None, D("2020-03-01"))],
        "oid int, id int, ts date",
    )
    out = asof_join(f, h, "id", "ts", columns={"sk": "customer_key", "name": "cname"}, method=method)
    assert out.count() == f.count()
    got = {r["oid"]: r["cname"] for r in out.collect()}
    assert got == {10: "a", 11: "b", 12: None, 13: None, 14: None}
    # build_fact chains lookups and projects.
    bf = build_fact(f, [AsOf(h, "id", "ts", {"name": "cname"})], select=["oid", "cname"])
    assert rows(bf) == rows(out, "oid", "cname")


@pytest.mark.parametrize("method", ["join", "window"])
def test_asof_timestamp_fact_against_date_validity(spark, method):
    h = _hist(spark)
    f = spark.createDataFrame([(1, 1)], "oid int, id int").withColumn("ts", F.to_timestamp(F.lit("2020-02-01 10:00:00")))
    out = asof_join(f, h, "id", "ts", columns=["name"], method=method)
    assert rows(out, "name") == [("b",)]


def test_schema_validation_and_drift(spark, tmp_path):
    exp = schema_from_fields([{"name": "id", "type": "integer"}, {"name": "price", "type": "decimal(10,2)"}])
    df = spark.createDataFrame([(1, 2.5, "x")], "id int, price double, extra string")
    v = validate_schema(df, exp)
    assert v["is_valid"] is False
    assert v["missing_columns"] == []
    assert v["type_mismatches"] == {"price": {"expected": "decimal(10,2)", "actual": "double"}}
    assert v["extra_columns"] == ["extra"]  # D6
    rep = drift_report(df, exp)
    assert rows(rep, "column_name", "issue") == [("extra", "extra_column"), ("price", "type_mismatch")]
    with pytest.raises(ValueError):
        schema_from_fields([])
    with pytest.raises(ValueError):
        schema_from_fields([{"name": "x", "type": "nonsense"}])
    y = tmp_path / "s.yaml"
    y.write_text("fields:\n  - name: id\n    type: integer\n  - name: name\n    type: string\n    nullable: true\n")
    try:
        st = load_schema_from_yaml(str(y))
    except ImportError:
        pytest.skip("no YAML parser installed")
    assert [f.name for f in st.fields] == ["id", "name"]

"""SCD2 history merge: the reference's asserted behaviours plus its defects
D1–D4, D7, D8, D12, D13, D15, D16, D18 (SURVEY §2.10), each by content."""

import pytest
from pyspark.sql import functions as F

from helpers import D, OPEN, intervals_ok, rows
from layertables.operators.history import (
    apply_scd2,
    change_counts,
    classify_changes,
    current_view,
    merge_scd2,
    resolve_effective_from,
)

SCHEMA = "id int, name string, segment string, effective_from date"


def batch(spark, data):
    return spark.createDataFrame([(i, n, s, D(f) if f else None) for i, n, s, f in data], SCHEMA)


def hist_of(spark, data):
    return merge_scd2(batch(spark, data), None, "id", ["name", "segment"])


H = ("id", "name", "segment", "effective_from", "effective_to", "is_current")


@pytest.mark.parametrize("strategy", ["auto", "window", "split"])
def test_first_load_and_change(spark, strategy):
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01"), (2, "b", None, "2020-01-01")])
    assert rows(h1, *H) == [
        (1, "a", "x", D("2020-01-01"), OPEN, True),
        (2, "b", None, D("2020-01-01"), OPEN, True),
    ]
    inc = batch(spark, [(1, "a", "y", "2020-02-01"), (2, "b", None, "2020-02-01"), (3, "c", "z", "2020-02-01")])
    h2 = merge_scd2(inc, h1, "id", ["name", "segment"], strategy=strategy)
    assert rows(h2, *H) == [
        (1, "a", "x", D("2020-01-01"), D("2020-02-01"), False),  # D3: closes where the next starts
        (1, "a", "y", D("2020-02-01"), OPEN, True),
        (2, "b", None, D("2020-01-01"), OPEN, True),  # D2: NULL on both sides is unchanged, row kept
        (3, "c", "z", D("2020-02-01"), OPEN, True),  # D1: new key exactly once
    ]
    intervals_ok(h2)


def test_replay_is_noop(spark):
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01")])
    inc = batch(spark, [(1, "a", "y", "2020-02-01"), (2, "b", None, "2020-02-01")])
    h2 = merge_scd2(inc, h1, "id", ["name", "segment"])
    h3 = merge_scd2(inc, h2, "id", ["name", "segment"])
    assert rows(h3, *H) == rows(h2, *H)


def test_batch_duplicates_chain_and_collapse(spark):
    # Several rows of one key in one batch are chained by date; equal
    # neighbours collapse; same key and date keeps one row by tie-break.
    inc = batch(
        spark,
        [
            (1, "a", "x", "2020-01-01"),
            (1, "a", "x", "2020-01-05"),  # unchanged → collapsed
            (1, "a", "y", "2020-02-01"),
            (1, "a", "z", "2020-02-01"),  # same date: least row wins
        ],
    )
    h = merge_scd2(inc, None, "id", ["name", "segment"])
    assert rows(h, *H) == [
        (1, "a", "x", D("2020-01-01"), D("2020-02-01"), False),
        (1, "a", "y", D("2020-02-01"), OPEN, True),
    ]


def test_late_arrival_goes_to_its_place(spark):
    # A row older than the current version does not become current.
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01")])
    h1 = merge_scd2(batch(spark, [(1, "a", "z", "2020-03-01")]), h1, "id", ["name", "segment"])
    late = batch(spark, [(1, "a", "y", "2020-02-01")])
    h = merge_scd2(late, h1, "id", ["name", "segment"])
    assert rows(h, "segment", "effective_from", "effective_to", "is_current") == [
        ("x", D("2020-01-01"), D("2020-02-01"), False),
        ("y", D("2020-02-01"), D("2020-03-01"), False),
        ("z", D("2020-03-01"), OPEN, True),
    ]
    intervals_ok(h)


def test_keys_independent_and_unchanged_not_duplicated(spark):
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01"), (2, "b", "x", "2020-01-01")])
    h = merge_scd2(batch(spark, [(1, "a", "x", "2020-03-01"), (2, "B", "x", "2020-03-01")]), h1, "id", ["name", "segment"])
    assert h.filter("id = 1").count() == 1
    assert rows(h.filter("id = 2"), "name", "is_current") == [("B", True), ("b", False)]


@pytest.mark.parametrize(
    "policy,expected",
    [
        ("keep", [(1, OPEN, True), (2, D("2020-01-01"), False), (2, OPEN, True)]),
        ("close", [(1, D("2020-06-30"), False), (2, D("2020-01-01"), False), (2, OPEN, True)]),
        ("drop", [(2, D("2020-01-01"), False), (2, OPEN, True)]),
    ],
)
def test_missing_keys_policy(spark, policy, expected):
    # Keys absent from the batch keep / close / lose their open version.
    h1 = hist_of(spark, [(1, "a", "x", "2019-01-01"), (2, "b", "x", "2019-01-01")])
    inc = batch(spark, [(2, "b", "y", "2020-01-01")])
    h = merge_scd2(inc, h1, "id", ["name", "segment"], missing_keys=policy, close_at=D("2020-06-30"))
    assert rows(h, "id", "effective_to", "is_current") == expected


def test_schema_evolution_fills_null(spark):
    # A column present in the batch only is NULL for stored rows.
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01")])
    inc = batch(spark, [(2, "b", "y", "2020-02-01")]).withColumn("tier", F.lit(3))
    h = merge_scd2(inc, h1, "id", ["name", "segment"])
    assert rows(h, "id", "tier") == [(1, None), (2, 3)]


def test_resolve_effective_from_order_and_single_column(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-02", "2019-01-01"), (2, None, "2019-01-01"), (3, None, None), (4, "junk", "2018-05-05")],
        "id int, upd string, cre string",
    )
    out = resolve_effective_from(df, "upd", "cre", "2000-01-01", time_type="date")
    assert rows(out, "id", "effective_from", "effective_to", "is_current") == [
        (1, D("2020-01-02"), OPEN, True),
        (2, D("2019-01-01"), OPEN, True),
        (3, D("2000-01-01"), OPEN, True),
        (4, D("2018-05-05"), OPEN, True),  # D7: malformed never aborts
    ]
    # One configured column works alone.
    one = resolve_effective_from(df, None, "cre", time_type="date")
    assert rows(one.filter("id = 1"), "effective_from") == [(D("2019-01-01"),)]


def test_apply_scd2_quarantine_reasons(spark):
    df = spark.createDataFrame(
        [(1, "a", "2020-01-01", None), (None, "b", "2020-01-01", None), (3, "c", None, None), (4, "d", "bad", "worse")],
        "id int, name string, upd string, cre string",
    )
    res = apply_scd2(df, None, "id", ["name"], None, "upd", "cre", time_type="date")
    assert rows(res.quarantine, "name", "quarantine_reason") == [
        ("b", "null_key"),  # D16
        ("c", "missing_dates"),
        ("d", "unparseable_dates"),  # D7
    ]
    assert rows(res.valid, "id") == [(1,)]
    assert res.valid.count() + res.quarantine.count() == df.count()


def test_apply_scd2_keeps_existing_validity(spark):
    # A batch that already carries validity is merged as is, not restamped.
    h = hist_of(spark, [(1, "a", "x", "2020-01-01")])
    res = apply_scd2(h, None, "id", ["name", "segment"])
    assert rows(res.valid, "effective_from") == [(D("2020-01-01"),)]


def test_classify_changes(spark):
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01"), (2, "b", None, "2020-01-01")])
    inc = batch(
        spark,
        [
            (1, "a", "y", "2020-02-01"),
            (2, "b", None, "2020-02-01"),
            (3, "c", "z", "2020-02-01"),
            (3, "c", "zz", "2020-02-01"),
        ],
    )
    c = classify_changes(inc, h1, "id", ["name", "segment"])
    assert rows(c, "id", "segment", "change_type") == [
        (1, "y", "changed"),
        (2, None, "unchanged"),
        (3, "z", "new"),
        (3, "zz", "duplicate"),
    ]
    assert rows(change_counts(c), "change_type", "n_rows") == [
        ("changed", 1),
        ("duplicate", 1),
        ("new", 1),
        ("unchanged", 1),
    ]


def test_current_view_one_per_key(spark):
    h1 = hist_of(spark, [(1, "a", "x", "2020-01-01")])
    h = merge_scd2(batch(spark, [(1, "a", "y", "2020-02-01")]), h1, "id", ["name", "segment"])
    assert rows(current_view(h), "id", "segment") == [(1, "y")]


def test_merge_argument_checks(spark):
    inc = batch(spark, [(1, "a", "x", "2020-01-01")])
    with pytest.raises(ValueError):
        merge_scd2(inc, None, "id", [])
    with pytest.raises(ValueError):
        merge_scd2(inc, None, "id", ["name"], missing_keys="close")
    with pytest.raises(ValueError):
        merge_scd2(inc.drop("effective_from"), None, "id", ["name"])

"""Rows never depend on the plan: every method, strategy and splitting of hot keys
gives the same result."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import D, OPEN, rows
from layertables.functions.hashing import content_key
from layertables.operators.asof import asof_join
from layertables.operators.history import apply_scd2, classify_changes, merge_scd2
from layertables.operators.keys import add_dense_key, add_surrogate_key
from layertables.operators.skew import SkewSpec

BASE = dt.date(2020, 1, 1)
HIST = "id int, v string, effective_from date, effective_to date, is_current boolean"
COLS = ["id", "v", "effective_from", "effective_to", "is_current"]
FORCE = SkewSpec(hot_rows=2, sample_fraction=1.0, bucket_rows=1, min_input_bytes=0)
QUIET = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return BASE + dt.timedelta(days=n)


def hist_df(spark, versions):
    return spark.createDataFrame([(k, v, day(f), OPEN if t is None else day(t), t is None) for k, v, f, t in versions], HIST)


def batch_df(spark, evs):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in evs], "id int, v string, effective_from date")


key = st.sampled_from([1, 2, None])
val = st.sampled_from(["a", "b", None])
overlapping = st.lists(
    st.tuples(key, val, st.integers(0, 12), st.integers(0, 8)).map(lambda x: (x[0], x[1], x[2], x[2] + x[3])), max_size=12
)
facts = st.lists(st.tuples(key, st.one_of(st.none(), st.integers(-1, 22))), min_size=1, max_size=20)


@settings(max_examples=4, **QUIET)
@given(versions=overlapping, fs=facts)
def test_asof_methods_agree_on_overlapping_versions(spark, versions, fs):
    dim = hist_df(spark, versions)
    f = spark.createDataFrame([(i, k, None if d is None else day(d)) for i, (k, d) in enumerate(fs)], "fid int, id int, ts date")
    got = [
        rows(asof_join(f, dim, "id", "ts", columns={"v": "dv"}, method=m, skew=s))
        for m, s in (("join", None), ("window", None), ("window", FORCE), ("auto", None))
    ]
    assert got[0] == got[1] == got[2] == got[3]
    assert len(got[0]) == len(fs)
    # The latest start counts, until its end.
    for fid, k, ts, dv in got[0]:
        best = [(day(a), day(b), v is not None, v or "") for kk, v, a, b in versions if k is not None and kk == k and ts is not None and day(a) <= ts]
        want = max(best) if best else None
        assert dv == ((want[3] if want[2] else None) if want and ts < want[1] else None)


def test_asof_null_ends_are_open_by_every_method(spark):
    a, b = spark.createDataFrame([(1, "A", day(0), None, True), (1, "B", day(150), OPEN, True), (2, "C", day(3), None, True)], HIST), None
    f = spark.createDataFrame([(i, k, day(n)) for i, (k, n) in enumerate([(1, 60), (1, 200), (2, 2), (2, 9), (3, 9)])], "fid int, id int, ts date")
    for m, s in (("join", None), ("window", None), ("window", FORCE), ("auto", None)):
        for prune in (False, True):
            b = asof_join(f, a, "id", "ts", columns={"v": "dv"}, method=m, skew=s, prune=prune)
            assert rows(b, "fid", "dv") == [(0, "A"), (1, "B"), (2, None), (3, "C"), (4, None)]


def test_pruned_versions_give_the_same_rows(spark, tmp_table):
    """Random overlapping and disjoint versions of many keys, some open, some NULL-ended."""
    import random

    from layertables.operators.asof import prune_versions

    rng = random.Random(2)
    apart, across = [], []
    for k in range(200):
        at = 0
        for _ in range(rng.randrange(6)):
            f = at + rng.randrange(3)
            at = f + rng.randrange(0, 30)
            apart.append((k, rng.choice("ab"), day(f), day(at), False))
            across.append((k, rng.choice("ab"), day(f), rng.choice([day(f + rng.randrange(60)), None]), False))
        if apart and rng.random() < 0.5:
            apart.append((k, "z", day(at), rng.choice([None, OPEN]), True))
    facts = spark.createDataFrame([(i, rng.choice([rng.randrange(210), None]), rng.choice([day(rng.randrange(40, 50)), None])) for i in range(300)], "fid int, id long, ts date")
    p = tmp_table("dim")
    spark.createDataFrame(apart, HIST).write.parquet(p)
    for dim, disjoint in ((spark.read.parquet(p), True), (spark.createDataFrame(across, HIST), False)):
        want = rows(asof_join(facts, dim, "id", "ts", columns={"v": "dv"}, method="join"))
        for m, s in (("join", None), ("window", None), ("window", FORCE)):
            assert rows(asof_join(facts, dim, "id", "ts", columns={"v": "dv"}, method=m, skew=s, prune=True, disjoint=disjoint)) == want
        less = prune_versions(dim, facts, "id", "ts", disjoint=disjoint).count()
        assert less < (0.7 if disjoint else 0.95) * dim.count()
    plan = asof_join(facts, spark.read.parquet(p), "id", "ts", columns={"v": "dv"}, prune=True, disjoint=True)._jdf.queryExecution().executedPlan().toString()
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x]
    assert any("LessThanOrEqual(effective_from" in x and "GreaterThan(effective_to" in x for x in pushed), plan
    # No fact with a time: no version is needed.
    assert prune_versions(dim, facts.filter("ts is null"), "id", "ts").count() == 0


@st.composite
def histories(draw):
    """Disjoint versions with gaps, some closed, some keys NULL."""
    out = []
    for k in draw(st.lists(st.sampled_from([1, 2, 3, None]), unique=True, max_size=4)):
        at = 0
        for _ in range(draw(st.integers(0, 4))):
            f = at + draw(st.integers(0, 3))
            t = f + draw(st.integers(1, 4))
            out.append([k, draw(val), f, t])
            at = t
        if out and out[-1][0] == k and draw(st.booleans()):
            out[-1][3] = None
    return [tuple(x) for x in out]


events = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), val, st.integers(0, 20)), max_size=10)


@settings(max_examples=4, **QUIET)
@given(stored=histories(), evs=events, policy=st.sampled_from(["keep", "close", "drop"]), present=st.lists(st.sampled_from([1, 2, 3, 9, None]), max_size=2))
def test_merge_strategies_and_hot_splitting_agree(spark, stored, evs, policy, present):
    kw = dict(missing_keys=policy, close_at=day(30), present_keys=spark.createDataFrame([(p,) for p in present], "id int"))
    got = [
        rows(merge_scd2(batch_df(spark, evs), hist_df(spark, stored), "id", ["v"], strategy=s, skew=w, **kw), *COLS)
        for s, w in (("window", None), ("window", FORCE), ("split", None), ("split", FORCE), ("auto", None))
    ]
    assert all(g == got[0] for g in got), (got, stored, evs)
    # Closed stays closed: a day that no stored version and no later start covers is not filled from behind.
    for k, f, t in {(r[0], r[2], r[3]) for r in got[0] if policy == "keep"}:
        inside = [(a, b) for kk, _, a, b in stored if kk == k and day(a) <= f and (b is None or f < day(b))]
        if inside and inside[0][1] is not None:
            assert t <= day(inside[0][1])
    a = rows(classify_changes(batch_df(spark, evs).filter("id is not null"), hist_df(spark, stored), "id", ["v"], skew=None))
    b = rows(classify_changes(batch_df(spark, evs).filter("id is not null"), hist_df(spark, stored), "id", ["v"], skew=FORCE))
    assert a == b


def test_late_row_does_not_reopen_a_closed_key(spark):
    stored = hist_df(spark, [(1, "A", 0, 150)])
    got = rows(merge_scd2(batch_df(spark, [(1, "B", 60)]), stored, "id", ["v"]), *COLS)
    assert got == [(1, "A", day(0), day(60), False), (1, "B", day(60), day(150), False)]
    got = rows(merge_scd2(batch_df(spark, [(1, "B", 60), (1, "C", 240)]), stored, "id", ["v"]), *COLS)
    assert got[1:] == [(1, "B", day(60), day(150), False), (1, "C", day(240), OPEN, True)]


def test_key_listed_as_present_is_not_missing_when_hot(spark):
    batch = spark.createDataFrame([(1, "a", "2020-01-05"), (1, "b", "2020-01-09"), (2, "x", None)], "id int, v string, day string")
    stored = hist_df(spark, [(1, "z", 0, None), (2, "x", 0, 3), (2, "y", 4, None), (3, "w", 1, None)])
    for policy, left in (("close", {1, 2}), ("drop", {1, 2})):
        for skew in (None, FORCE):
            res = apply_scd2(batch, stored, "id", ["v"], None, "day", time_type="date", missing_keys=policy, close_at=day(40), strategy="window", skew=skew)
            assert {r["id"] for r in res.valid.filter("is_current").collect()} == left, (policy, skew)


def test_times_are_not_cut_to_days(spark):
    stored = hist_df(spark, [(1, "A", 0, None)])
    batch = spark.sql("select 1 as id, 'B' as v, timestamp'2020-02-01 09:00:00' as effective_from")
    with pytest.raises(ValueError, match="lose its times"):
        merge_scd2(batch, stored, "id", ["v"])


def test_many_rows_of_one_key_and_date(spark):
    batch = spark.range(300_000).selectExpr("1 as id", "cast(id % 1000 as string) as v", "date'2020-02-01' as effective_from")
    want = [(1, "0", D("2020-02-01"), OPEN, True), (1, "A", day(0), D("2020-02-01"), False)]
    assert rows(merge_scd2(batch, hist_df(spark, [(1, "A", 0, None)]), "id", ["v"]), *COLS) == want
    # Found hot, the rows are combined before they meet.
    m = merge_scd2(batch, hist_df(spark, [(1, "A", 0, None)]), "id", ["v"], skew=SkewSpec(hot_rows=1000, sample_fraction=0.1, min_input_bytes=0))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "collect_list" not in plan
    assert rows(m, *COLS) == want


def test_classification_is_one_pass(spark, tmp_table):
    p = tmp_table("h")
    hist_df(spark, [(1, "A", 0, None)]).write.parquet(p)
    c = classify_changes(batch_df(spark, [(1, "B", 3)]), spark.read.parquet(p), "id", ["v"], skew=None)
    plan = c._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Join" not in plan
    assert plan.count("Sort [") <= 2


def test_first_load_has_no_join_and_no_job(spark, tmp_table):
    from layertables.sources.tables import read_table_or_empty

    empty = read_table_or_empty(spark, tmp_table("none"), batch_df(spark, []).schema)
    assert int(str(empty._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= 1
    history = read_table_or_empty(spark, tmp_table("none"), hist_df(spark, []).schema)
    m = merge_scd2(batch_df(spark, [(1, "B", 3), (1, "B", 5)]), history, "id", ["v"])
    assert "Join" not in m._jdf.queryExecution().executedPlan().toString()
    assert rows(m, *COLS) == [(1, "B", day(3), OPEN, True)]


def test_keys_are_injective_and_free_of_the_time_zone(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("<null>", "x"), ("-", "x"), ("", None), (None, ""), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert add_surrogate_key(df, "k", ["a", "b"]).select("k").distinct().count() == len(pairs)
    t = spark.sql("select timestamp_micros(1700000000123456) as t, timestamp_ntz'2024-03-01 10:00:00' as n")
    zone, seen = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for z in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            seen.add(tuple(t.select(content_key(["t", "n"], t)).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(seen) == 1


def test_dense_keys(spark):
    df = spark.createDataFrame([(k % 40, "same") for k in range(100)], "id int, v string")
    first = add_dense_key(df, "k", ["id"], buckets=7)
    assert first.columns == ["k", "id", "v"]
    assert sorted(r["k"] for r in first.collect()) == list(range(1, 101))
    assert sorted(r["k"] for r in add_dense_key(df, "k", ["id"], existing=first).collect()) == list(range(101, 201))
    assert add_dense_key(df.filter("id < 0"), "k", ["id"], existing=first.filter("id < 0")).collect() == []


def test_dense_keys_are_stable_and_no_group_is_large(spark, monkeypatch):
    from layertables.operators import keys

    monkeypatch.setattr(keys, "DENSE_ROWS", 200)
    monkeypatch.setattr(keys, "_DENSE_SAMPLE", 0.5)
    # A third are one row repeated; others are equal in the order column and differ elsewhere.
    df = spark.range(6000).selectExpr("if(id % 3 = 0, -1, id % 50) as a", "if(id % 3 = 0, 'same', string(id)) as b")
    groups = keys.dense_buckets(df, rows=200).groupBy("__lt_kb", "__lt_ks").count().agg({"count": "max", "*": "count"}).first()
    assert groups[0] <= 350 and groups[1] >= 30
    numbered = [rows(add_dense_key(x, "k", ["a"]), "k", "a", "b") for x in (df, df.repartition(13), df.coalesce(1))]
    assert numbered[0] == numbered[1] == numbered[2]
    assert [r[0] for r in numbered[0]] == list(range(1, 6001))

"""Hot keys split into time buckets give exactly the ordinary result."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import intervals_ok, rows
from layertables.operators.history import merge_scd2
from layertables.operators.skew import SkewSpec, estimated_bytes, hot_key_bounds

BASE = dt.date(2020, 1, 1)
SCHEMA = "id int, v string, effective_from date"
COLS = ["id", "v", "effective_from", "effective_to", "is_current"]
# Every key with >= 2 rows is hot; many narrow buckets, so seams are everywhere.
FORCE = SkewSpec(hot_rows=2, sample_fraction=1.0, bucket_rows=4, min_input_bytes=0)


def _df(spark, evs):
    return spark.createDataFrame([(k, v, BASE + dt.timedelta(days=d)) for k, d, v in evs], SCHEMA)


def test_detection_skips_small_inputs(spark, tmp_table):
    p = tmp_table("small")
    _df(spark, [(1, 1, "a")] * 50).write.parquet(p)
    df = spark.read.parquet(p)
    assert estimated_bytes(df) < SkewSpec().min_input_bytes
    assert hot_key_bounds(df, ["id"], "effective_from", SkewSpec()) is None
    b = hot_key_bounds(df, ["id"], "effective_from", FORCE)
    assert b is not None and b.count() == 1


def test_hot_key_plan_and_result(spark):
    rnd = random.Random(5)
    evs = [(0, d, rnd.choice(["a", "b", None])) for d in range(300)]  # one hot key
    evs += [(k, rnd.randrange(300), rnd.choice(["a", "b"])) for k in range(1, 40)]
    early = [e for e in evs if e[1] < 200]
    late = [e for e in evs if e[1] >= 150]  # overlaps: replays, late rows, corrections
    for policy in ["keep", "close", "drop"]:
        kw = dict(missing_keys=policy, close_at=BASE + dt.timedelta(days=250)) if policy != "keep" else {}
        plain = merge_scd2(_df(spark, late), merge_scd2(_df(spark, early), None, "id", ["v"], skew=None), "id", ["v"],
                           strategy="window", skew=None, **kw)
        hot = merge_scd2(_df(spark, late), merge_scd2(_df(spark, early), None, "id", ["v"], skew=FORCE), "id", ["v"],
                         strategy="window", skew=FORCE, **kw)
        assert rows(hot, *COLS) == rows(plain, *COLS), policy
        intervals_ok(hot)
    p = hot._jdf.queryExecution().executedPlan().toString()
    assert "__lt_bkt" in p


events = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 15), st.sampled_from(["a", "b", None])), min_size=1, max_size=30
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=events, b=events)
def test_random_batches_same_as_plain(spark, a, b):
    plain = merge_scd2(_df(spark, b), merge_scd2(_df(spark, a), None, "id", ["v"], skew=None), "id", ["v"], skew=None,
                       strategy="window")
    hot = merge_scd2(_df(spark, b), merge_scd2(_df(spark, a), None, "id", ["v"], skew=FORCE), "id", ["v"], skew=FORCE,
                     strategy="window")
    assert rows(hot, *COLS) == rows(plain, *COLS)


def test_asof_window_hot_buckets_equal_join(spark):
    from layertables.operators.asof import asof_join

    rnd = random.Random(9)
    evs = [(0, d, rnd.choice(["a", "b", "c"])) for d in range(0, 300, 3)]  # one key, many versions
    evs += [(k, rnd.randrange(300), rnd.choice(["a", "b"])) for k in range(1, 30)]
    hist = merge_scd2(_df(spark, evs), None, "id", ["v"], skew=None)
    # Close one version early to leave a gap, and add a zero-length correction.
    hist = hist.withColumn(
        "effective_to",
        F.when((F.col("id") == 0) & (F.col("effective_from") == BASE + dt.timedelta(days=30)), F.col("effective_from") + 1)
        .otherwise(F.col("effective_to")),
    )
    facts = spark.createDataFrame(
        [(i, rnd.choice([0, 0, 0, 1, 2, 99, None]), BASE + dt.timedelta(days=rnd.randrange(-5, 320))) for i in range(400)],
        "fid int, id int, ts date",
    )
    want = asof_join(facts, hist, "id", "ts", columns={"v": "dim_v"}, method="join")
    plain = asof_join(facts, hist, "id", "ts", columns={"v": "dim_v"}, method="window", skew=None)
    hot = asof_join(facts, hist, "id", "ts", columns={"v": "dim_v"}, method="window", skew=FORCE)
    assert rows(plain) == rows(want)
    assert rows(hot) == rows(want)
    assert hot.count() == facts.count()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=events, b=events)
def test_classify_hot_same_as_plain(spark, a, b):
    from layertables.operators.history import classify_changes

    hist = merge_scd2(_df(spark, a), None, "id", ["v"], skew=None)
    plain = classify_changes(_df(spark, b), hist, "id", ["v"], skew=None)
    hot = classify_changes(_df(spark, b), hist, "id", ["v"], skew=FORCE)
    cols = ["id", "v", "effective_from", "change_type"]
    assert rows(hot, *cols) == rows(plain, *cols)

"""Change rows of a merge: the stored history with the changes is the full merge."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import D, OPEN, rows
from layertables.operators.history import apply_changes, merge_changes, merge_scd2, replay_changes
from layertables.operators.skew import SkewSpec

BASE = dt.date(2020, 1, 1)
HIST = "id int, v string, note string, effective_from date, effective_to date, is_current boolean"
COLS = ["id", "v", "note", "effective_from", "effective_to", "is_current"]
FORCE = SkewSpec(hot_rows=3, sample_fraction=1.0, bucket_rows=1, min_input_bytes=0)


def day(n):
    return BASE + dt.timedelta(days=n)


def random_case(seed, keys=150):
    """A history of disjoint versions with gaps, and a batch with late, equal, repeated and new rows."""
    rng = random.Random(seed)
    stored, batch = [], []
    for k in range(keys):
        at = 0
        for _ in range(rng.randrange(4)):
            f = at + rng.randrange(4)
            at = f + rng.randrange(1, 5)
            stored.append([k, rng.choice(["a", "b", None]), f"n{f}", day(f), day(at), False])
        if stored and stored[-1][0] == k and rng.random() < 0.6:
            stored[-1][4:] = [OPEN, True]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            batch.append((k, rng.choice(["a", "b", None]), "new", day(rng.randrange(20))))
    return [tuple(s) for s in stored], batch


def frames(spark, seed):
    stored, batch = random_case(seed)
    stored.append((None, "x", "no key", day(1), OPEN, True))
    return spark.createDataFrame(stored, HIST), spark.createDataFrame(batch, "id int, v string, note string, effective_from date")


@pytest.mark.parametrize("policy,strategy,skew", [("keep", "window", None), ("keep", "split", None), ("close", "window", FORCE), ("close", "split", None), ("drop", "window", None), ("drop", "auto", FORCE)])
def test_history_with_changes_is_the_full_merge(spark, policy, strategy, skew):
    hist, batch = frames(spark, policy)
    kw = dict(missing_keys=policy, close_at=day(30), strategy=strategy, skew=skew)
    full = rows(merge_scd2(batch, hist, "id", ["v"], **kw), *COLS)
    changes = merge_changes(batch, hist, "id", ["v"], **kw).cache()
    assert rows(apply_changes(hist, changes, "id", ["v"]), *COLS) == full
    kinds = {r["change"] for r in changes.select("change").distinct().collect()}
    assert kinds == {"insert", "close", *(["delete"] if policy == "drop" else [])}
    assert changes.filter("change = 'insert' and previous_effective_to is not null").isEmpty()
    # Nothing untouched is among them.
    same = changes.filter("change = 'close' and effective_to <=> previous_effective_to")
    assert same.isEmpty() and (policy != "keep" or changes.count() < len(full) / 2)
    # Applied twice, nothing more happens; a rerun of the batch changes nothing.
    after = apply_changes(hist, changes, "id", ["v"])
    assert rows(apply_changes(after, changes, "id", ["v"]), *COLS) == full
    if policy == "keep":
        assert merge_changes(batch, after, "id", ["v"], strategy=strategy, skew=skew).isEmpty()
    changes.unpersist()


def test_replay_of_several_runs(spark, tmp_table):
    first, second = (frames(spark, s)[1] for s in ("r1", "r2"))
    one = tmp_table("run1")
    merge_changes(first, None, "id", ["v"]).write.parquet(one)
    h1 = merge_scd2(first, None, "id", ["v"])
    two = merge_changes(second, h1, "id", ["v"])
    got = replay_changes(None, [spark.read.parquet(one), two], "id", ["v"])
    assert rows(got, *COLS) == rows(merge_scd2(second, h1, "id", ["v"]), *COLS)


def test_stored_null_end_is_open(spark):
    hist, batch = frames(spark, 7)
    null_end = hist.withColumn("effective_to", F.when(F.col("effective_to") < F.lit("9999-12-31"), F.col("effective_to")))
    want = rows(merge_scd2(batch, hist, "id", ["v"], strategy="window", skew=None), *COLS)
    assert null_end.filter("effective_to is null").count() > 20
    for strategy, skew in (("window", None), ("split", None), ("window", FORCE)):
        assert rows(merge_scd2(batch, null_end, "id", ["v"], strategy=strategy, skew=skew), *COLS) == want
    changes = merge_changes(batch, null_end, "id", ["v"])
    assert rows(apply_changes(null_end, changes, "id", ["v"]), *COLS) == want


def test_new_columns_come_with_the_changes(spark):
    hist = spark.createDataFrame([(1, "a", D("2020-01-01"), OPEN, True)], "id int, v string, effective_from date, effective_to date, is_current boolean")
    batch = spark.createDataFrame([(1, "b", "x", D("2020-03-01"))], "id int, v string, more string, effective_from date")
    got = apply_changes(hist, merge_changes(batch, hist, "id", ["v"]), "id", ["v"])
    assert rows(got, "v", "more", "effective_to") == [("a", None, D("2020-03-01")), ("b", "x", OPEN)]

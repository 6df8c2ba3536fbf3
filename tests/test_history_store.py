"""Partitioned histories: a merge replaces only what it touches, and survives being stopped."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import D, OPEN, rows
from layertables.operators.history import apply_changes, merge_scd2
from layertables.sources import history_store as hs
from test_changes import COLS, day, frames, random_case


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for f in names:
            if f.endswith(".parquet"):
                out[os.path.join(folder, f)] = os.stat(os.path.join(folder, f)).st_mtime_ns
    return out


def local(p):
    return p[5:] if p.startswith("file:") else p


def parts_of(names):
    return {tuple(x.split("=")[1] for x in n.split("/")[-4:-1]) for n in names}


def test_one_percent_of_keys_rewrites_only_their_partitions(spark, tmp_table):
    p = tmp_table("store")
    h = spark.range(4000).selectExpr("id", "concat('v', id % 3) as v", "date'2020-01-01' as effective_from")
    old = merge_scd2(h, None, "id", ["v"])
    old = old.withColumn("effective_to", F.when(F.col("id") % 4 == 0, F.lit("2020-02-01").cast("date")).otherwise(F.col("effective_to")))
    old = old.withColumn("is_current", F.col("effective_to") == F.lit("9999-12-31").cast("date"))
    old = spark.createDataFrame(old.collect(), old.schema)
    hs.create_history(old, p, "id", buckets=64)
    batch = spark.range(1, 4000, 100).selectExpr("cast(id as int) as id", "'new' as v", "date'2020-03-01' as effective_from").filter("id % 4 != 0")
    n_keys = batch.count()
    before = files(local(p))
    done = hs.merge_history(batch, p, "id", ["v"])
    after = files(local(p))
    assert (done.inserted, done.closed, done.deleted) == (n_keys, n_keys, 0)
    kept = {f for f in before if after.get(f) == before[f]}
    buckets = {str(r[0]) for r in batch.select(F.pmod(F.xxhash64(F.col("id").cast("bigint")), F.lit(64))).collect()}
    assert len(buckets) < 40
    # Open partitions of touched buckets were replaced, closed ones of this run added, all others not written.
    assert parts_of(set(before) - kept) == {("open", b, "0") for b in buckets}
    assert parts_of(set(after) - kept) == {("open", b, "0") for b in buckets} | {("closed", b, "1") for b in buckets}
    assert set(done.replaced) == {(s, int(b), int(r)) for s, b, r in parts_of(set(after) - kept)}
    want = merge_scd2(batch, old, "id", ["v"])
    assert rows(hs.read_history(spark, p), *want.columns) == rows(want)
    # A rerun of the batch writes nothing.
    assert hs.merge_history(batch, p, "id", ["v"]).replaced == [] and files(local(p)) == after


@pytest.mark.parametrize("policy", ["keep", "close", "drop"])
def test_same_rows_as_the_full_overwrite(spark, tmp_table, policy):
    p, log = tmp_table("store"), tmp_table("log")
    hist, batch = frames(spark, policy)
    hist = hist.filter("id is not null")
    hs.create_history(hist, p, "id", buckets=8)
    kw = dict(missing_keys=policy, close_at=day(30))
    done = hs.merge_history(batch, p, "id", ["v"], changes_path=log, **kw)
    want = rows(merge_scd2(batch, hist, "id", ["v"], **kw), *COLS)
    assert rows(hs.read_history(spark, p), *COLS) == want and done.inserted and done.closed
    assert rows(apply_changes(hist, spark.read.parquet(log), "id", ["v"]), *COLS) == want
    # A second run on top, with late rows into versions that the first one closed.
    _, more = random_case("more")
    more = spark.createDataFrame(more, batch.schema)
    hs.merge_history(more, p, "id", ["v"])
    want = rows(merge_scd2(more, spark.createDataFrame(want, hist.select(*COLS).schema), "id", ["v"]), *COLS)
    assert rows(hs.read_history(spark, p), *COLS) == want
    if policy == "keep":
        n = len(hs.partitions(spark, p))
        gone = hs.compact_closed(spark, p)
        assert gone and rows(hs.read_history(spark, p), *COLS) == want
        assert len(hs.partitions(spark, p)) < n and {r for _, _, r in hs.partitions(spark, p)} == {0}


def test_first_load_and_a_bucket_that_ends_up_empty(spark, tmp_table):
    p = tmp_table("store")
    first = spark.createDataFrame([(k, "a", D("2020-01-01")) for k in range(6)], "id int, v string, effective_from date")
    assert hs.merge_history(first, p, "id", ["v"], buckets=16).inserted == 6
    batch = spark.createDataFrame([(0, "a", D("2020-02-01"))], "id int, v string, effective_from date")
    hs.merge_history(batch, p, "id", ["v"], missing_keys="drop")
    assert rows(hs.read_history(spark, p), "id", "v", "effective_to") == [(0, "a", OPEN)]
    assert len(hs.partitions(spark, p)) == 1
    hs.merge_history(batch.filter("id < 0"), p, "id", ["v"], missing_keys="drop")
    assert hs.partitions(spark, p) == []
    hs.merge_history(batch, p, "id", ["v"], buckets=4)
    assert rows(hs.read_history(spark, p), "id", "v") == [(0, "a")]
    with pytest.raises(ValueError, match="exists already"):
        hs.create_history(first, p, "id")


def test_a_stopped_merge_is_finished(spark, tmp_table, monkeypatch):
    p = tmp_table("store")
    hist, batch = frames(spark, "stop")
    hist = hist.filter("id is not null")
    hs.create_history(hist, p, "id", buckets=4)
    want = rows(merge_scd2(batch, hist, "id", ["v"]), *COLS)
    real = hs.recover_partitions
    calls = []

    def stop(s, path):  # the second call puts the result in place
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return real(s, path)

    monkeypatch.setattr(hs, "recover_partitions", stop)
    with pytest.raises(RuntimeError):
        hs.merge_history(batch, p, "id", ["v"])
    monkeypatch.undo()
    with pytest.raises(OSError, match="recover_partitions"):
        hs.read_history(spark, p)
    assert hs.recover_partitions(spark, p) == "completed"
    assert rows(hs.read_history(spark, p), *COLS) == want
    assert hs.recover_partitions(spark, p) == "none"
    # Stopped before the result was whole: the table is as it was.
    spark.range(3).write.parquet(f"{p}.part-half/data")
    assert rows(hs.read_history(spark, p), *COLS) == want
    assert hs.recover_partitions(spark, p) == "cleaned"


def test_new_columns(spark, tmp_table):
    p = tmp_table("store")
    first = spark.createDataFrame([(k, "a", D("2020-01-01")) for k in range(4)], "id int, v string, effective_from date")
    hs.merge_history(first, p, "id", ["v"], buckets=4)
    wide = spark.createDataFrame([(1, "b", "x", D("2020-02-01"))], "id int, v string, more string, effective_from date")
    hs.merge_history(wide, p, "id", ["v"])
    got = rows(hs.read_history(spark, p).filter("id = 1"), "v", "more", "effective_to")
    assert got == [("a", None, D("2020-02-01")), ("b", "x", OPEN)]


def test_refine_into_partitions_equals_the_overwrite(spark, tmp_table):
    from dataclasses import replace

    from layertables.plans import derive as dv
    from layertables.plans.jobs import refine_to_path
    from layertables.plans.queries import CUSTOMER_RULES, RAW_HIST

    sf, base = "/root/testdata/sf0.001", tmp_table("refine")
    for day_, make in enumerate((dv.batch1_raw, dv.batch2_raw)):
        make(spark, sf).write.parquet(f"{base}/in{day_}")
        for name, rules in (("plain", CUSTOMER_RULES), ("parts", replace(CUSTOMER_RULES, history_buckets=8, missing_keys="drop"))):
            rules = replace(rules, missing_keys="drop")
            out = refine_to_path(spark, rules, f"{base}/in{day_}", f"{base}/{name}", f"{base}/q-{name}")
    assert out["deleted"] > 0 and out["quarantined"] > 0
    got = [rows(hs.read_history(spark, f"{base}/{n}"), *RAW_HIST) for n in ("plain", "parts")]
    assert got[0] == got[1]

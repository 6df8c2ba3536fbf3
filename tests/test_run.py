"""One time for a whole run, and reruns that begin behind the last finished step."""

import datetime as dt
import json
import time

import pytest

from helpers import rows
from layertables.operators.clean import CleaningRules
from layertables.operators.history import resolve_effective_from
from layertables.operators.load import LoadSpec
from layertables.plans import jobs
from layertables.plans.jobs import DimensionJob, FactJob, TableJob, TableRules, load_rules, refine_all, run_layers
from layertables.plans.run import start_run
from layertables.sources.tables import read_table

FEEDS = {"people": "id int, name string", "visits": "visit int, id int, at string"}


def feeds(spark, base):
    out = {}
    for name, ddl, data in (("people", "id int, name string", [(1, "a"), (2, "b")]), ("visits", "visit int, id int, at string", [(7, 1, "2999-01-01"), (8, 9, "2999-01-01")])):
        spark.createDataFrame(data, ddl).coalesce(1).write.option("header", True).csv(f"{base}/raw/{name}")
        out[name] = (f"{base}/raw/{name}", FEEDS[name])
    return out


def layers(spark, base, raw, run=None):
    return run_layers(
        spark,
        raw_feeds=raw,
        bronze=f"{base}/bronze",
        silver=f"{base}/silver",
        gold=f"{base}/gold",
        quarantine=f"{base}/quarantine",
        rules=[TableRules("people", scd2=True, key="id", tracked=("name",), time_type="date", corrupt_column="_corrupt_record"), TableRules("visits", cleaning=CleaningRules(drop_null_columns=("id",)), corrupt_column="_corrupt_record")],
        dimensions=[DimensionJob("people", "dim_people", "id", "person_key", ("name",))],
        facts=[FactJob("visits", "fact_visits", "dim_people", "id", "at", "id", "person_key", ["visit", "person_key"], "yyyy-MM-dd")],
        run=run,
    )


def test_a_stopped_run_goes_on_behind_its_last_step(spark, tmp_table, monkeypatch):
    a, b = tmp_table("one"), tmp_table("two")
    raw = feeds(spark, a)
    now = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)
    layers(spark, b, raw, start_run(spark, "r1", f"{b}/journal", now=now))
    want = rows(read_table(spark, f"{b}/gold/fact_visits"))

    first = start_run(spark, "r1", f"{a}/journal", now=now)
    monkeypatch.setattr(jobs, "build_dimension", lambda *x, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        layers(spark, a, raw, first)
    monkeypatch.undo()
    ran = []
    real = jobs.refine_to_path
    monkeypatch.setattr(jobs, "refine_to_path", lambda *x, **k: ran.append(x) or real(*x, **k))
    again = start_run(spark, "r1", f"{a}/journal")
    assert again.now == now and set(again.finished) == {"bronze:people", "bronze:visits", "silver:people", "silver:visits"}
    report = layers(spark, a, raw, again)
    assert ran == [] and report["silver"]["people"]["rows"] == 2
    assert rows(read_table(spark, f"{a}/gold/fact_visits")) == want and [w[1] is None for w in want] == [False, True]
    # A finished run does nothing; another name is another run.
    done = start_run(spark, "r1", f"{a}/journal")
    before = rows(read_table(spark, f"{a}/gold/fact_visits"))
    monkeypatch.setattr(jobs, "write_table", lambda *x, **k: pytest.fail("written again"))
    assert layers(spark, a, raw, done)["gold"]["fact_visits"]["rows"] == 2 and rows(read_table(spark, f"{a}/gold/fact_visits")) == before
    monkeypatch.undo()
    assert start_run(spark, "r2", f"{a}/journal").finished == {}
    with pytest.raises(ValueError, match="name"):
        start_run(spark, None, f"{a}/journal")


def test_one_time_for_all_tables_of_a_run(spark, tmp_table):
    base = tmp_table("now")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    for t in ("t1", "t2", "t3", "t4"):
        df.write.parquet(f"{base}/in/{t}")
    run = start_run(spark)
    rules = [TableRules(t, scd2=True, key="id", tracked=("v",), history_buckets=b) for t, b in (("t1", None), ("t2", 2))]
    refine_all(spark, rules, f"{base}/in", f"{base}/out", run=run)
    time.sleep(0.05)
    # A job whose load dates the rows, and one whose own transform does.
    TableJob(spark, f"{base}/in/t3", f"{base}/out/t3", LoadSpec("scd2", keys="id", tracked=["v"]), lambda d: d, context=run).run()

    class Dated(TableJob):
        def transform(self, df):
            return resolve_effective_from(df, now=self.now)

    Dated(spark, f"{base}/in/t4", f"{base}/out/t4", LoadSpec("overwrite"), context=run).run()
    starts = [r["effective_from"] for t in ("t1", "t2", "t3", "t4") for r in read_table(spark, f"{base}/out/{t}").collect()]
    assert len(starts) == 4 and len(set(starts)) == 1
    assert starts[0].astimezone(dt.timezone.utc).replace(microsecond=0) == run.now.replace(microsecond=0)


def test_rules_are_read_through_spark(spark, tmp_path):
    for name, m in (("b.json", {"table": "b", "history_buckets": 4}), ("a.json", {"table": "a", "scd2": True, "scd2_key": "id"})):
        (tmp_path / name).write_text(json.dumps(m, indent=2))
    (tmp_path / "notes.txt").write_text("not a rule")
    got = load_rules(f"file:{tmp_path}", spark=spark)
    assert got == load_rules(str(tmp_path)) and [r.table for r in got] == ["a", "b"] and got[1].history_buckets == 4
    (tmp_path / "c.json").write_text('{"table": "a"}')
    with pytest.raises(ValueError, match="several"):
        load_rules(f"file:{tmp_path}", spark=spark)

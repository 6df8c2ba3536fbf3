"""No loss at the sinks: evolved columns, slices, interrupted swaps, shared folders."""

import json

import pytest
from pyspark.errors import AnalysisException

from helpers import D, OPEN, rows
from layertables import session
from layertables.operators.load import LoadSpec, plan_load
from layertables.plans.jobs import TableJob, TableRules, load_rules, refine_table
from layertables.sources import tables as t


def test_append_new_keeps_rows_that_differ_in_a_new_column(spark, tmp_table):
    p = tmp_table("q")
    t.append_new(spark.createDataFrame([(1, "a")], "id int, v string"), p)
    wide = spark.createDataFrame([(1, "a", "new-info"), (1, "a", None)], "id int, v string, more string")
    for _ in range(2):
        t.append_new(wide, p)
    t.append_new(spark.createDataFrame([("a", 1)], "v string, id int"), p)
    assert rows(t.read_table(spark, p, merge_schema=True), "id", "v", "more") == [(1, "a", None), (1, "a", "new-info")]


def test_scd2_slice_keeps_other_keys(spark, tmp_table):
    base = tmp_table("scd2")
    hist = spark.createDataFrame([(1, "a", D("2020-01-01"), OPEN, True), (2, "b", D("2020-01-01"), OPEN, True)], "id int, v string, effective_from date, effective_to date, is_current boolean")
    t.write_table(hist, f"{base}/out")
    t.write_table(spark.createDataFrame([(1, "c", D("2020-03-01"))], "id int, v string, effective_from date"), f"{base}/in")
    spec = LoadSpec("scd2", keys="id", tracked=["v"])
    for _ in range(2):
        TableJob(spark, f"{base}/in", f"{base}/out", spec, lambda df: df).run()
    got = rows(t.read_table(spark, f"{base}/out"), "id", "v", "effective_from", "effective_to")
    assert got == [(1, "a", D("2020-01-01"), D("2020-03-01")), (1, "c", D("2020-03-01"), OPEN), (2, "b", D("2020-01-01"), OPEN)]
    whole = plan_load(hist.filter("id = 1"), hist, LoadSpec("scd2", keys="id", tracked=["v"], full_history=True))
    assert whole.df.count() == 1


def test_scd1_null_keys_are_set_aside(spark):
    old = spark.createDataFrame([(1, "a"), (None, "kept")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (None, "x")], "id int, v string")
    p = plan_load(new, old, LoadSpec("scd1", keys="id"))
    assert rows(p.df, "id", "v") == [(None, "kept"), (1, "b")]
    assert rows(p.quarantine, "v") == [("x",)]


def _move(spark, a, b):
    fs, p = t._hadoop(spark, a)
    assert fs.rename(p, t._hadoop(spark, b)[1])


def test_interrupted_swap_is_no_first_load(spark, tmp_table):
    p = tmp_table("live")
    t.write_table(spark.range(5), p)
    _move(spark, p, f"{p}.old-abc")  # stopped between the two renames
    for act in (lambda: t.read_table_or_empty(spark, p, spark.range(1).schema), lambda: t.write_table(spark.range(1), p)):
        with pytest.raises(OSError, match="recover_swap"):
            act()
    assert t.recover_swap(spark, p) == "restored" and t.read_table(spark, p).count() == 5
    t.write_table(spark.range(7), f"{p}.staging-abc")
    _move(spark, p, f"{p}.old-abc")
    assert t.recover_swap(spark, p) == "completed" and t.read_table(spark, p).count() == 7
    assert t.recover_swap(spark, p) == "none" and not t._siblings(spark, p, ".old-")


def test_only_a_missing_table_is_empty(spark, tmp_table):
    p = tmp_table("bad")
    spark.range(3).selectExpr("cast(id as string) v").write.text(p)
    with pytest.raises(Exception) as e:
        df = t.read_table_or_empty(spark, p, spark.range(1).schema)
        df.count()
    assert not isinstance(e.value, AnalysisException) or "PATH_NOT_FOUND" not in str(e.value)


def test_reads_path_looks_at_roots(spark, tmp_table):
    p = tmp_table("roots")
    t.write_table(spark.range(3), f"{p}/a")
    df = t.read_table(spark, f"{p}/a").selectExpr("id + 1 as id").union(spark.range(2))
    assert t.reads_path(df, f"{p}/a") and t.reads_path(df, p) and not t.reads_path(df, f"{p}/b") and not t.reads_path(spark.range(1), p)


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_scratch_is_removed(spark):
    p = session.scratch_path(spark, "gone")
    spark.range(2).write.parquet(p)
    held = dict(session._SCRATCH)
    session._SCRATCH.clear()
    session._SCRATCH[p] = spark
    session.clean_scratch()
    assert not t.path_exists(spark, p)
    session._SCRATCH.update({k: v for k, v in held.items() if k != p})


def test_rules_folder(tmp_path, spark):
    (tmp_path / "b.json").write_text(json.dumps({"table": "orders", "drop_null_columns": ["v"], "quarantine_required": True}))
    (tmp_path / "a.json").write_text(json.dumps({"table": "customers", "scd2": True, "scd2_key": "id", "scd2_track_columns": ["v"]}))
    (tmp_path / "notes.txt").write_text("no rules")
    rules = load_rules(str(tmp_path))
    assert [r.table for r in rules] == ["customers", "orders"] and rules[0].scd2 and rules[0].tracked == ("v",)
    split = refine_table(spark.createDataFrame([(1, None), (2, "x")], "id int, v string"), None, rules[1])
    assert rows(split.valid, "id") == [(2,)] and rows(split.quarantine, "id", "quarantine_reason") == [(1, "null_required:v")]
    assert TableRules.from_mapping({"table": "t"}).quarantine_required is False
    (tmp_path / "c.json").write_text(json.dumps({"table": "orders"}))
    with pytest.raises(ValueError, match="several"):
        load_rules(str(tmp_path))


def test_malformed_line_is_kept_as_it_is(spark, tmp_path):
    from layertables.sources.csv import read_csv_declared

    lines = ['id,name,ok', '1,"a,b",true', 'q,"has,comma",true', "2,c,yes", "3,d", "", "id,name,ok", '4,"say ""x""",FALSE']
    (tmp_path / "f.csv").write_text("\ufeff" + "\n".join(lines) + "\n")
    df = read_csv_declared(spark, str(tmp_path), "id int, name string, ok boolean", escape='"')
    got = rows(df, "id", "name", "ok", "_corrupt_record")
    assert (1, "a,b", True, None) in got and (4, 'say "x"', False, None) in got
    assert {r[3] for r in got if r[3]} == {'q,"has,comma",true', "2,c,yes", "3,d"} and len(got) == 5


def test_hashed_append_reads_only_its_partitions(spark, tmp_table):
    import glob

    p = tmp_table("hashed")
    rows_ = [(k, f"v{k}", None if k % 3 else "x") for k in range(400)]
    first = spark.createDataFrame(rows_, "id int, v string, w string")
    t.append_new(first, p, buckets=32)
    t.append_new(first, p)
    assert t.read_appended(spark, p).columns == ["id", "v", "w"] and t.read_appended(spark, p).count() == 400
    # A few rows, stored ones and new ones; columns in another order.
    few = spark.createDataFrame([("v7", 7, None), ("v9", 9, "x"), ("v7", 7, "new"), ("new", None, None)], "v string, id int, w string")
    n = int(t._row_bucket(spark, p).rsplit("_", 1)[1])
    touched = {r[0] for r in few.select((t.F.pmod(t._row_hash(few), t.F.lit(n)))).collect()}
    local = p[5:] if p.startswith("file:") else p
    others = [f for f in glob.glob(f"{local}/*=*/*.parquet") if int(f.split("lt_rows_of_32=")[1].split("/")[0]) not in touched]
    assert len(touched) <= 4 and len(others) > 20
    kept = {f: open(f, "rb").read() for f in others}
    for f in others:  # no other file may be opened, not even for its schema
        with open(f, "wb") as h:
            h.write(b"unreadable")
        import os

        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert t.append_new(few, p)["rows"] == 2
    assert t.append_new(few, p)["rows"] == 0
    for f, data in kept.items():
        with open(f, "wb") as h:
            h.write(data)
    assert t.read_appended(spark, p).count() == 402
    # A new column: only rows that have a value there are new.
    wide = first.withColumn("more", t.F.when(t.F.col("id") < 5, "m"))
    assert t.append_new(wide, p)["rows"] == 5 and t.append_new(wide, p)["rows"] == 0


def test_every_overwrite_is_staged(spark, tmp_table):
    p = tmp_table("live")
    t.write_table(spark.range(5), p)
    bad = spark.range(3).selectExpr("id", "raise_error('stop') as x")
    with pytest.raises(Exception, match="stop"):
        t.write_table(bad, p)
    assert t.read_table(spark, p).count() == 5
    t.recover_swap(spark, p)
    assert t.write_table(spark.range(2), p)["rows"] == 2 and t.read_table(spark, p).count() == 2

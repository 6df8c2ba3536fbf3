"""CSV by header, corrupt capture, table reads/writes, load types, jobs."""

import pytest
from pyspark.sql import functions as F

from helpers import D, OPEN, rows
from layertables.operators.load import LoadSpec, plan_load, upsert
from layertables.plans.jobs import TableJob, TableRules, refine_table
from layertables.operators.clean import CleaningRules
from layertables.sources.csv import header_drift, ingest, read_csv_declared
from layertables.sources.tables import append_new, read_table, read_table_or_empty, write_table

DDL = "id int, name string, country string"


def _csv(spark, path, header, data, mode="overwrite"):
    spark.createDataFrame(data, ", ".join(f"{h} string" for h in header)).coalesce(1).write.mode(mode).option(
        "header", True
    ).csv(path)


def test_csv_binds_by_header_name(spark, tmp_table):
    # A file whose header order differs from the schema still binds by name.
    p = tmp_table("csv")
    _csv(spark, p, ["name", "id", "country"], [("Bob", "1", "UK"), ("ann", "2", None)])
    df = read_csv_declared(spark, p, DDL, corrupt_column=None)
    assert df.columns == ["id", "name", "country"]
    assert rows(df) == [(1, "Bob", "UK"), (2, "ann", None)]  # NULLs and case kept


def test_csv_corrupt_values_flagged(spark, tmp_table):
    p = tmp_table("csv")
    _csv(spark, p, ["id", "name", "country"], [("x", "bob", "UK"), ("2", "ann", "FR")])
    df = read_csv_declared(spark, p, DDL)
    got = rows(df, "name", "_corrupt_record")
    assert got[0][0] == "ann" and got[0][1] is None
    assert got[1][0] == "bob" and got[1][1] is not None
    # Capture does not depend on which columns a later query needs.
    assert df.filter(F.col("_corrupt_record").isNotNull()).select("name").count() == 1


def test_header_drift_reports_actual_header(spark, tmp_table):
    p = tmp_table("csv")
    _csv(spark, p, ["id", "name", "zip"], [("1", "a", "z")])
    d = header_drift(spark, p, DDL)
    assert d["is_valid"] is False
    assert d["missing_columns"] == ["country"] and d["extra_columns"] == ["zip"]


def test_ingest_writes_each_feed(spark, tmp_table):
    p, out = tmp_table("raw"), tmp_table("bronze")
    _csv(spark, p, ["id", "name", "country"], [("1", "a", "UK")])
    res = ingest(spark, {"customers": (p, DDL)}, out)
    assert res["customers"]["rows"] == 1
    assert rows(read_table(spark, f"{out}/customers"), "id", "name") == [(1, "a")]


def test_optional_table_and_staged_overwrite(spark, tmp_table):
    p = tmp_table("t")
    assert read_table_or_empty(spark, p) is None
    empty = read_table_or_empty(spark, p, spark.createDataFrame([], DDL).schema)
    assert empty.count() == 0
    write_table(spark.createDataFrame([(1, "a", "x")], DDL), p)
    # Overwrite the table the plan reads; staged, never loses the source.
    fixed = read_table(spark, p).withColumn("name", F.upper("name"))
    assert write_table(fixed, p)["rows"] == 1
    assert rows(read_table(spark, p)) == [(1, "A", "x")]


def test_append_new_is_idempotent(spark, tmp_table):
    # Rerunning a quarantine append adds nothing.
    p = tmp_table("q")
    q = spark.createDataFrame([(1, None, "null_key"), (2, "b", "missing_dates")], "id int, name string, quarantine_reason string")
    append_new(q, p)
    append_new(q, p)
    assert read_table(spark, p).count() == 2


def test_load_types(spark):
    ex = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], DDL)
    inc = spark.createDataFrame([(2, "B", "y"), (2, "BB", "z"), (3, "c", "z")], DDL)
    assert plan_load(inc, ex, LoadSpec("overwrite")).mode == "overwrite"
    assert plan_load(inc, ex, LoadSpec("append")).mode == "append"
    up = plan_load(inc, ex, LoadSpec("scd1", keys="id", latest_by=[F.col("name").desc()]))
    assert rows(up.df) == [(1, "a", "x"), (2, "BB", "z"), (3, "c", "z")]
    # A column name means "greatest wins" (latest).
    assert rows(upsert(None, inc, "id", ["name"])) == [(2, "BB", "z"), (3, "c", "z")]
    with pytest.raises(ValueError, match="no load type"):
        plan_load(inc, ex, LoadSpec("merge"))
    with pytest.raises(ValueError):
        plan_load(inc, ex, LoadSpec("scd2", keys="id"))


def test_table_job_template(spark, tmp_table):
    src, out = tmp_table("src"), tmp_table("out")
    write_table(spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], DDL), src)
    job = TableJob(spark, src, out, LoadSpec("overwrite"), lambda df: df.groupBy("country").count())
    assert job.run()["rows"] == 2
    assert rows(read_table(spark, out)) == [("x", 2), ("y", 1)]
    with pytest.raises(NotImplementedError):
        TableJob(spark, src, out).transform(read_table(spark, src))


def test_refine_table_cleans_before_merge(spark):
    # Stored values are cleaned; a raw batch equal up to case is unchanged.
    rules = TableRules(
        "c",
        CleaningRules(drop_null_columns=("name",), lowercase_columns=("status",)),
        scd2=True,
        key="id",
        tracked=("name", "status"),
        effective_from_column="upd",
        time_type="date",
    )
    b1 = spark.createDataFrame([(1, "a", "Active", "2020-01-01"), (2, None, "x", "2020-01-01"), (3, "c", "x", None)],
                               "id int, name string, status string, upd string")
    r1 = refine_table(b1, None, rules)
    assert rows(r1.valid, "id", "status") == [(1, "active")]
    assert rows(r1.quarantine, "id", "quarantine_reason") == [(3, "missing_dates")]
    b2 = spark.createDataFrame([(1, "a", "ACTIVE", "2020-02-01")], "id int, name string, status string, upd string")
    r2 = refine_table(b2, r1.valid, rules)
    assert rows(r2.valid, "id", "effective_from", "is_current") == [(1, D("2020-01-01"), True)]


def test_csv_gzip_header_and_many_files(spark, tmp_table):
    p = tmp_table("csvgz")
    spark.createDataFrame([("x", str(i), "UK") for i in range(40)], "name string, id string, country string").repartition(
        4
    ).write.option("header", True).option("compression", "gzip").csv(p)
    df = read_csv_declared(spark, p, DDL, corrupt_column=None)
    assert df.count() == 40 and df.filter("id IS NULL").count() == 0


def test_headers_are_read_by_the_executors(spark, tmp_table, monkeypatch):
    """Many files of three headers, one with a byte order mark, empty and compressed files."""
    import gzip
    import os

    from layertables.sources import csv as c

    p = tmp_table("many")
    local = p[5:] if p.startswith("file:") else p
    os.makedirs(local)
    heads = ["id,name,country", "country,id,name", "name,id,extra"]
    want = []
    for k in range(30):
        h = heads[k % 3]
        row = {"id": str(k), "name": f"n{k}", "country": "UK", "extra": "e"}
        body = "\n".join([("\ufeff" if k == 4 else "") + h, ",".join(row[x] for x in h.split(",")), h]) + "\n"
        if k % 10 == 7:
            with gzip.open(f"{local}/f{k}.csv.gz", "wt") as f:
                f.write(body)
        else:
            with open(f"{local}/f{k}.csv", "w", encoding="utf-8") as f:
                f.write(body)
        want.append((k, f"n{k}", None if k % 3 == 2 else "UK"))
    open(f"{local}/empty.csv", "w").close()
    got = c.header_table(spark, p).collect()
    assert len(got) == 30 and {r["line"].lstrip("\ufeff") for r in got} == set(heads)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != c._ONE_FILE["spark.sql.files.maxPartitionBytes"]
    df = read_csv_declared(spark, p, DDL)
    assert rows(df, "id", "name", "country") == sorted(want) and df.filter("_corrupt_record is not null").isEmpty()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text") >= 1 and "Union" not in plan  # one scan for all headers
    d = header_drift(spark, p, DDL)
    assert d["missing_columns"] == ["country"] and d["extra_columns"] == ["extra"]


def test_corrupt_lines_of_several_headers(spark, tmp_table):
    p = tmp_table("csv")
    _csv(spark, p, ["id", "name", "country"], [("x", "bob", "UK"), ("2", "ann", "FR")])
    _csv(spark, p, ["country", "id"], [("DE", "y"), ("IT", "5")], mode="append")
    df = read_csv_declared(spark, p, DDL)
    assert rows(df, "id", "name", "country", "_corrupt_record") == [
        (None, None, "DE", "DE,y"),
        (None, "bob", "UK", "x,bob,UK"),
        (2, "ann", "FR", None),
        (5, None, "IT", None),
    ]


def test_fields_over_several_lines(spark, tmp_table):
    p = tmp_table("csv")
    spark.createDataFrame([("1", "two\nlines", "UK"), ("x", "b", None)], "id string, name string, country string").coalesce(1).write.option("header", True).csv(p)
    df = read_csv_declared(spark, p, DDL, multi_line=True)
    got = rows(df, "id", "name", "country", "_corrupt_record")
    assert got[1] == (1, "two\nlines", "UK", None) and got[0][:3] == (None, "b", None) and got[0][3] is not None

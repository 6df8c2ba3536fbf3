"""Plan shape: one exchange for the merge, no Python in any plan, filters
and projections reach the parquet scan."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import D
from layertables.operators.clean import filter_equals
from layertables.operators.history import merge_scd2
from layertables.sources.tables import read_table, write_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def n_shuffles(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan(df)))


def _batches(spark):
    h = spark.createDataFrame([(i, "a", D("2020-01-01")) for i in range(20)], "id int, v string, effective_from date")
    b = spark.createDataFrame([(i, "b", D("2020-02-01")) for i in range(0, 40, 2)], "id int, v string, effective_from date")
    return merge_scd2(h, None, "id", ["v"]), b


def test_window_merge_is_one_exchange(spark):
    hist, b = _batches(spark)
    # Materialised history, as in production (a table read), not a nested merge.
    hist = spark.createDataFrame(hist.collect(), hist.schema)
    m = merge_scd2(b, hist, "id", ["v"], strategy="window")
    p = plan(m)
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    assert n_shuffles(m) == 1, p
    assert p.count("Sort [") == 1 and "min_by" not in p, p


def test_split_merge_shuffles_only_touched_history(spark, tmp_table):
    hist, b = _batches(spark)
    # Stored tables, whose sizes Spark knows: the batch keys are below its threshold.
    paths = tmp_table("hist"), tmp_table("batch")
    hist.write.parquet(paths[0])
    b.write.parquet(paths[1])
    hist, b = map(spark.read.parquet, paths)
    m = merge_scd2(b, hist, "id", ["v"], strategy="split")
    p = plan(m)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert m.count() == 20 + 10 + 10


def test_no_python_udfs_in_driver_queries(spark):
    from layertables.plans.queries import QUERIES

    for name, query in QUERIES.items():
        p = plan(query(spark, SF))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", p), name


def test_filter_and_projection_pushed_to_scan(spark, tmp_table):
    p = tmp_table("t")
    write_table(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, seg string"), p)
    df = filter_equals(read_table(spark, p), "seg", "x").select("id")
    s = plan(df)
    assert "PushedFilters: [IsNotNull(seg), EqualTo(seg,x)]" in s
    assert "ReadSchema: struct<id:int,seg:string>" in s


def test_asof_join_prunes_columns(spark):
    import __spark_entry__ as e

    s = plan(e.queries()["fact_asof_join"](spark, SF))
    orders_scan = [ln for ln in s.splitlines() if "orders.parquet" in ln or ("FileScan" in ln and "o_orderkey" in ln)]
    assert orders_scan
    assert all("o_comment" not in ln and "o_totalprice" not in ln for ln in orders_scan)

"""Batches derived from the driver's TPC-H-like tables, so that every driver
query exercises the operators on data that grows with the input.

Each derivation is written once here and once, identically, as SQL in
:mod:`layertables.plans.oracle`. ``k`` below is the source key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The derivation rules shared with the oracle SQL.
BATCH1_START = "1995-01-01"
BATCH2_START = "1998-01-01"
NEW_KEY_OFFSET = 1000000
CUSTOMER_TRACKED = ("name", "segment", "nation")
SUPPLIER_TRACKED = ("name", "nation", "tier")
EVENTS_SPLIT = "2024-01-16"
CLOSE_AT = "1999-12-31"
DEFAULT_FROM = "2000-01-01"
SLICE = ("1998-03-01", "1998-03-31")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


def _seg1(k: Column) -> Column:
    return F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))


def batch1(spark: SparkSession, d: str) -> DataFrame:
    """Every customer: created = 1995-01-01 + k % 365, no update date,
    segment NULL when k % 13 = 0."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        _seg1(k).alias("segment"),
        F.col("c_nationkey").alias("nation"),
        _day(BATCH1_START, k % 365).alias("created"),
        F.lit(None).cast("date").alias("updated"),
    )


def _batch2_rows(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    kept = c.filter(k % 11 != 0).withColumn("id", k)
    new = c.filter(k % 10 == 3).withColumn("id", k + F.lit(NEW_KEY_OFFSET))
    return kept.unionByName(new)


def batch2(spark: SparkSession, d: str) -> DataFrame:
    """Next snapshot: keys with k % 11 = 0 absent; segment 'X-…' when k % 5 = 0,
    NULL when k % 7 = 0; new keys k + 1000000 for k % 10 = 3;
    updated = 1998-01-01 + k % 700; both dates NULL when k % 17 = 0."""
    k = F.col("c_custkey")
    seg = F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 5 == 0, F.concat(F.lit("X-"), _seg1(k))).otherwise(_seg1(k))
    no_dates = k % 17 == 0
    return _batch2_rows(spark, d).select(
        "id",
        F.col("c_name").alias("name"),
        seg.alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.when(no_dates, F.lit(None).cast("date")).otherwise(_day(BATCH1_START, k % 365)).alias("created"),
        F.when(no_dates, F.lit(None).cast("date")).otherwise(_day(BATCH2_START, k % 700)).alias("updated"),
    )


def batch1_raw(spark: SparkSession, d: str) -> DataFrame:
    """batch1 as a raw feed: dates as text."""
    b = batch1(spark, d)
    return b.select(
        "id", "name", "segment", "nation",
        F.col("created").cast("string").alias("created_s"),
        F.col("updated").cast("string").alias("updated_s"),
    )


def batch2_raw(spark: SparkSession, d: str) -> DataFrame:
    """batch2 as a raw feed with defects: NULL key when k % 29 = 0; created text
    'not a date' when k % 19 = 0; updated text '1998-02-30' when k % 23 = 0 and
    NULL when k % 4 = 0."""
    k = F.col("id") % F.lit(NEW_KEY_OFFSET)
    b = batch2(spark, d)
    return b.select(
        F.when(k % 29 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id")).alias("id"),
        "name",
        "segment",
        "nation",
        F.when(k % 19 == 0, F.when(F.col("created").isNotNull(), F.lit("not a date")))
        .otherwise(F.col("created").cast("string"))
        .alias("created_s"),
        F.when(k % 23 == 0, F.when(F.col("updated").isNotNull(), F.lit("1998-02-30")))
        .when(k % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("updated").cast("string"))
        .alias("updated_s"),
    )


def supplier_batch1(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        k.alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.concat(F.lit("T"), (k % 3).cast("string")).alias("tier"),
        _day(BATCH1_START, k % 365).alias("created"),
        F.lit(None).cast("date").alias("updated"),
    )


def supplier_batch2(spark: SparkSession, d: str) -> DataFrame:
    """tier 'T9' when k % 4 = 0; updated = 1999-01-01 + k % 300; both dates NULL when k % 7 = 0."""
    k = F.col("s_suppkey")
    no_dates = k % 7 == 0
    return table(spark, d, "supplier").select(
        k.alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.when(k % 4 == 0, F.lit("T9")).otherwise(F.concat(F.lit("T"), (k % 3).cast("string"))).alias("tier"),
        F.when(no_dates, F.lit(None).cast("date")).otherwise(_day(BATCH1_START, k % 365)).alias("created"),
        F.when(no_dates, F.lit(None).cast("date")).otherwise(_day("1999-01-01", k % 300)).alias("updated"),
    )


def orders_fact(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


def orders_raw(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a raw feed: customer NULL when key % 37 = 0, date text NULL when
    key % 41 = 0, status lower-case when key % 2 = 0."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k.alias("order_id"),
        F.when(k % 37 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(k % 2 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.lower("o_orderpriority").alias("priority"),
        F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
    )


def change_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("user_id", "event_type", F.col("ts").alias("effective_from"))

"""The driver queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed by the library's operators over the whole input tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layertables.operators.asof import asof_join
from layertables.operators.clean import CleaningRules, apply_cleaning_rules, filter_equals
from layertables.operators.history import (
    apply_scd2,
    change_counts,
    changed_versions,
    classify_changes,
    current_view,
    merge_changes,
    merge_scd2,
    new_keys,
    replay_changes,
    resolve_effective_from,
)
from layertables.operators.keys import add_dense_key, add_surrogate_key, key_uniqueness
from layertables.operators.load import LoadSpec, plan_load
from layertables.operators.profile import compare_profiles, merge_profiles, profile
from layertables.operators.quarantine import quarantine_summary as _qsummary
from layertables.operators.quarantine import separate_quarantine_records
from layertables.operators.skew import SkewSpec
from layertables.plans import derive as dv
from layertables.plans.jobs import DimensionJob, FactJob, TableJob, TableRules, build_dimension, refine_table, run_layers
from layertables.session import scratch_path
from layertables.sources.csv import header_drift, read_csv_declared
from layertables.sources.history_store import create_history, merge_history, read_history
from layertables.sources.schema import drift_report
from layertables.sources.tables import append_new, read_appended, read_table, read_table_or_empty, write_table

TRACKED = list(dv.CUSTOMER_TRACKED)
HIST = ["id", "name", "segment", "nation", "created", "updated", "effective_from", "effective_to", "is_current"]
RAW_HIST = ["id", "name", "segment", "nation", "created_s", "updated_s", "effective_from", "effective_to", "is_current"]
CLOSE_AT = dt.date.fromisoformat(dv.CLOSE_AT)

CUSTOMER_RULES = TableRules(
    table="customers",
    cleaning=CleaningRules(drop_null_columns=("name",), uppercase_columns=("name",), lowercase_columns=("segment",)),
    scd2=True,
    key="id",
    tracked=tuple(TRACKED),
    effective_from_column="updated_s",
    effective_from_fallback_column="created_s",
    time_type="date",
)
ORDER_RULES = TableRules(
    table="orders",
    cleaning=CleaningRules(
        drop_null_columns=("customer_id", "order_date"), uppercase_columns=("priority",), lowercase_columns=("status",)
    ),
)


# --------------------------------------------------------------------------- shared histories


def h1(spark: SparkSession, d: str) -> DataFrame:
    return merge_scd2(resolve_effective_from(dv.batch1(spark, d), "updated", "created"), None, "id", TRACKED)


def b2_valid(spark: SparkSession, d: str) -> DataFrame:
    return separate_quarantine_records(dv.batch2(spark, d), "updated", "created", keys="id").valid


def h2(spark: SparkSession, d: str) -> DataFrame:
    inc = resolve_effective_from(b2_valid(spark, d), "updated", "created")
    return merge_scd2(inc, h1(spark, d), "id", TRACKED)


def dim_customers(spark: SparkSession, d: str) -> DataFrame:
    return build_dimension(h2(spark, d), "id", "customer_key", TRACKED)


# --------------------------------------------------------------------------- queries


def fact_asof_join(spark: SparkSession, d: str) -> DataFrame:
    return asof_join(dv.orders_fact(spark, d), dim_customers(spark, d), "o_custkey", "o_orderdate", "id", ["customer_key"])


def fact_unmatched(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    fact = dv.orders_fact(spark, d).select(
        "o_orderkey",
        F.when(k % 20 == 0, F.col("o_custkey") + F.lit(5000000)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderdate",
    )
    out = asof_join(fact, dim_customers(spark, d), "o_custkey", "o_orderdate", "id", ["customer_key"])
    return out.filter(F.col("customer_key").isNull())


def scd2_initial_load(spark: SparkSession, d: str) -> DataFrame:
    inc = resolve_effective_from(dv.batch1(spark, d), "updated", "created")
    empty = read_table_or_empty(spark, scratch_path(spark, "absent-table"), inc.schema)
    return merge_scd2(inc, empty, "id", TRACKED).select(*HIST)


def scd2_snapshot_merge(spark: SparkSession, d: str) -> DataFrame:
    return h2(spark, d).select(*HIST)


def scd2_replay_noop(spark: SparkSession, d: str) -> DataFrame:
    inc = resolve_effective_from(b2_valid(spark, d), "updated", "created")
    return merge_scd2(inc, h2(spark, d), "id", TRACKED).select(*HIST)


def scd2_change_log(spark: SparkSession, d: str) -> DataFrame:
    ev = dv.change_log(spark, d)
    split = F.lit(dv.EVENTS_SPLIT).cast(ev.schema["effective_from"].dataType)
    first = merge_scd2(ev.filter(F.col("effective_from") < split), None, "user_id", ["event_type"])
    hist = merge_scd2(ev.filter(F.col("effective_from") >= split), first, "user_id", ["event_type"])
    return hist.select(
        "user_id",
        "event_type",
        "effective_from",
        F.when(F.col("is_current"), F.lit(None)).otherwise(F.col("effective_to")).alias("effective_to"),
        "is_current",
    )


def _late(spark: SparkSession, d: str) -> DataFrame:
    later = merge_scd2(resolve_effective_from(b2_valid(spark, d), "updated", "created"), None, "id", TRACKED)
    return merge_scd2(resolve_effective_from(dv.batch1(spark, d), "updated", "created"), later, "id", TRACKED)


def scd2_late_arrival(spark: SparkSession, d: str) -> DataFrame:
    return _late(spark, d).select(*HIST)


def scd2_late_arrival_asof(spark: SparkSession, d: str) -> DataFrame:
    fact = dv.orders_fact(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    return asof_join(
        fact, _late(spark, d), "o_custkey", "o_orderdate", "id", {"name": "v_name", "segment": "v_segment", "nation": "v_nation"}
    )


def _classified(spark: SparkSession, d: str) -> DataFrame:
    inc = resolve_effective_from(b2_valid(spark, d), "updated", "created")
    return classify_changes(inc, h1(spark, d), "id", TRACKED)


def scd2_change_class(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select("id", "change_type")


def scd2_change_counts(spark: SparkSession, d: str) -> DataFrame:
    return change_counts(_classified(spark, d))


def _missing(spark: SparkSession, d: str, policy: str) -> DataFrame:
    res = apply_scd2(
        dv.batch2(spark, d), h1(spark, d), "id", TRACKED, None, "updated", "created", missing_keys=policy, close_at=CLOSE_AT
    )
    return res.valid.select(*HIST)


def scd2_missing_close(spark: SparkSession, d: str) -> DataFrame:
    return _missing(spark, d, "close")


def scd2_missing_drop(spark: SparkSession, d: str) -> DataFrame:
    return _missing(spark, d, "drop")


def scd2_current_view(spark: SparkSession, d: str) -> DataFrame:
    return current_view(h2(spark, d)).select("id", "name", "segment", "nation", "effective_from")


def scd2_pipeline(spark: SparkSession, d: str) -> DataFrame:
    first = apply_scd2(dv.batch1_raw(spark, d), None, "id", TRACKED, None, "updated_s", "created_s", time_type="date").valid
    res = apply_scd2(dv.batch2_raw(spark, d), first, "id", TRACKED, None, "updated_s", "created_s", time_type="date")
    return res.valid.select(*RAW_HIST)


def new_keys_anti(spark: SparkSession, d: str) -> DataFrame:
    return new_keys(b2_valid(spark, d), h1(spark, d), "id").select("id", "name")


def changed_keys_semi(spark: SparkSession, d: str) -> DataFrame:
    return changed_versions(b2_valid(spark, d), h1(spark, d), "id", TRACKED).select("id", "segment", "effective_from")


def effective_from_resolve(spark: SparkSession, d: str) -> DataFrame:
    out = resolve_effective_from(dv.batch2_raw(spark, d), "updated_s", "created_s", dv.DEFAULT_FROM, time_type="date")
    return out.select("id", "created_s", "updated_s", "effective_from", "effective_to", "is_current")


def _customer_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return separate_quarantine_records(dv.batch2_raw(spark, d), "updated_s", "created_s", keys="id", time_type="date").quarantine


def quarantine_split(spark: SparkSession, d: str) -> DataFrame:
    return _customer_quarantine(spark, d).select("id", "name", "created_s", "updated_s", "quarantine_reason")


def quarantine_append_idempotent(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "quarantine")
    q = quarantine_split(spark, d)
    append_new(q, path)
    append_new(q, path)  # a rerun adds nothing
    return read_table(spark, path)


def quarantine_summary(spark: SparkSession, d: str) -> DataFrame:
    sq = separate_quarantine_records(dv.supplier_batch2(spark, d), "updated", "created", keys="id").quarantine
    return _qsummary({"customers": _customer_quarantine(spark, d), "suppliers": sq})


def clean_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = CleaningRules(
        drop_null_columns=("segment",), uppercase_columns=("name", "segment"), lowercase_columns=("segment",)
    )
    return apply_cleaning_rules(dv.batch2_raw(spark, d), rules).select("id", "name", "segment", "nation")


def filter_equals_q(spark: SparkSession, d: str) -> DataFrame:
    return filter_equals(dv.batch1(spark, d), "segment", "BUILDING").select("id", "name", "segment")


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return dv.batch1(spark, d).groupBy("segment").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# Fixed value: the declared customer schema the drift report checks against.
EXPECTED_CUSTOMER = "c_custkey int, c_name string, c_phone string, c_nationkey bigint, c_mktsegment int"


def schema_drift_report(spark: SparkSession, d: str) -> DataFrame:
    return drift_report(dv.table(spark, d, "customer"), EXPECTED_CUSTOMER)


CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def csv_declared_scan(spark: SparkSession, d: str) -> DataFrame:
    c = dv.table(spark, d, "customer")
    path = scratch_path(spark, "raw-customers")
    # Two header orders in one feed; together the files hold the whole table.
    k = F.col("c_custkey")
    _write_csv(c.filter(k % 2 == 0).select("c_name", "c_mktsegment", "c_custkey", "c_nationkey", "c_acctbal"), path)
    _write_csv(c.filter(k % 2 == 1).select("c_nationkey", "c_custkey", "c_acctbal", "c_name", "c_mktsegment"), path, "append")
    return read_csv_declared(spark, path, CUSTOMER_DDL, corrupt_column=None)


def csv_corrupt_rows(spark: SparkSession, d: str) -> DataFrame:
    c = dv.table(spark, d, "customer")
    k = F.col("c_custkey")
    raw = c.select(
        "c_custkey",
        "c_name",
        F.when(k % 50 == 0, F.lit("x")).otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        "c_acctbal",
        "c_mktsegment",
    )
    path = scratch_path(spark, "raw-corrupt")
    _write_csv(raw, path)
    scanned = read_csv_declared(spark, path, CUSTOMER_DDL)
    q = separate_quarantine_records(scanned, corrupt_column="_corrupt_record").quarantine
    return q.select("c_custkey", "quarantine_reason")


def csv_header_drift(spark: SparkSession, d: str) -> DataFrame:
    """A feed of two headers, one without a declared column and one with an extra
    one: all rows, with what the actual headers lack and add."""
    c = dv.table(spark, d, "customer")
    path = scratch_path(spark, "raw-drift")
    k = F.col("c_custkey")
    _write_csv(c.filter(k % 2 == 0).withColumn("note", F.lit("n")), path)
    _write_csv(c.filter(k % 2 == 1).drop("c_acctbal"), path, "append")
    drift = header_drift(spark, path, CUSTOMER_DDL)
    return read_csv_declared(spark, path, CUSTOMER_DDL, corrupt_column=None).select(
        "c_custkey",
        "c_acctbal",
        F.lit(",".join(drift["missing_columns"])).alias("missing"),
        F.lit(",".join(drift["extra_columns"])).alias("extra"),
    )


def surrogate_key_unique(spark: SparkSession, d: str) -> DataFrame:
    return key_uniqueness(dim_customers(spark, d), "customer_key")


def dim_build(spark: SparkSession, d: str) -> DataFrame:
    return build_dimension(h2(spark, d), "id", "customer_key", TRACKED, rename={"id": "customer_id"})


def dim_build_second(spark: SparkSession, d: str) -> DataFrame:
    tracked = list(dv.SUPPLIER_TRACKED)
    first = merge_scd2(resolve_effective_from(dv.supplier_batch1(spark, d), "updated", "created"), None, "id", tracked)
    hist = apply_scd2(dv.supplier_batch2(spark, d), first, "id", tracked, None, "updated", "created").valid
    return build_dimension(hist, "id", "supplier_key", tracked, rename={"id": "supplier_id"})


def load_overwrite(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "load-overwrite")
    write_table(dv.batch1(spark, d), path)
    # The new content is computed from the table it replaces: staged swap.
    fixed = read_table(spark, path).withColumn("segment", F.lower("segment"))
    p = plan_load(fixed, None, LoadSpec("overwrite"))
    write_table(p.df, path, p.mode)
    return read_table(spark, path)


def load_append(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "load-append")
    write_table(dv.batch1(spark, d), path)
    p = plan_load(dv.batch2(spark, d), None, LoadSpec("append"))
    write_table(p.df, path, p.mode)
    return read_table(spark, path)


def load_scd1_upsert(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "load-scd1")
    write_table(dv.batch1(spark, d), path)
    p = plan_load(dv.batch2(spark, d), read_table(spark, path), LoadSpec("scd1", keys="id", latest_by=["updated"]))
    write_table(p.df, path, p.mode)
    return read_table(spark, path)


def refine_scd2_table(spark: SparkSession, d: str) -> DataFrame:
    first = refine_table(dv.batch1_raw(spark, d), None, CUSTOMER_RULES).valid
    return refine_table(dv.batch2_raw(spark, d), first, CUSTOMER_RULES).valid.select(*RAW_HIST)


def refine_plain_table(spark: SparkSession, d: str) -> DataFrame:
    return refine_table(dv.orders_raw(spark, d), None, ORDER_RULES).valid.select(
        "order_id", "customer_id", "status", "priority", "order_date"
    )


RAW_CUSTOMER_DDL = "id bigint, name string, segment string, nation int, created_s string, updated_s string"
RAW_ORDER_DDL = "order_id bigint, customer_id bigint, status string, priority string, order_date string"


def pipeline_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Two daily runs of the whole pipeline from CSV feeds: raw → bronze →
    silver (SCD2 + plain) → gold dimension → gold fact by as-of join."""
    base = scratch_path(spark, "pipeline")
    rules = [
        TableRules(**{**CUSTOMER_RULES.__dict__, "corrupt_column": "_corrupt_record"}),
        TableRules(**{**ORDER_RULES.__dict__, "corrupt_column": "_corrupt_record"}),
    ]
    dims = [DimensionJob("customers", "dim_customers", "id", "customer_key", tuple(TRACKED), {"id": "customer_id"})]
    facts = [
        FactJob(
            "orders", "fact_orders", "dim_customers", "customer_id", "order_date", "customer_id", "customer_key",
            ["order_id", "customer_key", "customer_id", "status", "priority", "order_date"], "yyyy-MM-dd",
        )
    ]
    for day, batch in enumerate([dv.batch1_raw, dv.batch2_raw]):
        raw = f"{base}/raw/day{day}"
        _write_csv(batch(spark, d), f"{raw}/customers")
        _write_csv(dv.orders_raw(spark, d), f"{raw}/orders")
        run_layers(
            spark,
            raw_feeds={"customers": (f"{raw}/customers", RAW_CUSTOMER_DDL), "orders": (f"{raw}/orders", RAW_ORDER_DDL)},
            bronze=f"{base}/bronze",
            silver=f"{base}/silver",
            gold=f"{base}/gold",
            quarantine=f"{base}/quarantine",
            rules=rules,
            dimensions=dims,
            facts=facts,
        )
    return read_table(spark, f"{base}/gold/fact_orders")


def fact_asof_window(spark: SparkSession, d: str) -> DataFrame:
    """The facts of ``fact_asof_join`` by the other plan."""
    return asof_join(
        dv.orders_fact(spark, d), dim_customers(spark, d), "o_custkey", "o_orderdate", "id", ["customer_key"], method="window"
    )


# Every key that a sample sees twice is hot, so nearly all keys are split.
ALL_HOT = SkewSpec(hot_rows=2, sample_fraction=1.0, bucket_rows=1, min_input_bytes=0)


def scd2_present_keys_hot(spark: SparkSession, d: str) -> DataFrame:
    """``scd2_missing_close`` with hot splitting forced."""
    res = apply_scd2(
        dv.batch2(spark, d), h1(spark, d), "id", TRACKED, None, "updated", "created",
        missing_keys="close", close_at=CLOSE_AT, strategy="window", skew=ALL_HOT,
    )
    return res.valid.select(*HIST)


def scd2_late_into_closed(spark: SparkSession, d: str) -> DataFrame:
    """Late rows that land in open versions, in closed ones and behind closed ones."""
    k = F.col("id")
    end = F.when(k % 5 == 0, F.lit("1996-01-01")).when(k % 3 == 0, F.lit("1999-12-31")).otherwise(F.lit("9999-12-31")).cast("date")
    stored = h1(spark, d).withColumn("effective_to", end).withColumn("is_current", end == F.lit("9999-12-31").cast("date"))
    late = dv.batch1(spark, d).filter(k % 2 == 0).select(
        "id",
        "name",
        F.when(k % 4 == 0, F.col("segment")).otherwise(F.concat(F.lit("L-"), F.coalesce("segment", F.lit("")))).alias("segment"),
        "nation",
        F.date_add(F.lit("1996-06-01").cast("date"), (k % 300).cast("int")).alias("effective_from"),
    )
    cols = ["id", "name", "segment", "nation", "effective_from", "effective_to", "is_current"]
    return merge_scd2(late, stored, "id", TRACKED).select(*cols)


def surrogate_key_adversarial(spark: SparkSession, d: str) -> DataFrame:
    """Separators and NULL marks inside the values: every row has a key of its own."""
    c = dv.table(spark, d, "customer")
    name, seg, null = F.col("c_name"), F.col("c_mktsegment"), F.lit(None).cast("string")
    pairs = [
        (F.concat(name, F.lit("|")), seg),
        (name, F.concat(F.lit("|"), seg)),
        (name, null),
        (name, F.lit("<null>")),
        (name, F.lit("")),
        (null, name),
    ]
    rows = c.select(F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in pairs])).alias("p")).select("p.*")
    return add_surrogate_key(rows, "k", ["a", "b"])


def surrogate_key_dense(spark: SparkSession, d: str) -> DataFrame:
    """Dense keys of a table, then of its second half behind the stored first half."""
    c = dv.table(spark, d, "customer").select("c_custkey", "c_name")
    half = F.col("c_custkey") % 2 == 0
    path = scratch_path(spark, "dense")
    write_table(add_dense_key(c.filter(half), "k", ["c_custkey"]), path)
    stored = read_table(spark, path)
    keyed = stored.unionByName(add_dense_key(c.filter(~half), "k", ["c_custkey"], existing=stored))
    moved = stored.select(F.col("c_custkey").alias("s"), F.col("k").alias("sk"))
    checked = keyed.join(moved, F.col("c_custkey") == F.col("s"), "left")
    return checked.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_distinct("k").cast("bigint").alias("n_keys"),
        F.min("k").cast("bigint").alias("least"),
        F.max("k").cast("bigint").alias("greatest"),
        F.coalesce(F.sum((F.col("sk") != F.col("k")).cast("int")), F.lit(0)).cast("bigint").alias("moved"),
    )


def quarantine_append_evolved(spark: SparkSession, d: str) -> DataFrame:
    """A later batch brings a new column: rows that differ only there are new."""
    path = scratch_path(spark, "quarantine-evolved")
    q = quarantine_split(spark, d)
    append_new(q, path)
    more = q.withColumn("feed", F.when(F.col("id") % 2 == 0, F.lit("second")))
    append_new(more, path)
    append_new(more, path)  # a rerun adds nothing
    return read_table(spark, path, merge_schema=True)


def quarantine_append_pruned(spark: SparkSession, d: str) -> DataFrame:
    """``quarantine_append_evolved`` in a table partitioned by row hash: every append reads only
    the partitions of its own rows."""
    path = scratch_path(spark, "quarantine-hashed")
    q = quarantine_split(spark, d)
    append_new(q, path, buckets=32)
    more = q.withColumn("feed", F.when(F.col("id") % 2 == 0, F.lit("second")))
    append_new(more, path)
    append_new(more, path)  # a rerun adds nothing
    return read_appended(spark, path)


def load_scd2_slice(spark: SparkSession, d: str) -> DataFrame:
    """A job loads a slice of the keys into a stored history: all other keys stay."""
    base = scratch_path(spark, "scd2-slice")
    write_table(h1(spark, d).select(*HIST), f"{base}/history")
    write_table(dv.batch1(spark, d).filter(F.col("id") % 10 == 1), f"{base}/batch")

    def prepare(df: DataFrame) -> DataFrame:
        df = df.withColumn("segment", F.concat(F.lit("S-"), F.coalesce("segment", F.lit(""))))
        return resolve_effective_from(df, effective_from_ts="1999-01-01", time_type="date")

    job = TableJob(spark, f"{base}/batch", f"{base}/history", LoadSpec("scd2", keys="id", tracked=TRACKED), prepare)
    job.run()
    return read_table(spark, f"{base}/history").select(*HIST)


def refine_quarantine_required(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the NULL rules of a plain table drop, with the reason."""
    rules = TableRules(**{**ORDER_RULES.__dict__, "quarantine_required": True})
    split = refine_table(dv.orders_raw(spark, d), None, rules)
    return split.quarantine.select("order_id", "customer_id", "order_date", "quarantine_reason")


def value_drift(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the customers, profiled and compared: in the second, balances are higher, every fourth
    name is missing and the segments are split by nation."""
    c = dv.table(spark, d, "customer")
    path = scratch_path(spark, "profiles")
    half = F.col("c_custkey") % 2 == 0
    # The first load came in two parts, whose profiles were stored apart.
    write_table(profile(c.filter(half)).withColumn("load", F.lit(1)), path)
    write_table(profile(c.filter(~half)).withColumn("load", F.lit(1)), path, "append")
    second = c.withColumns(
        {
            "c_acctbal": F.col("c_acctbal") + 3000,
            "c_name": F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")),
            "c_mktsegment": F.concat("c_mktsegment", F.col("c_nationkey").cast("string")),
        }
    )
    first = merge_profiles(read_table(spark, path).drop("load"))
    out = compare_profiles(first, profile(second))
    return out.select("column_name", "n_rows_before", "n_rows_after", "n_null_before", "n_null_after", "shifted", "reasons")


def _dated(df: DataFrame) -> DataFrame:
    return resolve_effective_from(df, "updated", "created")


def scd2_change_rows(spark: SparkSession, d: str) -> DataFrame:
    """What the second batch inserts and closes, without the history around it."""
    c = merge_changes(_dated(b2_valid(spark, d)), h1(spark, d), "id", TRACKED)
    return c.select("id", "segment", "effective_from", "effective_to", "change", "previous_effective_to")


def scd2_replay_changes(spark: SparkSession, d: str) -> DataFrame:
    """A reader's copy of the history, brought up to date by the change rows of two runs."""
    base = scratch_path(spark, "change-log")
    write_table(merge_changes(_dated(dv.batch1(spark, d)), None, "id", TRACKED), f"{base}/run=1")
    first = replay_changes(None, [read_table(spark, f"{base}/run=1")], "id", TRACKED)
    write_table(merge_changes(_dated(b2_valid(spark, d)), first, "id", TRACKED), f"{base}/run=2")
    runs = [read_table(spark, f"{base}/run={k}") for k in (1, 2)]
    return replay_changes(None, runs, "id", TRACKED).select(*HIST)


def scd2_partial_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """The merge of ``scd2_snapshot_merge`` into a partitioned history, then a rerun of it."""
    path = scratch_path(spark, "history-store")
    create_history(h1(spark, d), path, "id", buckets=16)
    for _ in range(2):
        merge_history(_dated(b2_valid(spark, d)), path, "id", TRACKED)
    return read_history(spark, path).select(*HIST)


def scd2_partial_late(spark: SparkSession, d: str) -> DataFrame:
    """Late rows into a partitioned history: closed versions are split in place."""
    path = scratch_path(spark, "history-late")
    merge_history(_dated(b2_valid(spark, d)), path, "id", TRACKED, buckets=16)
    merge_history(_dated(dv.batch1(spark, d)), path, "id", TRACKED)
    return read_history(spark, path).select(*HIST)


def _open_as_null(spark: SparkSession, d: str) -> DataFrame:
    """The history as other tools store it: open versions end at NULL."""
    return h2(spark, d).withColumn("effective_to", F.when(~F.col("is_current"), F.col("effective_to")))


def fact_asof_open_end(spark: SparkSession, d: str) -> DataFrame:
    """Facts against versions whose open end is NULL."""
    fact = dv.orders_fact(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    return asof_join(
        fact, _open_as_null(spark, d), "o_custkey", "o_orderdate", "id", {"name": "v_name", "segment": "v_segment", "nation": "v_nation"}
    )


def fact_asof_day_slice(spark: SparkSession, d: str) -> DataFrame:
    """The facts of one month against a stored dimension, of which only the versions that they
    can need are read."""
    path = scratch_path(spark, "dim")
    write_table(_open_as_null(spark, d).sort("effective_from"), path)
    fact = dv.orders_fact(spark, d).select("o_orderkey", "o_custkey", "o_orderdate").filter(
        F.col("o_orderdate").between(F.lit(dv.SLICE[0]).cast("date"), F.lit(dv.SLICE[1]).cast("date"))
    )
    wanted = {"name": "v_name", "segment": "v_segment", "nation": "v_nation"}
    return asof_join(fact, read_table(spark, path), "o_custkey", "o_orderdate", "id", wanted, prune=True, disjoint=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_asof_join": fact_asof_join,
    "fact_unmatched": fact_unmatched,
    "scd2_initial_load": scd2_initial_load,
    "scd2_snapshot_merge": scd2_snapshot_merge,
    "scd2_replay_noop": scd2_replay_noop,
    "scd2_change_log": scd2_change_log,
    "scd2_late_arrival": scd2_late_arrival,
    "scd2_late_arrival_asof": scd2_late_arrival_asof,
    "scd2_change_class": scd2_change_class,
    "scd2_change_counts": scd2_change_counts,
    "scd2_missing_close": scd2_missing_close,
    "scd2_missing_drop": scd2_missing_drop,
    "scd2_current_view": scd2_current_view,
    "scd2_pipeline": scd2_pipeline,
    "new_keys_anti": new_keys_anti,
    "changed_keys_semi": changed_keys_semi,
    "effective_from_resolve": effective_from_resolve,
    "quarantine_split": quarantine_split,
    "quarantine_append_idempotent": quarantine_append_idempotent,
    "quarantine_summary": quarantine_summary,
    "clean_rules": clean_rules,
    "filter_equals": filter_equals_q,
    "status_counts": status_counts,
    "schema_drift_report": schema_drift_report,
    "csv_declared_scan": csv_declared_scan,
    "csv_corrupt_rows": csv_corrupt_rows,
    "surrogate_key_unique": surrogate_key_unique,
    "dim_build": dim_build,
    "dim_build_second": dim_build_second,
    "load_overwrite": load_overwrite,
    "load_append": load_append,
    "load_scd1_upsert": load_scd1_upsert,
    "refine_scd2_table": refine_scd2_table,
    "refine_plain_table": refine_plain_table,
    "pipeline_end_to_end": pipeline_end_to_end,
    "csv_header_drift": csv_header_drift,
    "fact_asof_window": fact_asof_window,
    "scd2_present_keys_hot": scd2_present_keys_hot,
    "scd2_late_into_closed": scd2_late_into_closed,
    "surrogate_key_adversarial": surrogate_key_adversarial,
    "surrogate_key_dense": surrogate_key_dense,
    "quarantine_append_evolved": quarantine_append_evolved,
    "load_scd2_slice": load_scd2_slice,
    "refine_quarantine_required": refine_quarantine_required,
    "fact_asof_open_end": fact_asof_open_end,
    "fact_asof_day_slice": fact_asof_day_slice,
    "quarantine_append_pruned": quarantine_append_pruned,
    "value_drift": value_drift,
    "scd2_change_rows": scd2_change_rows,
    "scd2_replay_changes": scd2_replay_changes,
    "scd2_partial_overwrite": scd2_partial_overwrite,
    "scd2_partial_late": scd2_partial_late,
}

"""Table jobs: the layer-to-layer compositions users run.

Each job builds one lazy plan per output table and runs exactly one write
action for it (plus one for its quarantine); counts come from the writes.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layertables.operators.asof import AsOf, build_fact
from layertables.operators.clean import CleaningRules, apply_cleaning_rules, clean_with_quarantine
from layertables.operators.history import Batch, apply_scd2, prepare_batch
from layertables.operators.keys import add_surrogate_key, history_key_columns
from layertables.operators.load import LoadSpec, Planned, plan_load
from layertables.operators.quarantine import Split, separate_quarantine_records
from layertables.plans.run import Run, start_run
from layertables.sources.history_store import merge_history, read_history
from layertables.sources.tables import append_new, read_table, read_table_or_empty, recover_swap, write_table


# --------------------------------------------------------------------------- T1


@dataclass
class TableJob:
    """``read → transform → load``. ``transform`` is any ``DataFrame → DataFrame``
    (so it also works with ``df.transform``); subclasses may override it. Jobs that are given the
    same ``context`` share its time, :attr:`now`."""

    spark: SparkSession
    input_path: str | None
    output_path: str
    load: LoadSpec = field(default_factory=LoadSpec)
    transform_fn: Callable[[DataFrame], DataFrame] | None = None
    quarantine_path: str | None = None
    context: Run | None = None

    @property
    def now(self) -> dt.datetime | None:
        """The time of the run, for rows without a date (``None``: the query's own)."""
        return None if self.context is None else self.context.now

    def read(self) -> DataFrame:
        return read_table(self.spark, self.input_path)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.transform_fn is None:
            raise NotImplementedError(f"{type(self).__name__}: give a transform_fn or override transform")
        return self.transform_fn(df)

    def plan(self) -> Planned:
        self.load.check()
        df = self.transform(self.read())
        existing = None
        if self.load.load_type in ("scd1", "scd2"):
            existing = read_table_or_empty(self.spark, self.output_path)
        return plan_load(df, existing, self.load, self.now)

    def run(self) -> dict[str, Any]:
        p = self.plan()
        out = write_table(p.df, self.output_path, p.mode)
        if p.quarantine is not None and self.quarantine_path:
            out["quarantined"] = append_new(p.quarantine, self.quarantine_path)["rows"]
        return out


# --------------------------------------------------------------------------- T5 T6


@dataclass(frozen=True)
class TableRules:
    """Refinement rules of one table (bronze → silver)."""

    table: str
    cleaning: CleaningRules = CleaningRules()
    scd2: bool = False
    key: Sequence[str] | str | None = None
    tracked: Sequence[str] = ()
    effective_from_column: str | None = None
    effective_from_fallback_column: str | None = None
    effective_from_ts: Any = None
    time_type: Any = None
    missing_keys: str = "keep"
    close_at: Any = None
    corrupt_column: str | None = None
    # Rows that a NULL-drop rule removes go to the quarantine, with the column as reason.
    quarantine_required: bool = False
    # Store the history in partitions of this many key buckets, rewritten in part (see sources.history_store).
    history_buckets: int | None = None
    # Partition a new quarantine by row hash, so that an append reads a part of it (see append_new).
    quarantine_buckets: int | None = None

    @classmethod
    def from_mapping(cls, m: Mapping) -> "TableRules":
        """From a config mapping shaped like the silver YAML files."""
        return cls(
            table=m["table"],
            cleaning=CleaningRules.from_mapping(m),
            scd2=bool(m.get("scd2", False)),
            key=m.get("scd2_key"),
            tracked=tuple(m.get("scd2_track_columns", ()) or ()),
            effective_from_column=m.get("effective_from_column"),
            effective_from_fallback_column=m.get("effective_from_fallback_column"),
            effective_from_ts=m.get("effective_from_ts"),
            quarantine_required=bool(m.get("quarantine_required", False)),
            history_buckets=m.get("history_buckets"),
            quarantine_buckets=m.get("quarantine_buckets"),
        )


def load_rules(folder: str, read: Callable[[str], Mapping] | None = None, *, spark: SparkSession | None = None) -> list[TableRules]:
    """The rules of every table, one file each (``*.yml``, ``*.yaml`` or ``*.json``), by
    file name: a table is added by adding a file. ``read`` parses the path of one file; by
    default JSON is read as such and YAML with PyYAML, if installed. With ``spark`` the folder may
    be on any filesystem that Spark reads."""
    out = []
    for name, text in _rule_files(folder, spark):
        if read is not None:
            m = read(name)
        elif name.endswith(".json"):
            m = json.loads(text())
        else:
            import yaml  # optional dependency

            m = yaml.safe_load(text())
        if not isinstance(m, Mapping) or "table" not in m:
            raise ValueError(f"{name.rsplit('/', 1)[-1]}: a rule file is a mapping with a 'table'")
        out.append(TableRules.from_mapping(m))
    names = [r.table for r in out]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several rule files for {', '.join(twice)}")
    return out


_RULE_FILE = (".yml", ".yaml", ".json")


def _rule_files(folder: str, spark: SparkSession | None) -> list[tuple[str, Callable[[], str]]]:
    if spark is None:
        files = [f for f in sorted(Path(folder).iterdir()) if f.suffix in _RULE_FILE]
        return [(str(f), f.read_text) for f in files]
    # A few small files, read whole by Spark.
    pattern = "*{" + ",".join(_RULE_FILE) + "}"
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern)
    found = rows.select(F.col("_metadata.file_path").alias("f"), "value").sort("f").collect()
    return [(r["f"], lambda v=r["value"]: v) for r in found]


def _clean(valid: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame | None]:
    if not rules.quarantine_required:
        return apply_cleaning_rules(valid, rules.cleaning), None
    split = clean_with_quarantine(valid, rules.cleaning)
    return split.valid, split.quarantine


def _with(quarantine: DataFrame, more: DataFrame | None) -> DataFrame:
    return quarantine if more is None else quarantine.unionByName(more, allowMissingColumns=True)


def refine_table(incoming: DataFrame, existing: DataFrame | None, rules: TableRules, now: Any = None) -> Split:
    """Bronze batch → silver table content, in this order:

    1. quarantine split on the **raw** dates and key (a row with neither date
       is quarantined even if a cleaning rule would also drop it);
    2. cleaning (NULL drops, then re-casing), so the merge compares cleaned
       batch values with cleaned stored values;
    3. SCD2 merge into ``existing`` (or, for plain tables, the cleaned rows).
    """
    if not rules.scd2:
        qs = separate_quarantine_records(incoming, corrupt_column=rules.corrupt_column)
        valid = qs.valid.drop(rules.corrupt_column) if rules.corrupt_column else qs.valid
        cleaned, dropped = _clean(valid, rules)
        return Split(cleaned, _with(qs.quarantine, dropped))
    cleaned, quarantine = _scd2_batch(incoming, rules)
    res = apply_scd2(
        cleaned,
        existing,
        rules.key,
        rules.tracked,
        rules.effective_from_ts,
        rules.effective_from_column,
        rules.effective_from_fallback_column,
        time_type=rules.time_type,
        missing_keys=rules.missing_keys,
        close_at=rules.close_at,
        now=now,
    )
    return Split(res.valid, quarantine)


def _scd2_batch(incoming: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame]:
    """Steps 1 and 2 of :func:`refine_table` for a history: cleaned rows and those set aside."""
    if not rules.key or not rules.tracked:
        raise ValueError(f"{rules.table}: scd2 needs key and tracked columns")
    qs = separate_quarantine_records(
        incoming,
        rules.effective_from_column,
        rules.effective_from_fallback_column,
        keys=rules.key,
        time_type=rules.time_type,
        corrupt_column=rules.corrupt_column,
    )
    valid = qs.valid.drop(rules.corrupt_column) if rules.corrupt_column else qs.valid
    cleaned, dropped = _clean(valid, rules)
    return cleaned, _with(qs.quarantine, dropped)


def refine_batch(incoming: DataFrame, rules: TableRules, now: Any = None) -> Batch:
    """The batch of a history table, cleaned and dated, before any merge."""
    cleaned, quarantine = _scd2_batch(incoming, rules)
    batch = prepare_batch(
        cleaned,
        rules.key,
        rules.effective_from_ts,
        rules.effective_from_column,
        rules.effective_from_fallback_column,
        time_type=rules.time_type,
        now=now,
    )
    return Batch(batch.valid, quarantine, batch.present)


def refine_to_path(
    spark: SparkSession,
    rules: TableRules,
    input_path: str,
    output_path: str,
    quarantine_path: str | None = None,
    now: Any = None,
) -> dict[str, Any]:
    """Run :func:`refine_table` from a bronze path into a silver path; the silver
    table is overwritten (staged, since the merge reads it), or with
    ``history_buckets`` only the partitions that the batch changes, and the quarantine
    is appended without duplicates."""
    incoming = read_table(spark, input_path)
    if rules.scd2 and rules.history_buckets:
        batch = refine_batch(incoming, rules, now)
        merged = merge_history(
            batch.valid,
            output_path,
            rules.key,
            rules.tracked,
            missing_keys=rules.missing_keys,
            close_at=rules.close_at,
            present_keys=batch.present,
            buckets=rules.history_buckets,
        )
        out = {"inserted": merged.inserted, "closed": merged.closed, "deleted": merged.deleted, "partitions": len(merged.replaced)}
        if quarantine_path:
            out["quarantined"] = append_new(batch.quarantine, quarantine_path, buckets=rules.quarantine_buckets)["rows"]
        return out
    existing = read_table_or_empty(spark, output_path) if rules.scd2 else None
    split = refine_table(incoming, existing, rules, now)
    out = write_table(split.valid, output_path, "overwrite")
    if quarantine_path:
        out["quarantined"] = append_new(split.quarantine, quarantine_path, buckets=rules.quarantine_buckets)["rows"]
    return out


def refine_all(
    spark: SparkSession,
    rules: Sequence[TableRules],
    bronze_base: str,
    silver_base: str,
    quarantine_base: str | None = None,
    run: Run | None = None,
) -> dict[str, dict]:
    """Refine every table of a rule set; paths are ``{base}/{table}``. Rows without a
    date column start at the time of the run."""
    run = run or start_run(spark)
    out = {}
    for r in rules:
        target = f"{silver_base.rstrip('/')}/{r.table}"

        def work(r=r, target=target) -> dict[str, Any]:
            recover_swap(spark, target)
            quarantine = f"{quarantine_base.rstrip('/')}/{r.table}" if quarantine_base else None
            return refine_to_path(spark, r, f"{bronze_base.rstrip('/')}/{r.table}", target, quarantine, run.now)

        out[r.table] = run.step(f"silver:{r.table}", work)
    return out


# --------------------------------------------------------------------------- T2 T3 T4


def build_dimension(
    history: DataFrame,
    natural_key: Sequence[str] | str,
    key_name: str,
    tracked: Sequence[str],
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Silver history → gold dimension: rename columns, add the surrogate key
    (hash of natural key, ``effective_from`` and tracked values) as the first
    column. Versions and validity are kept exactly as in the history."""
    rename = dict(rename or {})
    nk = [rename.get(k, k) for k in ([natural_key] if isinstance(natural_key, str) else natural_key)]
    tr = [rename.get(t, t) for t in tracked]
    df = history.withColumnsRenamed(rename) if rename else history
    return add_surrogate_key(df, key_name, history_key_columns(nk, tr))


def fact_with_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_time: str,
    dim_key: str,
    key_name: str,
    select: Sequence[str] | None = None,
    time_format: str | None = None,
    prune: bool = False,
) -> DataFrame:
    """One as-of lookup; a string fact time is parsed with ``time_format``
    (unparseable → no match, NULL key). ``prune`` leaves out the versions that a slice of facts
    cannot need; the dimension is one that :func:`build_dimension` made of a merged history."""
    t = fact_time
    if dict(fact.dtypes)[fact_time] == "string":
        parsed = F.try_to_timestamp(F.col(fact_time), F.lit(time_format)) if time_format else F.col(fact_time).try_cast("timestamp")
        fact = fact.withColumn("__lt_fact_ts", parsed)
        t = "__lt_fact_ts"
    out = build_fact(fact, [AsOf(dim, fact_key, t, [key_name], dim_keys=dim_key, prune=prune, disjoint=prune)])
    return out.select(*select) if select else out.drop("__lt_fact_ts")


# --------------------------------------------------------------------------- T7


@dataclass(frozen=True)
class DimensionJob:
    table: str            # silver table name
    output: str           # gold table name
    natural_key: str
    key_name: str
    tracked: Sequence[str]
    rename: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FactJob:
    table: str            # silver table name
    output: str           # gold table name
    dimension: str        # gold dimension name
    fact_key: str
    fact_time: str
    dim_key: str
    key_name: str
    select: Sequence[str] | None = None
    time_format: str | None = None
    prune: bool = False   # for slices of facts: read only the versions they can need


def run_layers(
    spark: SparkSession,
    *,
    raw_feeds: Mapping[str, tuple[str, Any]],
    bronze: str,
    silver: str,
    gold: str,
    rules: Sequence[TableRules],
    dimensions: Sequence[DimensionJob] = (),
    facts: Sequence[FactJob] = (),
    quarantine: str | None = None,
    run: Run | None = None,
) -> dict[str, Any]:
    """raw → bronze → silver → gold dimensions → gold facts, in order.
    Sequential steps; each is one distributed Spark job per table. With a ``run`` that has
    a journal (:func:`layertables.plans.run.start_run`), finished steps are not run again."""
    from layertables.sources.csv import ingest

    run = run or start_run(spark)
    report: dict[str, Any] = {"bronze": {}, "gold": {}}

    def write(name: str, target: str, make: Callable[[], DataFrame]) -> dict[str, Any]:
        def work() -> dict[str, Any]:
            recover_swap(spark, target)
            return write_table(make(), target)

        return run.step(name, work)

    for table, feed in raw_feeds.items():

        def read_in(table=table, feed=feed) -> dict[str, Any]:
            recover_swap(spark, f"{bronze.rstrip('/')}/{table}")
            return ingest(spark, {table: feed}, bronze)[table]

        report["bronze"][table] = run.step(f"bronze:{table}", read_in)
    report["silver"] = refine_all(spark, rules, bronze, silver, quarantine, run)
    for d in dimensions:

        def dimension(d=d) -> DataFrame:
            return build_dimension(read_history(spark, f"{silver}/{d.table}"), d.natural_key, d.key_name, d.tracked, d.rename)

        report["gold"][d.output] = write(f"gold:{d.output}", f"{gold}/{d.output}", dimension)
    for f in facts:

        def fact(f=f) -> DataFrame:
            rows, dim = read_table(spark, f"{silver}/{f.table}"), read_table(spark, f"{gold}/{f.dimension}")
            return fact_with_dimension(rows, dim, f.fact_key, f.fact_time, f.dim_key, f.key_name, f.select, f.time_format, f.prune)

        report["gold"][f.output] = write(f"gold:{f.output}", f"{gold}/{f.output}", fact)
    return report

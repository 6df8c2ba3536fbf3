"""ANSI SQL (DuckDB dialect) for every driver query: the same derivations as
:mod:`layertables.plans.derive`, and the operators' meaning in another form on
purpose: the history merge by joins between versions where the operator uses
windows, change classes, key sets and as-of answers by joins with IS DISTINCT FROM.
"""

from __future__ import annotations

from collections.abc import Sequence

DATE_END = "DATE '9999-12-31'"
TS_END = "TIMESTAMP '9999-12-31 00:00:00'"
TRACKED = ["name", "segment", "nation"]
HIST = "id, name, segment, nation, created, updated, effective_from, effective_to, is_current"
RAW_HIST = "id, name, segment, nation, created_s, updated_s, effective_from, effective_to, is_current"


def key_sql(parts: Sequence[str]) -> str:
    inner = " || ".join(f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts)
    return f"('0x' || substr(md5({inner}), 1, 15))::BIGINT"


def merge_sql(
    name: str,
    hist: str | None,
    inc: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    rest: Sequence[str],
    end: str = DATE_END,
    missing: str = "keep",
    close_at: str | None = None,
    present: str | None = None,
) -> str:
    """CTEs ending in ``name`` = merge of ``inc`` (with effective_from) into ``hist``, stated by
    joins between versions: what a row's predecessor is, whether it is stored already, what starts next."""
    cols = [*keys, *tracked, *rest]
    c = ", ".join(cols)
    kp = ", ".join(keys)
    tie = ", ".join(f"{x} ASC NULLS FIRST" for x in [*tracked, *rest])
    same_key = " AND ".join(f"o.{k} = x.{k}" for k in keys)
    same = " AND ".join(f"o.{t} IS NOT DISTINCT FROM x.{t}" for t in tracked)
    values = "{" + ", ".join(f"'{t}': o.{t}" for t in tracked) + "}"
    differs = " OR ".join(f"x.{t} IS DISTINCT FROM p.v.{t}" for t in tracked)
    stored = f"SELECT {c}, effective_from, effective_to FROM {hist}" if hist else f"SELECT {c}, effective_from, {end} AS effective_to FROM {inc} WHERE FALSE"
    # Places in the order of a key: by start, stored before new, by end.
    place = "{{'f': {0}.effective_from, 's': {0}.src, 't': {0}.effective_to}}".format
    ctes = [
        f"{name}_s AS ({stored})",
        # One batch row a key and start (the tie-break), none that is stored already.
        f"{name}_b AS (SELECT {c}, effective_from FROM {inc} QUALIFY row_number() OVER (PARTITION BY {kp}, effective_from ORDER BY {tie}) = 1)",
        f"""{name}_n AS (SELECT row_number() OVER () AS n, x.* FROM {name}_b x
           WHERE NOT EXISTS (SELECT 1 FROM {name}_s o WHERE {same_key} AND o.effective_from = x.effective_from AND {same}))""",
        # A new row ends at the latest with the stored version that began last before it, if it is still in force.
        f"""{name}_inside AS (SELECT x.n, arg_max(o.effective_to, {{'f': o.effective_from, 't': o.effective_to}}) AS inside
           FROM {name}_n x JOIN {name}_s o ON {same_key} AND o.effective_from <= x.effective_from GROUP BY x.n)""",
        f"""{name}_u AS (SELECT 0 AS src, 0 AS n, {c}, effective_from, effective_to FROM {name}_s
           UNION ALL SELECT 1, x.n, {", ".join("x." + k for k in cols)}, x.effective_from,
                  CASE WHEN i.inside > x.effective_from THEN least(i.inside, {end}) ELSE {end} END
           FROM {name}_n x LEFT JOIN {name}_inside i ON i.n = x.n)""",
        # The row just before a new one: the latest to begin, among those of one start the new one, then the one that ends last.
        f"""{name}_p AS (SELECT x.n, arg_max({{'v': {values}, 't': o.effective_to}}, {place("o")}) AS p
           FROM {name}_u x JOIN {name}_u o ON {same_key} AND (o.effective_from < x.effective_from OR (o.effective_from = x.effective_from AND o.src < x.src))
           WHERE x.src = 1 GROUP BY x.n)""",
        # A new row stays if nothing is before it, or something else, or a gap.
        f"""{name}_k AS (SELECT x.* FROM {name}_u x LEFT JOIN {name}_p p0 ON p0.n = x.n AND x.src = 1 LEFT JOIN LATERAL (SELECT p0.p.v AS v, p0.p.t AS t) p ON TRUE
           WHERE x.src = 0 OR p0.n IS NULL OR {differs} OR p.t < x.effective_from)""",
        # A version ends where the next one starts.
        f"""{name}_e AS (SELECT {", ".join("x." + k for k in cols)}, x.effective_from, least(any_value(x.effective_to), coalesce(min(o.effective_from), {end})) AS effective_to
           FROM (SELECT *, row_number() OVER () AS id FROM {name}_k) x LEFT JOIN {name}_k o ON {same_key} AND {place("o")} > {place("x")}
           GROUP BY x.id, {", ".join("x." + k for k in cols)}, x.effective_from)""",
    ]
    if missing == "keep":
        final = f"SELECT {c}, effective_from, effective_to, effective_to = {end} AS is_current FROM {name}_e"
    else:
        on = " AND ".join(f"p.{k} = x.{k}" for k in keys)
        absent = f"NOT EXISTS (SELECT 1 FROM {present} p WHERE {on})"
        if missing == "close":
            e = f"CASE WHEN {absent} AND x.effective_to = {end} THEN greatest(x.effective_from, {close_at}) ELSE x.effective_to END"
            ctes.append(f"{name}_c AS (SELECT * REPLACE ({e} AS effective_to) FROM {name}_e x)")
            final = f"SELECT {c}, effective_from, effective_to, effective_to = {end} AS is_current FROM {name}_c"
        else:
            final = (
                f"SELECT {c}, effective_from, effective_to, effective_to = {end} AS is_current FROM {name}_e x "
                f"WHERE NOT ({absent} AND x.effective_to = {end})"
            )
    ctes.append(f"{name} AS ({final})")
    return ",\n".join(ctes)


# --------------------------------------------------------------------------- derivations

BATCH1 = """batch1 AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS segment,
         c_nationkey AS nation,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS created,
         CAST(NULL AS DATE) AS updated
  FROM customer)"""

BATCH2 = """b2rows AS (
  SELECT c_custkey AS k, c_custkey AS id, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT c_custkey AS k, c_custkey + 1000000 AS id, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 10 = 3),
batch2 AS (
  SELECT id, c_name AS name,
         CASE WHEN k % 7 = 0 THEN NULL
              WHEN k % 5 = 0 THEN 'X-' || (CASE WHEN k % 13 = 0 THEN NULL ELSE c_mktsegment END)
              ELSE (CASE WHEN k % 13 = 0 THEN NULL ELSE c_mktsegment END) END AS segment,
         c_nationkey AS nation,
         CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(DATE '1995-01-01' + CAST(k % 365 AS INTEGER) AS DATE) END AS created,
         CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(DATE '1998-01-01' + CAST(k % 700 AS INTEGER) AS DATE) END AS updated
  FROM b2rows)"""

RAW = """batch1_raw AS (
  SELECT id, name, segment, nation, CAST(created AS VARCHAR) AS created_s, CAST(updated AS VARCHAR) AS updated_s FROM batch1),
batch2_raw AS (
  SELECT CASE WHEN (id % 1000000) % 29 = 0 THEN NULL ELSE id END AS id, name, segment, nation,
         CASE WHEN (id % 1000000) % 19 = 0 THEN (CASE WHEN created IS NOT NULL THEN 'not a date' END)
              ELSE CAST(created AS VARCHAR) END AS created_s,
         CASE WHEN (id % 1000000) % 23 = 0 THEN (CASE WHEN updated IS NOT NULL THEN '1998-02-30' END)
              WHEN (id % 1000000) % 4 = 0 THEN NULL
              ELSE CAST(updated AS VARCHAR) END AS updated_s
  FROM batch2)"""

PARSED = "COALESCE(TRY_CAST(updated_s AS DATE), TRY_CAST(created_s AS DATE))"

REASON = f"""CASE WHEN id IS NULL THEN 'null_key'
            WHEN updated_s IS NULL AND created_s IS NULL THEN 'missing_dates'
            WHEN {PARSED} IS NULL THEN 'unparseable_dates' END"""

H1 = "h1_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM batch1),\n" + merge_sql(
    "h1", None, "h1_in", ["id"], TRACKED, ["created", "updated"]
)
B2_VALID = """b2_valid AS (SELECT * FROM batch2 WHERE id IS NOT NULL AND NOT (updated IS NULL AND created IS NULL)),
h2_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM b2_valid)"""
H2 = merge_sql("h2", "h1", "h2_in", ["id"], TRACKED, ["created", "updated"])
BASE = ",\n".join([BATCH1, BATCH2, H1, B2_VALID, H2])
RAWBASE = ",\n".join([BATCH1, BATCH2, RAW])

DIM_KEY = key_sql(["id", "effective_from", "name", "segment", "nation"])

# refine: quarantine on raw dates and key → clean (drop NULL name, upper name, lower segment) → merge
REFINE = (
    f"""c1_in AS (SELECT id, upper(name) AS name, lower(segment) AS segment, nation, created_s, updated_s, {PARSED} AS effective_from
           FROM batch1_raw WHERE ({REASON}) IS NULL AND name IS NOT NULL),
c2_in AS (SELECT id, upper(name) AS name, lower(segment) AS segment, nation, created_s, updated_s, {PARSED} AS effective_from
           FROM batch2_raw WHERE ({REASON}) IS NULL AND name IS NOT NULL),
"""
    + merge_sql("s1", None, "c1_in", ["id"], TRACKED, ["created_s", "updated_s"])
    + ",\n"
    + merge_sql("s2", "s1", "c2_in", ["id"], TRACKED, ["created_s", "updated_s"])
)

ORDERS_RAW = """orders_raw AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS status,
         lower(o_orderpriority) AS priority,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date
  FROM orders)"""
ORDERS_CLEAN = """orders_clean AS (
  SELECT order_id, customer_id, lower(status) AS status, upper(priority) AS priority, order_date
  FROM orders_raw WHERE customer_id IS NOT NULL AND order_date IS NOT NULL)"""

SUPPLIER = """sb1 AS (
  SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, 'T' || CAST(s_suppkey % 3 AS VARCHAR) AS tier,
         CAST(DATE '1995-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS DATE) AS created, CAST(NULL AS DATE) AS updated
  FROM supplier),
sb2 AS (
  SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation,
         CASE WHEN s_suppkey % 4 = 0 THEN 'T9' ELSE 'T' || CAST(s_suppkey % 3 AS VARCHAR) END AS tier,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(DATE '1995-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS DATE) END AS created,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(DATE '1999-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS DATE) END AS updated
  FROM supplier),
sh1_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM sb1),
sh2_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM sb2 WHERE id IS NOT NULL AND NOT (updated IS NULL AND created IS NULL))"""


def _w(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _asof_content(hist: str) -> str:
    return f"""SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS o_orderdate,
       h.name AS v_name, h.segment AS v_segment, h.nation AS v_nation
FROM orders o LEFT JOIN {hist} h
  ON o.o_custkey = h.id AND CAST(o.o_orderdate AS DATE) >= h.effective_from AND CAST(o.o_orderdate AS DATE) < h.effective_to"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    dim = f"dim AS (SELECT {DIM_KEY} AS customer_key, * FROM h2)"
    q["fact_asof_join"] = _w(
        BASE + ",\n" + dim,
        """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS o_orderdate, d.customer_key
FROM orders o LEFT JOIN dim d
  ON o.o_custkey = d.id AND CAST(o.o_orderdate AS DATE) >= d.effective_from AND CAST(o.o_orderdate AS DATE) < d.effective_to""",
    )
    q["fact_unmatched"] = _w(
        BASE + ",\n" + dim + """,
f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN o_custkey + 5000000 ELSE o_custkey END AS o_custkey,
             CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)""",
        """SELECT f.o_orderkey, f.o_custkey, f.o_orderdate, d.customer_key
FROM f LEFT JOIN dim d ON f.o_custkey = d.id AND f.o_orderdate >= d.effective_from AND f.o_orderdate < d.effective_to
WHERE d.customer_key IS NULL""",
    )
    q["scd2_initial_load"] = _w(",\n".join([BATCH1, H1]), f"SELECT {HIST} FROM h1")
    q["scd2_snapshot_merge"] = _w(BASE, f"SELECT {HIST} FROM h2")
    q["scd2_replay_noop"] = q["scd2_snapshot_merge"]

    ev = """ev AS (SELECT user_id, event_type, ts AS effective_from FROM events),
ev_a AS (SELECT * FROM ev WHERE effective_from < TIMESTAMP '2024-01-16 00:00:00'),
ev_b AS (SELECT * FROM ev WHERE effective_from >= TIMESTAMP '2024-01-16 00:00:00'),
""" + merge_sql("ea", None, "ev_a", ["user_id"], ["event_type"], [], TS_END) + ",\n" + merge_sql(
        "eb", "ea", "ev_b", ["user_id"], ["event_type"], [], TS_END
    )
    q["scd2_change_log"] = _w(
        ev,
        "SELECT user_id, event_type, effective_from, CASE WHEN is_current THEN NULL ELSE effective_to END AS effective_to, is_current FROM eb",
    )
    late = ",\n".join(
        [
            BATCH1,
            BATCH2,
            "h1_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM batch1)",
            B2_VALID,
            merge_sql("l1", None, "h2_in", ["id"], TRACKED, ["created", "updated"]),
            merge_sql("l2", "l1", "h1_in", ["id"], TRACKED, ["created", "updated"]),
        ]
    )
    q["scd2_late_arrival"] = _w(late, f"SELECT {HIST} FROM l2")
    q["scd2_late_arrival_asof"] = _w(BASE, _asof_content("h2"))
    classify = """cls AS (
  SELECT i.id, CASE WHEN h.id IS NULL THEN 'new'
                    WHEN i.name IS DISTINCT FROM h.name OR i.segment IS DISTINCT FROM h.segment OR i.nation IS DISTINCT FROM h.nation THEN 'changed'
                    ELSE 'unchanged' END AS change_type
  FROM b2_valid i LEFT JOIN (SELECT * FROM h1 WHERE is_current) h ON i.id = h.id)"""
    q["scd2_change_class"] = _w(BASE + ",\n" + classify, "SELECT id, change_type FROM cls")
    q["scd2_change_counts"] = _w(
        BASE + ",\n" + classify, "SELECT change_type, CAST(count(*) AS BIGINT) AS n_rows FROM cls GROUP BY change_type"
    )
    present = "b2keys AS (SELECT id FROM batch2 WHERE id IS NOT NULL)"
    q["scd2_missing_close"] = _w(
        ",\n".join([BATCH1, BATCH2, H1, B2_VALID, present,
                    merge_sql("mc", "h1", "h2_in", ["id"], TRACKED, ["created", "updated"], missing="close",
                              close_at="DATE '1999-12-31'", present="b2keys")]),
        f"SELECT {HIST} FROM mc",
    )
    q["scd2_missing_drop"] = _w(
        ",\n".join([BATCH1, BATCH2, H1, B2_VALID, present,
                    merge_sql("md", "h1", "h2_in", ["id"], TRACKED, ["created", "updated"], missing="drop", present="b2keys")]),
        f"SELECT {HIST} FROM md",
    )
    q["scd2_current_view"] = _w(BASE, "SELECT id, name, segment, nation, effective_from FROM h2 WHERE is_current")
    pipe = ",\n".join(
        [
            RAWBASE,
            f"r1_in AS (SELECT *, {PARSED} AS effective_from FROM batch1_raw)",
            merge_sql("r1", None, "r1_in", ["id"], TRACKED, ["created_s", "updated_s"]),
            f"r2_in AS (SELECT *, {PARSED} AS effective_from FROM batch2_raw WHERE id IS NOT NULL AND {PARSED} IS NOT NULL)",
            merge_sql("r2", "r1", "r2_in", ["id"], TRACKED, ["created_s", "updated_s"]),
        ]
    )
    q["scd2_pipeline"] = _w(pipe, f"SELECT {RAW_HIST} FROM r2")
    q["new_keys_anti"] = _w(
        BASE, "SELECT id, name FROM b2_valid b WHERE NOT EXISTS (SELECT 1 FROM h1 WHERE h1.is_current AND h1.id = b.id)"
    )
    q["changed_keys_semi"] = _w(
        BASE,
        """SELECT id, segment, effective_from FROM h1 c WHERE is_current AND EXISTS (
  SELECT 1 FROM b2_valid b WHERE b.id = c.id AND (b.name IS DISTINCT FROM c.name OR b.segment IS DISTINCT FROM c.segment OR b.nation IS DISTINCT FROM c.nation))""",
    )
    q["effective_from_resolve"] = _w(
        RAWBASE,
        f"""SELECT id, created_s, updated_s, COALESCE(TRY_CAST(updated_s AS DATE), TRY_CAST(created_s AS DATE), DATE '2000-01-01') AS effective_from,
       {DATE_END} AS effective_to, TRUE AS is_current FROM batch2_raw""",
    )
    quar = f"SELECT id, name, created_s, updated_s, {REASON} AS quarantine_reason FROM batch2_raw WHERE ({REASON}) IS NOT NULL"
    q["quarantine_split"] = _w(RAWBASE, quar)
    q["quarantine_append_idempotent"] = q["quarantine_split"]
    q["quarantine_summary"] = _w(
        RAWBASE + ",\n" + SUPPLIER + f""",
cq AS ({quar}),
sq AS (SELECT CASE WHEN id IS NULL THEN 'null_key' WHEN updated IS NULL AND created IS NULL THEN 'missing_dates' END AS quarantine_reason FROM sb2),
qa AS (SELECT 'customers' AS table_name, quarantine_reason FROM cq
       UNION ALL SELECT 'suppliers' AS table_name, quarantine_reason FROM sq WHERE quarantine_reason IS NOT NULL)""",
        "SELECT table_name, quarantine_reason, CAST(count(*) AS BIGINT) AS n_rows FROM qa GROUP BY ROLLUP (table_name, quarantine_reason)",
    )
    q["clean_rules"] = _w(
        RAWBASE, "SELECT id, upper(name) AS name, lower(segment) AS segment, nation FROM batch2_raw WHERE segment IS NOT NULL"
    )
    q["filter_equals"] = _w(BATCH1, "SELECT id, name, segment FROM batch1 WHERE segment = 'BUILDING'")
    q["status_counts"] = _w(BATCH1, "SELECT segment, CAST(count(*) AS BIGINT) AS n_rows FROM batch1 GROUP BY segment")
    q["schema_drift_report"] = """
SELECT 'c_custkey' AS column_name, 'type_mismatch' AS issue, 'int' AS expected_type, 'bigint' AS actual_type,
       CAST(count(*) FILTER (WHERE c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS INTEGER) IS NULL) AS BIGINT) AS bad_values FROM customer
UNION ALL SELECT 'c_phone', 'missing_column', 'string', NULL, CAST(NULL AS BIGINT)
UNION ALL SELECT 'c_nationkey', 'type_mismatch', 'bigint', 'int',
       CAST(count(*) FILTER (WHERE c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL) AS BIGINT) FROM customer
UNION ALL SELECT 'c_mktsegment', 'type_mismatch', 'int', 'string',
       CAST(count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND TRY_CAST(c_mktsegment AS INTEGER) IS NULL) AS BIGINT) FROM customer
UNION ALL SELECT 'c_acctbal', 'extra_column', NULL, 'double', CAST(NULL AS BIGINT)"""
    q["csv_declared_scan"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
    q["csv_corrupt_rows"] = "SELECT c_custkey, 'malformed_row' AS quarantine_reason FROM customer WHERE c_custkey % 50 = 0"
    q["surrogate_key_unique"] = _w(
        BASE + ",\n" + dim,
        """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT customer_key) AS BIGINT) AS n_keys,
       CAST(count(*) FILTER (WHERE customer_key IS NULL) AS BIGINT) AS n_null_keys FROM dim""",
    )
    q["dim_build"] = _w(
        BASE,
        f"""SELECT {key_sql(['id', 'effective_from', 'name', 'segment', 'nation'])} AS customer_key, id AS customer_id,
       name, segment, nation, created, updated, effective_from, effective_to, is_current FROM h2""",
    )
    q["dim_build_second"] = _w(
        SUPPLIER + ",\n"
        + merge_sql("sh1", None, "sh1_in", ["id"], ["name", "nation", "tier"], ["created", "updated"]) + ",\n"
        + merge_sql("sh2", "sh1", "sh2_in", ["id"], ["name", "nation", "tier"], ["created", "updated"]),
        f"""SELECT {key_sql(['id', 'effective_from', 'name', 'nation', 'tier'])} AS supplier_key, id AS supplier_id,
       name, nation, tier, created, updated, effective_from, effective_to, is_current FROM sh2""",
    )
    q["load_overwrite"] = _w(BATCH1, "SELECT id, name, lower(segment) AS segment, nation, created, updated FROM batch1")
    q["load_append"] = _w(
        ",\n".join([BATCH1, BATCH2]),
        "SELECT id, name, segment, nation, created, updated FROM batch1 UNION ALL SELECT id, name, segment, nation, created, updated FROM batch2",
    )
    q["load_scd1_upsert"] = _w(
        ",\n".join([BATCH1, BATCH2]),
        """SELECT id, name, segment, nation, created, updated FROM batch1 WHERE id NOT IN (SELECT id FROM batch2)
UNION ALL SELECT id, name, segment, nation, created, updated FROM batch2""",
    )
    q["refine_scd2_table"] = _w(RAWBASE + ",\n" + REFINE, f"SELECT {RAW_HIST} FROM s2")
    q["refine_plain_table"] = _w(
        ORDERS_RAW + ",\n" + ORDERS_CLEAN, "SELECT order_id, customer_id, status, priority, order_date FROM orders_clean"
    )
    q["pipeline_end_to_end"] = _w(
        RAWBASE + ",\n" + REFINE + ",\n" + ORDERS_RAW + ",\n" + ORDERS_CLEAN
        + f",\ngdim AS (SELECT {DIM_KEY} AS customer_key, * FROM s2)",
        """SELECT o.order_id, d.customer_key, o.customer_id, o.status, o.priority, o.order_date
FROM orders_clean o LEFT JOIN gdim d
  ON o.customer_id = d.id AND CAST(o.order_date AS DATE) >= d.effective_from AND CAST(o.order_date AS DATE) < d.effective_to""",
    )
    q["csv_header_drift"] = """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal,
       'c_acctbal' AS missing, 'note' AS extra FROM customer"""
    q["fact_asof_window"] = q["fact_asof_join"]
    q["scd2_present_keys_hot"] = q["scd2_missing_close"]
    # By intervals, not by the merge rule: each key has one stored version and one late row.
    q["scd2_late_into_closed"] = _w(
        BATCH1 + """,
st AS (SELECT *, created AS f, CASE WHEN id % 5 = 0 THEN DATE '1996-01-01' WHEN id % 3 = 0 THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS t FROM batch1),
lt AS (SELECT id, name, CASE WHEN id % 4 = 0 THEN segment ELSE 'L-' || coalesce(segment, '') END AS segment, nation, created,
              CAST(DATE '1996-06-01' + CAST(id % 300 AS INTEGER) AS DATE) AS late_at FROM batch1 WHERE id % 2 = 0),
both_ AS (SELECT st.*, lt.late_at, lt.segment AS late_segment, lt.late_at IS NOT NULL AND (lt.late_at >= st.t OR lt.segment IS DISTINCT FROM st.segment) AS opens
          FROM st LEFT JOIN lt ON lt.id = st.id)""",
        """SELECT id, name, segment, nation, f AS effective_from, CASE WHEN opens AND late_at < t THEN late_at ELSE t END AS effective_to,
       (CASE WHEN opens AND late_at < t THEN late_at ELSE t END) = DATE '9999-12-31' AS is_current FROM both_
UNION ALL
SELECT id, name, late_segment, nation, late_at, CASE WHEN late_at < t THEN t ELSE DATE '9999-12-31' END,
       (CASE WHEN late_at < t THEN t ELSE DATE '9999-12-31' END) = DATE '9999-12-31' FROM both_ WHERE opens""",
    )
    q["surrogate_key_adversarial"] = _w(
        """parts AS (
  SELECT c_name || '|' AS a, c_mktsegment AS b FROM customer
  UNION ALL SELECT c_name, '|' || c_mktsegment FROM customer
  UNION ALL SELECT c_name, NULL FROM customer
  UNION ALL SELECT c_name, '<null>' FROM customer
  UNION ALL SELECT c_name, '' FROM customer
  UNION ALL SELECT NULL, c_name FROM customer)""",
        f"SELECT a, b, {key_sql(['a', 'b'])} AS k FROM parts",
    )
    q["surrogate_key_dense"] = """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys,
       CAST(1 AS BIGINT) AS least, CAST(count(*) AS BIGINT) AS greatest, CAST(0 AS BIGINT) AS moved
FROM customer"""
    q["quarantine_append_evolved"] = _w(
        RAWBASE + f""",
q0 AS ({quar}),
ev0 AS (SELECT *, CAST(NULL AS VARCHAR) AS feed FROM q0 UNION ALL
        SELECT *, CASE WHEN id % 2 = 0 THEN 'second' END AS feed FROM q0 WHERE id % 2 = 0)""",
        "SELECT * FROM ev0",
    )
    q["load_scd2_slice"] = _w(
        BATCH1 + ",\n" + H1 + """,
sl AS (SELECT id, name, 'S-' || coalesce(segment, '') AS segment, nation, created, updated, DATE '1999-01-01' AS effective_from
       FROM batch1 WHERE id % 10 = 1),
"""
        + merge_sql("ms", "h1", "sl", ["id"], TRACKED, ["created", "updated"]),
        f"SELECT {HIST} FROM ms",
    )
    q["refine_quarantine_required"] = _w(
        ORDERS_RAW,
        """SELECT order_id, customer_id, order_date,
       CASE WHEN customer_id IS NULL THEN 'null_required:customer_id' ELSE 'null_required:order_date' END AS quarantine_reason
FROM orders_raw WHERE customer_id IS NULL OR order_date IS NULL""",
    )
    # Exact distinct counts and exact distribution functions in place of the sketches.
    loads = []
    for name in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"):
        second = {
            "c_acctbal": "c_acctbal + 3000",
            "c_name": "CASE WHEN c_custkey % 4 <> 0 THEN c_name END",
            "c_mktsegment": "c_mktsegment || CAST(c_nationkey AS VARCHAR)",
        }.get(name, name)
        for k, e in ((1, name), (2, second)):
            number = "NULL" if name in ("c_name", "c_mktsegment") else e
            loads.append(f"SELECT '{name}' AS c, {k} AS load, CAST({e} AS VARCHAR) AS v, CAST({number} AS DOUBLE) AS x FROM customer")
    q["value_drift"] = f"""WITH vals AS ({" UNION ALL ".join(loads)}),
sums AS (SELECT c, count(*) FILTER (WHERE load = 1) AS n1, count(*) FILTER (WHERE load = 2) AS n2,
                count(*) FILTER (WHERE load = 1 AND v IS NULL) AS z1, count(*) FILTER (WHERE load = 2 AND v IS NULL) AS z2,
                count(DISTINCT v) FILTER (WHERE load = 1) AS d1, count(DISTINCT v) FILTER (WHERE load = 2) AS d2,
                count(x) FILTER (WHERE load = 1) AS x1, count(x) FILTER (WHERE load = 2) AS x2 FROM vals GROUP BY c),
cdf AS (SELECT c, count(*) FILTER (WHERE load = 1) OVER w AS f1, count(*) FILTER (WHERE load = 2) OVER w AS f2 FROM vals WHERE x IS NOT NULL
        WINDOW w AS (PARTITION BY c ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
apart AS (SELECT c, max(abs(f1 / CAST(x1 AS DOUBLE) - f2 / CAST(x2 AS DOUBLE))) AS distance FROM cdf JOIN sums USING (c) GROUP BY c),
why AS (SELECT sums.*, concat_ws(',', CASE WHEN abs(z1 / CAST(n1 AS DOUBLE) - z2 / CAST(n2 AS DOUBLE)) > 0.05 THEN 'nulls' END,
               CASE WHEN greatest(d1, d2) > 1.5 * least(d1, d2) THEN 'distinct' END, CASE WHEN distance > 0.1 THEN 'distribution' END) AS reasons
        FROM sums LEFT JOIN apart USING (c))
SELECT c AS column_name, n1 AS n_rows_before, n2 AS n_rows_after, z1 AS n_null_before, z2 AS n_null_after, reasons <> '' AS shifted, reasons FROM why"""
    q["quarantine_append_pruned"] = q["quarantine_append_evolved"]
    q["fact_asof_open_end"] = q["scd2_late_arrival_asof"]
    q["fact_asof_day_slice"] = (
        q["scd2_late_arrival_asof"] + "\nWHERE CAST(o.o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"
    )
    # By joins, not by the merge rule: every key has at most one stored version and one batch row.
    q["scd2_change_rows"] = _w(
        ",\n".join([BATCH1, BATCH2, "h1_in AS (SELECT *, COALESCE(updated, created) AS effective_from FROM batch1)", B2_VALID]) + f""",
pair AS (SELECT b.id, b.segment, b.effective_from AS f, o.id IS NOT NULL AS known, o.segment AS old_segment, o.effective_from AS old_f,
                o.id IS NULL OR b.name IS DISTINCT FROM o.name OR b.segment IS DISTINCT FROM o.segment OR b.nation IS DISTINCT FROM o.nation AS opens
         FROM h2_in b LEFT JOIN h1_in o ON o.id = b.id)""",
        f"""SELECT id, segment, f AS effective_from, {DATE_END} AS effective_to, 'insert' AS change, CAST(NULL AS DATE) AS previous_effective_to
FROM pair WHERE opens
UNION ALL SELECT id, old_segment, old_f, f, 'close', {DATE_END} FROM pair WHERE known AND opens""",
    )
    q["scd2_replay_changes"] = q["scd2_snapshot_merge"]
    q["scd2_partial_overwrite"] = q["scd2_snapshot_merge"]
    q["scd2_partial_late"] = q["scd2_late_arrival"]
    return q

"""The trie of conversation prefixes, with totals of every subtree.

Every distinct sequence of first turns is a node, so conversations that begin alike
share a path. Nodes come from an aggregate over hashes of all prefixes: each
turn is hashed with its position, role and text, and running sums of those hashes
in four lanes of 32 bits name the prefix. A turn that very many conversations begin
with is combined before the shuffle.

Subtree totals come from **parallel tree contraction**, in rounds of joins:

* *rake*: leaves hand their totals to their parents (an aggregate by parent, so a
  node with very many children is no hot task) and go;
* *compress*: nodes with one child are spliced out of unary chains, the child
  taking over the parent and, on its edge, what the node held. In round ``k`` these are
  the nodes whose depth has bit ``k`` where their parent's has not. Two neighbours
  never both have that, and a chain halves in every round, so a conversation of
  ``n`` turns takes about ``log2 n`` rounds;
* *re-expansion*: spliced nodes are put back in reverse order, each getting its
  total from that of the child which took its place.

Joins of a round are by node, one row on either side. Every round is written to the
shared folder and read back.

Turns are numbered across tasks: rows are dealt by ranges of (conversation, turn), and
the rows of a conversation in the ranges before are added up, so one conversation
can hold any part of the table. The ids that end at a node are hashed in a stream:
joined by blocks of :data:`ID_BLOCK` ids, then fed to the hash in order.

Defined cases: rows with a null conversation id are left out; turns are ordered by
number (null first), then role, then text; equal rows are turns of their own; null role
and text are empty; a conversation without turns after :func:`rebuilt` is a member of
the root; an empty table has no root and gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layertables.llm.common import shuffle_partitions, written

LANES = ("l0", "l1", "l2", "l3")
PREV = tuple(f"p{x}" for x in LANES)
BLOCK_TURNS = 4096
ID_BITS = 12
ID_BLOCK = 1 << ID_BITS
NO_IDS = hashlib.sha256(b"").hexdigest()
_BEFORE = (Window.unboundedPreceding, -1)


# --------------------------------------------------------------------------- turns


def numbered(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, block, position (from 1), role, text`` and sizes ``conv_id, block, n, base``."""
    rows = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("tie"),  # divides equal rows between ranges
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    dealt = rows.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("block", F.spark_partition_id())
    dealt = written(dealt, "trie_turns")
    row = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order[1:]))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(*_BEFORE)
    sizes = dealt.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    sizes = written(sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "trie_sizes")
    turns = dealt.withColumn("row", row).join(sizes.select("conv_id", "block", "base"), ["conv_id", "block"])
    return turns.select("conv_id", "block", (F.col("base") + F.col("row")).alias("position"), "role", "text"), sizes


def head_length() -> Column:
    """How many turns a conversation takes from the first of its hundred."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, position (from 1), role, text`` and conversations ``conv_id, n_turns``,
    where conversation ``c`` begins with the first ``h`` turns of ``c - c % 100`` in place of its own."""
    turns, sizes = numbered(df)
    turns = written(turns, "trie_numbered")
    convs = sizes.groupBy("conv_id").agg(F.sum("n").alias("own"))
    convs = convs.withColumn("h", head_length()).withColumn("source", F.col("conv_id") - F.col("conv_id") % 100)
    sources = convs.select(F.col("conv_id").alias("source"), F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.join(sources, "source", "left").withColumn("taken", taken)
    convs = convs.withColumn("n_turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv_id", "source", "h", "taken", "n_turns"), "trie_conversations")
    heads = turns.filter("position <= 5 and conv_id % 100 = 0").select(F.col("conv_id").alias("source"), "position", "role", "text")
    first = convs.join(heads, "source").filter("position <= h").select("conv_id", "position", "role", "text")
    # By (conversation, block): the rows of one conversation are spread.
    shift = sizes.select("conv_id", "block").join(convs, "conv_id").select("conv_id", "block", "h", "taken")
    rest = turns.join(shift, ["conv_id", "block"]).filter("position > h")
    rest = rest.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "role", "text")
    return first.unionByName(rest), convs.select("conv_id", "n_turns")


# --------------------------------------------------------------------------- nodes


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, position, size`` (code points of the turn's text), the lanes of the prefix
    that ends there and those of the prefix before it."""
    h, h2 = F.xxhash64("role", "text"), F.xxhash64(F.lit("second"), "text", "role")
    t = turns.select("conv_id", "position", F.length("text").cast("bigint").alias("size"), h.alias("h"), h2.alias("h2"))
    one, two, low = F.xxhash64("position", "h", "h2"), F.xxhash64("h2", "position", "h"), F.lit(0xFFFFFFFF)
    parts = (one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32))
    t = t.select("conv_id", "position", "size", F.floor(F.col("position") / BLOCK_TURNS).alias("block"), *[c.alias(x) for c, x in zip(parts, LANES)])
    t = written(t, "trie_hashes")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(*_BEFORE)
    sums = t.groupBy("conv_id", "block").agg(*[F.sum(x).alias(x) for x in LANES])
    sums = sums.select("conv_id", "block", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"b{x}") for x in LANES])
    running = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({f"r{x}": F.sum(x).over(running) for x in LANES}).join(sums, ["conv_id", "block"])
    whole = {x: F.col(f"b{x}") + F.col(f"r{x}") for x in LANES}
    return t.select(
        "conv_id", "position", "size", *[whole[x].alias(x) for x in LANES], *[(whole[x] - F.col(x)).alias(f"p{x}") for x in LANES]
    )


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``conv_id, depth, lanes, n_convs, size, n_children, parent_conv_id`` and the
    lanes of the whole of every conversation, ``conv_id, depth, lanes``."""
    p = written(prefixes(turns), "trie_prefixes")
    nodes = p.withColumnRenamed("position", "depth").groupBy("depth", *LANES).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), *[F.max(x).alias(x) for x in PREV]
    )
    nodes = written(nodes, "trie_nodes")
    whole = p.groupBy("conv_id").agg(F.max("position").alias("depth"), *[F.max(x).alias(x) for x in LANES])  # sums only grow
    zero = F.lit(0).cast("bigint")
    turnless = convs.filter("n_turns = 0").select("conv_id", zero.alias("depth"), *[zero.alias(x) for x in LANES])
    whole = whole.select("conv_id", "depth", *LANES).unionByName(turnless)
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), *[F.col(x).alias(y) for x, y in zip(PREV, LANES)])
    kids = kids.agg(F.count("*").alias("n_children"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    least = root.collect()  # one row
    root = root.select("conv_id", "n_convs", zero.alias("depth"), zero.alias("size"), *[zero.alias(x) for x in (*LANES, *PREV)])
    counted = nodes.unionByName(root).join(kids, ["depth", *LANES], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # The parent's name; children of the root have it without a join.
    up = counted.filter("depth > 0 and n_children > 0").select(
        F.col("conv_id").alias("up"), (F.col("depth") + 1).alias("depth"), *[F.col(x).alias(y) for x, y in zip(LANES, PREV)]
    )
    top = F.lit(least[0]["conv_id"] if least else None).cast("bigint")
    deep = counted.filter("depth > 1").join(up, ["depth", *PREV]).withColumnRenamed("up", "parent_conv_id")
    flat = counted.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    cols = ["conv_id", "depth", *LANES, "n_convs", "size", "n_children", "parent_conv_id"]
    return written(deep.select(*cols).unionByName(flat.select(*cols)), "trie_named"), whole


def ends(whole: DataFrame) -> DataFrame:
    """``depth, lanes, ends_sha256``: hash of the ascending ids that end at a node."""
    spark = whole.sparkSession
    block = whole.withColumn("block", F.shiftright("conv_id", ID_BITS)).groupBy("depth", *LANES, "block")  # at most ID_BLOCK ids
    ids = block.agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ids = ids.select("depth", *LANES, "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    key = ["depth", *LANES]
    ids = ids.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in (*key, "ends_sha256")}
        now, sha = None, None

        def close():
            for c, v in zip(key, now):
                out[c].append(v)
            out["ends_sha256"].append(sha.hexdigest())

        for b in batches:
            for *k, _, joined in zip(*[c.to_pylist() for c in b.columns]):
                if k != now:
                    if now is not None:
                        close()
                    now, sha = k, hashlib.sha256(joined.encode())
                else:
                    sha.update(b"," + joined.encode())
            if len(out["depth"]) > 10_000:
                yield pa.RecordBatch.from_pydict(out)
                out = {c: [] for c in out}
        if now is not None:
            close()
        if out["depth"]:
            yield pa.RecordBatch.from_pydict(out)

    return ids.mapInArrow(run, ", ".join(f"{c} bigint" for c in key) + ", ends_sha256 string")


# --------------------------------------------------------------------------- contraction

NODE = ("conv_id", "depth")
PARENT = ("up_conv", "up_depth")


def _round(live: DataFrame, k: int) -> DataFrame:
    """One rake and one compress. ``live`` holds node, parent, ``a_*`` (own and raked
    values), ``e_*`` (values on the edge to the parent) and ``kids``. Returns all rows with
    ``status``; a child whose parent was spliced out carries that node in ``gone_*``."""
    values = [c[2:] for c in live.columns if c.startswith("a_")]
    leaf = F.col("kids") == 0
    below = live.filter(F.col("up_conv").isNotNull()).groupBy(*PARENT).agg(
        F.sum(F.when(leaf, 0).otherwise(1)).alias("left"),
        # The only child, where one is left.
        F.min(F.when(~leaf, F.col("conv_id"))).alias("kid_conv"),
        F.min(F.when(~leaf, F.col("depth"))).alias("kid_depth"),
        *[F.sum(F.when(leaf, F.col(f"a_{v}") + F.col(f"e_{v}")).otherwise(0)).alias(f"raked_{v}") for v in values],
    )
    below = below.withColumnsRenamed(dict(zip(PARENT, NODE)))
    inner = live.filter(~leaf).join(below, list(NODE)).withColumns({f"a_{v}": F.col(f"a_{v}") + F.col(f"raked_{v}") for v in values})
    bit = lambda c: F.shiftright(F.col(c), k) % 2
    out = F.col("up_conv").isNotNull() & (F.col("left") == 1) & (bit("depth") == 1) & (bit("up_depth") == 0)
    inner = inner.withColumn("out", F.coalesce(out, F.lit(False)))
    spliced = inner.filter("out").select(
        F.col("conv_id").alias("gone_conv"),
        F.col("depth").alias("gone_depth"),
        F.col("kid_conv").alias("conv_id"),
        F.col("kid_depth").alias("depth"),
        F.col("up_conv").alias("new_conv"),
        F.col("up_depth").alias("new_depth"),
        *[F.col(f"a_{v}").alias(f"gone_{v}") for v in values],
        *[(F.col(f"a_{v}") + F.col(f"e_{v}")).alias(f"over_{v}") for v in values],
    )
    kept = inner.join(spliced, list(NODE), "left")
    took = F.col("gone_conv").isNotNull()
    kept = kept.select(
        *NODE,
        F.when(took, F.col("new_conv")).otherwise(F.col("up_conv")).alias("up_conv"),
        F.when(took, F.col("new_depth")).otherwise(F.col("up_depth")).alias("up_depth"),
        *[F.col(f"a_{v}") for v in values],
        *[F.when(took, F.col(f"e_{v}") + F.col(f"over_{v}")).otherwise(F.col(f"e_{v}")).alias(f"e_{v}") for v in values],
        F.col("left").alias("kids"),
        F.when(F.col("out"), "spliced").otherwise("live").alias("status"),
        "gone_conv",
        "gone_depth",
        # What the node that went lacks to its total: its own and what was on its child's edge.
        *[(F.col(f"gone_{v}") + F.col(f"e_{v}")).alias(f"gone_{v}") for v in values],
    )
    return kept.unionByName(live.filter(leaf).withColumn("status", F.lit("raked")), allowMissingColumns=True)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``conv_id, depth`` and for each of ``values`` its sum over the node's subtree.
    ``nodes`` has ``conv_id, depth`` (together the node's name), ``up_conv, up_depth``
    (null for a root), ``n_children`` and the values."""
    zero = F.lit(0).cast("bigint")
    live = nodes.select(
        *NODE,
        *PARENT,
        *[F.col(v).cast("bigint").alias(f"a_{v}") for v in values],
        *[zero.alias(f"e_{v}") for v in values],
        F.col("n_children").cast("bigint").alias("kids"),
    )
    live = written(live, "trie_live")
    deepest = nodes.agg(F.max("depth")).collect()[0][0] or 0
    bits = max(1, int(deepest).bit_length())
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        rounds.append(written(_round(live, len(rounds) % bits), "trie_round"))
        live = rounds[-1].filter("status = 'live'").drop("status", "gone_conv", "gone_depth", *[f"gone_{v}" for v in values])
    done: DataFrame | None = None
    for r in reversed(rounds):
        raked = r.filter("status = 'raked'").select(*NODE, *[F.col(f"a_{v}").alias(v) for v in values])
        if done is not None:
            gone = r.filter("gone_conv is not null").select(*NODE, "gone_conv", "gone_depth", *[f"gone_{v}" for v in values])
            back = gone.join(done, list(NODE)).select(
                F.col("gone_conv").alias("conv_id"), F.col("gone_depth").alias("depth"), *[(F.col(f"gone_{v}") + F.col(v)).alias(v) for v in values]
            )
            done = done.unionByName(raked).unionByName(written(back, "trie_back"))
        else:
            done = raked
    return nodes.select(*NODE, *values).limit(0) if done is None else done


def build(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, from turns ``conv_id, position, role, text`` and
    conversations ``conv_id, n_turns``."""
    nodes, whole = trie(turns, convs)
    up = {"up_conv": F.col("parent_conv_id"), "up_depth": F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1)}
    own = {"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")}
    sums = subtree_sums(nodes.withColumns({**up, **own}), list(own))
    out = nodes.join(sums, list(NODE)).join(ends(whole), ["depth", *LANES], "left")
    longs = [F.col(c).cast("bigint").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return out.select(*longs, F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))

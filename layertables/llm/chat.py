"""Chat formatting: cumulative snapshots are collapsed, then conversations rendered.

Loggers write a conversation again after every turn. A rolling hash is taken of
every prefix of every conversation: each turn is hashed with its position, role
and text, and the prefix hash is the running sum of those, in four lanes of 32
bits. A conversation whose whole hash is a proper prefix hash of another is a
snapshot of it, and an anti-join removes it; of conversations with equal turns the
smallest id stays. The maximal conversations are then rendered.

A long conversation does not sit in one task while hashes are made: its turns are
numbered by blocks of turn numbers, whose sizes and sums are added up first.

Defined cases: rows that are equal in id, turn, role and text count once; turns are
ordered by number (null first), then role, then text; null role and text are
rendered as empty; rows with a null id form one conversation; a conversation of empty
turns is kept like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layertables.llm.common import written

LANES = ("l0", "l1", "l2", "l3")
BLOCK_TURNS = 4096
# The markers around a turn.
BEGIN, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"


def _turns(df: DataFrame) -> DataFrame:
    rows = df.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.withColumn("h", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit("second"), "text", "role"))


def prefix_hashes(df: DataFrame) -> DataFrame:
    """``conv_id, turn, h, h2, position`` and the lanes of the hash of the prefix
    that ends there; one row for each distinct turn."""
    t = _turns(df).distinct()
    t = t.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    in_conv = Window.partitionBy("conv_id").orderBy("block")
    before = in_conv.rowsBetween(Window.unboundedPreceding, -1)
    sizes = t.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    sizes = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    t = t.withColumn("row", F.row_number().over(in_block)).drop("role", "text").join(sizes.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "base"), same)
    t = t.withColumn("position", F.col("base") + F.col("row")).drop("c", "b", "base", "row")
    one, two = F.xxhash64("position", "h", "h2"), F.xxhash64("h2", "position", "h")
    low = F.lit(0xFFFFFFFF)
    t = t.withColumns({"l0": one.bitwiseAND(low), "l1": F.shiftrightunsigned(one, 32), "l2": two.bitwiseAND(low), "l3": F.shiftrightunsigned(two, 32)})
    sums = t.groupBy("conv_id", "block").agg(*[F.sum(x).alias(x) for x in LANES])
    sums = sums.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_base") for x in LANES])
    running = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    t = t.join(sums, same)
    return t.select("conv_id", "turn", "h", "h2", "position", *[(F.col(f"{x}_base") + F.sum(x).over(running)).alias(x) for x in LANES])


def maximal(df: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies``: conversations that are no prefix of another, with
    the number of conversations that have just these turns."""
    p = written(prefix_hashes(df), "prefixes")
    # The last prefix of a conversation is the whole of it.
    whole = p.groupBy("conv_id").agg(F.max(F.struct("position", *LANES)).alias("w")).select("conv_id", "w.*")
    same = [F.col("conv_id").eqNullSafe(F.col("c")), F.col("position") < F.col("n")]
    ends = whole.select(F.col("conv_id").alias("c"), F.col("position").alias("n"))
    proper = p.join(ends, same).select("position", *LANES).distinct()
    groups = whole.groupBy("position", *LANES).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    return groups.join(proper, ["position", *LANES], "left_anti").select("conv_id", F.col("position").alias("n_turns"), "n_copies")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit(BREAK), text, F.lit(END))


def format_chats(df: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, text, answers``: every maximal conversation, and the
    places of the assistant's texts in it (code points, end exclusive), the part
    that a loss is taken of."""
    kept = maximal(df)
    turns = _turns(df).distinct().join(kept.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    # A conversation's text is one value, so its turns meet in one task: one sort by conversation serves
    # the running start of every turn and the lists.
    turns = turns.withColumn("part", _rendered(F.col("role"), F.col("text")))
    in_conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("part")).over(in_conv), F.lit(0)))
    head = F.col("start") + len(BEGIN) + F.length("role") + len(BREAK)
    turns = turns.withColumn("span", F.struct(head.cast("int").alias("start"), (head + F.length("text")).cast("int").alias("end")))
    conv = turns.groupBy("conv_id", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("start", "part"))).alias("parts"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.col("span")))).alias("answers"),
    )
    return conv.select("conv_id", "n_turns", "n_copies", F.array_join("parts.part", "").alias("text"), "answers")

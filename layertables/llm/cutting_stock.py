"""Packing by cutting stock: a linear program over patterns of lengths, with column generation.

Documents of up to a full sequence are stock items, counted by length; a histogram of
as many numbers as a sequence has tokens is all that the driver sees. Lengths are put into
at most :data:`CLASSES` classes, each as long as its longest member. A pattern says how many documents of
each class share a sequence, which is full length or a shorter power of two (that
needs no padding either). The linear program

    minimise  sum(cost of pattern * repeats),  every class used as often as it occurs

starts from one pattern a class. Its dual prices go into an unbounded knapsack, whose
dynamic program over all capacities yields the patterns that would improve it;
those enter the basis, until the bound from the prices says that less than
:data:`GAP` is to be gained (or for :data:`MAX_ROUNDS` rounds). Repeats are rounded down, what is left is packed best-fit, and
documents get their places by rank in their class.

Padding is avoided by cutting: the room that a sequence has left is filled by a *stream* of the
documents that are not packed whole: those longer than a sequence, the few that
rounding leaves over, and, where these are not enough, a share of all others, drawn
by hash. The stream goes through the rooms in order, then into full sequences, and at
its end into sequences of falling powers of two. So there is no padding, and only
documents of the stream are cut.

Places in the stream are prefix sums over blocks of rows. Documents and rooms meet in an
equi join on buckets of :data:`BUCKET` tokens, in which neither side can have more
than that many rows. Ranks come from counts by (class, salt), and the salt is drawn from the row, so
neither one length nor one repeated document is one task. The plan that reaches
tasks has a row for each (pattern, class), whatever the size of the table.

Defined cases: null text is the empty text (one piece holding the end id); equal rows
are all packed; a null id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches, text_or_empty, written
from layertables.llm.tokens import encoder

MAX_TOKENS = 4096
CLASSES = 256
LEAST_SIZE = 256  # the shortest sequence that a pattern may fill
SEQUENCE_COST = 64  # tokens that a sequence counts beside its own, against needless short ones
GAP = 0.0005
MAX_ROUNDS = 100
PULL = 0.8
SHARES = 1024  # steps of the share drawn into the stream
BUCKET = 1 << 16
SALTS = 64
SALTED_ROWS = 100_000
BLOCK_BITS = 12
ENCODED = "uid bigint, doc_id bigint, length bigint, ids_crc32 bigint, ids binary"
PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

Plan = list[tuple[dict[int, int], int, int]]  # ({class: copies}, size, repeats)


# --------------------------------------------------------------------------- classes


def length_classes(counts: np.ndarray, most: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, class_of)``: the longest length of every class, ascending, and the class of
    every length (-1 where none occurs). Class borders are dense where lengths are frequent
    (by the square root of their counts, which makes the loss from rounding up least)."""
    there = np.flatnonzero(counts)
    if len(there) <= most:
        last = there
    else:
        weight = np.cumsum(np.sqrt(counts[there]))
        step = np.minimum((weight / weight[-1] * most).astype(int), most - 1)
        last = there[np.concatenate([np.flatnonzero(np.diff(step)), [len(there) - 1]])]
    class_of = np.full(len(counts), -1, np.int64)
    class_of[there] = np.searchsorted(last, there)
    return last, class_of


# --------------------------------------------------------------------------- linear program


class Knapsack:
    """The best value of any collection of classes, for every capacity at once."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.lengths = lengths
        self.size = size
        self._fit = np.searchsorted(lengths, np.arange(size + 1), side="right")

    def price(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``best[c]`` and ``taken[c]``: the capacity at which that is reached (the rest is room
        left) and the class taken last there, as ``(capacity, class)``."""
        best = np.zeros(self.size + 1)
        taken = np.zeros((self.size + 1, 2), np.int64)
        for c in range(int(self.lengths[0]), self.size + 1):
            n = self._fit[c]
            got = best[c - self.lengths[:n]] + value[:n]
            k = int(got.argmax())
            if got[k] > best[c - 1]:
                best[c], taken[c] = got[k], (c, k)
            else:
                best[c], taken[c] = best[c - 1], taken[c - 1]
        return best, taken

    def collection(self, taken: np.ndarray, capacity: int) -> np.ndarray:
        out = np.zeros(len(self.lengths))
        c, k = taken[capacity]
        while c:
            out[k] += 1
            c, k = taken[c - self.lengths[k]]
        return out


def sizes_of(size: int, least: int = LEAST_SIZE) -> list[int]:
    """The lengths a sequence of a pattern may have: powers of two and the full one."""
    out, p = [size], 1
    while p < size:
        if p >= least:
            out.append(p)
        p *= 2
    return sorted(set(out))


def solve(lengths: np.ndarray, counts: np.ndarray, size: int, first: list[tuple[np.ndarray, int]] = ()) -> list[tuple[np.ndarray, int, float]]:
    """Column generation: ``(copies of every class, size, repeats)`` with real repeats that use
    every class exactly ``counts`` times, of cost within :data:`GAP` of the least. ``first`` are
    patterns to be tried before any is generated."""
    m = len(lengths)
    if not m:
        return []
    cost = {s: s + SEQUENCE_COST for s in sizes_of(size)}
    sack = Knapsack(lengths, size)
    # One pattern a class: as many copies as a full sequence holds.
    copies = size // lengths
    columns = [(np.eye(m)[k] * copies[k], size) for k in range(m)]
    inverse = np.diag(1.0 / copies)
    x = counts / copies
    price = np.array([cost[s] for _, s in columns], float)

    def enter(a: np.ndarray, s: int) -> bool:
        nonlocal inverse, x
        y = price @ inverse
        if y @ a <= cost[s] * (1 + 1e-9):
            return False
        d = inverse @ a
        up = np.flatnonzero(d > 1e-9)
        if not len(up):
            return False
        ratio = x[up] / d[up]
        r = up[int(ratio.argmin())]
        theta = max(x[r] / d[r], 0.0)
        x = np.maximum(x - theta * d, 0)
        x[r] = theta
        row = inverse[r] / d[r]
        inverse = inverse - np.outer(d, row)
        inverse[r] = row
        price[r] = cost[s]
        columns[r] = (a, s)
        return True

    for used, s, _ in [] if first else _best_fit(counts.astype(np.int64), lengths, size):
        a = np.zeros(m)
        a[list(used)] = list(used.values())
        enter(a, max(s, min(cost)))
    for a, s in first:
        enter(a, s)
    # Prices are drawn towards the best ones so far, or they swing from round to round. Prices
    # in proportion to length allow no pattern above its cost, and are nearly right.
    centre = lengths * min(c / s for s, c in cost.items())
    bound, pull = float(centre @ counts), PULL
    for _ in range(MAX_ROUNDS):
        total = float(price @ x)
        if total - bound <= GAP * total:
            break
        y = pull * centre + (1 - pull) * (price @ inverse)
        best, taken = sack.price(y)
        # No pattern is worth more than this many times its cost: a bound on the least cost from below.
        worth = max(1.0, *(best[s] / c for s, c in cost.items()))
        if y @ counts / worth > bound:
            centre, bound = y / worth, float(y @ counts / worth)
        offers = [(best[s] / c, s, -1) for s, c in cost.items()]
        offers += [((y[k] + best[size - lengths[k]]) / cost[size], size, k) for k in range(m)]
        went = 0
        for _, s, k in sorted(offers, reverse=True):
            a = sack.collection(taken, s if k < 0 else int(size - lengths[k]))
            if k >= 0:
                a[k] += 1
            went += enter(a, s)
        if not went:
            if not pull:
                break
            pull = 0.0
        else:
            pull = PULL
    return [(a, s, float(v)) for (a, s), v in zip(columns, x) if v > 1e-9]


# --------------------------------------------------------------------------- rounding


def rounded(solution: list[tuple[np.ndarray, int, float]], lengths: np.ndarray, counts: np.ndarray, size: int) -> Plan:
    """Whole repeats, none using more documents than there are, then best-fit for the rest."""
    left = counts.astype(np.int64).copy()
    plan: Plan = []
    for a, s, v in sorted(solution, key=lambda c: -c[2]):
        used = {int(k): int(a[k]) for k in np.flatnonzero(a)}
        r = min([int(v + 1e-6), *(int(left[k]) // n for k, n in used.items())])
        if r > 0:
            plan.append((used, s, r))
            for k, n in used.items():
                left[k] -= r * n
    return plan + _best_fit(left, lengths, size)


def _best_fit(left: np.ndarray, lengths: np.ndarray, size: int) -> Plan:
    """Always the longest document left, completed by the longest that fit."""
    left = left.copy()
    plan: Plan = []
    while left.any():
        used: dict[int, int] = {}
        room = size
        there = np.flatnonzero(left)
        for k in there[::-1]:
            n = min(int(left[k]), room // int(lengths[k]))
            if n:
                used[int(k)] = n
                room -= n * int(lengths[k])
        filled = size - room
        least = next(s for s in sizes_of(size, 1) if s >= filled)
        r = min(int(left[k]) // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= r * n
        plan.append((used, least, r))
    return plan


def trimmed(plan: Plan, lengths: np.ndarray, tokens: int) -> Plan:
    """The plan without as many of its emptiest sequences as it takes for all tokens there are to fill the rest."""
    over = sum(s * r for _, s, r in plan) - tokens
    loss = lambda p: 1 - sum(int(lengths[k]) * n for k, n in p[0].items()) / p[1]
    out = []
    for p in sorted(plan, key=loss, reverse=True):
        used, s, r = p
        if over > 0:
            gone = min(r, -(-over // s))
            over -= gone * s
            r -= gone
        if r:
            out.append((used, s, r))
    return out


def falling_powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


# --------------------------------------------------------------------------- Spark


def encoded(df: DataFrame, tokenizer_path: str, *, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """One row a document: a row number, the number of its ids, their checksum and the ids
    (two bytes each where all fit)."""
    small_batches(df.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def make():
        enc = encoder(tokenizer_path)

        def run(b: pa.RecordBatch) -> dict:
            got = [ids + tail for ids in enc.encode(b.column("text").to_pylist())]
            whole = np.frombuffer(b"".join(got), "<u4")
            lengths = np.array([len(x) // 4 for x in got], np.int64)
            ends = np.cumsum(lengths)
            kept = got
            if len(whole) and whole.max() < 1 << 16:
                short = whole.astype("<u2").tobytes()
                kept = [short[2 * (e - n) : 2 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
            return {"length": lengths.tolist(), "ids_crc32": list(map(zlib.crc32, got)), "ids": kept}

        return run

    docs = df.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    return map_rows(docs, make, ENCODED)


def _small(spark, **cols) -> DataFrame:
    return spark.createDataFrame(pa.table({k: pa.array(v, pa.int64()) for k, v in cols.items()}))


def _positions(df: DataFrame, block: list[str], order: list[str], size: str) -> DataFrame:
    """Adds ``at``: the sum of ``size`` over all rows before, ordered by ``block``, then ``order``."""
    sums = df.groupBy(*block).agg(F.sum(size).alias("n"))
    before = F.sum("n").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*block, F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum(size).over(Window.partitionBy(*block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)
    return df.withColumn("inside", inside).join(sums, block).withColumn("at", F.col("base") + F.col("inside")).drop("base", "inside", *block)


def _plan_for(whole: DataFrame, counts: np.ndarray, size: int, tokens: int):
    """The share of documents that goes into the stream, the classes and the plan."""
    lengths, class_of = length_classes(counts)
    by_class = np.bincount(class_of[class_of >= 0], counts[class_of >= 0], len(lengths)).astype(np.int64)
    solution = solve(lengths, by_class, size)
    short = int((counts * np.arange(len(counts))).sum())
    wanted = sum(s * v for _, s, v in solution)
    share = 0
    # Rooms take what is not packed whole; a share of all documents is drawn until that is enough.
    while wanted > tokens and share < SHARES // 2:
        rate = (wanted - short) / short  # room a token packed whole
        need = (rate - (tokens - short) / short) / (1 + rate)
        share = max(share + 4, int(np.ceil(need * SHARES)) + 2)
        n = np.zeros_like(by_class)
        for r in whole.filter(F.col("share") >= share).groupBy("length").count().collect():  # a row a length
            n[class_of[r["length"]]] += r["count"]
        by_class = n
        keep = n > 0
        lengths, by_class = lengths[keep], n[keep]
        moved = np.cumsum(keep) - 1
        class_of = np.where((class_of >= 0) & keep[class_of], moved[class_of], -1)
        solution = solve(lengths, by_class, size, [(a[keep], s) for a, s, _ in solution if not a[~keep].any()])
        wanted = sum(s * v for _, s, v in solution)
        tokens_left = float((by_class * lengths).sum())
        if wanted <= tokens or not tokens_left:
            break
    return share, lengths, class_of, trimmed(rounded(solution, lengths, by_class, size), lengths, tokens)


def pack(
    df: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row a piece."""
    spark = df.sparkSession
    docs = written(encoded(df, tokenizer_path, id_col=id_col, text_col=text_col, end_id=end_id), "stock")
    docs = docs.withColumn("share", F.pmod(F.xxhash64(F.lit("share"), "uid"), F.lit(SHARES)))
    counts, tokens = np.zeros(max_tokens + 1, np.int64), 0
    for r in docs.groupBy(F.least("length", F.lit(max_tokens + 1)).alias("n")).agg(F.count("*").alias("c"), F.sum("length").alias("t")).collect():
        tokens += r["t"]
        if r["n"] <= max_tokens:
            counts[r["n"]] = r["c"]
    fits = docs.filter(F.col("length") <= max_tokens)
    share, lengths, class_of, plan = _plan_for(fits, counts, max_tokens, tokens)

    rows: dict[str, list[int]] = {c: [] for c in ("class", "first", "total", "repeats", "sequence", "slot", "size")}
    taken = np.zeros(len(lengths), np.int64)
    sequences = 0
    for used, size, repeats in plan:
        slot = 0
        for k, n in sorted(used.items(), reverse=True):
            for c, v in zip(rows, (k, int(taken[k]), n * repeats, repeats, sequences, slot, size)):
                rows[c].append(v)
            taken[k] += n * repeats
            slot += n
        sequences += repeats
    plan_rows = _small(spark, **rows)

    # Rank in the class, by counts of (class, salt).
    slim = docs.select("uid", "doc_id", "length", "ids_crc32", "share")
    there = np.flatnonzero(class_of >= 0)
    classes = _small(spark, length=there.tolist(), **{"class": class_of[there].tolist()})
    salts = max(SALTS, int(counts.sum()) // len(lengths) // SALTED_ROWS + 1, int(counts.max()) // SALTED_ROWS + 1) if len(lengths) else 1
    ranked = slim.filter(F.col("share") >= share).join(classes, "length").withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)))
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = ranked.groupBy("class", "salt").agg(F.count("*").alias("n"))
    base = base.select("class", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    row = F.row_number().over(Window.partitionBy("class", "salt").orderBy("uid"))
    ranked = ranked.withColumn("row", row).join(base, ["class", "salt"]).withColumn("rank", F.col("base") + F.col("row") - 1)
    in_row = F.col("rank") - F.col("first")
    placed = ranked.join(plan_rows.withColumnRenamed("class", "c"), (F.col("class") == F.col("c")) & (in_row >= 0) & (in_row < F.col("total")), "left")
    placed = placed.select(
        "uid",
        "doc_id",
        "length",
        "ids_crc32",
        (F.col("sequence") + in_row % F.col("repeats")).alias("sequence_id"),
        (F.col("slot") + F.floor(in_row / F.col("repeats"))).alias("slot"),
        "size",
    )
    placed = written(placed, "placed")

    # Whole documents and the room that is left behind them.
    in_sequence = Window.partitionBy("sequence_id")
    upto = in_sequence.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.filter(F.col("sequence_id").isNotNull())
    whole = whole.withColumn("offset", F.sum("length").over(upto) - F.col("length")).withColumn("last", F.lead("slot").over(in_sequence.orderBy("slot")).isNull())
    whole = written(whole, "whole")
    rooms = whole.filter("last").select("sequence_id", (F.col("offset") + F.col("length")).alias("offset"), "size")
    rooms = rooms.withColumn("room", F.col("size") - F.col("offset")).drop("size").filter("room > 0")

    # The stream: its documents and, behind the rooms, sequences of its own.
    over = written(placed.filter(F.col("sequence_id").isNull()).select("uid", "doc_id", "length"), "left_over")
    apart = (F.col("length") > max_tokens) | (F.col("share") < share)
    long = F.col("length") > max_tokens
    stream = docs.filter(apart).select("uid", "doc_id", "length").unionByName(over)
    stream = stream.withColumn("last", long.cast("int")).withColumn("block", F.shiftright("uid", BLOCK_BITS))
    stream = written(_positions(stream, ["last", "block"], ["uid"], "length"), "stream")
    rooms = written(_positions(rooms.withColumn("block", F.shiftright("sequence_id", BLOCK_BITS)), ["block"], ["sequence_id"], "room"), "rooms")
    filled = rooms.agg(F.coalesce(F.sum("room"), F.lit(0)).alias("n")).collect()[0]["n"]
    flow = stream.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).collect()[0]["n"]
    full, rest = divmod(flow - filled, max_tokens)
    own = spark.range(full).select(
        (F.col("id") + sequences).alias("sequence_id"), F.lit(0).alias("offset"), F.lit(max_tokens).alias("room"), (F.col("id") * max_tokens + filled).alias("at")
    )
    ends = falling_powers(rest)
    at = [flow - rest + sum(ends[:k]) for k in range(len(ends))]
    own = own.unionByName(_small(spark, sequence_id=[sequences + full + k for k in range(len(ends))], offset=[0] * len(ends), room=ends, at=at))
    rooms = rooms.select("sequence_id", "offset", "room", F.col("at").alias("from")).unionByName(own.withColumnRenamed("at", "from"))

    def dealt(x: DataFrame, at: str, n: str) -> DataFrame:
        last = F.floor((F.col(at) + F.col(n) - 1) / BUCKET)
        return x.withColumn("bucket", F.explode(F.sequence(F.floor(F.col(at) / BUCKET), last)))

    low = F.greatest("at", "from")
    high = F.least(F.col("at") + F.col("length"), F.col("from") + F.col("room"))
    cuts = dealt(stream, "at", "length").join(dealt(rooms, "from", "room"), "bucket").filter((low < high) & (F.floor(low / BUCKET) == F.col("bucket")))
    cut = F.struct((low - F.col("at")).alias("start"), (high - low).alias("length"), "sequence_id", (F.col("offset") + low - F.col("from")).alias("offset"))
    cuts = cuts.select("uid", cut.alias("cut")).groupBy("uid").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    ids = docs.filter(apart).select("uid", "doc_id", "length", "ids").unionByName(
        docs.filter(~apart).join(over.select("uid"), "uid", "left_semi").select("uid", "doc_id", "length", "ids")
    )

    def make():
        def run(b: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in PIECES}
            for doc_id, n, ids, parts in zip(*[b.column(c).to_pylist() for c in ("doc_id", "length", "ids", "cuts")]):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                for p in parts:
                    s, k = p["start"], p["length"]
                    for c, v in zip(PIECES, (doc_id, s, k, zlib.crc32(ids[s : s + k].tobytes()), n, p["sequence_id"], p["offset"])):
                        out[c].append(v)
            return out

        return run

    pieces = map_rows(ids.join(cuts, "uid").select("doc_id", "length", "ids", "cuts"), make, ", ".join(f"{c} bigint" for c in PIECES))
    whole = whole.withColumns({"start": F.lit(0).cast("bigint"), "doc_tokens": F.col("length")}).select(*PIECES)
    return whole.unionByName(pieces)

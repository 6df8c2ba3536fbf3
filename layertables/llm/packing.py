"""Best-fit packing of token pieces into sequences, by patterns of lengths.

The plan needs the histogram of piece lengths alone (as many numbers as a
sequence has tokens). Patterns are the ways of filling a sequence exactly with
one, two or three pieces; a non-negative least-squares fit finds how often each
is repeated so that the lengths used match the histogram. The repeats are
rounded, and what is left over is packed best-fit: always the longest piece
left, completed exactly by one or two others where such are left, else by the
longest that fits, again repeated as often as the histogram allows.

A piece gets its place by an equi join on (length, rank among pieces of that
length). Ranks come from counts by (length, salt), so a length that a third of
all pieces share is spread over many tasks.

Defined cases: null text is the empty text (one piece holding the end id); equal
rows are all packed; a null id is kept as null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches, text_or_empty, written
from layertables.llm.tokens import encoder

MAX_TOKENS = 2048
FIT_STEPS = 150
# Part of the fitted repeats that is used; the rest leaves short pieces for the
# best-fit pass, which otherwise ends with long ones alone in a sequence.
FIT_SHARE = 0.9
SALTS = 64
SALTED_ROWS = 100_000
# Repeats of a pattern that one row of the plan stands for.
PLAN_REPEATS = 100_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(df: DataFrame, tokenizer_path: str, *, id_col="doc_id", text_col="text", end_id=0, max_tokens=MAX_TOKENS) -> DataFrame:
    """One row a piece. Only documents over ``max_tokens`` ids are cut; then the
    first piece takes the remainder and all others are full."""
    small_batches(df.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def make():
        enc = encoder(tokenizer_path)

        def run(b: pa.RecordBatch) -> dict:
            out: list[tuple] = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist())):
                ids += tail
                n = len(ids) // 4
                ends = range((n - 1) % max_tokens + 1, n + 1, max_tokens)
                start = 0
                for k, end in enumerate(ends):
                    out.append((doc_id, k, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                    start = end
            return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), map(list, zip(*out)))) if out else {
                c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")
            }

        return run

    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_rows(docs, make, PIECES)


def patterns_of(counts: np.ndarray, size: int) -> np.ndarray:
    """Rows ``(a, b, c)`` with ``a <= b <= c`` and ``a + b + c = size``, 0 for no
    piece, using only lengths that occur."""
    there = counts > 0
    a = np.flatnonzero(there)
    a = np.concatenate([[0], a[a <= size]])
    rows = []
    for x in a:
        b = a[(a >= x) & (2 * a <= size - x)]
        c = size - x - b
        ok = (c >= b) & there[c]
        rows.append(np.stack([np.full(ok.sum(), x), b[ok], c[ok]], 1))
    return np.concatenate(rows).astype(np.int64) if rows else np.zeros((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative least squares, ``min |A x - counts|`` with ``x >= 0``, by
    accelerated projected gradient. ``A[length, pattern]`` is how often the
    pattern holds the length; it is never built."""
    n = len(counts)
    cols = [patterns[:, k] for k in range(3)]

    def used(x):
        y = sum(np.bincount(c, x, n) for c in cols)
        y[0] = 0
        return y

    def back(r):
        r[0] = 0
        return r[cols[0]] + r[cols[1]] + r[cols[2]]

    v = np.ones(len(patterns))
    for _ in range(12):  # largest eigenvalue of A'A
        v = back(used(v))
        top = np.linalg.norm(v)
        v /= top
    x = np.zeros(len(patterns))
    z, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(z - back(used(z) - counts) / top, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan_patterns(counts: np.ndarray, size: int = MAX_TOKENS) -> list[tuple[list[int], int]]:
    """``(lengths, repeats)`` covering ``counts[length]`` pieces exactly."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[list[int], int]] = []
    patterns = patterns_of(left, size)
    if len(patterns):
        x = fit_repeats(patterns, left.astype(float))
        repeats = np.diff(np.floor(np.cumsum(x * FIT_SHARE) + 0.5), prepend=0).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            r = int(repeats[k])
            if r <= 0:
                break
            lengths = [int(v) for v in patterns[k] if v]
            r = min([r, *(int(left[v]) // lengths.count(v) for v in lengths)])
            if r:
                plan.append((lengths, r))
                for v in lengths:
                    left[v] -= r
    return plan + _residual(left, size)


def _residual(left: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    plan = []
    top = len(left) - 1
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return plan
        lengths, room = [top], size - top
        left[top] -= 1
        while room:
            there = np.flatnonzero(left[1 : room + 1]) + 1
            if not len(there):
                break
            pair = there[(left[room - there] > 0) & ((room - there != there) | (left[there] > 1))] if there[-1] != room else []
            if there[-1] == room or not len(pair):
                v = int(there[-1])
                k = min(room // v, int(left[v]))
                lengths += [v] * k
                left[v] -= k
                room -= v * k
            else:
                v = int(pair[-1])
                lengths += [v, room - v]
                left[v] -= 1
                left[room - v] -= 1
                room = 0
        more = min(int(left[v]) // lengths.count(v) for v in set(lengths))
        for v in set(lengths):
            left[v] -= more * lengths.count(v)
        plan.append((lengths, 1 + more))


def _salted(pieces: DataFrame, salts: int) -> DataFrame:
    return pieces.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)))


def pack(df: DataFrame, tokenizer_path: str, *, max_tokens: int = MAX_TOKENS, end_id: int = 0, **cols) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = df.sparkSession
    cut = cut_pieces(df, tokenizer_path, max_tokens=max_tokens, end_id=end_id, **cols)
    # A number of its own for every row, fixed once it is written: equal rows are told apart by it.
    pieces = written(cut.withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    # At most max_tokens rows reach the driver.
    counts = np.zeros(max_tokens + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    slots: dict[str, list[int]] = {"length": [], "first": [], "repeats": [], "sequence": [], "offset": []}
    taken = np.zeros(max_tokens + 1, np.int64)
    sequence = 0
    for lengths, repeats in plan_patterns(counts, max_tokens):
        at = 0
        for v in lengths:
            for k in range(0, repeats, PLAN_REPEATS):
                for name, value in zip(slots, (v, int(taken[v]) + k, min(PLAN_REPEATS, repeats - k), sequence + k, at)):
                    slots[name].append(value)
            taken[v] += repeats
            at += v
        sequence += repeats
    places = spark.createDataFrame(pa.table({k: pa.array(v, pa.int64()) for k, v in slots.items()}))
    step = F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)).alias("k")
    places = places.select("length", "first", "sequence", "offset", step).select(
        "length", (F.col("first") + F.col("k")).alias("rank"), (F.col("sequence") + F.col("k")).alias("sequence_id"), "offset"
    )
    # As many salts as keep a task's share of the commonest length bounded.
    salted = _salted(pieces, max(SALTS, int(counts.max()) // SALTED_ROWS + 1))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = base.select("length", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    row = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row_id"))
    ranked = salted.withColumn("row", row).join(base, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("row") - 1)
    # Spark takes the places for a table of the plan's size; they are as many as the pieces, so never broadcast.
    return ranked.join(places.hint("merge"), ["length", "rank"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )

"""Periodic runs in texts: stretches of words that repeat with a period.

A run is a stretch with smallest period ``q`` and length at least
``max(MIN_LENGTH, 2 q)`` that neither neighbour extends. All runs are found, in
time near the number of words, by two means:

* **short periods**, below :data:`LAG_PERIODS`, by direct lag scans: words are
  compared with those ``q`` places on, and stretches of equal ones are read off;
* **long periods** by minimizers of many scales. Scale ``w`` (a power of two)
  serves the periods ``2w <= q < 4w``. The blocks of ``w`` words are hashed, and a
  place is selected if its block is the least of some ``w`` neighbouring ones. A
  run of period ``q`` holds a stretch of neighbours and, ``q`` places on, its copy, so
  a selected place and its equal ``q`` places on are both there: the equal pair at
  distance ``q`` is the seed. Seeds are extended to both sides by comparing words.

Where blocks overlap their own copies (a stretch with a period below ``w``), equal
selected places follow each other at one distance; such a progression is one
object. Two of them give one seed for every distance between their members instead of one
for every pair; a pair inside one progression never has a smallest period.

A whole batch of texts is one array of word numbers, with a number of its own
between texts, so numpy works on thousands of texts at once. Scale ``w`` only
looks at texts of at least ``4 w`` words. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches

MIN_LENGTH = 12
LAG_PERIODS = 16  # a power of two; the first scale is half of it
GROUP_WORDS = 1 << 18  # words worked on at once; a longer text is a group of its own

RUNS = "doc_id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed binary"
DIGEST = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _stretches(at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of the stretches of consecutive numbers in ``at`` of size ``least`` or more."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1)
    first = np.concatenate([[0], cut + 1])
    size = np.concatenate([cut + 1, [len(at)]]) - first
    ok = size >= least
    return at[first[ok]], size[ok]


def _lag_scans(a: np.ndarray, below: int) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, min(below, len(a))):
        begin, size = _stretches(np.flatnonzero(a[q:] == a[:-q]), max(MIN_LENGTH - q, q))
        out += [(int(s), int(s + m + q), q) for s, m in zip(begin, size)]
    return out


def _sliding(v: np.ndarray, w: int, op) -> np.ndarray:
    step = 1
    while step < w:
        v = op(v[:-step], v[step:])
        step *= 2
    return v


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (fixed values: the
    multipliers of a published finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, w: int) -> np.ndarray:
    """Hashes of blocks of ``2w`` words from those of ``w`` words."""
    return _mix(h[:-w] * np.uint64(0x9E3779B97F4A7C15) + h[w:])


def _progressions(key: np.ndarray, at: np.ndarray, w: int):
    """Equal keys at one distance below ``w``: key, first place, step, members. ``key``
    is sorted, and ``at`` ascends where keys are equal."""
    n = len(at)
    gap = np.zeros(n, np.int64)  # to the place before, 0 for a new key or a far one
    near = (key[1:] == key[:-1]) & (at[1:] - at[:-1] < w)
    gap[1:][near] = (at[1:] - at[:-1])[near]
    # A place goes on with a progression whose step it keeps; the second member sets it.
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    head = np.ones(n, bool)
    block_first = np.concatenate([[0], change])
    block_size = np.diff(np.concatenate([block_first, [n]]))
    for f, m in zip(block_first[gap[block_first] > 0], block_size[gap[block_first] > 0]):
        # Places f .. f+m-1 each lie the same step behind the one before them. The one
        # before begins the progression, unless it ends another; then f does.
        begin = f if not head[f - 1] else f - 1
        head[begin + 1 : f + m] = False
    first = np.flatnonzero(head)
    size = np.diff(np.concatenate([first, [n]]))
    step = np.where(size > 1, gap[np.minimum(first + 1, n - 1)], 0)
    return key[first], at[first], step, size


def _seeds(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``p`` and distances ``q`` (``2w <= q < 4w``) whose blocks are equal and selected."""
    none = np.zeros(0, np.int64)
    if len(h) < w + 1:
        return none, none
    least = _sliding(h, w, np.minimum)
    # The greatest of the minima of all neighbourhoods that hold a place.
    best = np.concatenate([np.full(w - 1, 0, np.uint64), least, np.full(w - 1, 0, np.uint64)])
    at = np.flatnonzero(_sliding(best, w, np.maximum) == h)
    order = np.argsort(h[at], kind="stable")
    at = at[order]
    key = h[at]
    # Keys that occur once have no pair.
    twice = np.zeros(len(key), bool)
    same = key[1:] == key[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    if not twice.any():
        return none, none
    key, first, step, size = _progressions(key[twice], at[twice], w)
    last = first + step * (size - 1)
    ps, qs = [], []
    shift = 0
    while True:
        shift += 1
        k = np.flatnonzero((key[shift:] == key[:-shift]) & (first[shift:] - last[:-shift] < 4 * w)) if shift < len(key) else none
        if not len(k):
            break
        j = k + shift
        # Steps differ: the members of the first are taken one by one.
        odd = (step[k] != step[j]) & (size[k] > 1) & (size[j] > 1)
        parts = [(first[k[~odd]], step[k[~odd]], size[k[~odd]], j[~odd])]
        if odd.any():
            ko, jo = k[odd], j[odd]
            member = np.arange(size[ko].sum()) - np.repeat(np.cumsum(size[ko]) - size[ko], size[ko])
            each = np.repeat(first[ko], size[ko]) + member * np.repeat(step[ko], size[ko])
            parts.append((each, np.zeros(len(each), np.int64), np.ones(len(each), np.int64), np.repeat(jo, size[ko])))
        for a0, r, m, b in parts:
            r = np.where(m > 1, r, step[b])  # the common step, 0 for two single places
            low = first[b] - (a0 + r * (m - 1))
            n = m + size[b] - 1
            # Members t of low + r t inside [2w, 4w).
            by = np.maximum(r, 1)
            t0 = np.maximum(0, -((low - 2 * w) // by))
            t1 = np.minimum(n - 1, (4 * w - 1 - low) // by)
            t0 = np.where(r == 0, np.where(low >= 2 * w, 0, 1), t0)
            t1 = np.where(r == 0, 0, t1)
            num = np.maximum(t1 - t0 + 1, 0)
            row = np.repeat(np.arange(len(num)), num)
            t = np.arange(num.sum()) - np.repeat(np.cumsum(num) - num, num) + t0[row]
            on_b = np.minimum(t, size[b][row] - 1)
            i = m[row] - 1 - (t - on_b)
            ps.append(a0[row] + i * r[row])
            qs.append(low[row] + t * r[row])
    return (np.concatenate(ps), np.concatenate(qs)) if ps else (none, none)


def _reach(x: np.ndarray, y: np.ndarray) -> int:
    """Number of equal leading elements, looked at in growing parts."""
    n, at, part = len(x), 0, 16
    while at < n:
        differ = x[at : at + part] != y[at : at + part]
        if differ.any():
            return at + int(differ.argmax())
        at += part
        part *= 2
    return n


def _extended(a: np.ndarray, p: np.ndarray, q: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The stretches of period ``q`` round the seeds, of at least ``2 q`` words."""
    out = []
    order = np.lexsort((p, q))
    done_q, done_to = -1, -1
    for s, d in zip(p[order].tolist(), q[order].tolist()):
        if d == done_q and s < done_to:
            continue  # inside the stretch just seen
        right = s + _reach(a[s : len(a) - d], a[s + d :])
        left = s - _reach(a[:s][::-1], a[d : s + d][::-1])
        done_q, done_to = d, right
        if right - left >= max(d, least - d):
            out.append((left, right + d, d))
    return out


def _prime_factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


def _primitive(a: np.ndarray, s: int, e: int, q: int) -> bool:
    """No shorter period: that would divide ``q``, as the stretch has two periods."""
    return not any(np.array_equal(a[s : e - q // f], a[s + q // f : e]) for f in _prime_factors(q))


def find_runs(a: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of an array of texts laid end to end, each
    followed by a number that occurs nowhere else. ``lengths`` are the texts' words."""
    found = _lag_scans(a, LAG_PERIODS)
    spans = np.cumsum(lengths + 1)
    starts = spans - lengths - 1
    w = LAG_PERIODS // 2
    h, have = None, 0
    at = np.arange(len(a))
    while True:
        long = lengths >= 4 * w
        if not long.any():
            break
        if h is None or long.sum() < have:  # shorter texts have no period of this scale
            have = long.sum()
            keep = np.concatenate([np.arange(s, s + n + 1) for s, n in zip(starts[long], lengths[long])])
            at, b = keep, a[keep]
            h, size = _mix(b.astype(np.uint64) + np.uint64(1)), 1
        while size < w:
            h, size = _doubled(h, size), size * 2
        p, q = _seeds(h, w)
        if len(p):
            got = _extended(b, p, q, MIN_LENGTH)
            found += [(int(at[s]), int(at[s]) + e - s, d) for s, e, d in got]
        w *= 2
    return sorted({r for r in found if _primitive(a, *r)})


def tail_repeats(words: list[bytes], doc_id) -> list[bytes]:
    """The stated change of every tenth document: from a place on, its words repeat."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    reps = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * reps)[: n - a]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of every text, by start, then period."""
    number: dict = defaultdict(count().__next__)
    of = number.__getitem__
    out: list[list] = [[] for _ in texts]
    group: list[int] = []
    total = 0

    def work():
        sizes = np.array([len(texts[k]) for k in group], np.int64)
        parts = []
        for k in group:
            parts.append(np.fromiter(map(of, texts[k]), np.int64, len(texts[k])))
            parts.append(np.array([-1]))
        a = np.concatenate(parts)
        ends = np.cumsum(sizes + 1)
        a[ends - 1] = -1 - np.arange(len(group))
        for s, e, q in find_runs(a, sizes):
            k = int(np.searchsorted(ends, s, side="right"))
            out[group[k]].append((s - int(ends[k] - sizes[k] - 1), e - s, q))

    for k, words in enumerate(texts):
        if len(words) < MIN_LENGTH:
            continue
        if group and total + len(words) > GROUP_WORDS:
            work()
            number.clear()
            group, total = [], 0
        group.append(k)
        total += len(words) + 1
    if group:
        work()
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text without what a run repeats: a word goes if some run holds it after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))


def detect(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prepare=None) -> DataFrame:
    """``doc_id, n_words, starts, lengths, periods, collapsed``: the runs of every text, by
    start, then period, and the text with every run cut to its first period (UTF-8).

    Words are what lies between ASCII white space. ``prepare(words, doc_id)``, if
    given, changes the words of a text before they are looked at.

    Defined cases: null text has no words; texts of fewer than twelve words have no
    run; equal rows each get their row; a null id is kept (and is the empty text for
    ``prepare``); an empty table gives no rows; other columns are not read."""

    def make():
        def run(b: pa.RecordBatch) -> dict:
            words = [t.split() for t in b.column("text").to_pylist()]
            if prepare is not None:
                words = [prepare(t, d) for t, d in zip(words, b.column("doc_id").to_pylist())]
            runs = runs_of(words)
            return {
                "n_words": [len(t) for t in words],
                "starts": [[r[0] for r in rs] for rs in runs],
                "lengths": [[r[1] for r in rs] for rs in runs],
                "periods": [[r[2] for r in rs] for rs in runs],
                "collapsed": [collapse(t, rs) for t, rs in zip(words, runs)],
            }

        return run

    return map_rows(_documents(df, id_col, text_col), make, RUNS)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run (ties: least start, then period) and hashes of what :func:`detect` found."""

    def make():
        def run(b: pa.RecordBatch) -> dict:
            cols = [b.column(c).to_pylist() for c in ("starts", "lengths", "periods")]
            runs = [list(zip(*c)) for c in zip(*cols)]
            top = [max(rs, key=lambda r: (r[1], -r[0], -r[2])) if rs else (None, None, None) for rs in runs]
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in rs).encode() for rs in runs]
            return {
                "n_runs": [len(rs) for rs in runs],
                "start": [t[0] for t in top],
                "length": [t[1] for t in top],
                "period": [t[2] for t in top],
                "exponent_milli": [t[1] and 1000 * t[1] // t[2] for t in top],
                "runs_sha256": [hashlib.sha256(x).hexdigest() for x in lines],
                "collapsed_sha256": [hashlib.sha256(x).hexdigest() for x in b.column("collapsed").to_pylist()],
            }

        return run

    return map_rows(found, make, DIGEST)

"""Benchmark decontamination by the q-gram lemma.

A passage within ``k`` edits of an item of ``n`` characters shares at least
``n + 1 - q (k + 1)`` q-grams with it, all on diagonals (place in the text minus
place in the item) that lie at most ``k`` apart. Shared q-grams are counted in
overlapping bands of diagonals, each ``step + k`` wide and starting every ``step``
diagonals, so that any ``k + 1`` neighbouring diagonals lie in one band. Bands that
reach the bound are regions; a region is verified by a banded alignment of the
whole item against it (free ends in the text), and counts if it has ``k`` edits or
fewer. ``k`` is a tenth of the item's length, or less where the bound would not be
positive; an item shorter than ``q`` must occur as it is.

Texts and items are compared lower-cased, with each run of white space as one
space. The benchmark is read in blocks of at most ``BLOCK_CHARS`` characters (or one
item), each a pass over all documents; so what a task holds of it is bounded,
and no document is ever shuffled. A text that shares more than ``MATCHES`` q-grams with
the block (a stock phrase of many items, many times) is compared with parts of the items,
and with a single item in overlapping stretches of the text: a band lies in one of them as a whole.

Defined cases: null and empty texts and items match nothing; items with equal
text all count; ids may be null or repeated; other columns pass through
:func:`reject_contaminated` untouched; an empty benchmark rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches, text_or_empty

Q = 8
EDIT_SHARE = 0.1
BLOCK_CHARS = 2_000_000
TABLE_BITS = 22
# Characters of text that one pass of the filter looks at.
PASS_CHARS = 1 << 21
# Shared q-grams, pairs of a place in the text and one in an item, that are counted at once.
MATCHES = 1 << 22


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def edit_budget(n: int, q: int = Q, share: float = EDIT_SHARE) -> int:
    """The most edits that still leave the lemma a positive bound."""
    return min(int(n * share), (n - q) // q) if n >= q else 0


def _bytes(text: str) -> np.ndarray:
    """One byte a character; equal characters have equal bytes."""
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (u ^ u >> np.uint32(8) ^ u >> np.uint32(16)).astype(np.uint8)


def _grams(b: np.ndarray) -> np.ndarray:
    """The 8-gram that begins at every place, as a 64-bit number."""
    if len(b) < Q:
        return np.zeros(0, np.uint64)
    two = b[:-1].astype(np.uint16) | b[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    return four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << np.uint64(32)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)


def banded_edits(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int] | None:
    """Least edits, up to ``k``, of the whole item against some part of ``text``,
    over cells whose diagonal (text place minus item place) is in
    ``low..high``; and the end of that part."""
    n, m = len(item), len(text)
    width = high - low + 1
    far = n + m + 1
    steps = np.arange(width)
    padded = np.full(m + 2 * width + n + 2, -1, np.int64)
    shift = width + max(0, -low) + n + 1
    padded = np.full(shift + max(m, n + high + 1) + width + 2, -1, np.int64)
    padded[shift : shift + m] = text
    at = low + steps  # text places of row 0
    row = np.where((at >= 0) & (at <= m), 0, far)
    for i in range(1, n + 1):
        at = i + low + steps
        chars = padded[shift + i + low - 1 : shift + i + low - 1 + width]
        best = np.minimum(row + (chars != item[i - 1]), np.append(row[1:], far) + 1)
        best[(at < 0) | (at > m)] = far
        best[at == 0] = np.minimum(best[at == 0], i)
        row = np.minimum.accumulate(best - steps) + steps
        row[(at < 0) | (at > m)] = far
        if row.min() > k:
            return None
    j = int(row.argmin())
    return (int(row[j]), n + low + j) if row[j] <= k else None


class Block:
    """Some benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [normalise(t or "") for _, t in items]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([edit_budget(n) for n in self.sizes], np.int64)
        self.bound = self.sizes + 1 - Q * (self.budget + 1)
        self.short = [k for k, n in enumerate(self.sizes) if 0 < n < Q]
        # Bands: steps are powers of two above the budget.
        self.step = np.array([1 << int(k).bit_length() for k in self.budget], np.int64)
        grams = [_grams(_bytes(t)) for t in self.texts]
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.grams, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        # Rows are in order of (q-gram, item).
        self.rank = np.repeat(np.arange(len(self.grams)), self.count) * len(grams) + self.item
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[_slot(self.grams)] = True
        self.codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in self.texts]

    def regions(self, text: str) -> list[tuple[int, int]]:
        """``(item, band)`` whose count of shared q-grams reaches the bound."""
        b = _bytes(text)
        places, grams = [], []
        for at in range(0, max(0, len(b) - Q + 1), PASS_CHARS):
            g = _grams(b[at : at + PASS_CHARS + Q - 1])
            here = np.flatnonzero(self.table[_slot(g)])
            places.append(here + at)
            grams.append(g[here])
        if not sum(map(len, places)) or not len(self.grams):
            return []
        here, g = np.concatenate(places), np.concatenate(grams)
        k = np.searchsorted(self.grams, g)
        k[k == len(self.grams)] = 0
        same = self.grams[k] == g
        here, k = here[same], k[same]
        found: set[tuple[int, int]] = set()
        self._search(here, k, 0, len(self.sizes), found)
        return sorted(found)

    def _search(self, here: np.ndarray, k: np.ndarray, a: int, z: int, found: set[tuple[int, int]]) -> None:
        """Bands of the items ``a..z-1``, from the q-grams ``k`` at the places ``here`` of the text."""
        items = len(self.sizes)
        if z - a == items:
            low, n = self.first[k], self.count[k]
        else:
            low = np.searchsorted(self.rank, k * items + a)
            n = np.searchsorted(self.rank, k * items + z) - low
            here, k, low, n = (x[n > 0] for x in (here, k, low, n))
        before = np.concatenate([[0], np.cumsum(n)])
        if before[-1] <= MATCHES:
            found.update(self._bands(here, low, n))
        elif z - a > 1:
            for part in ((a, (a + z) // 2), ((a + z) // 2, z)):
                self._search(here, k, *part, found)
        else:
            # No band of the item spans as many places of the text.
            reach = int(self.sizes[a] + 2 * (self.step[a] + self.budget[a])) + Q
            i = j = 0
            while j < len(here):
                j = max(np.searchsorted(before, before[i] + MATCHES, "right") - 1, np.searchsorted(here, here[i] + 2 * reach))
                found.update(self._bands(here[i:j], low[i:j], n[i:j]))
                if j < len(here):
                    i = np.searchsorted(here, here[j] - reach)

    def _bands(self, here: np.ndarray, low: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
        row = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = self.item[row]
        # An item whose shared q-grams miss the bound has no band that meets it.
        enough = (np.bincount(item, minlength=len(self.sizes)) >= self.bound)[item]
        if not enough.any():
            return []
        item, row, here = item[enough], row[enough], np.repeat(here, n)[enough]
        diagonal = here - self.place[row]
        step = self.step[item]
        band = diagonal // step
        over = diagonal - band * step < self.budget[item]
        # Band b covers diagonals b*step .. (b+1)*step + budget - 1.
        key = np.concatenate([item << 40 | band + (1 << 39), item[over] << 40 | band[over] - 1 + (1 << 39)])
        key, of, count = np.unique(key, return_inverse=True, return_counts=True)
        item, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 39)
        ok = count >= self.bound[item]
        # The shared q-grams of the lemma have places of their own in the text and in the item.
        kept = ok[of]
        for place in (here, self.place[row]):
            place = np.concatenate([place, place[over]])[kept]
            pairs = np.unique(of[kept] * (1 << 40) + place) >> 40
            ok &= np.bincount(pairs, minlength=len(key)) >= self.bound[item]
        return list(zip(item[ok].tolist(), band[ok].tolist()))

    def hits(self, text: str) -> list[tuple[int, int, int]]:
        """``(item id, edits, end)``: the best verified region of every item found,
        ``end`` its end in the normalised text."""
        text = normalise(text)
        best: dict[int, tuple[int, int]] = {}
        codes = None
        for item in self.short:
            at = text.find(self.texts[item])
            if at >= 0:
                best[item] = (0, at + int(self.sizes[item]))
        for item, band in self.regions(text):
            if best.get(item, (1,))[0] == 0:
                continue
            k, step, n = int(self.budget[item]), int(self.step[item]), int(self.sizes[item])
            low, high = band * step - k, (band + 1) * step + 2 * k
            a, e = max(0, low), min(len(text), high + n + 1)
            exact = text.find(self.texts[item], a, e)
            if exact >= 0:
                best[item] = (0, exact + n)
                continue
            if codes is None:
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            got = banded_edits(self.codes[item], codes[a:e], low - a, high - a, k)
            if got and (item not in best or got[0] < best[item][0]):
                best[item] = (got[0], got[1] + a)
        return [(self.ids[i], d, end) for i, (d, end) in sorted(best.items())]


def blocks(benchmark: DataFrame, *, id_col="item_id", text_col="text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in order of id, so many characters at a time."""
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("i"), text_or_empty(text_col).alias("t")).filter("t <> ''")
    part: list[tuple[int, str]] = []
    size = 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        if part and size + len(r["t"]) > block_chars:
            yield part
            part, size = [], 0
        part.append((r["i"], r["t"]))
        size += len(r["t"])
    if part:
        yield part


def find(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, edits, end_at``: one row for every document and item found in it."""
    small_batches(df.sparkSession)
    schema = "doc_id bigint, item_id bigint, edits int, end_at int"
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    out = df.sparkSession.createDataFrame([], schema)
    for part in blocks(benchmark):
        shared = df.sparkSession.sparkContext.broadcast(part)  # BLOCK_CHARS characters

        def make(shared=shared):
            block = Block(shared.value)

            def run(b: pa.RecordBatch) -> dict:
                got = []
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    got += [(doc_id, *h) for h in block.hits(text)]
                cols = list(zip(*got)) or [()] * 4
                return dict(zip(("doc_id", "item_id", "edits", "end_at"), map(list, cols)))

            return run

        out = out.unionByName(map_rows(rows, make, schema))
    return out


def reject_contaminated(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that hold no benchmark item."""
    small_batches(df.sparkSession)
    at = df.columns.index(text_col)
    for part in blocks(benchmark):
        shared = df.sparkSession.sparkContext.broadcast(part)

        def run(batches, shared=shared):
            block = Block(shared.value)
            for b in batches:
                yield b.filter(pa.array([not block.hits(t or "") for t in b.column(at).to_pylist()], pa.bool_()))

        df = df.mapInArrow(run, df.schema)
    return df

"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built of labelled text. A document is
parsed with each automaton into the longest phrases that occur in the training
text; the language that needs the fewest bits, phrases times ``log2`` of its
training length over the document's length, wins (ties: the smaller name).

Letters are lower-cased, everything else counts as one space between words. The
walk reads the automaton as a table of transitions. A missing transition ends a
phrase and starts the next one at the same character, so a step is one lookup,
and one numpy operation steps through many stretches of text at once. A document
is parsed in stretches of ``STRETCH`` characters (the end of one ends a phrase).

Languages of up to ``DENSE_LETTERS`` letters share a full table; for one of more letters (Chinese,
say) transitions are a sorted list, searched for many stretches at once, so that memory grows with
the training text and not with states times letters.

The automata are fitted on a bounded sample of labelled rows: for every language
the rows with the smallest hash of their id, one a id and the first ``2 TRAIN_CHARS`` characters
of each, until ``TRAIN_CHARS`` characters.

Defined cases: null text, or a text without a letter (a character of Unicode category L):
``und``, score 0; rows with null lang are not learned from; of rows that share an id the least text
is learned from; without any labelled text all are ``und``; other columns are ignored; equal rows
get equal answers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import crc_of_id, map_rows, small_batches, text_or_empty

TRAIN_CHARS = 40_000
TRAIN_DOCS = 60
STRETCH = 512
LANES = 1 << 15
DENSE_LETTERS = 256
NOT_LETTER = regex.compile(r"\P{L}+")
UND = "und"


class SuffixAutomaton:
    """States and transitions of the smallest automaton of all substrings."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[cur] = clone
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
            last = cur

    def phrases(self, text: str) -> int:
        """Longest-match phrases of ``text``; an unknown character is one."""
        state = count = 0
        for c in text:
            if state and c in self.next[state]:
                state = self.next[state][c]
            else:
                count += 1
                state = self.next[0].get(c, 0)
        return count


def normalise(text: str) -> str:
    return NOT_LETTER.sub(" ", text.lower()).strip()


class Dense:
    """Automata of few letters in one table, walked side by side."""

    def __init__(self, training: dict[str, str]):
        letters = sorted(set().union(*training.values())) if training else []
        self.code = np.zeros(0x110000, np.int32)
        for k, c in enumerate(letters):
            self.code[ord(c)] = k + 1
        width = len(letters) + 1
        tables, roots, first = [], [], 0
        for text in training.values():
            states = SuffixAutomaton(text).next
            root = np.zeros(width, np.int64)
            for c, to in states[0].items():
                root[self.code[ord(c)]] = to
            # 2 * (row of the next state) + 1 where a phrase begins with this character.
            t = np.tile((first + root) * width * 2 + 1, (len(states), 1))
            for s, edges in enumerate(states[1:], 1):
                for c, to in edges.items():
                    t[s, self.code[ord(c)]] = (first + to) * width * 2
            # 32 bits, until the table is too long for them.
            tables.append(t if (first + len(states)) * width * 2 >= 1 << 31 else t.astype(np.int32))
            roots.append(first * width)
            first += len(states)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int64)

    def start(self, n: int) -> np.ndarray:
        return np.repeat(self.roots[:, None], n, 1).astype(self.table.dtype)

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = self.table[state + code]
        return got >> 1, got & 1


class Sparse:
    """The automaton of one language of many letters: transitions as a sorted list."""

    def __init__(self, text: str):
        letters = sorted(set(text))
        self.code = np.zeros(0x110000, np.int32)
        for k, c in enumerate(letters):
            self.code[ord(c)] = k + 1
        self.width = len(letters) + 1
        states = SuffixAutomaton(text).next
        edges = sorted((s * self.width + int(self.code[ord(c)]), to) for s, e in enumerate(states) for c, to in e.items())
        self.keys = np.array([k for k, _ in edges] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([t for _, t in edges] + [0], np.int64)
        self.root = np.zeros(self.width, np.int64)
        for c, to in states[0].items():
            self.root[self.code[ord(c)]] = to

    def start(self, n: int) -> np.ndarray:
        return np.zeros((1, n), np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = state * self.width + code
        at = np.searchsorted(self.keys, wanted)
        there = (self.keys[at] == wanted) & (state > 0)
        return np.where(there, self.to[at], self.root[code]), ~there


class Model:
    """The automata of all languages."""

    def __init__(self, training: dict[str, str]):
        few = sorted(n for n, t in training.items() if len(set(t)) <= DENSE_LETTERS)
        many = sorted(n for n in training if n not in few)
        order = few + many
        self.names = sorted(training)
        self._at = np.array([self.names.index(n) for n in order], np.int64)
        self._parts = ([Dense({n: training[n] for n in few})] if few else []) + [Sparse(training[n]) for n in many]
        self.bits = np.log2([max(2, len(training[n])) for n in self.names])

    def phrase_counts(self, texts: list[str]) -> np.ndarray:
        """``[text, language]`` for normalised texts."""
        lanes, owner = [], []
        for d, t in enumerate(texts):
            for at in range(0, len(t), STRETCH):
                lanes.append(t[at : at + STRETCH])
                owner.append(d)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        order = sorted(range(len(lanes)), key=lambda k: -len(lanes[k]))
        for at in range(0, len(order), LANES):
            part = order[at : at + LANES]
            counts = self._walk([lanes[k] for k in part])
            np.add.at(out, np.array(owner)[part], counts.T)
        return out

    def _walk(self, lanes: list[str]) -> np.ndarray:
        """Lanes are sorted by falling length. ``[language, lane]``."""
        sizes = np.array([len(x) for x in lanes])
        flat = np.frombuffer("".join(lanes).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(sizes)
        row = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
        lane = np.repeat(np.arange(len(lanes)), sizes)
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        out = []
        for part in self._parts:
            chars = np.zeros((sizes[0], len(lanes)), np.int32)
            chars[row, lane] = part.code[flat]
            state = part.start(len(lanes))
            counts = np.zeros(state.shape, np.int32)
            for k in range(sizes[0]):
                n = alive[k]
                state[:, :n], new = part.step(state[:, :n], chars[k, :n])
                counts[:, :n] += new
            out.append(counts)
        found = np.zeros((len(self.names), len(lanes)), np.int32)
        found[self._at] = np.concatenate(out)
        return found

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        clean = [normalise(t) for t in texts]
        if not self.names:
            return [(UND, 0.0)] * len(texts)
        lengths = np.array([max(1, len(t)) for t in clean])
        cost = self.phrase_counts(clean) * self.bits / lengths[:, None]
        # Share of the winner when every language weighs 2^(-cost difference).
        weight = np.exp2(-4 * (cost - cost.min(1, keepdims=True)))
        best = cost.argmin(1)
        share = weight[np.arange(len(texts)), best] / weight.sum(1)
        return [(self.names[b], float(s)) if c else (UND, 0.0) for b, s, c in zip(best, share, clean)]


def training_text(
    df: DataFrame, *, learn_from: Column | None = None, text_col="text", lang_col="lang", chars=TRAIN_CHARS, max_docs=TRAIN_DOCS
) -> dict[str, str]:
    """Normalised text a language, at most ``chars`` characters of at most
    ``max_docs`` documents. Counts by language give the share of ids to read, so
    one scan with a filter finds the sample."""
    ok = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.lit(True) if learn_from is None else learn_from)
    rows = df.filter(ok).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col("doc_id").cast("string")).alias("h"),
        F.col(text_col).alias("text"),
    )
    # One row a language. Ids count, not rows: of a repeated id one row is taken.
    counts = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return {}
    limits = {k: min(2**63 - 1, -(2**63) + 2**64 * max_docs // n) for k, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    picked = rows.filter(F.col("h") <= limit[F.col("lang")]).withColumn("text", F.substring("text", 1, 2 * chars))
    picked = picked.groupBy("lang", "h").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for r in picked.orderBy("lang", "h", "text").collect():
        if size.get(r["lang"], 0) < chars:
            t = normalise(r["text"])[: chars - size.get(r["lang"], 0)]
            out.setdefault(r["lang"], []).append(t)
            size[r["lang"]] = size.get(r["lang"], 0) + len(t) + 1
    return {k: " ".join(v) for k, v in out.items() if "".join(v)}


_models: dict[tuple, Model] = {}


def predict(df: DataFrame, training: dict[str, str], *, text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``. Workers build the automata from the training text."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(training)  # TRAIN_CHARS characters a language

    def make():
        key = tuple(sorted(shared.value.items()))
        if key not in _models:
            _models.clear()
            _models[key] = Model(shared.value)
        model = _models[key]

        def run(b: pa.RecordBatch) -> dict:
            got = model.predict(b.column("text").to_pylist())
            return {"lang_pred": [x for x, _ in got], "score": [s for _, s in got]}

        return run

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_rows(rows, make, "doc_id bigint, lang_pred string, score double")


FOLDS = 4
HELD_OUT = 2


def held_out() -> Column:
    return crc_of_id() % FOLDS == HELD_OUT

"""Secret scans through a trigram inverted index.

For every rule a Boolean trigram query is derived from its regular expression:
the parsed pattern gives the strings that a match must contain, a literal run the
AND of its trigrams, an alternation the OR of its branches. Documents are
indexed in blocks (Arrow batches): postings list, for each trigram that some
rule's query names, the block's documents that hold it, found for all texts of
the block at once. The queries are answered by intersecting and uniting postings,
and only the candidates are matched with the expression. A rule without a
mandatory trigram matches every document. A block's index is built and used where
the block is read, so no text is shuffled and nothing outgrows a batch.

A trigram is three bytes, on both sides: of every character the low byte, A-Z
lower-cased. So rules that ignore the case of ASCII letters need no wider queries;
where a rule ignores case beyond ASCII, a letter stands for the bytes of all
characters that the expression takes for it. Characters that share a byte add
candidates and lose none.

Defined cases: null text is the empty text; an empty text has no span; ids may be
null or repeated; other columns pass through :func:`redact` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from re import _constants as K
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches, text_or_empty

MAX_STRINGS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    # Which matches count.
    valid: Callable[[re.Match], bool] | None = None


def _long_value(m: re.Match) -> bool:
    return len(m.group(2)) >= 6


# The base kinds, in the order in which they are listed. Runs of a
# character class are greedy, so a least length may stand in their expression.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, _long_value),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further kinds with published, recognisable forms.
MORE = (
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + MORE


# ----------------------------------------------------------- Boolean queries
# A query is True (no condition), a trigram, ("and", queries) or ("or", queries).


def _all(queries) -> object:
    parts: dict = {}
    for q in queries:
        if q is True:
            continue
        for x in q[1] if isinstance(q, tuple) and q[0] == "and" else (q,):
            parts[x] = None
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", tuple(parts))


def _any(queries) -> object:
    parts = dict.fromkeys(queries)
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> object:
    """Some string of the set is in the text."""
    return _any(_all(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def trigram_query(pattern: str, flags: int = 0) -> object:
    """What a text must hold, in lower-case trigrams, for the pattern to match."""
    parsed = _parser.parse(pattern, flags)
    found, rest = _walk(list(parsed), parsed.state.flags)
    return _all([rest, _of_strings(found) if found is not None else True])


def _fold(c: str) -> str:
    """The byte, as a character, that a trigram has of ``c``."""
    return chr(_LOWER[ord(c) & 0xFF])


@cache
def _cased() -> str:
    return "".join(c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (c.lower() != c or c.upper() != c))


@cache
def _variants(c: str, flags: int) -> frozenset[str]:
    """The bytes of all characters that match the literal ``c``."""
    if not flags & re.IGNORECASE or flags & re.ASCII and c.isascii():
        return frozenset({_fold(c)})
    return frozenset(map(_fold, {c, *re.findall(re.escape(c), _cased(), flags & (re.IGNORECASE | re.ASCII))}))


def _walk(items, flags: int) -> tuple[set[str] | None, object]:
    """``(strings, query)``: all strings that the part can match, if few, and what
    else must hold."""
    run: set[str] | None = {""}
    queries = []

    def close() -> None:
        nonlocal run
        if run:
            queries.append(_of_strings(run))
        run = None

    exact = True
    for op, arg in items:
        one = _strings(op, arg, flags)
        if isinstance(one, set):
            if run is None:
                run = {""}
            both = {a + b for a in run for b in one}
            if len(both) <= MAX_STRINGS:
                run = both
                continue
            exact = False
            close()
            run = one
            continue
        exact = False
        close()
        queries.append(one)
    if exact:
        return run, True
    close()
    return None, _all(queries)


def _strings(op, arg, flags: int) -> set[str] | object:
    """The strings an item can match, or a query where they are too many."""
    if op is K.LITERAL:
        return set(_variants(chr(arg), flags))
    if op is K.AT:
        return {""}
    if op is K.IN:
        chars: set[str] = set()
        for kind, v in arg:
            if kind is K.LITERAL:
                chars |= _variants(chr(v), flags)
            elif kind is K.RANGE and v[1] - v[0] < 8:
                chars = chars.union(*(_variants(chr(c), flags) for c in range(v[0], v[1] + 1)))
            else:
                return True
        return chars if len(chars) <= 8 else True
    if op is K.SUBPATTERN:
        found, query = _walk(list(arg[3]), (flags | arg[1]) & ~arg[2])
        return found if found is not None else query
    if op is K.BRANCH:
        parts = [_walk(list(x), flags) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts))
        return _any(_of_strings(s) if s is not None else q for s, q in parts)
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        low, high, body = arg
        found, query = _walk(list(body), flags)
        if found is not None and low == high == 1:
            return found
        if found is not None and (low, high) == (0, 1):
            return found | {""}
        if low == 0:
            return True
        return _of_strings(found) if found is not None else query
    return True


def names(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(names(q) for q in query[1]))


# -------------------------------------------------------------------- index


def _code(tri: str) -> int:
    a, b, c = (ord(x) & 0xFF for x in tri)
    return a | b << 8 | c << 16


def _lower_bytes(text: str) -> np.ndarray:
    """One byte a character: itself below 128, else its low byte (which can only
    add candidates)."""
    try:
        u = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint8)
    return u


class BlockIndex:
    """Postings of a block of texts for a vocabulary of trigrams."""

    def __init__(self, texts: list[str], vocabulary: list[str]):
        self.size = len(texts)
        table = np.zeros(1 << 24, np.uint8) if not hasattr(BlockIndex, "_table") or BlockIndex._words != vocabulary else BlockIndex._table
        if getattr(BlockIndex, "_words", None) != vocabulary:
            for k, t in enumerate(vocabulary):
                table[_code(t)] = k + 1
            BlockIndex._table, BlockIndex._words = table, vocabulary
        parts = [_lower_bytes(t) for t in texts]
        # Two zero bytes between texts: no trigram spans them.
        gap = np.zeros(2, np.uint8)
        flat = _LOWER[np.concatenate([x for p in parts for x in (p, gap)] or [gap])]
        code = flat[:-2].astype(np.uint32)
        code |= flat[1:-1].astype(np.uint32) << np.uint32(8)
        code |= flat[2:].astype(np.uint32) << np.uint32(16)
        word = table[code]
        at = np.flatnonzero(word)
        starts = np.cumsum([0, *(len(p) + 2 for p in parts)])
        doc = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(word[at].astype(np.int64) * max(1, self.size) + doc)
        words, docs = pairs // max(1, self.size), pairs % max(1, self.size)
        cut = np.searchsorted(words, np.arange(1, len(vocabulary) + 2))
        self.postings = {t: docs[cut[k] : cut[k + 1]] for k, t in enumerate(vocabulary)}

    def answer(self, query) -> np.ndarray:
        """Documents that may match, ascending."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        parts = [self.answer(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        out = parts[0]
        for p in sorted(parts[1:], key=len):
            out = np.intersect1d(out, p, assume_unique=True)
        return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        self.vocabulary = sorted(set().union(*(names(q) for _, _, q in self.rules)))
        if len(self.vocabulary) > 255:
            raise ValueError("the rules' queries name over 255 trigrams; scan with fewer rules at a time")

    def block(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text, ``(start, rule number, end)`` by start, then rule."""
        index = BlockIndex(texts, self.vocabulary)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, regex, query) in enumerate(self.rules):
            for d in index.answer(query):
                for m in regex.finditer(texts[d]):
                    if rule.valid is None or rule.valid(m):
                        out[d].append((m.start(), k, m.end()))
        for spans in out:
            spans.sort()
        return out


def _join(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{e}" for a, k, e in spans)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text") -> DataFrame:
    """``doc_id, found``: every span with its kind (code points, end exclusive)."""
    small_batches(df.sparkSession)

    def make():
        scanner = Scanner(rules)

        def run(b: pa.RecordBatch) -> dict:
            got = scanner.block(b.column("text").to_pylist())
            return {"found": [[{"kind": rules[k].kind, "start": a, "end": e} for a, k, e in s] for s in got]}

        return run

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_rows(rows, make, f"doc_id bigint, found {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, from :func:`scan`."""
    base = [r.kind for r in BASE]
    text = lambda arr: F.array_join(
        F.transform(arr, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("found", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")
    of_base = F.filter("found", lambda s: s.kind.isin(*base))
    return found.select("doc_id", *map(count, base), F.sha2(text(of_base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``df``, all columns, with every secret replaced by ``<kind>``
    (overlapping spans by the kind that starts first). ``length_col``, if there,
    follows the new text where the text changed."""
    small_batches(df.sparkSession)
    at = df.columns.index(text_col)
    n_at = df.columns.index(length_col) if length_col in df.columns else None

    def run(batches):
        scanner = Scanner(rules)
        for b in batches:
            cols, old = list(b.columns), b.column(at).to_pylist()
            new = list(old)
            for d, spans in enumerate(scanner.block([t or "" for t in old])):
                if not spans:
                    continue
                parts, end = [], 0
                for a, k, e in spans:
                    if a >= end:
                        parts += [old[d][end:a], f"<{rules[k].kind}>"]
                    end = max(end, e)
                new[d] = "".join(parts) + old[d][end:]
            cols[at] = pa.array(new, b.schema.field(at).type)
            if n_at is not None:
                sizes = [n if t == o else len(t) for n, t, o in zip(cols[n_at].to_pylist(), new, old)]
                cols[n_at] = pa.array(sizes, b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return df.mapInArrow(run, df.schema)

"""Tokenizer ids of whole texts as little-endian unsigned 32-bit bytes.

Both public vocabularies split a text at white space before they merge, so the
ids of a text are the ids of its pieces one after another. Every piece is
encoded by the tokenizers library once and kept in a bounded memo; a repeated
word then costs one lookup. :class:`PieceEncoder` proves on a probe that the
cut agrees with the whole-text result of the tokenizer at hand, and encodes
whole texts when it doesn't.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_PIECES = 1 << 19
MEMO_CHARS = 64
# Characters of texts whose words are gathered at once.
GROUP_CHARS = 1 << 22
# Pieces not met before that the tokenizer is given as one text.
JOINED = 128
# White space that the cuts below do not use, and characters that regular
# expression engines class differently: such texts are encoded whole.
UNUSUAL = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
# The cut of words as a space between them, for Arrow (whose expressions look at no characters behind).
WORD_END = ("(^|[ \n\r\t])([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?])", r"\1\2 \3")
SPACE = (" ", "\n", "\r", "\t")
# What a byte may be to the cut of pieces. _LATIN ends a letter behind the byte C3.
_SPACE, _MARK, _LETTER, _LATIN = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
KIND[list(map(ord, SPACE))] = _SPACE
KIND[list(b".,;:!?")] = _MARK
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
KIND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = _LATIN
BEYOND_LATIN = re.compile("[^\x00-\xff]")
PROBE = "It's 12 áb  c.\n\n DÉF's   \t x1y2!? <|endoftext|> \n\r z'll 中文 é "


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and where each text's words begin among them."""
    cut = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, *WORD_END))
    return cut.flatten(), cut.offsets.to_numpy()


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The same with the white space before each word: a piece begins where white space follows other
    characters, and at a mark behind a letter."""
    _, offsets, chars = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(chars or b"", np.uint8)[: offsets[-1]]
    kind = KIND[data]
    space = kind == _SPACE
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = space[1:] > space[:-1]
    mark = np.flatnonzero(kind[1:] == _MARK) + 1
    before = kind[mark - 1]
    begins[mark[(before == _LETTER) | (before == _LATIN) & (data[mark - 2] == 0xC3)]] = True
    begins[offsets] = True
    at = np.flatnonzero(begins)
    at = at[np.searchsorted(at, offsets[0]) :]
    pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), chars or pa.py_buffer(b""))
    return pieces, np.searchsorted(at, offsets)


class PieceEncoder:
    """``encode(texts)``: ids of each whole text, special tokens read as ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._memo: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        drops_space = self.whole("a b") == self.whole("a") + self.whole("b") and self.whole(" \n ") == b""
        self._cut = words_of if drops_space else pieces_of
        self._gap = " " if drops_space else ""
        # Where case does not count, "The" and "the" are one piece.
        self._any_case = self.whole("AB Ä'S ÞÝ") == self.whole("ab ä's þý")
        pieces = self._cut(pa.array([PROBE], pa.large_string()))[0].to_pylist()
        alone = {p: self.whole(p) for p in pieces}
        self.by_piece = b"".join(map(alone.get, pieces)) == self.whole(PROBE) and self._ids_of(pieces) == alone

    def whole(self, text: str) -> bytes:
        return np.asarray(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _one_case(self, text: str) -> str:
        # Lower case is a matter of single characters in Latin-1 only.
        return text.lower() if self._any_case and not BEYOND_LATIN.search(text) else text

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return [self.whole(t) for t in texts]
        usual = [not UNUSUAL.search(t) for t in texts]
        kept = [t for t, u in zip(texts, usual) if u]
        done = iter(self._by_piece(kept))
        return [next(done) if u else self.whole(t) for t, u in zip(texts, usual)]

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        """A text is its pieces in a row (where space has no ids, its words): the distinct pieces of a
        group of texts are looked up once, and the texts' ids are gathered from theirs."""
        out: list[bytes] = []
        sizes = np.cumsum([len(t) for t in texts]) // GROUP_CHARS
        for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
            part = pa.array([self._one_case(texts[i]) for i in group], pa.large_string())
            pieces, first = self._cut(part)
            pieces = pieces.dictionary_encode()
            ids = self._looked_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
            pool = np.frombuffer(b"".join(ids), "<u4")
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            code = pieces.indices.to_numpy()
            each = n[code]
            ends = np.cumsum(each)
            # Where the ids of a piece are in the pool, less where they go.
            shift = (np.cumsum(n) - n)[code] - (ends - each)
            total = int(ends[-1]) if len(ends) else 0
            got = pool[np.repeat(shift, each) + np.arange(total)].tobytes()
            at = 4 * np.concatenate([[0], ends])[first]
            out += [got[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return out

    def _looked_up(self, wanted: list[str]) -> list[bytes]:
        """The ids of each of the ``wanted`` pieces, which are distinct."""
        # Two generations: pieces in use move to the young one, the rest go with the old one.
        if len(self._memo) >= MEMO_PIECES:
            self._old, self._memo = self._memo, {}
        memo, old = self._memo, self._old
        new = set(wanted).difference(memo)
        memo.update((p, old[p]) for p in new & old.keys())
        new = list(new.difference(old))
        for at in range(0, len(new), 1 << 14):
            memo.update(self._ids_of(new[at : at + (1 << 14)]))
        out = list(map(memo.__getitem__, wanted))
        for p in new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return out

    def _apart(self, piece: str) -> bool:
        """Whether the tokenizer keeps the piece apart from others like it in one text: words with a space
        between (not those that NFC changes, so that places in the text stay), or pieces that begin with white space and end without."""
        if self._gap:
            return unicodedata.is_normalized("NFC", piece)
        return piece.startswith(SPACE) and not piece.endswith(SPACE)

    def _ids_of(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece by the tokenizer. Pieces that stay apart are given to it as one text, which
        is cut where they meet, and told apart by where their ids begin in it."""
        joined = list(filter(self._apart, pieces))
        alone = list(set(pieces).difference(joined)) if len(joined) < len(pieces) else []
        got = self._tok.encode_batch_fast(alone, add_special_tokens=False)
        ids = dict(zip(alone, (array("I", e.ids).tobytes() for e in got)))
        parts = [joined[k : k + JOINED] for k in range(0, len(joined), JOINED)]
        for part, e in zip(parts, self._tok.encode_batch([self._gap.join(p) for p in parts], add_special_tokens=False)):
            begin = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e))[::2]
            at = (4 * np.searchsorted(begin, np.cumsum([len(p) + len(self._gap) for p in part]))).tolist()
            run = array("I", e.ids).tobytes()
            ids.update((p, run[a:b]) for p, a, b in zip(part, [0, *at], at))
        return ids


_loaded: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per file and worker process."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))

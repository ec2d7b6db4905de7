"""Token ids of texts, from a tokenizer of the tokenizers library and a memory of pieces.

The vocabularies used here never merge across the start of a word, so a text can be cut at words
and every distinct piece given to the library once. The memory is bounded: past ``MOST`` pieces or
``MOST_CHARS`` characters it keeps the pieces that came back, or nothing.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain, islice

import numpy as np
import pyarrow as pa

MOST = 1_000_000
MOST_CHARS = 24 << 20
AGAIN = 3

WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Always safe: no word goes on from other characters to white space.
SAFE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: By byte: white space, and what a full stop or comma is split off from.
SPACES, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


class Layout:
    """Texts as one buffer of bytes, two zero bytes on both sides, with each one's start and size."""

    def __init__(self, docs: list[str]):
        raw = [x.encode() for x in docs]
        self.docs, self.size = docs, np.fromiter(map(len, raw), np.int64, len(raw))
        self.data = np.frombuffer(b"\0\0" + b"".join(raw) + b"\0\0", np.uint8)
        self.starts = 2 + np.cumsum(self.size) - self.size

    def pieces(self) -> tuple[pa.Array, np.ndarray]:
        """Pieces whose ids don't depend on each other, and how many each text has."""
        begins = (self.data == 32) | (self.data == 10) | (self.data == 44) | (self.data == 46)
        begins[1:] |= self.data[:-1] == 10
        for i in np.flatnonzero(self.unsafe()).tolist():
            start = self.starts[i]
            size = np.fromiter((len(x.encode()) for x in SAFE.findall(self.docs[i])), np.int64)
            begins[start : start + self.size[i]] = False
            begins[start + np.cumsum(size) - size] = True
        begins[:2] = begins[-2:] = False
        begins[self.starts[self.size > 0]] = True
        at = np.flatnonzero(begins)
        kind, width = (pa.string(), np.int32) if len(self.data) < 1 << 31 else (pa.large_string(), np.int64)
        offsets = np.append(at, len(self.data) - 2).astype(width)
        found = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])
        return found, np.searchsorted(at, self.starts + self.size) - np.searchsorted(at, self.starts)

    def unsafe(self) -> np.ndarray:
        """Texts that may be cut at white space only.

        The others have no two white spaces in a row and none beyond ASCII, and each full stop or comma
        follows a digit or Latin letter; these may also be cut around spaces and line ends and in front
        of full stops and commas.
        """
        data, starts, size = self.data, self.starts, self.size
        space = SPACES[data]
        first = starts[size > 0]
        inside = np.ones(len(data), bool)
        inside[first] = False
        places = [np.flatnonzero(space[1:] & space[:-1] & inside[1:]) + 1, np.flatnonzero(data == 1)]
        dot = np.flatnonzero((data == 44) | (data == 46))
        last, lead = data[dot - 1], data[dot - 2]
        latin = (last >= 0x80) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
        places.append(dot[~((LETTERS[last] | latin) & inside[dot])])
        wide = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        a, b, c = data[wide], data[wide + 1], data[wide + 2]
        blank = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        blank |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        blank |= (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        places.append(wide[blank])
        out = np.zeros(len(self.docs), bool)
        out[np.searchsorted(starts, np.concatenate(places), "right") - 1] = True
        return out


LATIN_WORD = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch


class _Memory(dict):
    """Gives each new piece the next number."""

    def __missing__(self, piece: str) -> int:
        at = self[piece] = len(self)
        return at


class PieceMemory:
    """Ids of texts, with ``encode(pieces) -> (ids, sizes)`` called once for each new piece."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MOST):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.memory = _Memory()
        self.ids = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)
        self.chars = 0

    def _learn(self) -> None:
        """Encodes the pieces met since the last call."""
        known, used = len(self.ends) - 1, int(self.ends[-1])
        new = list(islice(self.memory, known, None))
        if not new:
            return
        flat, size = self.encode(new)
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[used : used + len(flat)] = flat
        self.ends = np.concatenate([self.ends, used + np.cumsum(size)])
        self.chars += sum(map(len, new))

    def _forget(self) -> None:
        """Starts anew with the pieces that came back often, if these are short and not too many."""
        often = np.flatnonzero(self.met[: len(self.ends) - 1] >= AGAIN)
        pieces = [*self.memory]
        kept = [pieces[i] for i in often]
        if len(kept) > self.most // 2 or sum(map(len, kept)) > MOST_CHARS // 2:
            self._clear()
            return
        size = np.diff(self.ends)[often]
        ends = np.cumsum(size)
        flat = self.ids[np.arange(int(size.sum())) + np.repeat(self.ends[often] - (ends - size), size)]
        self._clear()
        self.memory.update(zip(kept, range(len(kept)), strict=True))
        self.ids = np.concatenate([flat, self.ids])
        self.ends = np.concatenate([self.ends, ends])
        self.chars = sum(map(len, kept))

    def __call__(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each document's end; documents without ids are empty."""
        if len(self.memory) > self.most or self.chars > MOST_CHARS:
            self._forget()
        pieces, sizes = Layout(docs).pieces()
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.memory.__getitem__, distinct), np.int64, len(distinct))
        self._learn()
        at = numbers[coded.indices.to_numpy()]
        met = np.bincount(at, minlength=len(self.memory))
        met[: len(self.met)] += self.met
        self.met = met
        start, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(size)
        flat = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
        total = np.concatenate([[0], ends])
        return self.ids[flat], total[np.cumsum(sizes)]


class WordIds(PieceMemory):
    """Ids as a file of the tokenizers library gives them."""

    def __init__(self, path: str, most: int = MOST):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        super().__init__(self._library, most)

        self.spelled = self._spelling()

    def _spelling(self) -> Callable[[list[str]], list[str]] | None:
        """How the model wants to see words of Latin letters, if words reach it whole."""
        shown = np.arange(256, dtype="<u4")
        for byte, char in _stand_ins().items():
            shown[byte] = ord(char) if byte != 10 else 10

        def plain(words: list[str]) -> list[str]:
            data = np.frombuffer("\n".join(words).encode(), np.uint8)
            return shown[data].tobytes().decode("utf-32-le").split("\n")

        def folded(words: list[str]) -> list[str]:
            return plain(["\n".join(words).replace(" ", "").lower()])

        probes = ["a", " a", "Word", " wOrd", "\xe9t\xe9", " \xc9t\xe9\xff", " \xdf", "s", " s", "antidisestablishment"]
        want = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in probes]
        for spelled in (plain, folded):
            if [[t.id for t in self.tokenizer.model.tokenize(x)] for x in spelled(probes)] == want:
                return spelled
        return None

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of Latin letters go straight to the library's model, all else through all of it."""
        got: list = [None] * len(pieces)
        latin = [i for i, piece in enumerate(pieces) if LATIN_WORD(piece)] if self.spelled else []
        if latin:
            merged = self.tokenizer.model.tokenize
            for i, word in zip(latin, self.spelled([pieces[i] for i in latin]), strict=True):
                got[i] = [t.id for t in merged(word)]
        rest = [i for i, ids in enumerate(got) if ids is None]
        found = self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            got[i] = e.ids
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum())), size


def _stand_ins() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_OPEN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The encoder of a file, opened once per process."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]


def with_end(ids: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each followed by the id ``end``."""
    return np.insert(ids, ends, end).astype(np.uint32), ends + np.arange(1, len(ends) + 1)

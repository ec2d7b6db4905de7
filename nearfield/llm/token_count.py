"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two transducers run one after the other; both advance many places of the text at once.

* The splitter has a dozen states and marks where words begin. The text of a batch is cut into
  chunks without regard to its content. Each chunk yields a map from every state it may be entered
  in to the state it is left in; the maps compose, so a parallel prefix scan over them gives all
  entry states, with which the chunks run once more and emit the marks.
* The merger reads the bytes of a word. Its state holds, for each suffix read so far that may still
  grow into a token, the token before that suffix; a transition carries the number of tokens it adds
  or takes back. States and transitions are compiled when a text first needs them. A token may
  follow another if no merge would reach across their border, which fixes the segmentation of every
  prefix.

Counts equal those of the tokenizers library. Null text reads as empty and has no tokens. The table
of the merger is bounded: it starts anew when it has grown past ``MAX_STATES``. Rows are independent,
so nothing is shuffled; a document stays in one row, and so in one task, however long it is.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import documents, pieces, query, texts

PIECE_BYTES = 4 << 20
CHUNK = 512
SYNC = 32
WORD_BLOCK = 1 << 16
MAX_STATES = 200_000
LIMIT = 512

# classes of characters; the letters of contractions have their own
SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, E, L, END = range(12)
# states: what the current word is so far
(START, ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE, LETTERS, NUMBERS, OTHERS) = range(8)
(QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CLOSED) = range(8, 13)
N_CLASSES, N_STATES = 12, 13
HERE, BEFORE = 1, 2  # a word begins at this character, at the one before it


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks, by state and class."""
    letters = (LETTER, STMD, R, V, E, L)
    fresh = {SPACE: ONE_SPACE, WHITE: ONE_WHITE, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: QUOTED, END: START}
    fresh |= dict.fromkeys(letters, LETTERS)
    joined = {NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: OTHERS} | dict.fromkeys(letters, LETTERS)
    more = {SPACE: RUN_SPACE, WHITE: RUN_WHITE}
    step = {s: {c: (fresh[c], HERE) for c in range(N_CLASSES)} for s in range(N_STATES)}

    def stay(state, to):
        step[state] |= {c: (s, 0) for c, s in to.items()}

    stay(LETTERS, dict.fromkeys(letters, LETTERS))
    stay(NUMBERS, {NUMBER: NUMBERS})
    stay(OTHERS, {OTHER: OTHERS, QUOTE: OTHERS})
    stay(ONE_SPACE, joined | more)
    stay(ONE_WHITE, more)
    # the last of several spaces goes with the word that follows, or stands alone
    step[RUN_SPACE] |= {c: (s, BEFORE) for c, s in joined.items()}
    step[RUN_WHITE] = {c: (s, m | BEFORE if c != END else m) for c, (s, m) in step[RUN_WHITE].items()}
    stay(RUN_SPACE, more)
    stay(RUN_WHITE, more)
    stay(QUOTED, {OTHER: OTHERS, QUOTE: OTHERS, STMD: CLOSED, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L})
    for state, last in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
        step[state] = {c: (s, m | BEFORE) for c, (s, m) in step[LETTERS].items()}
        stay(state, {last: CLOSED})
    table = np.array([[step[s][c] for c in range(N_CLASSES)] for s in range(N_STATES)], np.uint8)
    return table[..., 0].ravel().copy(), table[..., 1].ravel().copy()


NEXT, MARKS = _splitter()


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Where words begin, as booleans; texts end in ``END``, which counts as a word."""
    n = len(classes)
    width = -(-n // CHUNK)
    padded = np.full(width * CHUNK, END, np.uint8)
    padded[:n] = classes
    steps = np.ascontiguousarray(padded.reshape(width, CHUNK).T)

    # what each chunk does to every state; most chunks soon forget how they were entered
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (width, 1))
    for j in range(SYNC):
        maps = NEXT.take(maps.astype(np.int16) * N_CLASSES + steps[j][:, None])
    met = (maps == maps[:, :1]).all(axis=1)
    one, alone = maps[met, 0], np.flatnonzero(met)
    many, rest = maps[~met], np.flatnonzero(~met)
    for j in range(SYNC, CHUNK):
        one = NEXT.take(one.astype(np.int16) * N_CLASSES + steps[j][alone])
        if len(rest):
            many = NEXT.take(many.astype(np.int16) * N_CLASSES + steps[j][rest][:, None])
    maps[alone] = one[:, None]
    maps[rest] = many

    # inclusive scan: the map of a chunk after those of all chunks before it
    reach = 1
    while reach < width:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2

    state = np.concatenate([np.array([START], np.uint8), maps[:-1, START]])
    marks = np.empty((CHUNK, width), np.uint8)
    for j in range(CHUNK):
        at = state.astype(np.int16) * N_CLASSES + steps[j]
        marks[j] = MARKS.take(at)
        state = NEXT.take(at)
    marks = marks.T.reshape(-1)[:n]
    starts = (marks & HERE).astype(bool)
    starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return starts


def _packed(node: int, before: int, count: int) -> int:
    """One suffix of a state: its node, the token before it, and tokens relative to the state's."""
    return node << 40 | (before + 1) << 8 | (count + 128)


class Merger:
    """The transducer of merges, compiled as far as texts have needed it."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = vocabulary
        self.rank = {(vocabulary[a], vocabulary[b]): i for i, (a, b) in enumerate(merges)}
        self.parts = {vocabulary[a + b]: (vocabulary[a], vocabulary[b]) for a, b in reversed(merges)}
        self.edges: dict[str, tuple] = {}
        self.ok: dict[tuple[int, int], bool] = {}
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for word, token in vocabulary.items():
            if len(word) > 1 and not self._whole(token):
                continue
            node = 0
            for byte in word:
                to = self.child[node].get(byte)
                if to is None:
                    to = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = to
            self.token[node] = token
        self.clear()

    def clear(self) -> None:
        self.column = np.full(256, -1, np.int32)
        self.columns = 0
        self.to = np.full((4096, 64), -1, np.int32)
        self.add = np.zeros((4096, 64), np.int16)
        start = (_packed(0, -1, 0),)
        self.states = {start: 0}
        self.content = [start]

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces at the left or right end of a token while it forms, with the rank that ends each."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out[::-1]
            pair = self.parts[token]
            until, token = self.rank[pair], pair[side]

    def _crossing(self, a: int, b: int) -> tuple[int, int] | None:
        """The first pair that merges across the border of two tokens."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            (x, ends_x), (y, ends_y) = left[i], right[j]
            rank = self.rank.get((x, y))
            if rank is not None and rank < ends_x and rank <= ends_y:
                return x, y
            if ends_x == ends_y == float("inf"):
                return None
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether the bytes of a token merge into it."""
        pair = self.parts.get(token)
        return pair is not None and self._crossing(*pair) == pair

    def follows(self, a: int, b: int) -> bool:
        got = self.ok.get((a, b))
        if got is None:
            if len(self.ok) > 2_000_000:
                self.ok.clear()
            got = self.ok[a, b] = a < 0 or self._crossing(a, b) is None
        return got

    def _compile(self, state: int, byte: int) -> None:
        grown, last, count = [], None, 0
        child, token = self.child, self.token
        for x in self.content[state]:
            to = child[x >> 40].get(byte)
            if to is None:
                continue
            if last is None and (t := token[to]) >= 0 and self.follows((x >> 8 & 0xFFFFFFFF) - 1, t):
                last, count = t, (x & 0xFF) - 127
            if child[to]:
                grown.append((to << 40) | (x & 0xFFFFFFFFFF))
        content = (*(x - count for x in grown), _packed(0, last, 0))
        at = self.states.get(content)
        if at is None:
            at = self.states[content] = len(self.content)
            self.content.append(content)
            if at >= len(self.to):
                self.to = np.concatenate([self.to, np.full_like(self.to, -1)])
                self.add = np.concatenate([self.add, np.zeros_like(self.add)])
        column = self.column[byte]
        self.to[state, column] = at
        self.add[state, column] = count

    def _columns(self, seen: np.ndarray) -> None:
        new = seen[self.column[seen] < 0]
        self.column[new] = np.arange(self.columns, self.columns + len(new))
        self.columns += len(new)
        if (wider := self.columns - self.to.shape[1]) > 0:
            wide = ((0, 0), (0, max(wider, 32)))
            self.to = np.pad(self.to, wide, constant_values=-1)
            self.add = np.pad(self.add, wide)

    def count(self, data: np.ndarray, seen: np.ndarray, start: np.ndarray, size: np.ndarray):
        """Tokens of each word, given as places in the bytes; ``seen`` lists the bytes that occur."""
        if len(self.content) > MAX_STATES:
            self.clear()
        self._columns(seen)
        order = np.argsort(-size, kind="stable")
        start, long = start[order], -size[order]
        state = np.zeros(len(order), np.int64)
        total = np.zeros(len(order), np.int64)
        live = len(order)
        for j in range(-int(long[0]) if live else 0):
            live = int(np.searchsorted(long[:live], -j, "left"))
            byte = data[start[:live] + j]
            at = state[:live] * self.to.shape[1] + self.column[byte]
            to = self.to.ravel().take(at)
            while (lost := to < 0).any():
                _, first = np.unique(at[lost], return_index=True)
                for k in np.flatnonzero(lost)[first]:
                    self._compile(int(state[k]), int(byte[k]))
                to = self.to.ravel().take(at)
            total[:live] += self.add.ravel().take(at)
            state[:live] = to
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class Counter:
    """Counts tokens of texts as the library does with a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            raise ValueError("only plain byte-level BPE files can be compiled")
        # the printable stand-ins of bytes in such files
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        raw = lambda x: bytes(byte[c] for c in x)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        vocabulary = {raw(k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.merger = Merger(vocabulary, [(raw(a), raw(b)) for a, b in merges])
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = np.full(0x110000, 255, np.uint8)
        for c, kind in zip("' stmdrvel", (QUOTE, SPACE, STMD, STMD, STMD, STMD, R, V, E, L), strict=True):
            self.classes[ord(c)] = kind

    def _classify(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.classes[codes]
        if (kinds == 255).any():
            for code in np.unique(codes[kinds == 255]):
                alike = (k for k, c in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.split(c + chr(code))) == 1)
                self.classes[code] = next(alike, WHITE)
            kinds = self.classes[codes]
        return kinds

    def __call__(self, docs: list[str]) -> np.ndarray:
        parts, owner, fixed = [], [], np.zeros(len(docs), np.int64)
        for i, doc in enumerate(docs):
            cut = self.special.split(doc) if self.special and self.special.search(doc) else (doc,)
            parts.extend(cut)
            owner.extend([i] * len(cut))
            fixed[i] = len(cut) - 1
        whole = "\0".join(parts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.array([len(x) + 1 for x in parts], np.int64)) - 1
        kinds = self._classify(codes)
        kinds[ends] = END
        starts = np.flatnonzero(word_starts(kinds))
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        place = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer(whole.encode("utf-8"), np.uint8)
        size = np.diff(np.append(place[starts], len(data)))
        real = kinds[starts] != END
        starts, size = starts[real], size[real]
        counts = np.empty(len(starts), np.int64)
        seen = np.flatnonzero(np.bincount(data, minlength=256))
        for a in range(0, len(starts), WORD_BLOCK):
            b = slice(a, a + WORD_BLOCK)
            counts[b] = self.merger.count(data, seen, place[starts[b]], size[b])
        part = np.searchsorted(ends, starts)
        per = np.bincount(np.asarray(owner)[part], weights=counts, minlength=len(docs)) if len(starts) else 0
        return fixed + np.asarray(per).astype(np.int64)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of a file, compiled once per process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, doc_id="doc_id", text="text", limit=LIMIT) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in pieces(batches, "text", PIECE_BYTES):
            n = count(texts(batch, "text"))
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            out = [batch.column("doc_id"), size, pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, schema)


@query()
def op10_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))

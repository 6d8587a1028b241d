"""Byte-level BPE with vectorised pre-tokenisation.

Texts are laid side by side as one array of codepoints.  Each codepoint gets a symbol: its class
(letter, number, white space, apostrophe, other) and, where the rule looks ahead, what
follows.  A small automaton over these symbols says before which codepoints a piece begins.
Its transitions form a finite monoid, so the state before every codepoint comes from an
associative scan: symbols are elements of the monoid, prefixes are composed block by block,
and block totals are scanned the same way.  No regular expression is run.

Pieces are looked up in a cache of merged pieces; a piece seen for the first time is merged by rank.
Token ids keep the byte offset at which each token starts.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelworks.llm.common import batch, map_batches, slices, utf8

# The classes behind the published pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
OTHER, LETTER, NUMBER, SPACE, BLANK, APOSTROPHE = range(6)  # SPACE: white space but U+0020
# Codepoints with the property White_Space, ranges inclusive.
WHITE_SPACE = (
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
# Endings after an apostrophe that are pieces of their own.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Symbols: what the automaton reads.  INNER is white space that stays with its run, JOIN the
# last blank of a run before something else, LAST any other last white space; SHORT and LONG are
# apostrophes before an ending of one or two letters.
S_OTHER, S_LETTER, S_NUMBER, S_INNER, S_JOIN, S_LAST, S_SHORT, S_LONG = range(8)
SYMBOLS = 8
# States: what the codepoint before belongs to.  TWO and ONE: an ending with so many letters to come;
# ENDED: an ending that is complete.
BEGIN, IN_OTHER, IN_LETTER, IN_NUMBER, IN_SPACE, JOINED, LAST, TWO, ONE, ENDED = range(10)
STATES = 10

BLOCK = 64
# Pieces remembered by a worker; longer pieces are merged each time they occur.
CACHED_PIECES = 1 << 19
CACHED_BYTES = 64
SHORT_PIECE = 40
NEVER = 1 << 60


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins before this codepoint."""
    if symbol == S_LETTER:
        if state in (TWO, ONE):
            return (ONE if state == TWO else ENDED), False
        return IN_LETTER, state not in (IN_LETTER, JOINED)
    if symbol == S_NUMBER:
        return IN_NUMBER, state not in (IN_NUMBER, JOINED)
    if symbol in (S_SHORT, S_LONG) and state not in (IN_OTHER, JOINED):
        return (ONE if symbol == S_SHORT else TWO), True
    if symbol in (S_OTHER, S_SHORT, S_LONG):
        return IN_OTHER, state not in (IN_OTHER, JOINED)
    if symbol == S_INNER:
        return IN_SPACE, state != IN_SPACE
    return (JOINED if symbol == S_JOIN else LAST), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, composition table, state reached from BEGIN, begins).

    Elements are functions on states, closed under composition; symbols 8..15 are the
    symbols at the first codepoint of a text, which forget the state before.
    """
    moves = [tuple(_step(s, x)[0] for s in range(STATES)) for x in range(SYMBOLS)]
    moves += [(move[BEGIN],) * STATES for move in moves]
    known = dict.fromkeys([tuple(range(STATES)), *moves])
    elements = list(known)
    for f in elements:  # grows while it is walked
        for g in moves:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = None
                elements.append(h)
    number = {f: i for i, f in enumerate(elements)}
    compose = np.array([[number[tuple(g[s] for s in f)] for g in elements] for f in elements], np.uint8)
    begins = np.array([[_step(s, x)[1] for x in range(SYMBOLS)] for s in range(STATES)])
    return (
        np.array([number[m] for m in moves], np.uint8),
        compose,
        np.array([f[BEGIN] for f in elements], np.uint8),
        begins,
    )


def scan(elements: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions.  Columns of blocks are composed side by side, the block
    totals are scanned the same way, and each block then takes in what is before it."""
    n = len(elements)
    if n <= BLOCK:
        out = elements.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.uint8)  # element 0 is the identity
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    flat, width = compose.ravel(), np.uint16(len(compose))
    for i in range(1, BLOCK):
        grid[i] = flat[grid[i - 1] * width + grid[i]]
    before = np.zeros(blocks, np.uint8)
    before[1:] = scan(grid[-1], compose)[:-1]
    return flat[before * width + grid].T.ravel()[:n]


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    classes = np.zeros(0x110000, np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        classes[c] = kind.get(unicodedata.category(chr(c))[0], OTHER)
    for a, b in WHITE_SPACE:
        classes[a : b + 1] = SPACE
    classes[0x20], classes[ord("'")] = BLANK, APOSTROPHE
    return classes


def _after(values: np.ndarray, k: int, fill: int) -> np.ndarray:
    out = np.full(len(values), fill, values.dtype)
    if k < len(values):
        out[: len(values) - k] = values[k:]
    return out


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each codepoint; ``first`` marks the first codepoint of each text."""
    classes = codepoint_classes()[points]
    symbol = np.where(classes == LETTER, S_LETTER, np.where(classes == NUMBER, S_NUMBER, S_OTHER))
    symbol = symbol.astype(np.uint8)
    white = (classes == SPACE) | (classes == BLANK)
    ends = _after(first.view(np.uint8), 1, 1).astype(bool)
    inner = ends | _after(white.view(np.uint8), 1, 1).astype(bool)
    symbol[white] = np.where(inner, S_INNER, np.where(classes == BLANK, S_JOIN, S_LAST))[white]
    at = np.flatnonzero((classes == APOSTROPHE) & ~ends)
    if at.size:
        one = points[at + 1]
        two = np.where(ends[at + 1], 0, points[np.minimum(at + 2, len(points) - 1)])
        short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
        long = np.zeros(len(at), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        symbol[at[short]] = S_SHORT
        symbol[at[long]] = S_LONG
    return symbol


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the first codepoint of every piece."""
    if not len(points):
        return np.zeros(0, np.int64)
    element_of, compose, reached, begins = automaton()
    symbol = symbols(points, first)
    prefix = scan(element_of[symbol + first * np.uint8(SYMBOLS)], compose)
    state = np.empty(len(points), np.uint8)
    state[0] = BEGIN
    state[1:] = reached[prefix[:-1]]
    state[first] = BEGIN
    return np.flatnonzero(begins[state, symbol])


class Vocabulary(dict):
    """Merged pieces by their bytes, as numbers of entries in flat arrays of ids and offsets."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids = array("i")
        self.offsets = array("i")
        self.starts = array("i", [0])

    def __missing__(self, piece: bytes) -> int:
        ids = self.merge(piece) if len(piece) > SHORT_PIECE else self.merge_short(piece)
        at = 0
        for i in ids:
            self.offsets.append(at)
            at += len(self.tokens[i])
        self.ids.extend(ids)
        self.starts.append(len(self.ids))
        entry = len(self.starts) - 2
        if len(piece) <= CACHED_BYTES:
            self[piece] = entry
        return entry

    def merge_short(self, piece: bytes) -> list[int]:
        """As :meth:`merge`, by scanning the ranks of all neighbours; quicker for few bytes."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return [self.ranks[p] for p in parts]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the neighbours of least rank are merged, the leftmost first.

        A heap of neighbours over a linked list, so a long piece takes n log n steps.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (rank := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or len(parts[i]) != a or j >= n or len(parts[j]) != b:
                continue  # one of the two has changed since
            parts[i], parts[j], right[i] = parts[i] + parts[j], None, right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [self.ranks[p] for p in parts if p is not None]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, byte offset of each token in its text, tokens per text)."""
        if len(self) > CACHED_PIECES or len(self.ids) > 16 * CACHED_PIECES:
            self.forget()
        joined = b"".join(texts)
        points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(joined, np.uint8)
        point_at = np.flatnonzero((raw & 0xC0) != 0x80)
        lengths = np.array([len(t) for t in texts], np.int64)
        text_at = np.cumsum(lengths) - lengths
        first = np.zeros(len(points), bool)
        first[np.searchsorted(point_at, text_at[lengths > 0])] = True
        starts = point_at[piece_starts(points, first)]
        bounds = [*starts.tolist(), len(joined)]
        entries = np.fromiter(
            (self[joined[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)),
            np.int64,
            len(starts),
        )
        table = np.frombuffer(self.starts, np.int32).astype(np.int64)
        size = table[entries + 1] - table[entries]
        total = int(size.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(table[entries], size) + inside
        ids = np.frombuffer(self.ids, np.int32)[at] if total else np.zeros(0, np.int32)
        place = np.repeat(starts, size)
        if total:
            place = place + np.frombuffer(self.offsets, np.int32)[at]
        text_of = np.searchsorted(text_at + lengths, place, side="right")
        counts = np.bincount(text_of, minlength=len(texts)) if total else np.zeros(len(texts), int)
        return ids, (place - text_at[text_of]).astype(np.int32), counts

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    """The vocabulary of a rank file (base64 token, rank), loaded once per process."""
    if path not in _LOADED:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        _LOADED[path] = Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs})
    return _LOADED[path]


_TOKENS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("token_ids", pa.list_(pa.int32())),
        ("token_offsets", pa.list_(pa.int32())),
    ]
)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches to (doc_id, token_ids, token_offsets) batches."""
    vocabulary = load(path)
    for x in slices(batches):
        ids, offsets, counts = vocabulary.encode([t or b"" for t in utf8(x.column("text"))])
        bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        yield batch(
            _TOKENS,
            doc_id=x.column("doc_id"),
            token_ids=pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())),
            token_offsets=pa.ListArray.from_arrays(bounds, pa.array(offsets, pa.int32())),
        )


def decode_list(vocabulary: Vocabulary, lists: pa.ListArray) -> list[bytes]:
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [
        vocabulary.decode(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, token_ids, token_offsets (bytes from the start of the text) of every row.

    Null and empty texts have no tokens.  ``path`` must exist on every worker.
    """
    return map_batches(
        _texts(docs, id_col, text_col),
        lambda batches: encode_batches(batches, path),
        "doc_id bigint, token_ids array<int>, token_offsets array<int>",
    )


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded bytes of rows (doc_id, token_ids); null ids decode to null."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        for x in batches:
            lists = [
                None if ids is None else vocabulary.decode(np.array(ids, np.int64))
                for ids in x.column("token_ids").to_pylist()
            ]
            yield batch(schema, doc_id=x.column("doc_id"), decoded=lists)

    return map_batches(tokens.select("doc_id", "token_ids"), run, "doc_id bigint, decoded binary")


_ROUND = "doc_id bigint, n_tokens bigint, ids string, decoded binary"


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by spaces) and the bytes decoded from them.

    Encoding and decoding run in the same worker, so token arrays do not travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        decimal = [str(i) for i in range(len(vocabulary.tokens))]
        for x in encode_batches(batches, path):
            lists = x.column("token_ids")
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            words = [decimal[i] for i in values.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("doc_id"),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(
                        [" ".join(words[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    ),
                    pa.array(decode_list(vocabulary, lists), pa.binary()),
                ],
                names=[part.split()[0] for part in _ROUND.split(", ")],
            )

    return map_batches(_texts(docs, id_col, text_col), run, _ROUND)

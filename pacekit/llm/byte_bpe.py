"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

No regular expression runs over the texts. A batch of UTF-8 text is one byte array:

1. every codepoint becomes one of ten symbols (space, other white space, letter
   kinds, number, apostrophe, anything else) through a class array; the first
   codepoint of a text has its own ten, so texts never touch;
2. the split rule is a small automaton that tells, with each symbol, whether a
   piece starts here or started one codepoint before. A block of symbols is a
   transition function (state in -> state out); functions compose associatively,
   so blocks are folded side by side, a doubling scan composes the blocks, and a
   last sweep from the known entry states gives all piece starts;
3. the distinct pieces of a batch are merged pair by pair (lowest rank first,
   leftmost on ties) behind a cache that lives as long as the worker, and gathered
   back. Each token keeps the byte offset of its start; decoding lays the tokens'
   bytes at these offsets.

Which codepoints are letters, numbers and white space is asked of the tokenizer
library itself, once per worker, so both agree on every codepoint.

Defined cases: null and empty texts have no tokens and decode to nothing; repeated
rows are coded once for each listing and null ids stay null; a text of any length is
coded whole (a piece without a break is merged with a heap, n log n); an empty table
gives no rows; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import whole_text
from pacekit.llm.packing import counted, gather, slices

BATCH_BYTES = 4 << 20
CACHE_PIECES = 200_000
CACHE_LONGEST = 64
BLOCK = 64

# Symbols.
SPACE, BLANK, LETTER, SHORT, REVE, E, L, NUMBER, OTHER, QUOTE = range(10)
SYMBOLS = 10
BLANKS, LETTERS = (SPACE, BLANK), (LETTER, SHORT, REVE, E, L)
# The letters of the split rule's contractions ('s 't 'm 'd, 're 've, 'll).
CONTRACTION_LETTERS = {"s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": REVE, "v": REVE, "e": E, "l": L}

# States: what the codepoints so far end in.
(IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_BLANK, MORE_SPACE, MORE_BLANK,
 QUOTED, QUOTED_REVE, QUOTED_L, SHORTENED) = range(11)
STATES = 11
IN_BLANKS = (ONE_SPACE, ONE_BLANK, MORE_SPACE, MORE_BLANK)
HERE, BEFORE = 1, 2


def _fresh(sym: int) -> int:
    """The state after ``sym`` at the start of a piece."""
    if sym in LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: QUOTED, SPACE: ONE_SPACE, BLANK: ONE_BLANK}[sym]


def _step(state: int, sym: int, first: bool) -> tuple[int, int]:
    """(next state, piece starts told): HERE at this codepoint, BEFORE at the one before it."""
    waiting = BEFORE if state in (QUOTED_REVE, QUOTED_L) else 0    # 'r, 'v or 'l was no contraction
    if first:
        return _fresh(sym), HERE | waiting
    if sym in BLANKS:
        if state in IN_BLANKS:
            return (MORE_SPACE if sym == SPACE else MORE_BLANK), 0
        return _fresh(sym), HERE | waiting
    if state in IN_BLANKS:
        # the last white space of several is split off; a space goes with what follows
        apart = BEFORE if state in (MORE_SPACE, MORE_BLANK) else 0
        if state in (ONE_SPACE, MORE_SPACE):
            return (IN_OTHERS if sym == QUOTE else _fresh(sym)), apart
        return _fresh(sym), apart | HERE
    if state == QUOTED and sym not in (NUMBER, LETTER, E):
        return {SHORT: SHORTENED, REVE: QUOTED_REVE, L: QUOTED_L}.get(sym, IN_OTHERS), 0
    if (state, sym) in ((QUOTED_REVE, E), (QUOTED_L, L)):
        return SHORTENED, 0
    if waiting and sym in LETTERS:
        return IN_LETTERS, BEFORE
    same = ((state == IN_LETTERS and sym in LETTERS) or (state == IN_NUMBERS and sym == NUMBER)
            or (state == IN_OTHERS and sym in (OTHER, QUOTE)))
    return (state, 0) if same else (_fresh(sym), HERE | waiting)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and starts told, by symbol * STATES + state; symbols from SYMBOLS on are first ones."""
    each = [_step(st, sym % SYMBOLS, sym >= SYMBOLS) for sym in range(2 * SYMBOLS) for st in range(STATES)]
    return np.array([e[0] for e in each], np.uint8), np.array([e[1] for e in each], np.uint8)


NEXT, TOLD = _tables()


def piece_starts(symbols: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each symbol; the first symbol must be a first one."""
    n = len(symbols)
    blocks = n // BLOCK + 1                                  # at least one closing first symbol
    rows = np.full(blocks * BLOCK, SYMBOLS, np.int16)
    rows[:n] = symbols
    rows = np.ascontiguousarray((rows * STATES).reshape(blocks, BLOCK).T)
    whole = np.broadcast_to(np.arange(STATES, dtype=np.int16), (blocks, STATES))
    for r in rows:                                           # all blocks side by side, for every state
        whole = NEXT.take(r[:, None] + whole)
    step = 1
    while step < blocks:                                     # doubling scan over the blocks' functions
        whole = np.concatenate([whole[:step], np.take_along_axis(whole[step:], whole[:-step].astype(np.intp), 1)])
        step *= 2
    state = np.concatenate([[0], whole[:-1, 0]]).astype(np.int16)
    told = np.empty((BLOCK, blocks), np.uint8)
    for j, r in enumerate(rows):
        key = r + state
        told[j] = TOLD.take(key)
        state = NEXT.take(key)
    told = told.T.reshape(-1)[:n + 1]
    return ((told[:n] & HERE) | (told[1:] >> 1)).astype(bool)


def _class_array() -> np.ndarray:
    """The symbol of every codepoint, letters, numbers and white space as the library sees them."""
    import tiktoken

    every = np.delete(np.arange(0x110000, dtype="<u4"), np.s_[0xD800:0xE000])
    text = every.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    single = {bytes([i]): i for i in range(256)}
    for symbol, kind in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=single, special_tokens={})
        seen = bytes(probe.encode_ordinary(text)).decode("utf-8")
        out[np.frombuffer(seen.encode("utf-32-le"), "<u4")] = symbol
    for c, symbol in {" ": SPACE, "'": QUOTE, **CONTRACTION_LETTERS}.items():
        out[ord(c)] = symbol
    return out


def codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, codepoint) of every character of valid UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.uint32)
    lead = data[at]
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        own = np.flatnonzero((lead >= low) & (lead < high))
        value = cp[own] & mask
        for k in range(1, more + 1):
            value = (value << 6) | (data[at[own] + k] & 0x3F)
        cp[own] = value
    return at, cp


def binary_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of an Arrow string or binary array."""
    texts = texts.cast(pa.large_binary())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data else np.zeros(0, np.uint8)
    return off - off[0], raw


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary array over ``data`` cut at ``offsets``; nothing is copied."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                              pa.py_buffer(np.ascontiguousarray(data))])


class ByteCoder:
    """Encodes and decodes whole batches by a rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            table[rank] = token
        self.table = pa.array(table, pa.large_binary())
        self.classes = _class_array()
        self.cache: dict[bytes, list[int]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ids = self.cache.get(piece)
        if ids is None:
            own = self.ranks.get(piece)
            ids = [own] if own is not None else merge_pairs(piece, self.ranks)
            if len(piece) <= CACHE_LONGEST:
                if len(self.cache) >= CACHE_PIECES:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def pieces(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte position of every piece start, pieces per text)."""
        at, cp = codepoints(data)
        symbols = self.classes[cp]
        nonempty = offsets[:-1][np.diff(offsets) > 0]
        symbols[np.searchsorted(at, nonempty)] += SYMBOLS
        starts = at[piece_starts(symbols)] if len(at) else at
        return starts, np.diff(np.searchsorted(starts, offsets))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text, byte offset of each id in its text)."""
        offsets, data = binary_parts(texts)
        starts, each = self.pieces(offsets, data)
        coded = binaries(np.append(starts, len(data)), data).dictionary_encode()
        found = [self.merged(p) for p in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        ids, per_piece = gather(pool, size, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        counts = counted(per_piece, each)
        where = self.token_ends(ids)[:-1] - np.repeat(offsets[:-1], counts)
        return ids.astype("<u4"), counts, where

    def token_ends(self, ids: np.ndarray) -> np.ndarray:
        """0 and the end of every token's bytes, all tokens in a row."""
        if not hasattr(self, "lengths"):
            self.lengths = np.diff(np.frombuffer(self.table.buffers()[1], np.int64)[:len(self.table) + 1])
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray, counts: np.ndarray, where: np.ndarray | None = None) -> pa.Array:
        """The bytes of each text; with ``where`` the tokens must lie at these offsets, gapless."""
        token = self.table.take(pa.array(ids.astype(np.int64)))
        off, data = binary_parts(token)
        ends = off[np.concatenate([[0], np.cumsum(counts)])]
        if where is not None and not np.array_equal(off[:-1] - np.repeat(ends[:-1], counts), where):
            raise ValueError("token offsets do not fit the tokens")
        return binaries(ends, data)


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte pairs of a piece, the lowest rank (then the leftmost) merged first until none is left."""
    n = len(piece)
    end = list(range(1, n + 1))                               # end of the part that starts here, 0 once merged away
    before = list(range(-1, n - 1))                           # start of the part before
    heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i:i + 2]) in ranks]
    heapq.heapify(heap)

    def offer(a: int) -> None:
        if a >= 0 and end[a] < n:
            stop = end[end[a]]
            rank = ranks.get(piece[a:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, a, stop))

    while heap:
        _, a, stop = heapq.heappop(heap)
        b = end[a]
        if not b or b >= n or end[b] != stop:
            continue
        end[a], end[b] = stop, 0
        if stop < n:
            before[stop] = a
        offer(before[a])
        offer(a)
    out, a = [], 0
    while a < n:
        out.append(ranks[piece[a:end[a]]])
        a = end[a]
    return out


_coders: dict[str, ByteCoder] = {}


def coder(path: str) -> ByteCoder:
    """One coder per worker process; its cache outlives the task."""
    if path not in _coders:
        _coders[path] = ByteCoder(path)
    return _coders[path]


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One packed binary of little-endian unsigned 32-bit numbers per text."""
    return binaries(4 * np.concatenate([[0], np.cumsum(counts)]), flat.astype("<u4").view(np.uint8))


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids, starts): the token ids of each text and the byte offset of each token.

    Both are packed as little-endian unsigned 32-bit numbers, the usual form of token
    files; :func:`unpacked` reads them as arrays.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, BATCH_BYTES):
                ids, counts, where = own.encode(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), _lists(ids, counts).cast(pa.binary()),
                     _lists(where, counts).cast(pa.binary())], names=["doc_id", "ids", "starts"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, starts binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Rows (doc_id, ids, decoded): the bytes that the ids stand for, laid at the kept offsets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path)
        for batch in batches:
            packed = batch.column("ids")
            for a, b in slices(packed, 4 * BATCH_BYTES):
                rows = batch.slice(a, b - a)
                off, data = binary_parts(rows.column("ids"))
                _, where = binary_parts(rows.column("starts"))
                decoded = own.decode(data.view("<u4"), np.diff(off) // 4, where.view("<u4"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("ids"), decoded.cast(pa.binary())],
                    names=["doc_id", "ids", "decoded"])
            pa.default_memory_pool().release_unused()

    return encoded.select("doc_id", "ids", "starts").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def unpacked(packed: bytes) -> list[int]:
    """The numbers of a packed column's value."""
    return np.frombuffer(packed, "<u4").tolist()

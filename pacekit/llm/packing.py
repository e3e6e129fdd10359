"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Texts are tokenized once per batch: the distinct words of a batch are encoded
by the tokenizer and gathered back. With ``with_ids=True``, as the registered
queries have it, the token ids go along into the sequences and the checksums are
taken from there; without, only piece lengths and checksums leave the task.

A document is cut into full windows and a remainder, the remainder into pieces
of at most ``cut`` tokens: small pieces are what differencing needs to balance.
Full pieces are windows of their own. The rest is spread over groups by a hash
of the document; a group holds about ``WINDOWS`` windows of tokens, whatever the
corpus or the size of a source, and is packed in one task. A group far above that - the
listings of one document all hash alike - is dealt out by listing:

* every piece starts as a partial partition of k windows, one of them filled;
* the two partitions with the largest spread are merged, the fullest windows of
  one onto the emptiest of the other, until one is left;
* if its fullest window exceeds the capacity, k rises and the group is packed
  again. k starts at the least count that could hold the tokens.

Defined cases: null and empty texts are one piece of one token (the end id);
repeated rows are packed once for each listing; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pacekit.llm.common import arrow_batches, released, stored, whole_text

END_ID = 1
CAPACITY = 2048
CUT = 256
WINDOWS = 128
GROUP_PIECES = 20_000
BATCH_BYTES = 4 << 20                          # of text at a time; a worker holds about 20 bytes for each
ARROW_BYTES = BATCH_BYTES - (512 << 10)        # of rows that reach a worker in one Arrow batch: one slice of text
JOINED = 256                                   # pieces that go through the merges in one call


class WordEncoder:
    """Token ids of whole texts, the same as the tokenizer gives.

    The tokenizer drops white space and never joins across it, so a text is the
    concatenation of its words. Texts are split, and words that occur again in a
    batch are told, by Arrow's kernels. Words of plain letters, digits and signs
    are lower-cased and cut by the tokenizer's published rule, and each distinct
    piece of a batch goes through the tokenizer's merges once, many to a call: the
    last token of a piece is marked as such in the vocabulary. Any other word, and
    any text with unusual white space, control characters or an added token's
    literal, goes through the whole tokenizer.
    """

    # Unusual white space and controls, in RE2 syntax.
    ODD = r"[\x00-\x08\x0e-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2060}\x{3000}\x{feff}]"
    # Not: letters below U+0250 that NFC leaves alone and that lower-case one to one, digits, ASCII signs
    # but the apostrophe (the tokenizer's contractions go the long way).
    NOT_PLAIN = r"[^!-&(-~\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]"
    # The tokenizer's split rule.
    PIECES = r"(\pL+|\pN|[^\pL\pN]+)"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([self.ODD, *[f"(?i:{re.escape(t)})" for t in added]])
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(END_ID, *vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.letters = byte_letters()
        self.kept = np.dtype("<u2" if len(self.last) <= 1 << 16 else "<u4")   # holds every id of the vocabulary

    def long_way(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and the number of ids of each."""
        out = [np.zeros(0, np.uint32)]
        for i in range(0, len(pieces), JOINED):
            seen = [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
                    for p in pieces[i:i + JOINED]]
            coded, = self.merges.encode_batch_fast([" ".join(seen)], add_special_tokens=False)
            out.append(np.array(coded.ids, np.uint32))
        ids = np.concatenate(out)
        each = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(each) != len(pieces) - pieces.count(""):
            raise ValueError("the vocabulary does not mark the last token of a word")
        size = np.zeros(len(pieces), np.int64)               # none for an empty piece
        size[[p != "" for p in pieces]] = each
        return ids, size

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and the number of ids of each word."""
        plain = ~pc.match_substring_regex(words, self.NOT_PLAIN).to_numpy(zero_copy_only=False)
        lower = pc.utf8_lower(words.filter(pa.array(plain)))
        letters = pc.utf8_is_alpha(lower).to_numpy(zero_copy_only=False)    # one piece: nothing to cut
        single, rest = lower.filter(pa.array(letters)), lower.filter(pa.array(~letters))
        stem, sign = pc.utf8_slice_codeunits(rest, 0, -1), pc.utf8_slice_codeunits(rest, -1)
        ended = pc.and_not(pc.utf8_is_alpha(stem), pc.utf8_is_alpha(sign))    # letters and one sign: two pieces
        stem, sign = stem.filter(ended), sign.filter(ended)
        mixed = pc.replace_substring_regex(rest.filter(pc.invert(ended)), self.PIECES, r"\1 ")
        parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(mixed))
        coded = pa.chunked_array([single, stem, sign, parts.flatten()]).combine_chunks().dictionary_encode()
        pool, size = self.merged(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        others = [np.array(self.long_way(w), np.uint32) for w in words.filter(pa.array(~plain)).to_pylist()]
        known = len(size)
        size = np.concatenate([size, np.array([len(x) for x in others], np.int64)])
        pool = np.concatenate([pool, *others])
        two = ended.to_numpy(zero_copy_only=False)
        kind = np.where(plain, 1, 0)                         # 0: the long way, 1: letters, 2: letters and sign, 3: cut
        kind[np.flatnonzero(plain)[~letters]] = np.where(two, 2, 3)
        pieces = np.maximum(kind, 1)                         # a word taken the long way is one piece
        pieces[kind == 3] = np.diff(np.asarray(parts.offsets))
        own = np.repeat(kind, pieces)
        at = np.empty(len(own), np.int64)
        index = coded.indices.to_numpy(zero_copy_only=False)
        a, b, c = np.cumsum([len(single), len(stem), len(sign)])
        at[own == 0] = known + np.arange(len(others))
        at[own == 1], at[own == 3] = index[:a], index[c:]
        at[own == 2] = np.column_stack([index[a:b], index[b:c]]).ravel()
        ids, each = gather(pool, size, at)
        return ids, counted(each, pieces)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        whole = {int(i): texts[int(i)].as_py() for i in odd}
        if whole:
            plain = np.ones(len(texts), bool)
            plain[odd] = False
            texts = pc.if_else(pa.array(plain), texts, pa.scalar("", texts.type))
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten().dictionary_encode()
        pool, size = self.words(flat.dictionary)
        ids, each = gather(pool, size, flat.indices.to_numpy(zero_copy_only=False))
        counts = counted(each, np.diff(np.asarray(split.offsets)))
        if whole:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, t in whole.items():
                parts[i] = np.array(self.long_way(t), np.uint32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts


def gather(pool: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``at`` of a pool of runs of ``size``, in a row, and the length of each."""
    first, each = np.cumsum(size) - size, size[at]
    shift = first[at] - (np.cumsum(each) - each)
    return pool[np.repeat(shift, each) + np.arange(int(each.sum()))], each


def counted(each: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Sums of ``each`` over consecutive groups of the given lengths."""
    total = np.concatenate([[0], np.cumsum(each)])
    ends = np.concatenate([[0], np.cumsum(groups)])
    return total[ends[1:]] - total[ends[:-1]]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet by its rule: printable Latin-1 stands for itself, the rest follows U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + n) for n, b in enumerate(rest)}


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; its word cache outlives the task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text (a longer text is a range of its own)."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + limit)))
        yield a, b
        a = b


def cuts(n: int, capacity: int = CAPACITY, cut: int = CUT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    out = [(s, capacity) for s in range(0, n - capacity + 1, capacity)]
    out += [(s, min(cut, n - s)) for s in range(n // capacity * capacity, n, cut)]
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", capacity: int = CAPACITY, cut: int = CUT,
                 with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, doc_tokens, pieces array<(start, length, ids_crc32[, ids])>).

    ``ids`` has the ids as little-endian integers of two bytes, of four where the vocabulary needs them.
    """
    ids_type = ", ids: binary" if with_ids else ""
    kind = f"doc_id long, doc_tokens long, pieces array<struct<start: long, length: long, ids_crc32: long{ids_type}>>"

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                ids, counts = enc.batch(texts.slice(a, b - a))
                first = np.cumsum(counts + 1) - counts - 1
                tokens = np.full(len(ids) + len(counts), END_ID, "<u4")
                tokens[np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
                own = [cuts(n + 1, capacity, cut) for n in counts.tolist()]
                each = np.array([len(c) for c in own], np.int64)
                start, length = np.array(list(chain.from_iterable(own)), np.int64).reshape(-1, 2).T
                at = np.repeat(first, each) + start
                fields = [pa.array(start), pa.array(length), pa.array(checksums(tokens, at, length))]
                if with_ids:                               # the pieces lie in a row in ``tokens``
                    fields.append(byte_runs(at, tokens.astype(enc.kept)))
                pieces = pa.StructArray.from_arrays(fields, fields=list(arrow_kind(with_ids).value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts + 1),
                     runs(np.cumsum(each) - each, pieces)],
                    names=["doc_id", "doc_tokens", "pieces"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(released(run), kind)


def checksums(tokens: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of little-endian ids."""
    return np.array([zlib.crc32(tokens[a:a + m]) for a, m in zip(at.tolist(), length.tolist(), strict=True)], np.int64)


def runs(at: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Lists that begin ``at`` and cover the values."""
    return pa.ListArray.from_arrays(pa.array(np.append(at, len(values)).astype(np.int32)), values)


def byte_runs(at: np.ndarray, values: np.ndarray) -> pa.Array:
    """The bytes of runs that begin ``at`` and cover the values."""
    ends = (np.append(at, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def run_values(data: pa.Array, values: int) -> np.ndarray:
    """What :func:`byte_runs` holds, as 32-bit integers; ``values`` is their number."""
    ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1]
    width = int(ends[-1] - ends[0]) // max(1, values)
    return np.frombuffer(data.buffers()[2], f"<u{width}", values, int(ends[0])).astype("<u4")


def arrow_kind(with_ids: bool) -> pa.DataType:
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    return pa.list_(pa.struct(fields + ([("ids", pa.binary())] if with_ids else [])))


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: (window of each item, sum of each window) for k windows."""
    n = len(sizes)
    # node x < n is item x; a merged window is a node with two children
    left, right = np.full(2 * n + 1, -1), np.full(2 * n + 1, -1)
    free = n
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for x, s in enumerate(sizes.tolist()):      # sums ascending; the last window holds the item
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1)
        sums[-1], nodes[-1] = s, x
        heap.append((-s, x, sums, nodes))
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        sums, other = sa + sb[::-1], nb[::-1]   # the fullest of one meets the emptiest of the other
        nodes = np.where(na < 0, other, na)
        both = np.flatnonzero((na >= 0) & (other >= 0))
        fresh = np.arange(free, free + len(both))
        left[fresh], right[fresh], nodes[both] = na[both], other[both], fresh
        free += len(both)
        order = np.argsort(sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), tick, sums, nodes))
        tick += 1
    _, _, sums, nodes = heap[0]
    window = np.full(free, -1)
    filled = np.flatnonzero(nodes >= 0)
    window[nodes[filled]] = filled
    for x in range(free - 1, n - 1, -1):        # children come before their parents
        window[left[x]] = window[right[x]] = window[x]
    return window[:n], sums


def pack_items(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each item; no window above the capacity, their count as low as differencing gets."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, sums = difference(sizes, k)
        if sums[-1] <= capacity:
            return window
        k += 1


def totals() -> list[Column]:
    return [F.sum("doc_tokens").alias("tokens"), F.sum(F.size("pieces")).alias("pieces")]


def pack(pieces: DataFrame, capacity: int = CAPACITY, windows: int = WINDOWS, size: dict | None = None) -> DataFrame:
    """Give every piece of :func:`token_pieces` its sequence_id and offset; if it has ids, ids_crc32 is
    taken from the packed sequence. ``size`` has the :func:`totals` where they are known."""
    rows = pieces.select("doc_id", "doc_tokens", F.monotonically_increasing_id().alias("_at"),
                         F.explode("pieces").alias("p")).select("doc_id", "doc_tokens", "_at", "p.*")
    size = size or pieces.agg(*totals()).first().asDict()
    groups = max(1, -(-(size["tokens"] or 0) // (capacity * windows)), -(-(size["pieces"] or 0) // GROUP_PIECES))
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("long")
    rows = rows.withColumn("_hash", group)
    # a document listed very often fills one group: what is far above the mean is dealt out by listing
    crowd = F.greatest(F.sum("length") / (3 * capacity * windows), F.count(F.lit(1)) / (2 * GROUP_PIECES))
    crowded = stored(rows.groupBy("_hash").agg(F.ceil(crowd).alias("_parts")).filter("_parts > 1"), "crowded")
    if crowded.isEmpty():                           # as a rule; the pieces are then shuffled once
        rows = rows.withColumn("_group", F.col("_hash"))
    else:
        rows = rows.join(crowded, "_hash", "left").withColumn(
            "_group", F.col("_hash") + F.lit(groups) * F.pmod("_at", F.coalesce("_parts", F.lit(1))))
    carried = [c for c in rows.columns if not c.startswith("_")]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.select(carried).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        length = table["length"].to_numpy()
        window = np.arange(len(length))             # the full pieces come first, a window each
        n = int((length == capacity).sum())
        if n < len(length):
            window[n:] = n + pack_items(length[n:], capacity)
        order = np.argsort(window, kind="stable")
        window, length = window[order], length[order]
        starts = np.flatnonzero(np.diff(window, prepend=-1))
        run_of = np.cumsum(np.diff(window, prepend=-1) != 0) - 1
        before = np.cumsum(length) - length
        tokens = np.add.reduceat(length, starts)
        table = table.take(pa.array(order))
        if "ids" in carried:                        # in a row, the sequences one after another
            packed = run_values(pa.concat_arrays(table["ids"].chunks).cast(pa.binary()), int(length.sum()))
            table = table.set_column(carried.index("ids_crc32"), "ids_crc32",
                                     pa.array(checksums(packed, before, length)))
            table = table.set_column(carried.index("ids"), "ids", runs(before, pa.array(packed.view(np.int32))))
        for name, values in (("sequence_id", key[0].as_py() * (1 << 24) + window),
                             ("offset", before - before[starts][run_of]), ("sequence_tokens", tokens[run_of])):
            table = table.append_column(name, pa.array(values.astype(np.int64)))
        return table

    kinds = dict(rows.dtypes) | {"ids": "array<int>"}
    schema = ", ".join(f"{c} {kinds[c]}" for c in carried) + ", sequence_id long, offset long, sequence_tokens long"
    return rows.select("_group", *carried).groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   with_ids: bool = False, **kw) -> DataFrame:
    """One row per piece: doc_id, doc_tokens, start, length, ids_crc32[, ids], sequence_id, offset,
    sequence_tokens, padded_length (the capacity, or the tokens where they are a power of two)."""
    seen = Observation()                            # the write counts what it writes
    pieces = token_pieces(docs, tokenizer_path, capacity=capacity, with_ids=with_ids, **kw)
    with arrow_batches(docs.sparkSession, ARROW_BYTES):
        pieces = stored(pieces.observe(seen, *totals()), "pieces")
    out = pack(pieces, capacity, size=seen.get)
    power = F.expr("sequence_tokens & (sequence_tokens - 1)") == 0
    return out.withColumn("padded_length", F.when(power, F.col("sequence_tokens")).otherwise(F.lit(capacity)).cast("long"))

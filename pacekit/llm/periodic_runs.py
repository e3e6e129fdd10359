"""Periodic runs of words: block convolution at dyadic scales, seeds extended to whole runs.

A run is a maximal stretch of consecutive words with smallest period q that is at least
``least`` words and ``times`` periods long. At scale B (1, 2, 4, ...) the words are cut into
blocks of B. A run with B <= q < 2B and at least three periods holds a whole block together
with that block's next occurrence q words on, so it is enough to ask, for every block, at
which distances d in [B, 2B) it occurs again in the window that follows. The sums of squared
differences between block and window are a convolution, taken for all d at once by a number
theoretic transform over the integers modulo a prime: a sum of zero is an occurrence.

* Blocks in which some word does not recur within 2B hold no such run; blocks that lie with
  their window inside a known run hold no other one (Fine and Wilf). Neither is transformed.
* An occurrence (block, d) is a seed: the stretch around it in which words d apart are equal
  is found by bisecting on prefix hashes, and every stretch kept is compared word by word,
  so neither the modulus nor a hash can bring in a wrong run.
* A stretch found at a multiple of its period is the same stretch as at its period.

Texts are taken in batches and never touch: equal words of two texts have two numbers.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text;
repeated rows are searched once for each listing and null ids stay null; runs that overlap
are all told; a text of any length is searched whole, in O(n log^2 n) steps; an empty table
gives no rows; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacekit.llm.byte_bpe import binaries, binary_parts
from pacekit.llm.common import WORD, text_crc32, whole_text
from pacekit.llm.packing import counted, slices

LEAST, TIMES = 6, 4
BATCH_BYTES = 4 << 20
ROOM = 1 << 20                    # numbers transformed at a time (one block's window may be longer)
MOD, ROOT = 998_244_353, 3        # 119 * 2**23 + 1 and a generator of its units
HASH_MOD, HASH_BASE = (1 << 31) - 1, 1_220_703_125
ROW = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@lru_cache(maxsize=64)
def _twiddles(m: int, inverse: bool) -> np.ndarray:
    """The first m/2 powers of an m-th root of unity."""
    w = pow(ROOT, (MOD - 1) // m, MOD)
    return powers(pow(w, MOD - 2, MOD) if inverse else w, max(1, m // 2), MOD)


def powers(base: int, n: int, mod: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo ``mod`` (below 2**31), by doubling."""
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * np.uint64(pow(base, have, mod)) % np.uint64(mod)
        have += take
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Number theoretic transform of each row; the result is in bit-reversed order."""
    count, size = rows.shape
    mod = np.uint64(MOD)
    m = size
    while m > 1:
        a = rows.reshape(count, size // m, 2, m // 2)
        low, high = a[:, :, 0], a[:, :, 1]
        a = np.stack([(low + high) % mod, (low + mod - high) * _twiddles(m, False) % mod], 2)
        rows, m = a.reshape(count, size), m // 2
    return rows


def inverse(rows: np.ndarray) -> np.ndarray:
    """The inverse of :func:`transform`."""
    count, size = rows.shape
    mod = np.uint64(MOD)
    m = 2
    while m <= size:
        a = rows.reshape(count, size // m, 2, m // 2)
        low, high = a[:, :, 0], a[:, :, 1] * _twiddles(m, True) % mod
        rows, m = np.stack([(low + high) % mod, (low + mod - high) % mod], 2).reshape(count, size), 2 * m
    return rows * np.uint64(pow(size, MOD - 2, MOD)) % mod


def occurrences(x: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, d): the blocks x[start:start + size] that occur again at start + d, size <= d < 2 * size.

    The sum of squared differences is zero modulo the prime there; elsewhere it is zero only
    by chance (the caller compares the words).
    """
    mod = np.uint64(MOD)
    padded = np.concatenate([x.astype(np.uint64), np.full(3 * size, x.max() + 1 if len(x) else 0, np.uint64)])
    found_at, found_d = [], []
    each = max(1, ROOM // (4 * size))
    for k in range(0, len(at), each):
        own = at[k:k + each]
        window = padded[own[:, None] + np.arange(3 * size)]
        rows = np.zeros((2, len(own), 4 * size), np.uint64)
        rows[0, :, :size] = window[:, size - 1::-1] if size > 1 else window[:, :1]
        rows[1, :, :3 * size] = window
        rows = transform(rows.reshape(-1, 4 * size)).reshape(rows.shape)
        cross = inverse(rows[0] * rows[1] % mod)[:, 2 * size - 1:3 * size - 1]     # d = size .. 2 * size - 1
        squares = np.cumsum(window * window % mod, axis=1)
        own_sum = squares[:, size - 1:size]
        ends = squares[:, 2 * size - 1:3 * size - 1]
        sums = ends - squares[:, size - 1:2 * size - 1]
        row, d = np.nonzero((own_sum + sums + 2 * (mod - cross)) % mod == 0)
        found_at.append(own[row])
        found_d.append(d + size)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_at]), np.concatenate([empty, *found_d])


class Hashes:
    """Prefix hashes of a sequence: how far two places agree, for many pairs at a time."""

    def __init__(self, x: np.ndarray):
        self.n, mod = len(x), np.uint64(HASH_MOD)
        self.power = powers(HASH_BASE, self.n + 1, HASH_MOD)
        own = (x.astype(np.uint64) + np.uint64(1)) % mod * self.power[:-1] % mod
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own) % mod])

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        mod, p = np.uint64(HASH_MOD), self.prefix
        left = (p[a + length] + mod - p[a]) % mod * self.power[b - a] % mod
        return left == (p[b + length] + mod - p[b]) % mod

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the longest agreement from a < b on (or of what ends before them)."""
        room = self.n - b if forward else a
        have = np.zeros(len(a), np.int64)
        step = 1 << max(0, int(room.max(initial=0)).bit_length() - 1)
        while step:
            more = have + step
            ok = more <= room
            i = np.flatnonzero(ok)
            start = (a[i], b[i]) if forward else (a[i] - more[i], b[i] - more[i])
            ok[i] = self.same(*start, more[i])
            have = np.where(ok, more, have)
            step >>= 1
        return have


def next_same(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Distance from each place to the next equal number (a huge one if there is none)."""
    gap = np.full(len(x), np.iinfo(np.int64).max // 2)
    again = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return gap


def exact(x: np.ndarray, start: int, end: int, d: int) -> list[tuple[int, int, int]]:
    """The stretches of [start, end) in which words d apart are equal, compared one by one."""
    equal = x[start:end - d] == x[start + d:end]
    if equal.all():
        return [(start, end, d)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]])))
    return [(start + a, start + b + d, d) for a, b in edges.reshape(-1, 2).tolist()]


def periodic_runs(x: np.ndarray, gap: np.ndarray, longest: int, least: int = LEAST,
                  times: int = TIMES) -> np.ndarray:
    """All runs (start, end, period) of ``x``, by start, then period. ``longest``: of a text."""
    if times < 3:
        raise ValueError("a run needs three periods for a block and its next occurrence")
    n = len(x)
    runs = np.zeros((0, 3), np.int64)
    hashes = Hashes(x)
    size = 1
    while times * size <= longest:
        blocks = n // size
        at = size * np.flatnonzero(gap[:blocks * size].reshape(blocks, size).max(1) < 2 * size)
        covered = np.zeros(n, np.int64)                      # furthest end of a known run that holds the place
        np.maximum.at(covered, runs[:, 0], runs[:, 1])
        covered = np.maximum.accumulate(covered) if n else covered
        at = at[covered[at] < np.minimum(at + 3 * size, n)]
        i, d = occurrences(x, at, size)
        ok = (i + size + d <= n) & (covered[i] < i + size + d)
        i, d = i[ok], d[ok]
        right = hashes.agree(i, i + d, True)
        start, end = i - hashes.agree(i, i + d, False), i + d + right
        ok = (right >= size) & (end - start >= np.maximum(least, times * d))
        told = np.unique(np.stack([start[ok], end[ok], d[ok]], 1), axis=0)
        told = [r for s, e, q in told.tolist() for r in exact(x, s, e, q) if r[1] - r[0] >= max(least, times * q)]
        runs = np.concatenate([runs, np.array(told, np.int64).reshape(-1, 3)])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        first = np.ones(len(runs), bool)                     # of one stretch the smallest period
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
        runs = runs[first]
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words in a row, length of each word, words per text)."""
    offsets, data = binary_parts(texts)
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    compact = np.concatenate([[0], np.cumsum(inside)])
    length = np.diff(np.append(compact[starts], compact[-1]))
    return data[inside], length, np.diff(np.searchsorted(starts, offsets))


def joined(data: np.ndarray, length: np.ndarray, counts: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    text = np.repeat(np.arange(len(counts)), counts)[kept]
    own = length[kept]
    last = np.ones(len(own), bool)
    last[:-1] = text[1:] != text[:-1]
    room = own + ~last
    out = np.full(int(room.sum()), 0x20, np.uint8)
    shift = (np.cumsum(room) - room) - (np.cumsum(own) - own)
    out[np.repeat(shift, own) + np.arange(int(own.sum()))] = data[np.repeat(kept, length)]
    ends = np.concatenate([[0], np.cumsum(room)])
    return binaries(ends[np.searchsorted(text, np.arange(len(counts) + 1))], out).cast(pa.string())


def search(texts: pa.Array, least: int = LEAST, times: int = TIMES) -> list[pa.Array]:
    """Columns (n_words, runs, collapsed) of a batch of texts."""
    data, length, counts = words_of(texts)
    n = len(length)
    coded = binaries(np.concatenate([[0], np.cumsum(length)]), data).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    key = text * (len(coded.dictionary) + 1) + number
    order = np.argsort(key, kind="stable")
    x = np.empty(n, np.int64)                                # dense numbers of (text, word)
    x[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
    runs = periodic_runs(x, next_same(x, order), int(counts.max(initial=0)), least, times)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change)[:n] == 0
    first = np.concatenate([[0], np.cumsum(counts)])
    own = np.searchsorted(runs[:, 0], first)
    place = runs[:, 0] - np.repeat(first[:-1], np.diff(own))
    fields = [pa.array(place), pa.array(runs[:, 1] - runs[:, 0]), pa.array(np.ascontiguousarray(runs[:, 2]))]
    told = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), told)
    return [pa.array(counts.astype(np.int64)), lists, joined(data, length, counts, kept)]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              times: int = TIMES) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed): all runs of each text, by start, then period, and the
    text without what its runs repeat (the words of a run after its first period)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, BATCH_BYTES):
                columns = search(texts.slice(a, b - a), least, times)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, ROW)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): every tenth text by the hash of its id ends in a run, known by rule.

    With h = crc32 of the decimal id and g = h div 10: where h mod 10 is 0, the words from
    a = g mod n on repeat the first p = 1 + (n - a) div (3 + g mod 8) of them. Null ids have no hash.
    """
    h = text_crc32(F.col(id_col).cast("string"))
    g = F.expr("_h div 10")

    def plant(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(F.col("_g"), F.greatest(n, F.lit(1)))

        def repeat(bounds: Column) -> Column:
            first, period = bounds["a"], bounds["p"]
            tail = F.transform(F.sequence(first, F.size(w) - 1), lambda i: F.get(w, first + F.pmod(i - first, period)))
            return F.array_join(F.concat(F.slice(w, F.lit(1), first), tail), " ")

        p = F.floor((n - a) / (F.lit(3) + F.pmod(F.col("_g"), F.lit(8)))) + 1
        bounds = F.struct(a.cast("int").alias("a"), p.cast("int").alias("p"))
        return F.when(n > 0, F.get(F.transform(F.array(bounds), repeat), F.lit(0))).otherwise(F.lit(""))

    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    planted = F.get(F.transform(F.array(words), plant), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
                       h.alias("_h")).withColumn("_g", g)
    return rows.select("doc_id", F.when(F.col("_h") % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of the runs and the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    b = found.withColumn("_b", best)
    length, period = -F.col("_b.neg"), F.col("_b.period")
    return b.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(length * F.lit(1000) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))

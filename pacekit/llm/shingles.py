"""Shingle sets as sorted 64-bit hashes, and the slice keys that near sets must share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = 3) -> Iterator[np.ndarray]:
    """The distinct ``width``-word shingles of each text, as sorted 64-bit hashes.

    A to Z are lower-cased; words are runs of anything but ASCII white space. A
    text of fewer words is one shingle, a text without words has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    flat = split.flatten().dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in distinct),
                      np.uint64, len(distinct))
    words = own[flat.indices.to_numpy(zero_copy_only=False)]
    ends = np.asarray(split.offsets) - split.offsets[0].as_py()
    blank = {i for i, w in enumerate(distinct) if w == ""}
    first = flat.indices.to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        if len(words) >= width:
            runs = words[:len(words) - width + 1].copy()
            for k in range(1, width):
                runs = mix(runs * MULTIPLIER + words[k:len(words) - width + 1 + k])
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            n = b - a
            if n == 0 or (n == 1 and first[a] in blank):
                yield np.empty(0, np.uint64)
            elif n < width:
                x = np.full(1, n, np.uint64)
                for w in words[a:b]:
                    x = mix(x * MULTIPLIER + w)
                yield x
            else:
                yield np.unique(runs[a:b - width + 1])


def set_key(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        a, b = mix(s ^ MULTIPLIER).sum(dtype=np.uint64), mix(s + MULTIPLIER).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


class SliceKeys:
    """Keys of which any two sets of Jaccard similarity ``percent`` or more share some.

    Sets of about the same size form a class; a pair that links differs in at
    most k elements, where k follows from the class's largest size. Hash ranges
    cut the sets of a class into k + t slices, so at least t slices of a linked
    pair are equal: seen in one slice, the two lie at distance 0. A set with e
    empty slices (e < t) leaves those out and still shares t - e keys, so by
    the prefix principle it may also forgo its t - e - 1 most frequent keys, if
    all sets use one order of frequency; one with more empty slices keeps them
    all. Classes with k = 0 need no keys: only equal sets link there. The low
    byte of a key is its class.
    """

    GROWTH = 1.5

    def __init__(self, percent: int):
        self.percent = percent
        self.starts, self.slices, self.equal = [1], [], []
        while self.starts[-1] < 1 << 40:
            nxt = max(self.starts[-1] * 100 // percent + 2, int(self.starts[-1] * self.GROWTH))
            k = 2 * (nxt - 1) * (100 - percent) // (100 + percent)
            self.equal.append(3 + k // 6)
            self.slices.append(k + self.equal[-1] if k else 0)
            self.starts.append(nxt)

    def classes(self, n: int) -> list[int]:
        """The class of size n, and the next if n may link to its sizes."""
        c = int(np.searchsorted(self.starts, n, side="right")) - 1
        return [c, c + 1] if 100 * n >= self.percent * self.starts[c + 1] else [c]

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(keys, [class, how many keys it may forgo, ...])."""
        out, forgo = [], []
        with np.errstate(over="ignore"):
            for c in self.classes(len(s)) if len(s) else ():
                m, t = self.slices[c], self.equal[c]
                if not m:
                    continue
                piece = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)     # ascending, as s is
                at = np.flatnonzero(np.diff(piece, prepend=np.uint64(m)))
                content = np.add.reduceat(mix(s ^ np.uint64(0xD6E8FEB86659FD93)), at)
                salt = np.uint64(c << 32)
                keys = mix(content + mix(piece[at] + salt))
                empty = m - len(at)
                if empty >= t:
                    none = np.setdiff1d(np.arange(m, dtype=np.uint64), piece[at])
                    keys = np.concatenate([keys, mix(mix(none + salt) ^ MULTIPLIER)])
                out.append(keys & ~np.uint64(255) | np.uint64(c))
                forgo += [c, max(0, t - empty - 1)]
        return (np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)), forgo

"""Periodic runs against a quadratic search; the transform against plain sums."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pacekit.llm import periodic_runs as R
from pacekit.llm.queries import op13_periodic_runs
from tests.llm.helpers import awkward, clashing, docs


def brute(w, least=6, times=4):
    out, seen = [], set()
    for q in range(1, len(w) // times + 1):
        j = 0
        while j + q < len(w):
            start = j
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > start:
                end = j + q
                if end - start >= max(least, times * q) and (start, end) not in seen:
                    seen.add((start, end))
                    out.append((start, end - start, q))
            else:
                j += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def left(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts(n, seed):
    random.seed(seed)
    out = ["", " ", "a", "\n a", "a " * 5, "a " * 6]
    for _ in range(n):
        k, w = random.choice([1, 2, 2, 3, 5, 50]), []
        for _ in range(random.randint(0, 6)):
            unit = [random.randint(0, k) for _ in range(random.randint(1, 9))]
            size = random.randint(1, 60)
            w += [unit[i % len(unit)] for i in range(size)] if random.random() < .6 else [
                random.randint(0, k) for _ in range(size // 3)]
        out.append(random.choice([" ", "\t\n", "  "]).join(f"w{x}" for x in w) + random.choice(["", " "]))
    return out


@pytest.mark.parametrize("least, times", [(6, 4), (2, 3), (40, 5)])
def test_runs_as_a_quadratic_search_finds_them(least, times):
    every = texts(800, least)
    n, runs, collapsed = R.search(pa.array(every), least, times)
    for t, k, r, c in zip(every, n.to_pylist(), runs.to_pylist(), collapsed.to_pylist(), strict=True):
        w = t.split()
        want = brute(w, least, times)
        assert k == len(w) and [(x["start"], x["length"], x["period"]) for x in r] == want
        assert c == left(w, want)


@pytest.mark.parametrize("words, want", [
    (["a"] * 100_000, [(0, 100_000, 1)]),
    (["a"] * 30_000 + ["b"] + ["a"] * 30_000, [(0, 30_000, 1), (30_001, 30_000, 1)]),
    ([str(i % 5000) for i in range(100_000)], [(0, 100_000, 5000)]),
    ([str(i) for i in range(50_000)], [])])
def test_very_long_texts(words, want):
    _, runs, _ = R.search(pa.array([" ".join(words)]))
    assert [(r["start"], r["length"], r["period"]) for r in runs[0].as_py()] == want


def test_transform_and_occurrences():
    rng = np.random.default_rng(3)
    for size in (1, 2, 8, 64):
        rows = rng.integers(0, R.MOD, (3, 4 * size)).astype(np.uint64)
        assert (R.inverse(R.transform(rows)) == rows).all()
        x = rng.integers(0, 2 if size < 8 else 3, 40 * size)
        x[10 * size:14 * size] = np.resize(x[10 * size:10 * size + size + size // 2], 4 * size)
        at = np.arange(0, len(x) - 3 * size, size)
        want = {(i, d) for i in at.tolist() for d in range(size, 2 * size)
                if (x[i:i + size] == x[i + d:i + d + size]).all()}
        i, d = R.occurrences(x, at, size)
        assert set(zip(i.tolist(), d.tolist(), strict=True)) == want and want


def test_hash_collisions_cannot_bring_in_a_run(monkeypatch):
    """With a hash of two values nearly every bisection is wrong; what is kept is still compared."""
    every = texts(60, 9)
    monkeypatch.setattr(R, "HASH_MOD", 2)
    _, runs, _ = R.search(pa.array(every))
    for t, r in zip(every, runs.to_pylist(), strict=True):
        w = t.split()
        for x in r:
            s, n, q = x["start"], x["length"], x["period"]
            assert all(w[j] == w[j + q] for j in range(s, s + n - q))


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left(w, runs).encode()).hexdigest())


def test_digests_and_planting(spark):
    rows = [(k, " ".join(random.Random(k).choices(["a", "b", "c", "d e"], k=k % 90))) for k in range(400)]
    df = docs(spark, rows + [(None, "x " * 20), (None, None), (5, None), (6, " \t")] + [rows[10]] * 3)
    got = [tuple(r) for r in R.run_digests(R.find_runs(R.with_planted_runs(clashing(df)))).collect()]
    want = [expected(r.doc_id, r.text) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    found = R.find_runs(clashing(awkward(spark)))
    assert found.count() == awkward(spark).count() and R.find_runs(docs(spark, [])).count() == 0


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        if len(r.text or "") < 9000:
            assert got[r.doc_id] == expected(r.doc_id, r.text)

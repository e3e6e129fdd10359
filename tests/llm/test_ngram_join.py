import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pacekit.llm import ngram_join
from pacekit.llm.components import components
from pacekit.llm.ngram_join import (chunk_links, chunked_regions, exact_links, intersections, jaccard_components, join_region,
                                    one_per_component, windows)
from pacekit.llm.shingles import SliceKeys, shingle_sets
from tests.llm.helpers import awkward, clashing, docs


def shingles_of(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute(rows, percent=90):
    """{id: (n, component)} by all pairs."""
    sets = [(i, shingles_of(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def variants(rng, n_base, n_copies, lo, hi):
    """Base texts with copies that differ in a few words, some beyond the threshold."""
    out = []
    for _ in range(n_base):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(lo, hi))]
        out.append(" ".join(words))
        for _ in range(n_copies):
            w = list(words)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"z{rng.randint(0, 9999)}"
            out.append(" ".join(w))
    return out


def sets_of(texts):
    return list(shingle_sets(pa.array(texts)))


def test_shingles_follow_the_contract():
    texts = ["", " \t\n", "One", "one TWO", "a b c", "a b c a b c", "É é a", "a b\x0bc", "x\x1cy z w", "A  b\r\nC d "]
    assert [len(s) for s in sets_of(texts)] == [len(shingles_of(t)) for t in texts]
    a, b, c = sets_of(["a b c d", "A B\nC D", "a b c e"])
    assert np.array_equal(a, b) and len(np.intersect1d(a, c)) == 1
    assert not np.array_equal(*sets_of(["a a", "a"]))


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_share_a_slice_key(percent):
    rng = random.Random(4)
    keys = SliceKeys(percent)
    hit = 0
    for lo, hi in ((3, 20), (20, 60), (60, 700)):
        sets = sets_of(variants(rng, 60, 4, lo, hi))
        for g in range(0, len(sets), 5):
            for a in range(g, g + 5):
                for b in range(a + 1, g + 5):
                    i = len(np.intersect1d(sets[a], sets[b]))
                    if 0 < i < len(sets[a]) + len(sets[b]) - i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                        hit += 1
                        assert set(keys(sets[a])[0].tolist()) & set(keys(sets[b])[0].tolist())
    assert hit > 100


def test_intersections_are_exact():
    rng = random.Random(2)
    sets = sets_of(variants(rng, 6, 12, 20, 80))
    got = intersections(sets)
    for i in range(len(sets)):
        for j in range(len(sets)):
            assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_windows_lose_no_pair():
    rng = random.Random(7)
    sets = sets_of(variants(rng, 4, 40, 40, 60))
    pick = [0, 41, 60, 100, 120]
    d = np.array([[1 - len(np.intersect1d(s, sets[p])) / len(np.union1d(s, sets[p])) for p in pick] for s in sets])
    near, seen = windows(d, 90)
    for i in range(len(sets)):
        for j in range(len(sets)):
            if len(np.intersect1d(sets[i], sets[j])) >= 0.9 * len(np.union1d(sets[i], sets[j])):
                assert seen[j, near[i]]


def roots_of(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(int(a)), find(int(b))
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_recursive_join_equals_the_exact_one():
    rng = random.Random(9)
    sets = sets_of(variants(rng, 12, 30, 30, 60) + variants(rng, 200, 0, 30, 60))
    home = np.ones(len(sets), bool)
    got = roots_of(len(sets), join_region(sets, home, 90, leaf=16))
    assert got == roots_of(len(sets), exact_links(sets, 90))


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5001 + i) for i in range(300)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots_of(6000, edges)
    ids = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {i: want[i] for i in ids}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("region_docs", [2048, 24])
def test_matches_brute_force(spark, region_docs):
    rng = random.Random(11)
    texts = (variants(rng, 15, 5, 3, 30) + variants(rng, 20, 5, 30, 200) + variants(rng, 3, 60, 50, 60)
             + variants(rng, 80, 0, 1, 60) + ["the licence of this text"] * 30 + ["a", "A", "a b", "b a", "", None])
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_components(docs(spark, rows), region_docs=region_docs).collect()}
    assert got == brute(rows)


def test_shared_passages_at_a_lower_threshold(spark):
    rng = random.Random(13)
    passages = [" ".join(f"p{k}x{i}" for i in range(60)) for k in range(3)]
    texts = []
    for t in variants(rng, 60, 2, 60, 400):
        w = t.split()
        cut = rng.randrange(len(w))
        texts.append(" ".join([*w[:cut], rng.choice(passages), *w[cut:]]))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, rows), percent=80).collect()}
    assert got == brute(rows, 80)


def test_chunk_pairs_find_all_links(spark):
    rng = random.Random(5)
    sets = sets_of(variants(rng, 4, 20, 50, 60))
    members = spark.createDataFrame(
        [(7, i, True, s.astype(np.int64).tolist()) for i, s in enumerate(sets)],
        "region long, rep long, home boolean, items array<long>")
    edges = [(r.u, r.v) for r in chunked_regions(members, 90, 16).collect()]
    assert roots_of(len(sets), edges) == roots_of(len(sets), exact_links(sets, 90))


@pytest.mark.parametrize("n_left, n_right", [(50, 34), (84, 0), (1, 83), (0, 0)])
def test_blocks_of_two_chunks_miss_no_link_between_them(n_left, n_right):
    rng = random.Random(6)
    sets = sets_of(variants(rng, 4, 20, 50, 60))
    left = np.array(rng.sample(range(len(sets)), n_left), int)
    right = np.setdiff1d(np.arange(len(sets)), left)[:n_right] if n_right else left
    both = np.union1d(left, right)
    roots = dict(zip(both.tolist(), roots_of(len(both), np.searchsorted(both, e := chunk_links(
        sets, left, right, 90, 16)).tolist()), strict=True))
    assert np.isin(e, both).all()
    for i in left.tolist():
        for j in right.tolist():
            shared = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * shared < 90 * (len(sets[i]) + len(sets[j]) - shared) or roots[i] == roots[j]


def chained(rng, n):
    """Documents of which each shares a passage with the next, and some have a near copy."""
    passages = [" ".join(f"p{i}x{k}" for k in range(30)) for i in range(n + 1)]
    texts = []
    for i in range(n):
        own = [f"w{rng.randint(0, 99999)}" for _ in range(60)]
        texts.append(" ".join([passages[i], *own, passages[i + 1]]))
        if i % 5 == 0:
            texts.append(" ".join([passages[i], *own[:-1], "other", passages[i + 1]]))
    return list(enumerate(texts))


def test_chance_meetings_do_not_chain_regions_together(spark, monkeypatch):
    """Neighbours share keys all along the chain; no region is large for that."""
    rows = chained(random.Random(17), 100)

    def none(members, *a):
        raise AssertionError("a region became large")

    monkeypatch.setattr(ngram_join, "large_regions", none)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_components(docs(spark, rows), region_docs=16).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("n_copies", [80])
def test_a_region_that_does_not_shrink_is_not_multiplied(spark, monkeypatch, n_copies):
    """Near copies of one text lie within every pivot's window: they are compared once, not once a pivot."""
    rng = random.Random(19)
    rows = list(enumerate(variants(rng, 1, n_copies, 200, 210)))
    seen, compare = [], ngram_join.chunked_regions

    def watched(members, percent, chunk):
        seen.append(members.count())
        return compare(members, percent, chunk)

    monkeypatch.setattr(ngram_join, "chunked_regions", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_components(docs(spark, rows), region_docs=48).collect()}
    assert got == brute(rows)
    assert 48 < sum(seen) <= 2 * len(rows)


def test_a_large_region_that_shrinks_is_split(spark, monkeypatch):
    """Groups far from each other in one region: the rounds divide it, and lose no link."""
    rng = random.Random(23)
    sets = sets_of(variants(rng, 4, 74, 40, 60))
    members = spark.createDataFrame(
        [(7, i, True, s.astype(np.int64).tolist()) for i, s in enumerate(sets)],
        "region long, rep long, home boolean, items array<long>")
    seen, compare = [], ngram_join.chunked_regions
    monkeypatch.setattr(ngram_join, "chunked_regions", lambda m, *a: seen.append(m.count()) or compare(m, *a))
    edges = [(r.u, r.v) for e in ngram_join.large_regions(members, 90, 80) for r in e.collect()]
    assert roots_of(len(sets), edges) == roots_of(len(sets), exact_links(sets, 90))
    assert seen[0] == 0


def test_key_lists_are_not_shuffled_whole(spark, monkeypatch):
    """Keys go by themselves: no join or sort of the stored lists before they are counted."""
    plans, write = {}, ngram_join.stored

    def watched(df, name, *a):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name, *a)

    monkeypatch.setattr(ngram_join, "stored", watched)
    rows = list(enumerate(variants(random.Random(3), 5, 3, 30, 60)))
    assert jaccard_components(docs(spark, rows)).count() == len(rows)
    assert "Join" not in plans["jaccard-shared"]


def test_awkward_rows(spark):
    df = clashing(awkward(spark))
    got = jaccard_components(df).collect()
    assert len(got) == df.count()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[1, 0] == 1 and by[2, 0] == 2 and by[4, 1] == 3 and by[None, 0] is None
    assert next(r.component_id for r in got if r.doc_id == 6) == 5
    assert one_per_component(df).columns == df.columns
    assert jaccard_components(docs(spark, [])).count() == 0


def test_a_region_is_compared_without_wide_matrices():
    """A region that does not shrink is compared whole: its links are told for some rows at a time."""
    n = 1024
    sets = [np.array([10 * (i // 2), 10 * (i // 2) + 1], np.uint64) for i in range(n)]
    tracemalloc.start()
    edges = exact_links(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(map(tuple, edges.tolist())) == [(i + 1, i) for i in range(0, n, 2)]
    assert peak < 16 * n * n                                # 13 bytes a pair; 21 as one matrix of whole numbers

import numpy as np
import pyarrow as pa

from pacekit.llm.embedding_dedup import leaf_forest, link_forest, local_roots, near_vectors, unit_rows


def brute_force(vectors, threshold=0.9):
    """(links, smallest index linked to through others) of each vector."""
    x = unit_rows(pa.array(vectors))
    near = x @ x.T >= threshold
    return near.sum(axis=1) - 1, local_roots(near)


def table(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")


def at(degrees):
    return np.column_stack([np.cos(np.radians(degrees)), np.sin(np.radians(degrees))])


def same_trees(edges, near):
    """Do the edges connect what the links connect, with no edge too many?"""
    n = len(near)
    by = np.eye(n, dtype=bool)
    by[edges[:, 0], edges[:, 1]] = by[edges[:, 1], edges[:, 0]] = True
    root = local_roots(near)
    return np.array_equal(local_roots(by), root) and len(edges) == n - len(set(root.tolist()))


def test_links_across_chunks_span_a_chain():
    x = at([0, 48, 72, 24])                                # 24 and 48 are linked, and neither is the other's first
    left, right = np.array([0, 1]), np.array([2, 3])
    near = np.eye(4, dtype=bool)
    near[:2, 2:] = x[:2] @ x[2:].T >= 0.9
    assert same_trees(link_forest(x, left, right, 0.9), near | near.T)


def test_links_across_chunks_span_random_graphs():
    rng = np.random.default_rng(3)
    for n in (2, 30, 200):
        x = at(rng.uniform(0, 360 if n < 200 else 3000, n))
        own = rng.random(n) < 0.5
        near = x @ x.T >= 0.995
        near &= own[:, None] != own[None, :]
        near |= np.eye(n, dtype=bool)
        edges = link_forest(x, np.flatnonzero(own), np.flatnonzero(~own), 0.995, block=7)
        assert same_trees(edges, near)


def test_leaf_that_cannot_be_split_keeps_every_link():
    chain = np.column_stack([at([0, 48, 24]), np.zeros(3)])     # 48 is linked to the later 24 only
    many = np.array([[0.0, 0.0, 2.0 ** k] for k in range(20)])  # one unit vector, 20 classes
    x = unit_rows(pa.array(np.concatenate([chain, many]).tolist()))
    tops = [s for s in range(50) if (p := x @ np.random.default_rng(s).standard_normal(3))[:3].max() < p[3]]
    assert tops
    for seed in tops:                                           # all others below the cut: no split
        assert same_trees(leaf_forest(x, 0.9, leaf=8, seed=seed), x @ x.T >= 0.9)


def test_small_chunks_and_sample_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    chain = np.column_stack([at(np.arange(0, 15) * 24.0), np.zeros((15, 6))])
    far = rng.standard_normal((60, 8))
    close = far[:20].repeat(3, axis=0) + 0.05 * rng.standard_normal((60, 8))
    vectors = np.concatenate([chain, far, close]).tolist()
    links, root = brute_force(vectors)
    # no sample has over 64 vectors here, leaves of it stand for the table, and any above 32 is chunked
    got = near_vectors(table(spark, vectors), chunk=8, sample_bytes=1, leaf=256).collect()
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(links.tolist()))
    assert {r.vec_id: r.component_id for r in got} == dict(enumerate(root.tolist()))

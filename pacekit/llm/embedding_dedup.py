"""Near-duplicate vectors through a forest of random-projection trees with spill.

1. Equal vectors collapse to one class with a multiplicity.
2. Each tree splits recursively on random directions at the median; vectors
   near the cut go to both sides (spill), so a close pair is rarely parted, and
   the trees differ, so a pair parted in one meets in another. Cuts are fitted
   on at most ``SAMPLE_BYTES`` of vectors taken by hash; every vector is
   routed. Leaves that are large because the table is far larger than the
   sample are split further, in the task that has them.
3. Within leaves all vectors are compared by cosine in double precision. A leaf
   emits a spanning forest of its links, never the pairs.
4. The forests of all trees are united by connected components, and each
   component counts its members' links by comparing them exactly.

A leaf or component above ``CHUNK`` vectors is compared as pairs of chunks, one
task each, so memory stays bounded and no link is given up.

Defined cases: null vectors, vectors with null or non-finite components, zero
vectors and rows without an id link with nothing (component_id is their own id,
they are kept); vectors of different length are not compared; repeated rows are
separate vectors; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import stored
from pacekit.llm.components import components

TREES = 8
LEAF = 256
SPILL = 0.06
SAMPLE_BYTES = 16 << 20
CHUNK = 4096
THRESHOLD = 0.9


def unit_rows(column) -> np.ndarray:
    """An Arrow list column as rows of unit length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tree:
    """Cuts fitted on a sample: one direction per level, (low, high) per node."""

    def __init__(self, sample: np.ndarray, seed: int, leaf: int, spill: float):
        rng = np.random.default_rng(seed)
        self.directions, self.cuts = [], []
        level = {0: np.arange(len(sample))}
        while any(len(rows) > leaf for rows in level.values()):
            d = rng.standard_normal(sample.shape[1])
            p = sample @ d
            cuts, below = {}, {}
            for node, rows in level.items():
                if len(rows) > leaf:
                    low, high = np.quantile(p[rows], [0.5 - spill, 0.5 + spill])
                    left, right = rows[p[rows] <= high], rows[p[rows] > low]
                    if len(left) < len(rows) and len(right) < len(rows):
                        cuts[node] = (low, high)
                        below[2 * node + 1], below[2 * node + 2] = left, right
            if not cuts:
                break
            self.directions.append(d)
            self.cuts.append(cuts)
            level = below

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every place a row falls to."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        out_rows, out_nodes = [], []
        for d, cuts in zip(self.directions, self.cuts, strict=True):
            keys = np.array(sorted(cuts))
            at = np.minimum(np.searchsorted(keys, nodes), len(keys) - 1)
            inner = keys[at] == nodes
            out_rows.append(rows[~inner])
            out_nodes.append(nodes[~inner])
            rows, nodes, at = rows[inner], nodes[inner], at[inner]
            p = (x @ d)[rows]
            low = np.array([cuts[k][0] for k in keys.tolist()])[at]
            high = np.array([cuts[k][1] for k in keys.tolist()])[at]
            left, right = p <= high, p > low
            rows = np.concatenate([rows[left], rows[right]])
            nodes = np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
        return np.concatenate([*out_rows, rows]), np.concatenate([*out_nodes, nodes])


def local_roots(links: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a symmetric boolean matrix."""
    n = len(links)
    root = np.arange(n)
    while True:
        best = np.minimum(root, np.where(links, root[None, :], n).min(axis=1, initial=n))
        best = best[best]
        if np.array_equal(best, root):
            return root
        root = best


def link_forest(x: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float,
                block: int = 512) -> np.ndarray:
    """(i, j) edges, a spanning forest of the links between rows ``left`` and rows ``right`` of ``x``."""
    label, y, out = np.arange(len(x)), x[right].T, [np.empty((0, 2), np.int64)]
    for s in range(0, len(left), block):
        part = left[s:s + block]
        near = x[part] @ y >= threshold
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            i, at = part[k], right[near[k]]
            seen = label[at]
            if (seen == label[i]).all():
                continue
            trees, first = np.unique(seen, return_index=True)
            out.append(np.column_stack(np.broadcast_arrays(i, at[first[trees != label[i]]])))
            joined = np.zeros(len(x), bool)
            joined[trees] = joined[label[i]] = True
            label[joined[label]] = min(trees[0], label[i])
    return np.concatenate(out)


def leaf_forest(x: np.ndarray, threshold: float, leaf: int = 4 * LEAF, seed: int = 0) -> np.ndarray:
    """(i, j) edges that connect what the links within ``x`` connect; large leaves split again."""
    if len(x) <= leaf:
        root = local_roots(x @ x.T >= threshold)
        i = np.flatnonzero(root != np.arange(len(x)))
        return np.column_stack([i, root[i]])
    tree = Tree(x, seed, leaf, SPILL)
    rows, nodes = tree.route(x)
    order = np.argsort(nodes, kind="stable")
    out = []
    for part in np.split(rows[order], np.flatnonzero(np.diff(nodes[order])) + 1):
        if len(part) == len(x):                            # cannot be split: compare in blocks
            out.append(link_forest(x, part, part, threshold))
        else:
            out.append(part[leaf_forest(x[part], threshold, leaf, seed + 1)])
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def chunk_pairs(rows: DataFrame, key: list[str], order: str, chunk: int) -> DataFrame:
    """Rows of each group in every pair of chunks (_a <= _b) they belong to; one pair if the group is small."""
    sizes = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("_chunks"))
    own = F.pmod(F.xxhash64(F.lit("chunk"), order), F.col("_chunks")).cast("int")
    paired = rows.join(sizes, key).withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return (paired.withColumn("_a", F.least("_own", "_other")).withColumn("_b", F.greatest("_own", "_other"))
            .drop("_other", "_chunks"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL,
                 sample_bytes: int = SAMPLE_BYTES, seed: int = 11, chunk: int = CHUNK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    good = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), F.col("v")))
    classes = stored(rows.filter("v is not null").groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")).withColumn("dim", F.size("v")),
        "vector-classes")

    edges = []
    for r in classes.groupBy("dim").count().collect():     # vectors of one length are one space
        space = classes.filter(F.col("dim") == r["dim"])
        edges.append(forest_edges(space, r["dim"], r["count"], threshold, trees, leaf, spill,
                                  sample_bytes, seed, chunk))
    if not edges:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = edges[0]
    for e in edges[1:]:
        found = found.unionAll(e)
    roots = stored(components(found.distinct()), "vector-components")
    degrees = stored(count_links(classes.join(roots, F.col("rep") == F.col("id")), threshold, chunk), "vector-links")

    per_class = (classes.select("v", "rep", "times").join(roots, F.col("rep") == F.col("id"), "left").drop("id")
                 .join(degrees, "rep", "left"))
    out = rows.join(per_class, "v", "left")
    component = F.coalesce("root", "rep", "vec_id")
    return out.select(
        "vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("times") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def forest_edges(space: DataFrame, dim: int, n: int, threshold: float, trees: int, leaf: int, spill: float,
                 sample_bytes: int, seed: int, chunk: int) -> DataFrame:
    """(u, v) edges between class representatives found in the leaves of all trees."""
    most = max(64, sample_bytes // (8 * dim))
    picked = space.orderBy(F.xxhash64("rep"), "rep").limit(most).select("v").toArrow()["v"]
    sample = unit_rows(picked)
    # a leaf of the sample stands for `leaf` vectors, as far as the sample resolves them
    small = max(16, leaf * len(sample) // max(1, n))
    forest = [Tree(sample, seed + 1000 * t, small, spill) for t in range(trees)]

    def route(batches):
        for batch in batches:
            x = unit_rows(batch.column("v"))
            for t, tree in enumerate(forest):
                r, nodes = tree.route(x)
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(at), batch.column("v").take(at),
                     pa.array(np.full(len(r), t, np.int32)), pa.array(nodes)], names=["rep", "v", "tree", "leaf"])

    def compare(table: pa.Table) -> pa.Table:
        x, rep = unit_rows(table["v"]), table["rep"].to_numpy()
        own = table["_own"].to_numpy()
        a, b = table["_a"][0].as_py(), table["_b"][0].as_py()
        if a == b:
            e = leaf_forest(x, threshold)
        else:                                              # two chunks of one leaf: only links across
            e = link_forest(x, np.flatnonzero(own == a), np.flatnonzero(own == b), threshold)
        return pa.table({"u": pa.array(rep[e[:, 0]], pa.int64()), "v": pa.array(rep[e[:, 1]], pa.int64())})

    routed = space.select("rep", "v").mapInArrow(route, "rep long, v array<double>, tree int, leaf long")
    routed = stored(routed, "vector-leaves")
    paired = chunk_pairs(routed, ["tree", "leaf"], "rep", 4 * chunk)
    return paired.groupBy("tree", "leaf", "_a", "_b").applyInArrow(compare, "u long, v long")


def count_links(members: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(rep, links): vectors of other classes in the component that are linked, by multiplicity."""

    def count(table: pa.Table) -> pa.Table:
        x, rep = unit_rows(table["v"]), table["rep"].to_numpy()
        times, own = table["times"].to_numpy().astype(np.float64), table["_own"].to_numpy()
        a, b = table["_a"][0].as_py(), table["_b"][0].as_py()
        links = np.zeros(len(x))
        here, there = np.flatnonzero(own == a), np.flatnonzero(own == b)
        for s in range(0, len(here), 512):
            part = here[s:s + 512]
            near = x[part] @ x[there].T >= threshold
            links[part] += near @ times[there]
            if a != b:
                links[there] += near.T @ times[part]
        if a == b:
            links -= times                                  # not its own class
        return pa.table({"rep": pa.array(rep, pa.int64()), "links": pa.array(np.rint(links).astype(np.int64))})

    paired = chunk_pairs(members.select("rep", "v", "times", "root", "dim"), ["root", "dim"], "rep", chunk)
    each = paired.groupBy("root", "dim", "_a", "_b").applyInArrow(count, "rep long, links long")
    return each.groupBy("rep").agg(F.sum("links").alias("links"))

"""Exact Jaccard join of word-shingle sets in metric space, as connected components.

Jaccard distance is a metric. Plain document pivots cannot split a corpus:
unrelated texts all lie at a distance near 1 from every pivot, so the window of
twice the threshold replicates nearly every document into nearly every region
(the README has figures). So regions are made in two steps, both exact.

1. Regions at distance 0. Equal sets collapse to one. Every set is cut into
   slices by hash ranges (``shingles.SliceKeys``); a pair within the threshold
   has several equal slices, that is, both lie at distance 0 from the same
   slice pivots. Of those keys a set forgoes the most frequent ones (passages
   that many texts share) as far as a common one is sure to remain. The sets
   that share a key meet in the region of the key's pivot, one of them. Regions
   overlap and are never united: chance meetings of a corpus chain nearly all
   of it together, while a region only holds what meets its pivot.
2. Voronoi regions within. A region picks pivots among its documents, computes
   exact distances, links what lies within the threshold of a pivot, and sends
   each document to its nearest pivot. By the triangle inequality a document
   within the threshold of another region's member lies at most twice the
   threshold further from that region's pivot than from its own: such boundary
   documents are replicated as visitors. Regions join recursively until they
   are small or do not shrink, and those are compared exactly.

Regions of at most ``REGION_DOCS`` documents recurse within a task, many to a
task; larger ones recurse as Spark rounds, one group per (region, salt), as long
as that halves the work, and are compared as pairs of bounded chunks otherwise.
Only spanning links leave a task, so a large group never becomes all its pairs.

Defined cases: null and empty texts have an empty set and link with nothing;
repeated rows and equal sets are linked; a row without an id is in the component of
its equal sets (null if none has an id); an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.llm.common import arrow_batches, free_shuffles, release_memory, released, stored, whole_text
from pacekit.llm.components import components
from pacekit.llm.embedding_dedup import local_roots
from pacekit.llm.packing import ARROW_BYTES, slices
from pacekit.llm.shingles import SliceKeys, set_key, shingle_sets

REGION_DOCS = 2048
LEAF_DOCS = 256
PIVOTS = 8
TASK_SHINGLES = 1_000_000
SPREAD_CHUNKS = 8
ROUNDS = 6


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections (float32 holds them up to 2**24)."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    row, first = row[order], np.cumsum(df) - df
    out = np.zeros((n, n), np.float32)
    for d in range(2, 9):                                   # rare shingles: their few pairs
        rows = row[first[df == d][:, None] + np.arange(d)]
        for a, b in combinations(range(d), 2):
            out += np.bincount(rows[:, a] * n + rows[:, b], minlength=n * n).reshape(n, n)
    common = np.flatnonzero(df > 8)                         # common ones: blocks of a 0/1 matrix
    for a in range(0, len(common), 4096):
        part = common[a:a + 4096]
        at = np.concatenate([np.arange(first[c], first[c] + df[c]) for c in part])
        x = np.zeros((n, len(part)), np.float32)
        x[row[at], np.repeat(np.arange(len(part)), df[part])] = 1
        half = x @ x.T
        np.fill_diagonal(half, 0)
        out += np.triu(half)
    np.maximum(out, 0, out=out)
    out = out + out.T
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out


def linked(inter, size_a, size_b, percent: int):
    """percent or more of the union is shared, in whole numbers."""
    return (100 + percent) * np.asarray(inter, np.int64) >= percent * (size_a + size_b)


def distances(sets: list[np.ndarray], pivots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard distance, shared elements) of every set to every pivot."""
    size = np.array([len(s) for s in sets])
    flat, starts = np.concatenate(sets), np.cumsum(size) - size
    shared = np.column_stack([np.add.reduceat(np.isin(flat, p, kind="sort").astype(np.int64), starts) for p in pivots])
    union = size[:, None] + np.array([len(p) for p in pivots])[None, :] - shared
    return 1 - shared / union, shared


def windows(d: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, in whose region it must be seen) from distances."""
    tau = 1 - percent / 100
    near = d.argmin(axis=1)
    return near, d <= d.min(axis=1, keepdims=True) + 2 * tau + 1e-9


def exact_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Spanning edges (i, j) of the links among the sets."""
    size = np.array([len(s) for s in sets])
    shared, part = intersections(sets), 256                 # whole numbers of 64 bits for some rows at a time
    root = local_roots(np.concatenate([linked(shared[a:a + part], size[a:a + part, None], size[None, :], percent)
                                       for a in range(0, len(sets), part)]))
    i = np.flatnonzero(root != np.arange(len(sets)))
    return np.column_stack([i, root[i]])


def join_region(sets: list[np.ndarray], home: np.ndarray, percent: int, leaf: int = LEAF_DOCS,
                seed: int = 0) -> np.ndarray:
    """Edges (i, j) that connect all that links with a home document connect."""
    n = len(sets)
    if n < 2 or not home.any():
        return np.empty((0, 2), np.int64)
    if n <= leaf:
        return exact_links(sets, percent)
    rng = np.random.default_rng(seed)
    picked = np.sort(rng.choice(np.flatnonzero(home), min(PIVOTS, int(home.sum())), replace=False))
    d, shared = distances(sets, [sets[p] for p in picked])
    size = np.array([len(s) for s in sets])
    i, r = np.nonzero(linked(shared, size[:, None], size[picked][None, :], percent))
    out = [np.column_stack([i, picked[r]])]
    near, seen = windows(d, percent)
    for q in range(len(picked)):
        part = np.flatnonzero(seen[:, q])
        own = home[part] & (near[part] == q)
        if own.any():
            if len(part) > 0.8 * n:                         # the region does not shrink
                return np.concatenate([*out, exact_links(sets, percent)])
            out.append(part[join_region([sets[x] for x in part], own, percent, leaf, seed + 1)])
    return np.concatenate(out)


def shingled(docs: DataFrame, width: int, keys: SliceKeys | None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carried..., n_shingles, k1, k2, items, forgo): items are slice keys, or without ``keys`` the set."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *carried))
    schema += ", n_shingles long, k1 long, k2 long, items array<long>, forgo array<long>"

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                size, k1, k2, items, forgo = [], [], [], [], []
                for s in shingle_sets(texts.slice(a, b - a), width):
                    one, two = set_key(s)
                    size.append(len(s))
                    k1.append(one)
                    k2.append(two)
                    own, may = keys(s) if keys else (s.astype(np.int64), [])
                    items.append(own)
                    forgo.append(may)
                ends = np.cumsum([0, *map(len, items)], dtype=np.int32)
                rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*items, np.empty(0, np.int64)])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in ("doc_id", *carried)]
                    + [pa.array(x, pa.int64()) for x in (size, k1, k2)] + [rows, pa.array(forgo, pa.list_(pa.int64()))],
                    names=["doc_id", *carried, "n_shingles", "k1", "k2", "items", "forgo"])
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text", *carried).mapInArrow(released(run), schema)


def column_sets(column) -> list[np.ndarray]:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.asarray(flat.offsets)
    values = flat.values.to_numpy(zero_copy_only=False).astype(np.uint64)
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def edge_table(ids: np.ndarray, edges: list[np.ndarray]) -> pa.Table:
    e = np.concatenate([*edges, np.empty((0, 2), np.int64)]).astype(np.int64)
    return pa.table({"u": pa.array(ids[e[:, 0]], pa.int64()), "v": pa.array(ids[e[:, 1]], pa.int64())})


def join_many(percent: int):
    """A task's worth of small regions, one after the other."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("region").combine_chunks()
        region, ids = table["region"].to_numpy(), table["rep"].to_numpy()
        home, sets = table["home"].to_numpy(), column_sets(table["items"])
        out = []
        cut = np.flatnonzero(np.diff(region)) + 1
        for a, b in zip([0, *cut], [*cut, len(region)], strict=True):
            out.append(a + join_region(sets[a:b], home[a:b], percent))
        del sets
        release_memory()
        return edge_table(ids, out)

    return run


def small_regions(members: DataFrame, percent: int) -> DataFrame:
    """Links of regions that fit in a task. ``members``: region, rep, home, items, bucket."""
    return (members.select("region", "rep", "home", "items", "bucket").groupBy("bucket")
            .applyInArrow(join_many(percent), "u long, v long"))


def split_regions(members: DataFrame, percent: int, salts: int) -> DataFrame:
    """One Spark round over large regions: links to pivots, and the members of the Voronoi regions.

    ``members`` has region, rep, home, items. Rows of the result with ``u`` set are
    links; the others are members of new regions, with the old one, but without their sets.
    """
    order = F.xxhash64("region", "rep")
    picked = (members.filter("home").groupBy("region", F.pmod(order, F.lit(PIVOTS)).alias("_slot"))
              .agg(F.min(F.struct(order.alias("h"), "rep")).alias("p")).select("region", F.col("p.rep").alias("rep")))
    picked = picked.toDF("_region", "_rep")
    pivots = (members.select("region", "rep", "items")
              .join(picked, (F.col("region") == F.col("_region")) & (F.col("rep") == F.col("_rep")), "left_semi")
              .dropDuplicates(["region", "rep"]))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    spread = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        *[F.col(c).alias(f"p_{c}") for c in ("region", "salt", "rep", "items")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.sort_by("p_rep").combine_chunks()
        sets, pivot_sets = column_sets(left["items"]), column_sets(right["p_items"])
        ids, pivot_ids, home = left["rep"].to_numpy(), right["p_rep"].to_numpy(), left["home"].to_numpy()
        if not len(sets) or not len(pivot_sets):
            return OUT.empty_table()
        d, shared = distances(sets, pivot_sets)
        size, pivot_size = np.array([len(s) for s in sets]), np.array([len(s) for s in pivot_sets])
        i, r = np.nonzero(linked(shared, size[:, None], pivot_size[None, :], percent))
        links = pa.table({"u": ids[i], "v": pivot_ids[r], "old": pa.nulls(len(i), pa.int64()),
                          "region": pa.nulls(len(i), pa.int64()), "rep": pa.nulls(len(i), pa.int64()),
                          "home": pa.nulls(len(i), pa.bool_())}, schema=OUT)
        near, seen = windows(d, percent)
        i, r = np.nonzero(seen)
        old = left["region"][0].as_py()
        names = np.array([hash((old, int(p))) for p in pivot_ids], np.int64)
        parts = pa.table({"u": pa.nulls(len(i), pa.int64()), "v": pa.nulls(len(i), pa.int64()),
                          "old": np.full(len(i), old), "region": names[r], "rep": ids[i],
                          "home": home[i] & (near[i] == r)}, schema=OUT)
        return pa.concat_tables([links, parts])

    return salted.groupBy("region", "salt").cogroup(spread.groupBy("p_region", "p_salt")).applyInArrow(
        run, "u long, v long, old long, region long, rep long, home boolean")


OUT = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("old", pa.int64()), ("region", pa.int64()),
                 ("rep", pa.int64()), ("home", pa.bool_())])


def chunk_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, block: int) -> np.ndarray:
    """Edges that connect what links between the left and the right sets (or among them, if they are the same)."""
    one, two = ([x[a:a + block] for a in range(0, len(x), block)] for x in (left, right))
    same, out = np.array_equal(left, right), [np.empty((0, 2), np.int64)]
    for i, x in enumerate(one):
        for y in two[i:] if same else two:
            part = x if x is y or np.array_equal(x, y) else np.concatenate([x, y])
            out.append(part[exact_links([sets[k] for k in part], percent)])
    return np.concatenate(out)


def chunked_regions(members: DataFrame, percent: int, chunk: int) -> DataFrame:
    """All links of large regions that do not shrink: pairs of chunks, one task each.

    A set goes to as many tasks as its region has chunks: ``SPREAD_CHUNKS``, fewer if they would hold
    less than ``chunk`` sets, more from four times that or ``TASK_SHINGLES`` on.
    """
    n = F.count(F.lit(1))
    sizes = members.groupBy("region").agg(F.greatest(
        F.least(F.ceil(n / F.lit(chunk)), F.lit(SPREAD_CHUNKS)), F.ceil(n / F.lit(4 * chunk)),
        F.ceil(F.sum(F.size("items")) / F.lit(TASK_SHINGLES))).cast("int").alias("_chunks"))
    own = F.pmod(F.xxhash64(F.lit("chunk"), "rep"), F.col("_chunks")).cast("int")
    paired = members.join(F.broadcast(sizes), "region").withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    paired = paired.withColumn("_a", F.least("_own", "_other")).withColumn("_b", F.greatest("_own", "_other"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own, a, b = (table[c].to_numpy() for c in ("_own", "_a", "_b"))
        sets = column_sets(table["items"])
        edges = chunk_links(sets, np.flatnonzero(own == a), np.flatnonzero(own == b), percent, chunk)
        del sets
        release_memory()
        return edge_table(table["rep"].to_numpy(), [edges])

    return paired.select("region", "rep", "items", "_own", "_a", "_b").groupBy("region", "_a", "_b").applyInArrow(
        run, "u long, v long")


def large_regions(members: DataFrame, percent: int, region_docs: int) -> list[DataFrame]:
    """Links of regions too large for a task, by rounds of splitting as long as that halves what is compared."""
    out, chunk = [], max(1, region_docs // 2)
    n, whole = F.col("_n"), F.col("_n") * F.ceil(F.col("_n") / F.lit(chunk))
    active = stored(members.select("region", "rep", "home", "items"), "jaccard-large")
    for _ in range(ROUNDS):
        olds = active.groupBy("region").agg(F.count(F.lit(1)).alias("_n"))
        largest = olds.agg(F.max("_n")).first()[0]
        if not largest:
            return out
        salts = max(1, -(-largest // region_docs))
        done = stored(split_regions(active, percent, salts), "jaccard-split")
        out.append(done.filter("u is not null").select("u", "v"))
        parts = done.filter("u is null").select("old", "region", "rep", "home")
        sizes = parts.groupBy("old", "region").agg(F.count(F.lit(1)).alias("_n"), F.max("home").alias("_any"))
        sizes = sizes.filter("_any").select("old", "region", "_n")
        split = sizes.groupBy("old").agg(F.sum(F.when(n <= region_docs, n).otherwise(whole)).alias("_parts"))
        pays = stored(split.join(olds.withColumnRenamed("region", "old"), "old").filter(2 * F.col("_parts") <= whole)
                      .select("old"), "jaccard-pays")
        stuck = active.join(F.broadcast(pays), F.col("region") == F.col("old"), "left_anti")
        out.append(chunked_regions(stuck, percent, chunk))
        sets = active.select(F.col("region").alias("old"), "rep", "items").join(F.broadcast(pays), "old", "left_semi")
        sized = parts.join(sizes, ["old", "region"]).join(sets, ["old", "rep"])
        fits = sized.filter(n <= region_docs).withColumn("bucket", F.col("region"))
        out.append(small_regions(fits, percent))
        active = stored(sized.filter(n > region_docs).select("region", "rep", "home", "items"), "jaccard-large")
    out.append(chunked_regions(active, percent, chunk))
    return out


def cells(kept: DataFrame) -> DataFrame:
    """(rep, key) -> (rep, region): whoever shares a key with others is in the region of the key's pivot.

    The pivot is the one with most keys, so that the keys of a group of near copies name few pivots.
    """
    held = kept.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("rep")))
    pivots = held.groupBy("key").agg(F.min(F.struct((-F.col("held")).alias("h"), "rep")).alias("p")).select(
        "key", F.col("p.rep").alias("region"))
    near = kept.join(pivots, "key").filter("rep <> region").select("rep", "region").distinct()
    near = stored(near, "jaccard-near")
    return near.unionAll(near.select(F.col("region").alias("rep"), "region").distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90,
                       width: int = 3, region_docs: int = REGION_DOCS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    spark = docs.sparkSession
    with arrow_batches(spark, ARROW_BYTES):
        base = stored(shingled(rows, width, SliceKeys(percent)), "jaccard-keys")
    filled = base.filter("n_shingles > 0")
    sets = stored(filled.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")), "jaccard-sets")

    # regions at distance 0 of a slice; only the keys that several rows share meet the sets' first documents,
    # as a join of whole key lists would write all of them to disk again
    first = sets.select("k1", "k2", "n_shingles", F.col("rep").alias("doc_id"))
    keyed = filled.filter("doc_id is not null").select(F.col("doc_id").alias("rep"), F.explode("items").alias("key"))
    shared = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "jaccard-shared")
    free_shuffles(spark)
    may = filled.select("k1", "k2", "n_shingles", "doc_id", "forgo").join(
        first, ["k1", "k2", "n_shingles", "doc_id"], "left_semi").filter("size(forgo) > 0").select(
        F.col("doc_id").alias("rep"), "forgo").distinct()
    met = keyed.join(shared, "key").join(may, "rep").withColumn("class", F.col("key").bitwiseAND(255))
    # every set forgoes its most frequent keys, as far as its class (the first or the second) allows
    often = F.row_number().over(Window.partitionBy("rep", "class").orderBy(F.col("n").desc(), "key"))
    allowed = F.when(F.get("forgo", F.lit(0)) == F.col("class"), F.get("forgo", F.lit(1))).when(
        F.get("forgo", F.lit(2)) == F.col("class"), F.get("forgo", F.lit(3)))
    kept = stored(met.withColumn("often", often).filter(F.col("often") > allowed).select("rep", "key"), "jaccard-kept")
    free_shuffles(spark)
    regions = stored(cells(kept), "jaccard-regions")

    sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("_n"))
    fit = F.col("_n") <= region_docs
    total = sizes.agg(F.sum(F.when(fit, F.col("_n"))), F.sum(F.when(~fit, F.col("_n")))).first()
    edges = None
    if total[0] or total[1]:
        free_shuffles(spark)
        wanted = regions.join(sizes, "region").groupBy("rep").agg(
            F.collect_list(F.when(fit, F.col("region"))).alias("small"),
            F.collect_list(F.when(~fit, F.col("region"))).alias("large"))
        wanted = wanted.join(sets.select("rep", F.col("k1").alias("w1"), F.col("k2").alias("w2")), "rep")
        # one plan at every size: a broadcast here would only hold while regions are few
        text = rows.join(wanted.withColumnRenamed("rep", "doc_id").hint("merge"), "doc_id")
        with arrow_batches(spark, ARROW_BYTES):
            members = stored(shingled(text, width, None, ("small", "large", "w1", "w2")).filter(
                "k1 = w1 and k2 = w2").select(F.col("doc_id").alias("rep"), "small", "large", "items"), "jaccard-members")
        free_shuffles(spark)
        buckets = max(1, -(-(total[0] or 0) // REGION_DOCS))

        def placed(which: str) -> DataFrame:
            return members.select(F.explode(which).alias("region"), "rep", F.lit(True).alias("home"), "items")

        found = [small_regions(placed("small").withColumn("bucket", F.pmod(F.xxhash64("region"), F.lit(buckets))), percent)]
        if total[1]:
            found += large_regions(placed("large"), percent, region_docs)
        edges = found[0]
        for e in found[1:]:
            edges = edges.unionAll(e)
    out = base.select("doc_id", "n_shingles", "k1", "k2")
    if edges is None:
        by_set = sets.select("k1", "k2", "n_shingles", F.col("rep").alias("_root"))
    else:
        with arrow_batches(spark, ARROW_BYTES):                       # the edges are found as they are stored
            edges = stored(edges.filter("u <> v").distinct(), "jaccard-links")
        free_shuffles(spark)
        roots = components(edges)
        by_set = sets.join(roots, F.col("rep") == F.col("id"), "left").select(
            "k1", "k2", "n_shingles", F.coalesce("root", "rep").alias("_root"))
    return out.join(stored(by_set, "jaccard-roots"), ["k1", "k2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("_root", "doc_id").alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents whose id names their component, all columns."""
    kept = (jaccard_components(docs, id_col, text_col, **kw).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_kept_id")).distinct())
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")

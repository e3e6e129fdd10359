"""Merkle manifest of a dataset: leaf places from a bitmap index, levels from slot arrays.

Leaves of a group (a source) ascend by id; 16 consecutive nodes become their hash until one
is left; the groups' roots, in the order of the groups, become the root the same way.

1. **Index.** Ids of a group are set in 64-bit words; words are merged by OR, map side first,
   and empty words do not exist, so the index grows with the ids, however far apart they are. A
   popcount directory stands above the words: each level has the number of leaves before a
   node within its parent, 2**16 nodes to a parent, so no window is larger, whatever the
   group. Ids that occur more than once keep their surplus beside the word.
2. **Rank.** A leaf's place is its word's offset plus the popcount of the word below its bit:
   leaves are looked up, never sorted. Leaves that share an id follow each other by leaf hash.
3. **Levels.** Nodes are keyed by (tree, place div 4096); a task lays 4096 of them in an array by
   slot and folds three levels, so 10**11 leaves take four rounds.
4. **Proofs** go down the same way: a chunk meets the path above it, and each node gets the
   siblings of its levels, as text before and after it.

Every table is written to the shared folder once, so lost executors cost their tasks only.

Defined cases: a null field counts as ``-``; leaves with a null id come first; a null group comes
first; repeated rows are leaves of their own, next to each other; a single leaf is its own root
and its proof is empty; an empty table gives no rows; long texts are hashed whole; columns not
named as fields are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.llm.common import BLOCK_ROWS, null_safe_join, stored
from pacekit.operators.ranking import prefix_sums

FAN = 16
LEVELS = 3                      # levels folded in one task
CHUNK = FAN ** LEVELS
DIRECTORY_BITS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<before: string, after: string>>"


# ---------------------------------------------------------------- leaves

def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


# ---------------------------------------------------------------- bitmap index

def bitmap_index(leaves: DataFrame) -> DataFrame:
    """One row per non-empty word of a group: (grp, word, bits, base, surplus).

    ``leaves`` has (grp, id). ``base`` is the number of the group's leaves in earlier words,
    ``surplus`` lists (bit, more) for ids with ``more`` further leaves.
    """
    ids = leaves.groupBy("grp", "id").agg(F.count(F.lit(1)).alias("c"))
    words = ids.groupBy("grp", F.shiftright("id", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(id & 63 as int))")).alias("bits"), F.sum("c").alias("n"),
        F.collect_list(F.when(F.col("c") > 1, F.struct(F.expr(BIT).alias("bit"), (F.col("c") - 1).alias("more"))))
        .alias("surplus"))
    out = words.withColumn("base", F.lit(0).cast("long"))
    level = words.select("grp", F.col("word").alias("node"), "n")
    for above in range(4):                                    # 58 bits of a word number: 16, 16, 16 and the rest
        shift = above * DIRECTORY_BITS
        parent = F.shiftright("node", DIRECTORY_BITS) if above < 3 else F.lit(0)
        before = (Window.partitionBy("grp", "up").orderBy(F.col("node").asc_nulls_first())
                  .rowsBetween(Window.unboundedPreceding, -1))
        level = level.withColumn("up", parent)
        offsets = level.select("grp", "node", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
        out = null_safe_join(out.withColumn("node", F.shiftright("word", shift)), offsets, ["grp", "node"])
        out = out.withColumn("base", F.col("base") + F.col("off")).drop("off", "node")
        level = level.groupBy("grp", F.col("up").alias("node")).agg(F.sum("n").alias("n"))
    return out.select("grp", "word", "bits", "base", "surplus")


BIT = "coalesce(cast(id & 63 as int), 0)"                    # leaves with a null id share a word of their own


def places(leaves: DataFrame, index: DataFrame) -> DataFrame:
    """``leaves`` with ``first`` - the place of the first leaf of their id - and ``copies`` of the id."""
    j = null_safe_join(leaves.withColumn("word", F.shiftright("id", 6)), index, ["grp", "word"])
    j = j.withColumn("_bit", F.expr(BIT))
    below = F.expr("coalesce(bit_count(bits & ~shiftleft(-1L, _bit)), 0)")
    earlier = F.expr("aggregate(filter(surplus, s -> s.bit < _bit), 0L, (a, s) -> a + s.more)")
    own = F.expr("aggregate(filter(surplus, s -> s.bit = _bit), 1L, (a, s) -> a + s.more)")
    return (j.withColumn("first", F.col("base") + below + earlier).withColumn("copies", own)
            .drop("word", "bits", "base", "surplus", "_bit"))


def numbered(found: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(tree, idx, n, id, leaf, carried...) of all leaves; those that share an id by leaf hash.

    Equal rows are one row until the end; an id with very many leaves is cut into blocks by
    its leaves' hashes, and blocks of its copies are dealt out again before they are listed.
    """
    cols = ["tree", "n", "id", "leaf", *carried]
    single = found.filter("copies = 1").select("tree", F.col("first").alias("idx"), *cols[1:])
    again = found.filter("copies > 1").groupBy("first", "copies", *cols).agg(F.count(F.lit(1)).alias("c"))
    unit = F.conv(F.substring("leaf", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    again = again.withColumn("_b", F.floor(unit * F.ceil(F.col("copies") / BLOCK_ROWS)))

    def before(*keys: str):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    blocks = again.groupBy("tree", "first", "_b").agg(F.sum("c").alias("_c")).withColumn(
        "_off", F.coalesce(F.sum("_c").over(before("tree", "first", "_b")), F.lit(0))).drop("_c")
    inner = F.coalesce(F.sum("c").over(before("tree", "first", "_b", "leaf")), F.lit(0))
    start = again.withColumn("_in", inner).join(blocks, ["tree", "first", "_b"]).withColumn(
        "_start", F.col("first") + F.col("_off") + F.col("_in"))
    piece = start.withColumn("_k", F.explode(F.expr(f"sequence(0L, (c - 1) div {BLOCK_ROWS})")))
    rows = piece.repartition("tree", "_start", "_k").withColumn("_i", F.explode(F.expr(
        f"sequence(_k * {BLOCK_ROWS}, least(c, (_k + 1) * {BLOCK_ROWS}) - 1)")))
    return single.unionByName(rows.select("tree", (F.col("_start") + F.col("_i")).alias("idx"), *cols[1:]))


# ---------------------------------------------------------------- levels

def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_left(n: int, round_: int) -> int:
    """How many levels a tree of n leaves folds in a round."""
    nodes, levels = -(-n // CHUNK ** round_), 0
    while levels < LEVELS and nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def folded(hashes: list[str], levels: int) -> list[list[str]]:
    """The levels over an array of nodes, itself first."""
    out = [hashes]
    for _ in range(levels):
        low = out[-1]
        out.append([sha("".join(low[k:k + FAN])) for k in range(0, len(low), FAN)])
    return out


def slot_array(table: pa.Table) -> tuple[pa.Table, list[str]]:
    """A chunk's rows in slot order, and their hashes."""
    table = table.sort_by("idx")
    idx = table.column("idx").to_pylist()
    if idx != list(range(idx[0], idx[0] + len(idx))):
        raise ValueError("places of a chunk are not gapless")
    return table, table.column("hash").to_pylist()


CHUNK_NO = f"idx div {CHUNK} as chunk"


def fold_round(nodes: DataFrame, round_: int) -> DataFrame:
    """The top nodes of all chunks: (tree, idx, n, hash)."""
    def up(key, table):
        _, hashes = slot_array(table)
        n = table.column("n")[0].as_py()
        top = folded(hashes, levels_left(n, round_))[-1]
        if len(top) != 1:
            raise ValueError("a chunk did not fold to one node")
        return pa.table({"tree": [key[0].as_py()], "idx": [key[1].as_py()], "n": [n], "hash": top},
                        schema=pa.schema([("tree", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()),
                                          ("hash", pa.string())]))

    return (nodes.selectExpr("tree", "idx", "n", "hash", CHUNK_NO).groupBy("tree", "chunk")
            .applyInArrow(up, "tree long, idx long, n long, hash string"))


def tree_levels(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """``nodes`` and the nodes after each round; the last ones are the roots, one per tree."""
    out = [nodes]
    for r in range(rounds(largest)):
        out.append(stored(fold_round(out[-1], r), f"{name}-{r}"))
    return out


def rounds(largest: int) -> int:
    r = 1
    while CHUNK ** r < largest:
        r += 1
    return r


def paths(nodes: DataFrame, above: DataFrame, round_: int, carried: Sequence[str] = ()) -> DataFrame:
    """Each node with its path to the root: the chunk's levels, then what is ``above`` the chunk.

    ``above``: (tree, chunk, path, subroot, root), one row per chunk. A step of a path has the
    siblings' hashes before and after the node, joined.
    """
    kinds = dict(nodes.dtypes)
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in ("tree", "idx", "hash", *carried)], f"path {STEP}",
                        "subroot string", "root string"])
    step = pa.struct([("before", pa.string()), ("after", pa.string())])

    def down(left, right):
        rows, hashes = slot_array(left)
        levels = folded(hashes, levels_left(rows.column("n")[0].as_py(), round_))[:-1]
        top = right.to_pylist()[0]
        steps = []
        for k in range(len(hashes)):
            path, at = [], k
            for low in levels:
                run = low[at - at % FAN:at - at % FAN + FAN]
                path.append(("".join(run[:at % FAN]), "".join(run[at % FAN + 1:])))
                at //= FAN
            steps.append(path + [(s["before"], s["after"]) for s in top["path"]])
        out = {c: rows.column(c) for c in ("tree", "idx", "hash", *carried)}
        out["path"] = pa.array(steps, pa.list_(step))
        for c in ("subroot", "root"):
            out[c] = pa.array([top[c]] * len(hashes), pa.string())
        return pa.table(out)

    own = nodes.selectExpr("tree", "idx", "n", "hash", *carried, CHUNK_NO).groupBy("tree", "chunk")
    return own.cogroup(above.groupBy("tree", "chunk")).applyInArrow(down, schema)


# ---------------------------------------------------------------- manifest

@dataclass
class Manifest:
    """The stored tables of a manifest.

    ``groups`` (grp, tree, n), ``index`` (the bitmap index), ``leaves`` (tree, idx, n, id, hash and
    carried columns), ``levels`` of the groups' trees, ``top`` levels over the groups' roots.
    """

    groups: DataFrame
    index: DataFrame
    leaves: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    carried: tuple[str, ...]

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, path, carried...): one row per leaf; ``path`` from leaf to root."""
        root = self.top[-1].select("tree", F.lit(0).cast("long").alias("chunk"),
                                   F.expr(f"cast(array() as {STEP})").alias("path"),
                                   F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
        above = root
        for r in range(len(self.top) - 2, -1, -1):
            found = paths(self.top[r], above, r)
            above = found.select("tree", F.col("idx").alias("chunk"), "path",
                                 F.col("hash").alias("subroot"), "root")
        # a node of the top tree is a group's root: the tree of that number, its one chunk
        above = above.select(F.col("chunk").alias("tree"), F.lit(0).cast("long").alias("chunk"), "path",
                             "subroot", "root")
        for r in range(len(self.levels) - 2, 0, -1):
            found = paths(self.levels[r], above, r)
            above = found.select("tree", F.col("idx").alias("chunk"), "path", "subroot", "root")
        out = paths(self.levels[0], above, 0, ("id", *self.carried))
        return out.select("id", F.col("hash").alias("leaf"), "subroot", "root", "path", *self.carried)


def build_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                   fields: Sequence[str] = FIELDS, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: a leaf per row over ``fields``; ``carry`` adds columns to the leaves."""
    carried = tuple(carry or {})
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"),
                      leaf_hash([F.col(f) for f in fields]).alias("leaf"),
                      *[c.alias(name) for name, c in (carry or {}).items()])
    own = stored(own, "merkle-rows")                          # the texts are read once
    sizes = own.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
    groups = stored(prefix_sums(sizes, ["grp"], "one", "tree").select("grp", F.col("tree").cast("long").alias("tree"),
                                                                       "n"), "merkle-groups")
    index = stored(null_safe_join(bitmap_index(own), groups, ["grp"]), "merkle-index")
    found = stored(places(own, index), "merkle-places")
    leaves = numbered(found, carried).withColumnRenamed("leaf", "hash")
    most = groups.agg(F.coalesce(F.max("n"), F.lit(1)).alias("n"), F.count(F.lit(1)).alias("groups")).first()
    levels = tree_levels(leaves, most["n"], "merkle-level")
    roots = levels[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                              F.lit(most["groups"]).cast("long").alias("n"), "hash")
    return Manifest(groups, index, leaves, levels, tree_levels(roots, most["groups"], "merkle-top"), carried)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")

"""Merkle manifest against plain hashing, with repeated and null ids, far ids and many leaves."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pacekit.llm import merkle as M
from tests.llm.helpers import awkward, clashing, docs


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def plain(rows):
    """(id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha("".join(map(field, r)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([leaf for _, _, leaf in sorted(groups[n])]) for n in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for g, name in enumerate(names):
        for i, (known, doc, leaf) in enumerate(sorted(groups[name])):
            proof = ""
            for tree, at in ((trees[g], i), (top, g)):
                for low in tree[:-1]:
                    run = at - at % 16
                    proof += "".join(low[run:at] + low[at + 1:run + 16])
                    at //= 16
            out.append((doc if known else None, leaf, trees[g][-1][0], top[-1][0], proof))
    return out


def manifest(df):
    p = M.build_manifest(df).proofs()
    rows = p.select("id", "leaf", "subroot", "root", M.proof_text(F.col("path")).alias("proof"),
                    M.fold_path(F.col("leaf"), F.col("path")).alias("again")).collect()
    assert all(r.again == r.root for r in rows)
    return [tuple(r)[:5] for r in rows]


def check(df):
    rows = [tuple(r) for r in df.select(*M.FIELDS).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(manifest(df), key=key) == sorted(plain(rows), key=key)


def test_awkward_rows(spark):
    check(clashing(awkward(spark)))
    assert M.build_manifest(docs(spark, [])).proofs().count() == 0
    one = docs(spark, [(5, "only")])
    assert [r.proof for r in spark.createDataFrame(manifest(one), "id long, leaf string, subroot string, root string, "
                                                   "proof string").collect()] == [""]
    check(one)


def test_many_leaves_far_negative_and_repeated_ids(spark):
    random.seed(11)
    ids = [random.choice([random.randint(-50, 400), random.randint(-2**63, 2**63 - 1), 7, None]) for _ in range(1200)]
    rows = [(i, random.choice(["x", "y", "same"]), random.choice(["a", "a", "b", None, "é", "Z"])) for i in ids]
    check(docs(spark, rows))


def test_many_sources(spark):
    check(docs(spark, [(k, "t", f"s{k % 300}") for k in range(700)]))


@pytest.mark.parametrize("n", [4096, 4097, 9000])
def test_trees_of_more_than_one_chunk(spark, n):
    check(docs(spark, [(k, str(k), "s") for k in range(n)] + [(k, "o", "t") for k in range(17)]))


def test_a_document_repeated_very_often_is_split(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 50)
    rows = [(9, "copy", "s")] * 900 + [(9, f"other {k}", "s") for k in range(120)] + [(k, "t", "s") for k in range(30)]
    check(docs(spark, rows))


def test_ranks_need_no_sort_of_leaves(spark):
    df = docs(spark, [(k, "t", "s") for k in range(50)]).select(F.col("doc_id").alias("id"), F.col("source").alias("grp"))
    index = M.bitmap_index(df)
    assert index.count() == 1 and index.first().bits != 0
    p = M.places(df, index)._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in p.split("\n") if "Window [" in ln]
    # only directory nodes are ordered, at most 2**16 below one parent
    assert windows and all("windowspecdefinition(grp" in ln and "[node#" in ln for ln in windows)
    assert sorted((r.id, r.first, r.copies) for r in M.places(df, index).collect()) == [(k, k, 1) for k in range(50)]


def test_tampered_leaves_do_not_verify(spark):
    df = docs(spark, [(k, f"Text {k}", f"s{k % 3}") for k in range(60)])
    p = M.build_manifest(df, carry={"tampered": F.when(F.col("doc_id") % 5 == 0, F.sha2(F.lit("x"), 256))}).proofs()
    out = p.select("id", (M.fold_path(F.coalesce("tampered", "leaf"), F.col("path")) == F.col("root")).alias("ok"))
    assert {r.id: r.ok for r in out.collect()} == {k: k % 5 != 0 for k in range(60)}

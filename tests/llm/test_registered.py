"""Registered corpus queries on the smallest tables: DuckDB, contracts and the pipeline by brute force."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pacekit.llm.oracle import SQL
from pacekit.llm.packing import WordEncoder
from pacekit.llm.queries import REGISTRY, word_tokenizer
from pacekit.llm.toxicity import score_toxicity
from tests.llm.helpers import awkward, clashing, docs

SF = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@driver_tables
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = REGISTRY[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@driver_tables
def test_every_operator_is_registered(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    import __spark_entry__ as E
    assert {*REGISTRY, "pipeline"} <= set(E.queries())


@driver_tables
def test_shards_hold_whole_documents(spark):
    out = REGISTRY["op10_shard_rows"](spark, SF)
    folder = {f.split("/shard=")[0] for f in out.inputFiles()}
    assert len(folder) == 1                                # the digests are read from the shards
    shards = spark.read.parquet(*folder)
    want = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(shards.select(*want.columns).collect()) == sorted(want.collect())
    kept = {(r.shard, r.slot): r.text for r in shards.collect()}
    for r in out.collect():
        text = kept[r.shard, r.slot].encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))


@driver_tables
def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    s = {r.doc_id: r for r in REGISTRY["op9_toxicity"](spark, sf).collect()}
    assert len(s) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in s.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in s.items())
    marks = [(s[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
             if s[r.doc_id].held_out]
    pos, neg = [x for x, y in marks if y], [x for x, y in marks if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85
    assert np.mean([x >= 0.7 for x in pos]) > 0.6 and np.mean([x >= 0.7 for x in neg]) < 0.05


def test_toxicity_learns_and_takes_awkward_rows(spark):
    rows = [(i, ("You are scum, idiot! " if i % 4 == 0 else "a quiet day by the sea ") + f"w{i} " * 9) for i in range(200)]
    df = clashing(docs(spark, rows)).unionByName(clashing(awkward(spark).withColumn("doc_id", F.col("doc_id") + 1000)))
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(200)] + [(3, None), (None, 1)],
                                   "doc_id long, toxic int")
    got = score_toxicity(df, labels).collect()
    assert len(got) == df.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == (i % 4 == 0) for i in range(200))
    assert by[1001].score == by[1002].score and by[1001].predicted == 0
    none = score_toxicity(df, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.0}
    assert score_toxicity(docs(spark, []), labels).count() == 0


def pipeline_tables(spark, path):
    """Planted toxic documents, copies, near copies, sources of three sizes."""
    rng = np.random.default_rng(3)
    words = [hashlib.md5(str(i).encode()).hexdigest()[:7] for i in range(900)]
    rows = []
    for i in range(600):
        t = " ".join(rng.choice(words, 60))
        if i % 10 == 0:
            t = "you idiot scum idiot you moron " + t + " idiot scum moron"
        rows.append((i, t, f"s{i % 3}"))
    base = rows[11][1].split()
    rows += [(700 + i, rows[5][1], "s0") for i in range(20)]
    for i in range(15):
        w = list(base)
        w[7 + i] = "changed"
        rows.append((800 + i, " ".join(w), "s1"))
    rows += [(900, None, None), (901, "", "s0")]
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i % 10 == 0)) for i in range(600)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_pipeline_by_brute_force(spark, tmp_path):
    rows = pipeline_tables(spark, str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, got, str(tmp_path))
        if k < len(P.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/stage{k}")
        got = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append(sorted(r.doc_id for r in got.select("doc_id").collect()))
    clean = {i for i, t, _ in rows if not (t or "").startswith("you idiot")}
    assert set(kept[0]) == clean
    best = {}
    for i, t, _ in rows:
        if i in clean:
            best[t or ""] = max(i, best.get(t or "", -1))
    assert kept[1] == sorted(best.values())
    near = set(kept[2])
    assert near == set(kept[1]) - set(range(800, 815))            # near copies of 11 go, 11 stays
    text = {i: t or "" for i, t, _ in rows}
    taken = sum(len(text[i].split()) for i in kept[3])
    assert abs(taken - 1.5 * sum(len(text[i].split()) for i in near)) < 300
    assert all(kept[3].count(i) <= 2 for i in near)
    pieces = got.collect()
    enc = WordEncoder(word_tokenizer())
    ids, counts = enc.batch(pa.array([text[i] for i in kept[3]]))
    assert sum(r.length for r in pieces) == len(ids) + len(counts)
    assert P.run(spark, str(tmp_path)).count() == len(pieces)


@driver_tables
def test_digest_queries_on_driver_tables(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in REGISTRY["op6_secret_scan"](spark, SF).collect():
        spans = [m.span() for m in re.finditer("[0-9a-f]{16,}", text[r.doc_id])]
        assert r.n_hex == len(spans)
    for r in REGISTRY["op1_personal_data"](spark, SF).collect():
        base = [s for s in r.spans.split(",") if s]
        if not r.n_added:
            assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256

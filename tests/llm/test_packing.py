import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pacekit.llm import common, ngram_join, packing
from pacekit.llm.common import arrow_batches, released
from pacekit.llm.packing import (
    ARROW_BYTES, BATCH_BYTES, GROUP_PIECES, WordEncoder, cuts, difference, pack, pack_documents, pack_items, token_pieces)
from pacekit.llm.queries import op8_pack_windows, word_tokenizer
from tests.llm.helpers import awkward, clashing, docs


@pytest.fixture(scope="module")
def enc():
    return WordEncoder(word_tokenizer())


def test_word_encoder_equals_the_tokenizer(enc):
    rng = random.Random(5)
    alphabet = "aBZéÉßñİıſΣσ09_'’-.!@#$%&*()<>|~`\"\\/é́\x00\x1c\x85\xa0‍\t\n½²٣漢字🙂ÄµªºÐ×÷ŉDž don't we'll"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|> x", "", " ", "it's", "__a__1"]
    ids, counts = enc.batch(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for t, p in zip(texts, parts, strict=True):
        assert p.tolist() == enc.long_way(t), repr(t)


def test_added_tokens_in_texts_are_as_the_untouched_tokenizer_gives(enc):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_tokenizer())
    texts = ["x <|endoftext|> y", "<|startoftext|>a<|endoftext|><|endoftext|>", "x <|ENDOFTEXT|> y", "no token",
             "<|endoftext |>", "it's <|endoftext|>it's\n\tÉ <|", ""]
    ids, counts = enc.batch(pa.array(texts))
    for t, p in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert p.tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)
    assert enc.batch(pa.array(texts[:1]))[0].tolist() == [343, 49407, 344]


def test_differencing_is_a_partition_with_small_spread():
    rng = np.random.default_rng(0)
    items = np.sort(rng.integers(1, 256, 400))[::-1]
    window, sums = difference(items, 25)
    assert np.array_equal(np.sort(np.bincount(window, weights=items, minlength=25)), np.sort(sums))
    assert sums.max() - sums.min() <= 16
    w, s = difference(np.array([8, 7, 6, 5, 4]), 2)       # the classic case: 16 / 14
    assert sorted(s) == [14, 16] and len(w) == 5


def test_window_count_rises_when_capacity_is_exceeded():
    w = pack_items(np.array([60, 60, 60]), 100)
    assert sorted(w.tolist()) == [0, 1, 2]
    assert len(set(pack_items(np.array([50, 50, 30]), 100).tolist())) == 2


@pytest.mark.parametrize("n", [1, 255, 256, 257, 2047, 2048, 2049, 9000])
def test_cuts_cover_each_token_once(n):
    at = 0
    for s, m in cuts(n):
        assert s == at and 0 < m <= 2048
        at += m
    assert at == n


def test_pack_round_trip(spark, enc):
    df = clashing(awkward(spark)).unionByName(clashing(docs(spark, [
        (100 + i, "the cat, sat on a mat " * (1 + i * 31 % 90)) for i in range(400)])))
    got = pack_documents(df, word_tokenizer(), with_ids=True).collect()
    want = sorted(tuple(enc.long_way(r.text or "")) + (1,) for r in df.select("text").collect())
    for r in got:
        assert len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    seen = []
    for (_, n), pieces in by_doc.items():
        copies = sum(1 for r in pieces if r.start == 0)
        pieces = sorted(pieces, key=lambda r: (r.start, r.sequence_id, r.offset))
        for c in range(copies):
            own = pieces[c::copies]
            assert sum(r.length for r in own) == n
            seen.append(tuple(x for r in own for x in r.ids))
    assert sorted(seen) == want
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at == rows[0].sequence_tokens
    tokens = sum(r.length for r in got)
    padded = sum(rows[0].padded_length for rows in windows.values())
    assert padded <= tokens * 1.05 + 2048


def test_checksums_come_from_the_packed_ids(spark):
    df = docs(spark, [(i, "the cat sat " * (1 + i * 131 % 900)) for i in range(40)])
    pieces = token_pieces(df, word_tokenizer(), with_ids=True)
    lost = pieces.withColumn("pieces", F.transform("pieces", lambda p: p.withField("ids_crc32", F.lit(0).cast("long"))))
    got = pack(lost).collect()
    assert got and all(zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in got)
    want = [(r.doc_id, r.start, r.ids_crc32) for r in pack(token_pieces(df, word_tokenizer())).collect()]
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in got) == sorted(want)


def test_queries_pack_the_ids(spark, tmp_dir):
    df = docs(spark, [(1, "a cat"), (2, None)])
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    for out in (op8_pack_windows(spark, tmp_dir), corpus_pipeline.packing(spark, df, tmp_dir)):
        assert " ids#" in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 2


def test_pack_empty_table(spark):
    assert pack_documents(docs(spark, []), word_tokenizer()).count() == 0


def test_long_ids_survive_null_ids(spark):
    big = (1 << 60) + 1
    got = pack_documents(docs(spark, [(big, "a"), (None, "b")]), word_tokenizer()).select("doc_id").collect()
    assert {r.doc_id for r in got} == {big, None}


def test_one_document_listed_very_often_is_many_groups(spark):
    """Equal pieces hash alike; beyond a few groups' worth they are dealt out by listing."""
    n = 100_000
    df = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a cat sat on a mat today").alias("text"))
    few = docs(spark, [(100 + k, f"other {k} words") for k in range(50)]).select("doc_id", "text")
    got = pack_documents(df.unionByName(few), word_tokenizer()).select(
        "doc_id", "length", "offset", "sequence_id", "sequence_tokens")
    groups = got.groupBy(F.shiftright("sequence_id", 24).alias("g")).count().collect()
    assert len(groups) > 2 and max(r["count"] for r in groups) < 2 * GROUP_PIECES
    assert got.filter("doc_id = 7").count() == n and got.count() == n + 50
    filled = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("sequence_tokens").alias("t"))
    assert filled.filter("n <> t or n > 2048").count() == 0
    assert filled.count() <= got.agg(F.sum("length")).first()[0] / 2048 * 1.05 + 8


ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("module, name, run", [
    (packing, "pieces", lambda df: pack_documents(df, word_tokenizer(), with_ids=True)),
    (ngram_join, "jaccard-keys", lambda df: ngram_join.jaccard_components(df)),
])
def test_whole_texts_reach_the_workers_in_small_batches(spark, monkeypatch, module, name, run):
    seen, before = {}, spark.conf.get(ARROW_LIMIT)
    write = module.stored

    def watched(df, name, *a):
        seen.setdefault(name, spark.conf.get(ARROW_LIMIT))
        return write(df, name, *a)

    monkeypatch.setattr(module, "stored", watched)
    df = docs(spark, [(1, "a cat sat on a mat"), (2, "a cat sat on a mat"), (3, None)])
    assert run(df).count() == 3
    assert int(seen[name]) == ARROW_BYTES <= BATCH_BYTES <= 4 << 20
    assert spark.conf.get(ARROW_LIMIT) == before


def test_arrow_batches_bound_what_a_worker_gets(spark):
    df = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))     # 12 MB in one split

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    with arrow_batches(spark, 1 << 20):
        got = df.mapInArrow(run, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 6000 and max(r.bytes for r in got) < 2 << 20


def test_a_task_gives_its_memory_back_after_its_last_batch(monkeypatch):
    said = []
    monkeypatch.setattr(common, "release_memory", lambda: said.append("released"))

    def run(batches):
        try:
            for b in batches:
                yield b + 1
        finally:
            said.append("over")

    assert list(released(run)(iter([1, 2]))) == [2, 3]
    assert said == ["over", "released"]

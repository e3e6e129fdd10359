"""Byte-level BPE against the tokenizer library, on awkward texts and whole tables."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from pacekit.llm import byte_bpe as B
from pacekit.llm.queries import byte_ranks, op11_byte_bpe
from tests.llm.helpers import awkward, clashing, docs

ALPHABET = [" ", "  ", "'", "''", "s", "t", "re", "ve", "ll", "l", "r", "v", "e", "m", "d", "x", "S", "É", "1", "²", "\n",
            "\t", " ", "　", "\x1c", "\x85", "!", "…", "é", "中", "́", "\U0001f600", "\x00", "​"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(byte_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(texts):
    ids, counts, where = B.coder(byte_ranks()).encode(pa.array(texts, pa.string()))
    ends = np.concatenate([[0], np.cumsum(counts)])
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)], (ids, counts, where)


def test_random_texts_as_the_library_has_them(library):
    random.seed(7)
    texts = ["".join(random.choices(ALPHABET, k=random.randint(0, 16))) for _ in range(20_000)]
    texts += ["", "'", " ", "'r", "'l", "' ll", "a'll's", "中" * 3000, "a" * 20_000, " " * 5000, "'" * 999]
    got, flat = coded(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert B.coder(byte_ranks()).decode(*flat).to_pylist() == [t.encode() for t in texts]


def test_offsets_point_at_the_tokens(library):
    text = "Straße, it's 12 o'clock — 中文 \U0001f600!"
    _, (ids, counts, where) = coded([text, text])
    raw = text.encode()
    for token, at in zip(ids.tolist(), where.tolist(), strict=True):
        piece = library.decode_single_token_bytes(token)
        assert raw[at:at + len(piece)] == piece
    bad = where.copy()
    bad[1] += 1
    with pytest.raises(ValueError):
        B.coder(byte_ranks()).decode(ids, counts, bad)


def test_scan_does_not_depend_on_the_blocks(monkeypatch):
    random.seed(8)
    symbols = np.array([random.randrange(B.SYMBOLS) for _ in range(1000)], np.uint8)
    symbols[[0, 100, 101, 500]] += B.SYMBOLS
    want, state, pending = [], 0, None
    for s in [*symbols.tolist(), B.SYMBOLS]:                  # one symbol after the other
        state, told = B._step(state, s % B.SYMBOLS, s >= B.SYMBOLS)
        if pending is not None:
            want.append(pending or bool(told & B.BEFORE))
        pending = bool(told & B.HERE)
    for block in (1, 7, 64, 4096):
        monkeypatch.setattr(B, "BLOCK", block)
        assert B.piece_starts(symbols).tolist() == want


def test_documents_round_trip(spark, library):
    df = clashing(awkward(spark))
    rows = B.decode_documents(B.encode_documents(df, byte_ranks()), byte_ranks()).collect()
    want = sorted((r.doc_id or -1, r.text or "") for r in df.select("doc_id", "text").collect())
    assert sorted((r.doc_id or -1, r.decoded.decode()) for r in rows) == want
    assert sorted((r.doc_id or -1, B.unpacked(r.ids)) for r in rows) == sorted(
        (i, library.encode_ordinary(t)) for i, t in want)
    assert B.encode_documents(docs(spark, []), byte_ranks()).count() == 0


def test_query_equals_the_library_on_a_table(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in op11_byte_bpe(spark, sf).collect())
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)

import base64
import hashlib
import random

import pytest
import tiktoken

from callcredit.llm import bpe
from callcredit.llm.catalog import tokenizer
from llm_helpers import docs_of, rng  # noqa: F401

PATH, PATTERN = tokenizer()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(RANKS)


def test_pieces_append_and_edit(vocabulary):
    rng = random.Random(5)
    pool = list(RANKS)
    for _ in range(400):
        piece = b"".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))
        table = bpe.Prefixes(vocabulary, piece[:3])
        table.append(piece[3:])
        if piece not in RANKS:
            assert table.ids() == REFERENCE._core_bpe.encode_single_piece(piece)
        i = rng.randint(0, len(piece))
        j = rng.randint(i, len(piece))
        new = rng.choice(pool)
        table.replace(i, j, new)
        assert table.last == bpe.Prefixes(vocabulary, piece[:i] + new + piece[j:]).last


def test_edit_recomputes_near_the_edit_only(vocabulary):
    table = bpe.Prefixes(vocabulary, b"the quiet river of stone and amber " * 200)
    assert table.replace(100, 103, b"xyz") < 600


def test_round_trip_matches_the_library(spark, docs_of):
    texts = [None, "", " ", "it's 12 o'clock", "naïve  Straße\n\n x", "日本語テキスト", "a" * 3000, "​﻿", "<|endoftext|>", "ab" * 5000 + " end"]
    rows = list(enumerate(texts)) + [(1, ""), (None, "no id")]
    got = {(r.doc_id, r.ids_sha256): r for r in bpe.round_trip(docs_of(rows), PATH, PATTERN).collect()}
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        r = got[i, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()]
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_decode_keep_columns(spark, docs_of):
    docs = docs_of([(1, "some text"), (2, None)])
    ids = bpe.encode(docs, PATH, PATTERN)
    assert ids.columns == [*docs.columns, "ids"]
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(ids, PATH, PATTERN).collect()}
    assert back == {1: b"some text", 2: b""}
    assert bpe.checked_ids(docs, PATH, PATTERN).where("exact").count() == 2
    assert bpe.round_trip(docs_of([]), PATH, PATTERN).count() == 0


def test_id_buffers_are_small(spark, docs_of, monkeypatch):
    """Ids leave in several batches of one buffer each, whatever the texts."""
    from callcredit.llm import text
    monkeypatch.setattr(text, "PART_BYTES", 50)
    rows = [(i, "some words " * (i % 7) if i % 5 else None) for i in range(40)]
    docs = docs_of(rows)
    path, pattern = PATH, PATTERN
    got = {r.doc_id: r for r in bpe.checked_ids(docs, path, pattern).collect()}
    for i, t in rows:
        assert got[i].ids == bpe.encoder(path, pattern).encode(t) and got[i].n_tokens == len(got[i].ids) and got[i].exact
    back = bpe.decode(bpe.encode(docs, path, pattern), path, pattern).select("doc_id", "decoded").collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {i: t or "" for i, t in rows}


def test_what_a_task_remembers_is_bounded(vocabulary):
    """Texts of ever new pieces: both memories of pieces together, the tables
    of beginnings and the pair tests stay within fixed numbers of entries."""
    enc = bpe.Encoder(PATH, PATTERN)
    pairs = enc.vocabulary.compatible.__self__
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(280):
        text = " ".join(letters[k % 26] + letters[i % 26] + letters[i // 26 % 26] + letters[k // 26] + letters[i // 676 % 26] for i in range(1000))
        pieces = enc.pieces(text)
        assert enc.decode_pieces(pieces) == text.encode() and len(enc._ids) + len(enc._older) <= 1 << 18
    assert len(enc._older) <= 1 << 17 and len(enc._bytes) <= 1 << 17 and len(enc._heads) <= 1 << 15 and len(pairs) <= 1 << 18
    few = bpe.Remembered(lambda x: x + 1, 3)
    assert [few[i] for i in (1, 2, 3, 1, 4, 1)] == [2, 3, 4, 2, 5, 2] and len(few) == 2

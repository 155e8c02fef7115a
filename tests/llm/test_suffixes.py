import hashlib
import random

import numpy as np
import pytest

from callcredit.llm import suffixes
from llm_helpers import docs_of, rng, words  # noqa: F401


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(500):
        symbols = [rng.randint(1, rng.choice([1, 2, 3, 200])) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            symbols = (symbols[:7] * 20)[:80]
        depth = rng.choice([1, 2, 3, 5, 10, 100])
        order = suffixes.suffix_array(np.array(symbols), depth).tolist()
        assert sorted(order) == list(range(len(symbols)))
        keys = [symbols[i:i + depth] for i in order]
        assert keys == sorted(keys)


def brute(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(raw[s:s + length])
        spans = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(raw, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("block", [2, 4096])
def test_matches_brute_force(spark, docs_of, rng, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    common, line = words(rng, 60), words(rng, 17)[:101]
    rows = [(0, None), (1, ""), (2, "é" * 49), (3, "é" * 50), (4, "é" * 51), (5, "ab" * 400), (6, "x" * 5000), (7, "x" * 99), (8, common), (9, common)]
    for i in range(10, 60):
        t = words(rng, rng.randint(0, 90))
        if rng.random() < 0.6:
            cut = rng.randint(0, 150)
            t += " " + rng.choice([common, line, common[cut:], common[:cut + 60]]) + words(rng, rng.randint(0, 30))
        if rng.random() < 0.3:
            t += t[:rng.randint(0, len(t))] + rows[rng.randrange(8, len(rows))][1]
        rows.append((i, t))
    rows += [(None, common + "tail"), rows[20], rows[9], (200, words(rng, 8000) + common + words(rng, 100))]
    got = suffixes.deduplicate(docs_of(rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id], r.doc_id
    assert sum(v[1] for v in want.values()) > 5000


def test_empty(spark, docs_of):
    assert suffixes.deduplicate(docs_of([])).count() == 0


def test_texts_with_one_32_bit_hash_under_a_null_id(spark, docs_of, rng):
    from pyspark.sql import functions as F
    shared = words(rng, 30)
    n, hexed = F.col("id").cast("string"), lambda k: F.sha2(F.concat(F.lit(k), F.col("id").cast("string")), 512)
    ids = spark.range(250000)
    left = ids.select(F.concat(F.lit(shared), hexed("a")).alias("a"))
    right = ids.select(F.concat(hexed("b"), hexed("c"), F.lit(shared)).alias("b"))
    a, b = left.join(right, F.hash("a") == F.hash("b")).first()
    got = suffixes.deduplicate(docs_of([(1, shared), (None, a), (None, b)])).collect()
    kept = {bytes(r.kept).decode() for r in got if r.doc_id is None}
    assert kept == {a[len(shared):], b[:-len(shared)]}

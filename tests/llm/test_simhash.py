import numpy as np
import pytest
import xxhash

from callcredit.llm import simhash
from llm_helpers import docs_of, rng, words  # noqa: F401


def brute_fingerprint(text, k=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + k]), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprints(rng):
    for t in [None, "", "one", "one two three four", "Ünï CASE  x\ty", words(rng, 300)]:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_components_match_brute_force(spark, docs_of, rng):
    texts = [None, "", "  "]
    for n in (3, 30, 60, 120, 300):
        for _ in range(6):
            t = words(rng, n).split()
            texts.append(" ".join(t))
            for _ in range(4):  # near copies, some of them near each other only
                t[rng.randrange(len(t))] = "changed"
                texts.append(" ".join(t))
    texts += texts[5:9]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(list(zip(ids, texts))), distance=6).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    comp = brute_components(fps, 6)
    least = {}
    for c, i in zip(comp, ids):
        least[c] = min(least.get(c, i), i)
    for i, f, c in zip(ids, fps, comp):
        assert got[i].fp % 2 ** 64 == f and got[i].component_id == least[c]
    assert len(set(comp)) < len(texts) - 10


@pytest.mark.parametrize("block", [2, 1024])
def test_links_in_blocks(spark, monkeypatch, block):
    """One dense group, cut into blocks or not, and chains beside it."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 64, 5, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        x = int(b)
        for _ in range(12):
            x ^= 1 << int(rng.integers(64))
            fps.add(x)
    fps |= {int(v) for v in rng.integers(0, 2 ** 64, 30, dtype=np.uint64)} | {0, 1, 3, 7, 2 ** 64 - 1}
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    n, ones, joint = simhash.bit_statistics(df)
    assert n == len(fps) and ones[0] == sum(f & 1 for f in fps)
    for distance in (1, 4):
        edges = simhash.links(spark, df, simhash.plan_parts(n, ones, joint, distance), distance)
        root = {r.node: r.root for r in simhash.components(spark, edges).collect()}
        comp = brute_components(fps, distance)
        by = {}
        for s, c in zip(signed, comp):
            by.setdefault(c, []).append(s)
        for group in by.values():
            assert {root.get(s, s) for s in group} == {min(group)}


def test_allocation_covers_the_distance():
    rng = np.random.default_rng(1)
    m = rng.integers(0, 2, (500, 64)).astype(float)
    for distance in range(0, 7):
        for n in (0, 1, 1000, 10 ** 9):
            parts = simhash.plan_parts(n, m.sum(0) / 500 * n, (m.T @ m) / 500 * n, distance)
            assert sorted(b for p in parts for b in p.bits) == list(range(64))
            assert sum(p.threshold + 1 for p in parts) == distance + 1


def test_keep_first(spark, docs_of, rng):
    a, b = words(rng, 80), words(rng, 90)
    docs = docs_of([(5, a), (3, a), (9, b), (9, b), (None, words(rng, 70)), (1, None), (2, "")])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "9", "None"]
    assert simhash.keep_first(docs_of([])).count() == 0

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from callcredit.llm import lexical
from llm_helpers import docs_of, rng, words  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    docs = [(i, fold(t)) for i, t in rows]
    held = [(i, Counter(t), len(t)) for i, t in docs if t]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for i, c, size in held:
            m = 25 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in fold(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i, s))
        out += [(item_id, r, x[3], x[4]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_terms():
    for text in (None, "", "A-b_C9 éÉx\tÀ1", "ǅ Kelvin K", "a\x00b\x7fc^d`e{f@g[h", "日本 語"):
        assert [t.decode() for t in lexical.terms(text.encode() if text is not None else None)] == fold(text)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id bigint, text string, doc_id int, score string")


@pytest.mark.parametrize("part, block", [(200, 8 << 20), (16 << 20, 300)])
def test_matches_brute_force(spark, docs_of, rng, monkeypatch, part, block):
    monkeypatch.setattr(lexical, "PART_BYTES", part)
    rows = [(i, words(rng, rng.choice([0, 1, 3, 20, 60, 400]))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, "..."), (3, rows[3][1]), (7, "other text"), (None, rows[10][1]), (153, "RIVER River é")]
    rows += [(i, "amber " * 9) for i in range(200, 220)]  # ties
    items = [(i, words(rng, rng.choice([1, 2, 9, 30]))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "unheard of"), (33, "amber AMBER!"), (33, "amber AMBER!"), (34, "É é"), (2, "river stone"), ((1 << 62), rows[5][1] or "cloud")]
    got = lexical.search(docs_of(rows), items_of(spark, items), block_bytes=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, items)


def test_empty(spark, docs_of):
    assert lexical.search(docs_of([]), items_of(spark, [(1, "a")])).count() == 0
    assert lexical.search(docs_of([(1, "a")]), items_of(spark, [])).count() == 0


def test_dotted_names(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "`doc.id` bigint, `the.text` string")
    got = lexical.search(docs, items_of(spark, [(5, "a")]), doc_id="doc.id", text="the.text").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [(5, 1, 1)]


def test_few_accumulators_once_the_best_are_known():
    """The frequent term of an item makes no accumulators where the rare ones decide."""
    rng = random.Random(5)
    texts = [("rare one two " if i % 50 == 0 else "") + "the " * rng.randint(1, 4) + f"w{i}" for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "raw": [t.encode() for t in texts]})
    known = {t: i for i, t in enumerate([b"rare", b"one", b"two", b"the"])}
    postings = lexical.Postings(batch, known, 2000, 8000)
    item = [(0, 4000), (1, 4000), (2, 4000), (3, 100)]
    none = postings.doc[:0]
    found, score = lexical.score_batch(item, postings, 2000, 10, none)
    assert len(found) == 40 and (found % 50 == 0).all()
    full = [sum(w * int(dict(zip(*postings.of(t))).get(d, 0)) for t, w in item) for d in found.tolist()]
    assert score.tolist() == full

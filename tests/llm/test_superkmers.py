import hashlib
import random
import re

import pytest

from callcredit.llm import superkmers
from llm_helpers import docs_of, rng, words  # noqa: F401


def brute(rows, length=35):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for r, ws in enumerate(texts):
        for i in range(len(ws) - length + 1):
            seen.setdefault(tuple(ws[i:i + length]), []).append((r, i))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r].update(range(i, i + length))
    return sorted(((str(d), len(ws), len(g), " ".join(w for i, w in enumerate(ws) if i not in g)) for (d, _), ws, g in zip(rows, texts, gone)))


def same(got, rows, length=35):
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == brute(rows, length)


def test_super_kmers_cover_every_window(rng, monkeypatch):
    monkeypatch.setattr(superkmers, "SECTION", 50)
    for n in (0, 34, 35, 36, 200, 333):
        text = superkmers.words_text(words(rng, n).encode())
        find = superkmers.Minimisers(35, 8)
        split, at = text.split(b" "), 0
        for minimiser, start, count, a, z in find(text):
            for s, c, x, y in zip(start.tolist(), count.tolist(), a.tolist(), z.tolist()):
                assert s == at and text[x:y] == b" ".join(split[s:s + c + 34])
                at += c
        assert at == max(n - 34, 0)


@pytest.mark.parametrize("hot, part", [(256, 4 << 20), (1, 2000), (3, 1)])
def test_matches_brute_force(spark, docs_of, rng, monkeypatch, hot, part):
    monkeypatch.setattr(superkmers, "PART_BYTES", part)
    passage, line = words(rng, 60), words(rng, 34)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a " * 34), (4, "a " * 35), (5, "a " * 36), (6, "b c " * 40), (7, passage), (8, "x" * 9000)]
    for i in range(10, 70):
        t = words(rng, rng.randint(0, 80))
        if rng.random() < 0.6:
            cut = rng.randint(0, 200)
            t += rng.choice([" ", "\n", "\t \r"]) + rng.choice([passage, line, passage[cut:], passage[:cut + 100]]) + " " + words(rng, rng.randint(0, 40))
        if rng.random() < 0.2:
            t += " " + (rows[rng.randrange(len(rows))][1] or "")
        rows.append((i, t))
    rows += [(None, passage + " tail"), (None, passage + " end"), rows[20], rows[30], (12, words(rng, 70)), (80, words(rng, 3000) + " " + passage + " " + words(rng, 50)),
             (81, "É" + passage.replace(" ", "  ")), ((1 << 63) - 1, passage)]
    got = superkmers.deduplicate(docs_of(rows), hot=hot).collect()
    same(got, rows)
    assert sum(r.n_removed for r in got) > 1000


def test_other_lengths(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    for length, gram in ((5, 2), (9, 9), (6, 1)):
        same(superkmers.deduplicate(docs_of(rows), length=length, gram=gram, hot=4).collect(), rows, length)


def test_empty(spark, docs_of):
    assert superkmers.deduplicate(docs_of([])).count() == 0


def test_query_digests_the_kept_words(spark, docs_of, rng):
    t = words(rng, 50)
    got = superkmers.deduplicate(docs_of([(1, t + " one"), (2, t + " two")])).collect()
    assert {hashlib.sha256(r.kept.encode()).hexdigest() for r in got} == {hashlib.sha256(w).hexdigest() for w in (b"one", b"two")}

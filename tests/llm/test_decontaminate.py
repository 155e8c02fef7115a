import pytest

from callcredit.llm import decontaminate
from llm_helpers import docs_of, rng, words  # noqa: F401


@pytest.fixture()
def items(spark, rng):
    rows = [(1, words(rng, 25)), (2, words(rng, 15)), (3, words(rng, 5)), (4, None), (5, "")]
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id bigint, text string, bits int"), dict(rows)


def test_overlaps(spark, docs_of, rng, items):
    table, text = items
    changed = text[1].split()
    changed[4], changed[11], changed[18] = "odd", "other", "third"
    rows = [(1, words(rng, 200)), (2, f"{words(rng, 50)} {text[1]} {words(rng, 50)}"), (3, text[2].upper() + "!"), (4, " ".join(changed)),
            (5, None), (6, ""), (7, " ".join(text[1].split()[:8])), (8, text[3]), (2, f"{words(rng, 50)} {text[1]} {words(rng, 50)}"),
            (None, text[2]), (9, words(rng, 20000) + " " + text[2])]
    got = decontaminate.overlaps(docs_of(rows), table).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found >= {(2, 1), (3, 2), (4, 1), (None, 2), (9, 2)}
    assert not {d for d, _ in found} & {1, 5, 6, 7, 8}
    assert sum(r.doc_id == 2 for r in got) == 2  # two texts under one id
    exact = [r for r in got if r.doc_id == 3][0]
    assert (exact.item_words, exact.equal_words, exact.window_equal) == (15, 15, 13)


def test_two_substitutions_in_every_window_are_found():
    from itertools import combinations
    for gone in combinations(range(decontaminate.WINDOW), 2):
        assert any(not {s + o for o in m} & set(gone)
                   for m in decontaminate.MASKS for s in range(decontaminate.WINDOW - decontaminate.SPAN + 1))


def test_keep_clean_and_empty_tables(spark, docs_of, rng, items):
    table, text = items
    docs = docs_of([(1, text[1]), (2, words(rng, 30)), (3, None), (2, words(rng, 30))])
    kept = decontaminate.keep_clean(docs, table)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 2, 3]
    assert decontaminate.keep_clean(docs, table.limit(0)).count() == 4
    assert decontaminate.overlaps(docs.limit(0), table).count() == 0


def test_full_bitmaps_change_nothing(spark, docs_of, rng, items, monkeypatch):
    """With every bit set the sieve lets all through and the join decides."""
    table, text = items
    docs = docs_of([(1, words(rng, 60) + " " + text[1]), (2, words(rng, 60))])
    from pyspark.sql import functions as F
    monkeypatch.setattr(decontaminate, "bitmap", lambda _: spark.range(1).select(
        F.array_repeat(F.lit(-1).cast("bigint"), 2 * decontaminate.BIT_WORDS).alias("bits")))
    assert [(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, table).collect()] == [(1, 1)]


def test_short_masks_hold_every_pattern():
    from itertools import combinations
    for n in range(1, decontaminate.WINDOW):
        k = decontaminate.may_differ(n)
        assert k == (0 if n < 5 else 1 if n < 10 else 2)
        for gone in combinations(range(n), k):
            assert any(not set(m) & set(gone) for m in decontaminate.short_masks(n)), (n, gone)


def test_every_pattern_of_short_items_is_found(spark, docs_of):
    """Items of 1 to 12 words, with each set of words that may differ and
    with one word more, in the middle of a text."""
    from itertools import combinations
    item = {n: [f"i{n}w{j}" for j in range(n)] for n in range(1, decontaminate.WINDOW)}
    rows, want = [], set()
    for n, ws in item.items():
        k = decontaminate.may_differ(n)
        for some in (k, k + 1):
            for gone in combinations(range(n), some) if some == k or n > 4 else [(0,)]:
                rows.append((len(rows), "start of it " + " ".join("other" if j in gone else w for j, w in enumerate(ws)) + " and an end"))
                want |= {(len(rows) - 1, n, n - k)} if some == k else set()
    table = spark.createDataFrame([(n, " ".join(ws)) for n, ws in item.items()], "item_id bigint, text string")
    got = decontaminate.overlaps(docs_of(rows), table, least_words=1).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in got} == want and len(got) == len(want)
    by_default = decontaminate.overlaps(docs_of(rows), table).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in by_default} == {w for w in want if w[1] >= decontaminate.SPAN}


def test_registered_queries_find_short_items(spark, tmp_path):
    import corpus_pipeline
    from callcredit.llm import catalog
    docs = spark.createDataFrame([(1, "what is the capital of france " * 30), (2, "nothing of this here"), (3, "of france"), (4, None)], "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "What is the capital of France?"), (2, ""), (3, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [tuple(r) for r in catalog.QUERIES["op7_benchmark_decontamination"](spark, str(tmp_path)).collect()] == [(1, 1, 6, 6, 6)]
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]

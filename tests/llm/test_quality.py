import re
from collections import Counter

from callcredit.llm import quality
from llm_helpers import docs_of, rng, words  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {p for i in range(len(ws) - 7) if seen[tuple(ws[i:i + 8])] > 1 for p in range(i, i + 8)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def texts(rng):
    base = [words(rng, n) for n in (0, 1, 7, 8, 9, 19, 20, 40, 200)]
    loop = words(rng, 9)
    return [None, "", " \t\n\x0b\x0c\r ", "a b c", *base, loop + " " + loop, "a " * 30, "x\ny\nx\n \n \nx", words(rng, 5000) + " " + loop + " # $ " + loop,
            "\n".join([loop] * 6), "SHOUT!! " * 40, "w* " * 50, "é ü ñ " * 12]


def test_metrics_match_brute_force(spark, docs_of, rng):
    rows = list(enumerate(texts(rng)))
    got = {r.doc_id: r for r in quality.annotate(docs_of(rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_verdict(spark, docs_of, rng):
    good = "The " + words(rng, 120) + "."
    rows = [(1, good), (2, good), (3, good.upper()), (4, " ".join(w + "***" for w in good.split())), (5, "one two three")]
    kept = quality.keep_good(docs_of(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert kept.columns == docs_of(rows).columns


def test_rules_are_a_parameter_and_empty_tables_work(spark, docs_of):
    lax = quality.annotate(docs_of([(1, "w* " * 30)]), rules=()).first()
    assert lax.failed_rules == ""
    assert quality.keep_good(docs_of([])).count() == 0


def test_plan_is_one_projection(spark, docs_of):
    plan = quality.annotate(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_the_verdict_is_computed_once(spark, docs_of):
    """No copy of the metrics in a filter; any column name."""
    docs = docs_of([(1, "a")]).withColumnRenamed("lang", "the.lang")
    plan = quality.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    once = quality.annotate(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= once.count("split(") and "Python" not in plan
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(docs).count() == 0

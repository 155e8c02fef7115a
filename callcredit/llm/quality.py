"""Quality rules: a threshold table compiled into one projection.

The metrics of a text (lengths, symbols, stop words, line and repetition
counts) and the verdict of every rule are built-in Spark expressions, so a
scan of the documents is all the work there is: no shuffle, no user function.

Defined results: a null text counts as empty; an empty text has no words,
all its counts are zero and it fails the base rule; repeated rows are judged
one by one; extra input columns are kept by :func:`annotate` unless they bear
the name of a metric, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bind, named, ratio, words

WINDOW = 8  # words in a repetition window

# Frequent function words of the corpus languages, in the
# lower-case spelling that running text has.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "with", "a", "this", "from", "by", "an", "be", "as", "are", "on", "at",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "dans", "pour", "est", "avec", "sur", "par", "au", "aux",
    "der", "die", "und", "das", "von", "den", "mit", "ein", "eine", "ist", "im", "auf", "zu", "dem", "des", "nicht", "sich", "test",
    "el", "los", "las", "y", "una", "por", "con", "para", "su", "del", "se", "no", "lo",
)


@dataclass(frozen=True)
class Rule:
    """A text fails when ``metric`` lies outside [low, high] and it has
    between ``min_words`` and ``max_words`` words."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    max_words: int | None = None


RULES = (
    Rule("mean_word_chars", "mean_word_chars", low=2.0, high=12.0),
    Rule("symbols_per_word", "symbols_per_word", high=0.1),
    Rule("upper_per_char", "upper_per_char", high=0.4),
    Rule("stop_words", "stop_ratio", low=0.01, min_words=50),
    Rule("duplicate_lines", "dup_line_ratio", high=0.4, min_words=30),
    Rule("few_distinct_words", "distinct_ratio", low=0.4, max_words=300),
)


def _run_hashes(hashes: Column, size: int) -> Column:
    """Hash of the ``size`` elements from each position on; those that run
    past the end are included (an absent element adds nothing)."""
    return bind(hashes, lambda h: F.transform(
        h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])))


def _covered_by_repeats(hashes: Column, size: int) -> Column:
    """Words covered by the windows whose hash occurs at least twice."""
    def repeated_starts(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), (same(x, k - 1) | same(x, k + 1)).alias("r")))
        return F.array_sort(F.transform(F.filter(marked, lambda x: x["r"]), lambda x: x["i"]))

    by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, i: F.struct(
        (i + size).alias("end"), (acc["n"] + size - F.greatest(F.lit(0), acc["end"] - i)).cast("bigint").alias("n"))
    return bind(by_hash, lambda s: F.aggregate(repeated_starts(s), start, step, lambda acc: acc["n"]))


def _n_repeat_words(ws: Column) -> Column:
    """Words in 8-word windows that occur at least twice in the text.

    A text without two equal half windows has no repeated window: one hash
    set settles almost every text.
    """
    none = F.lit(0).cast("bigint")

    def exact(h: Column) -> Column:
        full = F.slice(_run_hashes(h, WINDOW), F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
        return _covered_by_repeats(full, WINDOW)

    def gated(h: Column) -> Column:
        half = _run_hashes(h, WINDOW // 2)
        return F.when(bind(half, lambda x: F.size(F.array_distinct(x)) == F.size(x)), none).otherwise(exact(h))

    return bind(F.transform(ws, lambda w: F.xxhash64(w)), gated)


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column per metric; the text columns are read once."""
    raw = F.coalesce(F.col(text), F.lit(""))
    staged = docs.withColumn("_w", words(F.col(text)))
    w = F.col("_w")
    lines = F.filter(F.split(raw, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    counted = staged.withColumns({
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
        "n_symbols": (F.length(raw) - F.length(F.regexp_replace(raw, r"[#*$%&|<>]+", ""))).cast("bigint"),
        "n_upper": F.regexp_count(raw, F.lit("[A-Z]")).cast("bigint"),
        "_lines": bind(lines, lambda ls: F.struct(F.size(ls).alias("n"), F.size(F.array_distinct(ls)).alias("d"))),
        "n_repeat_words": _n_repeat_words(w),
        "n_distinct_words": F.size(F.array_distinct(w)).cast("bigint"),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("bigint"),
    })
    return counted.withColumns({
        "n_lines": F.col("_lines.n").cast("bigint"),
        "n_dup_lines": (F.col("_lines.n") - F.col("_lines.d")).cast("bigint"),
        "mean_word_chars": ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": ratio(F.col("n_symbols"), F.col("n_words")),
        "upper_per_char": ratio(F.col("n_upper"), F.col("word_chars")),
        "stop_ratio": ratio(F.col("n_stop_words"), F.col("n_words")),
        "dup_line_ratio": ratio(F.col("_lines.n") - F.col("_lines.d"), F.col("_lines.n")),
        "distinct_ratio": ratio(F.col("n_distinct_words"), F.col("n_words")),
    }).drop("_w", "_lines")


def _fails(rule: Rule) -> Column:
    m = F.col(rule.metric)
    out = F.lit(False)
    if rule.low is not None:
        out = out | (m < rule.low)
    if rule.high is not None:
        out = out | (m > rule.high)
    out = out & (F.col("n_words") >= rule.min_words)
    return out & (F.col("n_words") <= rule.max_words) if rule.max_words is not None else out


def annotate(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the metrics, ``base_failed``, ``failed_rules`` (names,
    comma-joined) and ``kept``."""
    names = docs.columns
    boxed = docs.select(F.struct(*[named(c) for c in names]).alias("_row"), named(text).alias("_t"))
    out = metrics(boxed, "_t").withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    failed = F.array(*[F.when(_fails(r), F.lit(r.name)) for r in rules]) if rules else F.array().cast("array<string>")
    out = out.withColumn("failed_rules", F.array_join(F.array_compact(failed), ","))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
    made = [c for c in out.columns if c not in ("_row", "_t")]
    return out.select(*[F.col("_row")[c].alias(c) for c in names if c not in made], *made)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    boxed = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row_"), named(text).alias("text_"))
    # a filter would be given a copy of every metric, a generator takes them as they are
    passed = F.explode(F.when(F.col("kept"), F.array("row_")))
    return annotate(boxed, "text_", rules).select(passed.alias("row_")).select("row_.*")

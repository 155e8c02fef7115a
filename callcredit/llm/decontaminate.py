"""Benchmark decontamination with spaced seeds, in Spark expressions only.

A seed is the hash of the words under a fixed mask of ``SPAN`` positions; the
positions the mask leaves out may differ.  Seeds of documents and benchmark
items are joined; each hit names a diagonal (document position minus item
position) on which the words are compared.  A document holds an item when on
some diagonal a window of ``WINDOW`` words (the whole item, if shorter) has at
least ``SHARE`` of its words equal.  The two masks find every such window of
13 words with up to two substitutions.  Items of fewer words have seeds over
the whole item: its positions are dealt to five groups, and of each choice of
as many groups as words may differ one seed leaves those groups out, so one of
them is without the words that differ (up to four words: one seed, all words).
Documents are searched for the lengths that the benchmark has.

Work before the join stays in the scan: two constant-size bitmaps of the
benchmark (word pairs, seeds) sieve the positions of each document.  They only
sieve; with a benchmark that fills them the join does more, with the same
result.  Documents with a surviving seed go to a table with their word
hashes, so no text is shuffled.

Defined results: words are runs of letters and digits, lower-cased; null and
empty texts and items of fewer than ``least_words`` words (by default
``SPAN``; the registered queries look for all) match nothing; null ids are
kept as an id of their own; repeated rows of one id and text, and repeated
items, count once; extra columns are ignored by :func:`overlaps` and kept by
:func:`keep_clean`.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcredit.session import materialize

from .text import bind, named

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))  # both start with a word pair
SPAN = 8
WINDOW = 13
SHARE = 0.8
BIT_WORDS = 1 << 17  # longs per bitmap: 1 MB
GROUPS = 5  # of the positions of an item shorter than WINDOW
_SHORT = 100  # mask numbers of items of n words begin at n times this


def may_differ(n: int) -> int:
    """Words of ``n`` that may differ with ``SHARE`` of them equal."""
    return max(k for k in range(n + 1) if n - k >= SHARE * n)


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Positions of the seeds of an item of ``n`` words: for each set of
    positions that may differ, one mask holds none of it."""
    groups = min(n, GROUPS)
    return [tuple(i for i in range(n) if i % groups not in out) for out in combinations(range(groups), may_differ(n))]


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _pair(h: Column, i: Column) -> Column:
    return F.xxhash64(F.get(h, i), F.get(h, i + 1))


def _seed(h: Column, i: Column, mask: int) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(h, i + o) for o in MASKS[mask]])


def _starts(h: Column) -> Column:
    return F.when(F.size(h) >= SPAN, F.sequence(F.lit(0), F.size(h) - SPAN)).otherwise(F.array().cast("array<int>"))


def _seeds(h: Column, starts: Column) -> Column:
    return F.flatten(F.transform(starts, lambda i: F.array(*[
        F.struct(i.alias("pos"), F.lit(m).alias("mask"), _seed(h, i, m).alias("seed")) for m in range(len(MASKS))])))


def _short_seed(h: Column, i: Column, n: int) -> Column:
    """All seeds of the ``n`` words from ``i`` on."""
    return F.array(*[F.struct(i.alias("pos"), F.lit(_SHORT * n + m).alias("mask"), F.xxhash64(F.lit(_SHORT * n + m), *[F.get(h, i + o) for o in mask]).alias("seed"))
                     for m, mask in enumerate(short_masks(n))])


def _short_seeds(h: Column, n: int) -> Column:
    starts = F.when(F.size(h) >= n, F.sequence(F.lit(0), F.size(h) - n)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, lambda i: _short_seed(h, i, n)))


def _item_seeds(h: Column) -> Column:
    """The seeds of an item, by its length."""
    out = _seeds(h, _starts(h))
    for n in range(1, WINDOW):
        short = F.when(F.size(h) == n, _short_seed(h, F.lit(0), n))
        out = F.concat(out, F.coalesce(short, F.array().cast("array<struct<pos:int,mask:int,seed:bigint>>")))
    return out


def _slot(hash_: Column) -> Column:
    return F.shiftrightunsigned(hash_, 47).cast("int")


def _bit(hash_: Column) -> Column:
    return hash_.bitwiseAND(F.lit(63)).cast("int")


def _marked(bits: Column, first: int, hash_: Column) -> Column:
    return F.bit_get(F.get(bits, _slot(hash_) + first), _bit(hash_)) == 1


def bitmap(items: DataFrame) -> DataFrame:
    """One row, ``bits``: the pair bitmap followed by the seed bitmap."""
    pairs = items.select(F.explode(F.transform(_starts(F.col("iw")), lambda i: _pair(F.col("iw"), i))).alias("h"), F.lit(0).alias("first"))
    seeds = items.select(F.explode(F.transform(_item_seeds(F.col("iw")), lambda s: s["seed"])).alias("h"),
                         F.lit(BIT_WORDS).alias("first"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("h")))
    filled = pairs.union(seeds).groupBy((_slot(F.col("h")) + F.col("first")).cast("bigint").alias("slot")).agg(F.bit_or(one).alias("v"))
    slots = items.sparkSession.range(2 * BIT_WORDS).withColumnRenamed("id", "slot")
    whole = slots.join(filled, "slot", "left").select(F.struct("slot", F.coalesce("v", F.lit(0).cast("bigint")).alias("v")).alias("s"))
    return whole.agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["v"]).alias("bits"))


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
             item_id: str = "item_id", item_text: str = "text", least_words: int = SPAN) -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, ``item_words``, and over the
    verified diagonals the most equal words (``equal_words``) and the best
    window (``window_equal``); one row per document text and item it holds."""
    items = items.select(named(item_id).alias("item_id"), word_hashes(named(item_text)).alias("iw")).distinct()
    items = materialize(items.where(F.size("iw") >= max(least_words, 1)), "decon-items")
    # the lengths below WINDOW that the benchmark has
    lengths = sorted(r["n"] for r in items.select(F.size("iw").alias("n")).where(F.col("n") < WINDOW).distinct().collect())
    exact = [n for n in lengths if not may_differ(n)]
    item_seeds = materialize(items.select("item_id", F.explode(_item_seeds(F.col("iw"))).alias("s")).select(
        "item_id", F.col("s.pos").alias("item_pos"), "s.mask", "s.seed"), "decon-seeds")
    bits = materialize(bitmap(items), "decon-bits")

    def sieve(s: Column) -> Column:
        starts = F.filter(_starts(s["h"]), lambda i: _marked(s["bits"], 0, _pair(s["h"], i)))
        marked = lambda x: _marked(s["bits"], BIT_WORDS, x["seed"])
        found = F.filter(_seeds(s["h"], starts), marked)
        return F.concat(found, *[F.filter(_short_seeds(s["h"], n), marked) for n in lengths]) if lengths else found

    found = docs.select(named(doc_id).alias("doc_id"), F.xxhash64(named(text)).alias("text_hash"), word_hashes(named(text)).alias("dw"))
    found = found.withColumn("bits", bits.scalar())
    # one expression: the word hashes are computed once and the bitmap is
    # never part of a row
    found = found.select("doc_id", "text_hash", bind(
        F.struct(F.col("dw").alias("h"), F.col("bits").alias("bits")),
        lambda s: F.struct(s["h"].alias("dw"), sieve(s).alias("seeds"))).alias("x"))
    found = materialize(found.where(F.size("x.seeds") > 0).select("doc_id", "text_hash", "x.dw", "x.seeds"), "decon-candidates")

    hits = found.select("doc_id", "text_hash", F.explode("seeds").alias("s")).select(
        "doc_id", "text_hash", "s.pos", "s.mask", "s.seed").join(item_seeds, ["mask", "seed"])
    diag = F.col("pos") - F.col("item_pos")
    if exact:  # all words are the seed: one place of a document tells
        whole = F.floor(F.col("mask") / _SHORT).isin(exact)
        hits = hits.groupBy("doc_id", "text_hash", "item_id", F.when(~whole, diag).alias("_at")).agg(F.min(diag).alias("diag")).drop("_at")
    else:
        hits = hits.select("doc_id", "text_hash", "item_id", diag.alias("diag"))
    hits = materialize(hits.distinct(), "decon-hits")

    texts = found.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "dw")
    sides = hits.join(texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
    sides = sides.join(items.select(F.col("item_id").alias("_i"), "iw"), F.col("item_id").eqNullSafe(F.col("_i")))

    def equal(s: Column) -> Column:
        low = F.greatest(F.lit(0), -s["diag"])
        high = F.least(F.size(s["iw"]), F.size(s["dw"]) - s["diag"]) - 1
        at = lambda q: F.coalesce(F.get(s["dw"], q + s["diag"]) == F.get(s["iw"], q), F.lit(False)).cast("int")
        return F.when(high >= low, F.transform(F.sequence(low, high), at)).otherwise(F.array().cast("array<int>"))

    add = lambda a, x: a + x
    window = F.least(F.lit(WINDOW), F.size("iw"))
    best = lambda eq: F.when(F.size(eq) >= window, F.array_max(F.transform(
        F.sequence(F.lit(1), F.size(eq) - window + 1), lambda i: F.aggregate(F.slice(eq, i, window), F.lit(0), add)))).otherwise(F.lit(0))
    checked = sides.select("doc_id", "text_hash", "item_id", F.size("iw").alias("item_words"), window.alias("window"), bind(
        bind(F.struct("dw", "iw", "diag"), equal),
        lambda eq: F.struct(F.aggregate(eq, F.lit(0), add).alias("n"), best(eq).alias("best"))).alias("m"))
    checked = checked.where(F.col("m.best") >= SHARE * F.col("window"))
    return checked.groupBy("doc_id", "text_hash", "item_id", "item_words").agg(
        F.max("m.n").alias("equal_words"), F.max("m.best").alias("window_equal"))


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", least_words: int = SPAN) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    names = docs.columns
    bad = materialize(overlaps(docs, items, doc_id, text, item_id, item_text, least_words).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct(), "decon-bad")
    boxed = docs.select(F.struct(*[named(c) for c in names]).alias("_row"), named(doc_id).alias("_id"), F.xxhash64(named(text)).alias("_th"))
    return boxed.join(bad, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_h")), "left_anti").select("_row.*")

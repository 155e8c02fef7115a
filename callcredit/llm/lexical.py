"""Ranked lexical search: accumulator-limited term-at-a-time scoring.

The documents stay where they are.  One pass counts the documents, their
terms and the documents of every query term; the second scores each batch of
documents against all items of a block:

1. The query terms of the batch become postings (term, document, frequency),
   sorted once by term.
2. An item takes its terms rarest first.  Each posting adds to its document's
   accumulator, made on first sight.  Once the most that all remaining terms
   can add in this batch lies below the k-th highest partial score, a document
   without an accumulator cannot come among the k highest: no more are made,
   and only those that exist are updated, exactly, to the last term.  The k-th
   partial score starts from the k best documents that the task has seen in
   its earlier batches, so later batches make few accumulators.
3. A task passes on its k best documents of each item; these are cut to k in
   two steps, by (item, one of ``FAN`` groups of tasks) and by item.

Sent to the tasks: the terms of one block of items (about ``BLOCK_BYTES`` of
item text) and their counts; more items take more blocks, each a scan.

Score: ``sum of w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms,
repeats included, in 64-bit integers, with ``w = floor(1000 ln((2N + 2) /
(2 df + 1)))`` and ``m = 25 + (75 n N) div L``.

Defined results: null and empty texts have no terms and are never found; an
item without terms, or whose terms no document holds, has no rows; equal
scores are ordered by ascending ``doc_id``, a null one last; every row of the
documents is ranked on its own, so repeated rows take a rank each; item rows
with equal id and text are one item; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callcredit.session import materialize

BLOCK_BYTES = 8 << 20  # item text that one scan of the documents looks for
PART_BYTES = 16 << 20  # text of a batch whose postings are held at once
FAN = 512  # groups of tasks whose best documents are cut together first
_BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(_BREAKS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_BREAKS) + b"abcdefghijklmnopqrstuvwxyz")


def terms(raw: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of ASCII letters and digits and all
    that is not ASCII, with A-Z in lower case."""
    return (raw or b"").translate(_FOLD).split()


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    return docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).cast("string").cast("binary").alias("raw"))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PART_BYTES`` of text."""
    sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column("raw")).to_pylist()], np.int64)
    part = np.cumsum(sizes) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        if z > a:
            yield batch.slice(a, z - a)


# -- corpus counts ------------------------------------------------------------

def corpus_counts(texts: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the number of
    documents of each word of ``vocabulary``."""
    known = {t: i for i, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = total = 0
        df = np.zeros(len(known), np.int64)
        for b in batches:
            for raw in b.column("raw"):
                found = terms(raw.as_py())
                if found:
                    docs, total = docs + 1, total + len(found)
                    df[[known[t] for t in known.keys() & set(found)]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], at])), pa.array(np.concatenate([[docs, total], df[at]]))],
                                         names=["term", "n"])

    rows = texts.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r.term: r.n for r in rows}
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in got.items():
        if t >= 0:
            df[t] = n
    return got.get(-2, 0), got.get(-1, 0), df


def weight(docs: int, df: int) -> int:
    """``w`` of a term that ``df`` of ``docs`` documents hold."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# -- one batch ----------------------------------------------------------------

class Postings:
    """Frequencies of the query terms in a batch of documents, by term."""

    def __init__(self, batch: pa.RecordBatch, known: dict[bytes, int], docs: int, total: int):
        found, owner, m = [], [], np.zeros(batch.num_rows, np.int64)
        for i, raw in enumerate(batch.column("raw")):
            all_terms = terms(raw.as_py())
            if all_terms:
                m[i] = 25 + (75 * len(all_terms) * docs) // total
                ids = [t for t in map(known.get, all_terms) if t is not None]
                found.append(np.array(ids, np.int64))
                owner.append(np.full(len(ids), i, np.int64))
        flat = np.concatenate([np.empty(0, np.int64), *found]) * batch.num_rows + np.concatenate([np.empty(0, np.int64), *owner])
        flat, tf = np.unique(flat, return_counts=True)
        term, self.doc = np.divmod(flat, max(batch.num_rows, 1))
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        self.ends = np.searchsorted(term, np.arange(len(known) + 1))
        self.highest = np.zeros(len(known), np.int64)
        np.maximum.at(self.highest, term, self.impact)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, z = self.ends[term], self.ends[term + 1]
        return self.doc[a:z], self.impact[a:z]


def kth(values: np.ndarray, k: int) -> int:
    """The k-th highest value; 0 where there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def score_batch(item: list[tuple[int, int]], postings: Postings, n_docs: int, k: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the batch that may be among the k highest, with their
    exact scores.  ``item``: (term, weight times occurrences), rarest first;
    ``best``: the k highest scores so far."""
    most = np.array([w * int(postings.highest[t]) for t, w in item] + [0], np.int64)
    remaining = np.cumsum(most[::-1])[::-1]  # what the terms from here on can add
    score, made = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    floor, creating = kth(best, k), True
    for j, (t, w) in enumerate(item):
        doc, impact = postings.of(t)
        if creating and remaining[j] < floor:
            creating = False
        if creating:
            made[doc] = True
        else:
            at = made[doc]
            doc, impact = doc[at], impact[at]
        score[doc] += w * impact
        if creating and len(doc):
            floor = max(floor, kth(np.concatenate([best, score[made]]), k))
    found = np.flatnonzero(made & (score > 0))
    return found, score[found]


def _highest(score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores, then smallest ids, null ids last."""
    keep = np.flatnonzero(score >= kth(score, k))
    return keep[np.lexsort((doc[keep], null[keep], -score[keep]))[:k]]


# -- search -------------------------------------------------------------------

def _search_block(texts: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """Best documents of each (item_id, terms), k at most from each task."""
    spark = texts.sparkSession
    vocabulary = sorted({t for _, found in items for t in found})
    docs, total, df = corpus_counts(texts, vocabulary)
    known = {t: i for i, t in enumerate(vocabulary)}
    weights = [weight(docs, int(n)) if n else 0 for n in df]
    queries = []
    for _, found in items:
        times = Counter(known[t] for t in found)
        useful = [t for t in times if df[t] and weights[t] > 0]
        queries.append([(t, weights[t] * times[t]) for t in sorted(useful, key=lambda t: (df[t], t))])
    shared = spark.sparkContext.broadcast((known, queries))  # of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, queries = shared.value
        none = np.empty(0, np.int64)
        held = [(none, none, none.astype(bool))] * len(queries)
        for whole in batches:
            for b in _parts(whole):
                ids = b.column("doc_id")
                null = np.asarray(ids.is_null())
                ids = ids.fill_null(0).to_numpy()
                postings = Postings(b, known, docs, total)
                for q, item in enumerate(queries):
                    at, score = score_batch(item, postings, b.num_rows, k, held[q][0])
                    if len(at):
                        merged = [np.concatenate(x) for x in zip(held[q], (score, ids[at], null[at]))]
                        keep = _highest(*merged, k)
                        held[q] = tuple(x[keep] for x in merged)
        sizes = [len(h[0]) for h in held]
        score, doc, null = (np.concatenate([h[i] for h in held]) for i in range(3)) if held else (none, none, none)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(held)), sizes)), pa.array(doc, pa.int64(), mask=null.astype(bool)),
                                          pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    found = texts.mapInArrow(run, "item bigint, doc_id bigint, score bigint").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item bigint, item_id bigint")
    return last.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k``
    documents of highest score above 0 for each item."""
    texts = _texts(docs, doc_id, text)
    asked = _texts(items, item_id, item_text).distinct()
    size = asked.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    dealt = materialize(asked.withColumn("block", F.pmod(F.xxhash64("doc_id", "raw"), F.lit(blocks))), "lexical-items")
    out = []
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).orderBy("doc_id", "raw").collect()
        found = [(r.doc_id, terms(bytes(r.raw) if r.raw is not None else None)) for r in rows]
        out.append(_search_block(texts, found, k))
    return reduce(DataFrame.unionByName, out)

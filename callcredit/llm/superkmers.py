"""Substring removal by super-k-mer partitioning.

A word goes when a window of ``LENGTH`` consecutive words that covers it also
starts anywhere else.  Of the ``GRAM``-word strings in a window, that of least
hash (the leftmost of equals) is its minimiser; equal windows have equal
minimisers at the same place.  Consecutive windows that share a minimiser at
one position are a super-k-mer: one string of words, joined by one space, that
travels as a whole to the bucket of its minimiser.

1. A first pass lists minimisers only (no strings) and counts them.  Two
   bitmaps of ``SLOTS`` bits hold the hashed minimisers that occur more than
   once and those that occur more than ``HOT`` times.  Their size does not
   depend on the data: full ones let more strings travel and change no result.
2. The second pass sends the super-k-mers of minimisers that may occur again.
   Where many share one minimiser (a frequent line with ever different words
   around it) the super-k-mer is taken apart into its windows, each dealt by its
   own hash, so that no bucket grows with the corpus.  Equal strings of a batch
   are settled there and then: they are repeats as a whole, and one row stands
   for them in the bucket.
3. A bucket arrives sorted by (minimiser, string).  Equal strings repeat as a
   whole; the windows of the different strings of a minimiser are sorted and
   neighbours compared, byte by byte, so counts are exact.
4. The removed runs of each document meet its text again.

Defined results: null and empty texts have no words; texts of fewer than
``LENGTH`` words lose nothing; every row is a document of its own, so repeated
rows remove each other's windows; null ids are kept apart by a 64-bit hash of
their text, as are different texts under one id; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.session import materialize

LENGTH = 35  # words of a window
GRAM = 8  # words of a minimiser
SLOTS = 1 << 27  # bits of each bitmap: 16 MB
HOT = 256  # rows of one minimiser beyond which its windows are dealt one by one
PART_BYTES = 4 << 20  # text whose super-k-mers are held at once
SECTION = 1 << 16  # windows of one text that are looked at together
_BUCKET = 1 << 15  # bits in one row of Spark's bitmap functions
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(12).integers(0, 2 ** 64, 256, dtype=np.uint64)
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def words_text(raw: bytes | None) -> bytes:
    """The words of a text, joined by one space."""
    out = (raw or b"").translate(_SPACES)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out.strip(b" ")


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of :func:`words_text`."""
    if not joined:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])


class Minimisers:
    """Super-k-mers of byte strings, with powers kept for the longest so far."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.span = length, gram, length - gram + 1
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, joined: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Sections of a text: minimiser, first window, number of windows,
        start and end byte of every super-k-mer."""
        starts, ends = word_bounds(joined)
        windows = len(starts) - self.length + 1
        for a in range(0, max(windows, 0), SECTION):
            z = min(a + SECTION, windows) + self.length - 1  # words a to z
            yield self._section(joined, starts[a:z], ends[a:z], a)

    def _section(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
        base = int(starts[0])
        data = np.frombuffer(joined, np.uint8)[base:int(ends[-1])]
        if len(self.up) <= len(data):
            self.up, self.down = _powers(_ODD, 2 * len(data)), _powers(pow(_ODD, -1, 2 ** 64), 2 * len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * self.up[:len(data)])])
        at = starts[:len(starts) - self.gram + 1] - base
        h = (sums[ends[self.gram - 1:] - base] - sums[at]) * self.down[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        # hash first, then place: the least is the leftmost of the least hash
        place = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        least = (_sliding_least(place, self.span) & np.uint64((1 << 20) - 1)).astype(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        stop = np.append(cut[1:], len(least))
        return h[least[cut]].view(np.int64), cut + first, stop - cut, starts[cut], ends[stop + self.length - 2]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` neighbours, from running least values
    forwards and backwards within blocks of ``w``."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.uint64(2 ** 64 - 1))
    blocks[:n] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


# -- the distributed steps ----------------------------------------------------

def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    raw = F.coalesce(quoted(text).cast("string"), F.lit(""))
    return docs.select(quoted(doc_id).cast("bigint").alias("doc"), F.xxhash64(raw).alias("sub"), raw.cast("binary").alias("raw"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    """Ids, hashes and joined words of documents, about ``PART_BYTES`` at a time."""
    doc, sub, text, size = [], [], [], 0
    for b in batches:
        for d, s, raw in zip(b.column("doc").to_pylist(), b.column("sub").to_pylist(), b.column("raw")):
            joined = words_text(raw.as_py())
            doc.append(d)
            sub.append(s)
            text.append(joined)
            size += len(joined)
            if size >= PART_BYTES:
                yield doc, sub, text
                doc, sub, text, size = [], [], [], 0
    yield doc, sub, text


def list_minimisers(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``minimiser``, ``rows`` (super-k-mers in a part of the documents)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Minimisers(length, gram)
        for _, _, texts in _parts(batches):
            got = [s[0] for t in texts for s in find(t)]
            if got:
                minimiser, rows = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(minimiser), pa.array(rows)], names=["minimiser", "rows"])

    return docs.select("doc", "sub", "raw").mapInArrow(run, "minimiser bigint, rows bigint")


def bitmap(slots: DataFrame, n: int) -> np.ndarray:
    """Bits 0 to n - 1 as bytes, set for the values of ``slot``; the driver
    holds n / 8 bytes however many rows there are."""
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(-(-n // _BUCKET) * _BUCKET // 8, np.uint8)
    for r in rows.toLocalIterator():
        at = (r.bucket - 1) * _BUCKET // 8
        out[at:at + _BUCKET // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _slot(minimiser: np.ndarray) -> np.ndarray:
    return minimiser & (SLOTS - 1)


def sieves(docs: DataFrame, length: int, gram: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of minimisers that occur again and of those that occur often."""
    counts = list_minimisers(docs, length, gram).groupBy("minimiser").agg(F.sum("rows").alias("rows")).where("rows > 1")
    # bit 1 is slot 0 in Spark's bitmap functions
    counts = materialize(counts.select((F.col("minimiser").bitwiseAND(F.lit(SLOTS - 1)) + 1).alias("slot"), (F.col("rows") > hot).alias("hot")),
                         "superkmer-slots")
    return bitmap(counts, SLOTS), bitmap(counts.where("hot"), SLOTS)


_ROW = "key bigint, packed binary, doc bigint, sub bigint, at int, words int, times int"
_RUN = "doc bigint, sub bigint, start int, stop int"


def deal_superkmers(docs: DataFrame, again: np.ndarray, hot: np.ndarray, length: int, gram: int) -> DataFrame:
    """Super-k-mers, or windows of hot ones, by ``key``.  ``times`` is 2 where
    the string occurs more than once in a part of the documents; such
    repeats are rows without a key."""
    shared = docs.sparkSession.sparkContext.broadcast((again, hot))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, digest = Minimisers(length, gram), xxhash.xxh3_64_intdigest
        again, hot = shared.value
        has = lambda bits, slot: (bits[slot >> 3] >> (slot & 7)) & 1 == 1
        for doc, sub, texts in _parts(batches):
            first: dict[bytes, int] = {}
            key, packed, owner, at, words, times = [], [], [], [], [], []
            more: list[tuple[int, int, int]] = []  # owner, start and words of repeats

            def put(k: int, string: bytes, i: int, start: int, n: int) -> None:
                seen = first.setdefault(string, len(key))
                if seen == len(key):
                    for column, v in zip((key, packed, owner, at, words, times), (k, string, i, start, n, 1)):
                        column.append(v)
                else:
                    if times[seen] == 1:
                        times[seen] = 2
                        more.append((owner[seen], at[seen], n))
                    more.append((i, start, n))

            for i, text in enumerate(texts):
                for minimiser, start, windows, a, z in find(text):
                    slot = _slot(minimiser)
                    keep = np.flatnonzero(has(again, slot))
                    apart = has(hot, slot[keep])
                    for k, s, n, x, y, one in zip(minimiser[keep].tolist(), start[keep].tolist(), windows[keep].tolist(),
                                                  a[keep].tolist(), z[keep].tolist(), apart.tolist()):
                        if one:
                            starts, ends = word_bounds(text[x:y])
                            for o, (p, q) in enumerate(zip(starts[:n].tolist(), ends[length - 1:].tolist())):
                                string = text[x + p:x + q]
                                put(digest(string) - (1 << 63), string, i, s + o, length)
                        else:
                            put(k, text[x:y], i, s, n + length - 1)
            who = owner + [m[0] for m in more]
            none = [None] * len(more)
            columns = [key + none, packed + none, [doc[i] for i in who], [sub[i] for i in who], at + [m[1] for m in more],
                       words + [m[2] for m in more], times + [2] * len(more)]
            if who:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = ["key", "packed", "doc", "sub", "at", "words", "times"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return docs.select("doc", "sub", "raw").mapInArrow(run, _ROW)


def repeated_windows(strings: list[bytes], length: int) -> list[set[int]]:
    """For different strings of joined words: the windows of each that occur
    more than once among them."""
    windows = []
    for i, s in enumerate(strings):
        starts, ends = word_bounds(s)
        windows += [(s[a:z], i, o) for o, (a, z) in enumerate(zip(starts.tolist(), ends[length - 1:].tolist()))]
    windows.sort()
    out: list[set[int]] = [set() for _ in strings]
    for x, y in zip(windows, windows[1:]):
        if x[0] == y[0]:
            out[x[1]].add(x[2])
            out[y[1]].add(y[2])
    return out


def count_buckets(rows: DataFrame, length: int) -> DataFrame:
    """``doc``, ``sub``, ``start``, ``stop``: runs of words to remove.  Between
    batches a task holds the different strings of one key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, strings, owners = None, [], []  # of the present key; an owner is None where its windows are known to repeat

        def close(out: list[tuple]) -> None:
            if len(strings) < 2 or not any(owners):
                return
            for found, owner in zip(repeated_windows(strings, length), owners):
                if owner:
                    doc, sub, at, _ = owner
                    # neighbouring windows overlap: the first and last of a run cover it
                    out += [(doc, sub, at + o, at + o + length) for o in sorted(found) if o - 1 not in found or o + 1 not in found]

        for b in batches:
            out: list[tuple] = []
            for key, packed, doc, sub, at, words, times in zip(*(b.column(n).to_pylist() for n in names)):
                if key is None:
                    out.append((doc, sub, at, at + words))
                    continue
                if key != now:
                    close(out)
                    now, strings, owners = key, [], []
                if strings and strings[-1] == packed:
                    if owners[-1]:
                        d, s, a, w = owners[-1]
                        out.append((d, s, a, a + w))
                        owners[-1] = None
                    out.append((doc, sub, at, at + words))
                else:
                    strings.append(packed)
                    owners.append((doc, sub, at, words) if times == 1 else None)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["doc", "sub", "start", "stop"])
        out = []
        close(out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["doc", "sub", "start", "stop"])

    names = ["key", "packed", "doc", "sub", "at", "words", "times"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    dealt = rows.repartition(F.coalesce("key", F.xxhash64("doc", "sub", "at"))).sortWithinPartitions("key", "packed")
    return dealt.mapInArrow(run, _RUN)


def removed_runs(docs: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """``doc``, ``sub``, ``start``, ``stop``: runs of words to remove, which
    may overlap; ``docs`` has ``doc``, ``sub``, ``raw``."""
    again, often = sieves(docs, length, gram, hot)
    return count_buckets(deal_superkmers(docs, again, often, length, gram), length)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                hot: int = HOT) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words that
    stay, joined by one space) of every row."""
    keyed = _documents(docs, doc_id, text)
    runs = removed_runs(keyed, length, gram, hot).distinct().groupBy(F.col("doc").alias("_d"), F.col("sub").alias("_s")).agg(
        F.collect_list(F.struct("start", "stop")).alias("runs"))
    runs = materialize(runs, "superkmer-runs")
    rows = keyed.join(runs, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("sub") == F.col("_s")), "left").select("doc", "raw", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], []]
            for raw, found in zip(b.column("raw"), b.column("runs")):
                for column, v in zip(out, _cut(words_text(raw.as_py()), found)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc"), *(pa.array(c, t) for c, t in zip(out, kinds))], names=names)

    names = ["doc_id", "n_words", "n_removed", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    done = rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
    return done.withColumn("kept", F.col("kept").cast("string"))


def _cut(joined: bytes, runs: pa.ListScalar) -> tuple[int, int, bytes]:
    if runs.values is None or not len(runs.values):
        return (joined.count(b" ") + 1 if joined else 0), 0, joined
    starts, ends = word_bounds(joined)
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, runs.values.field("start").to_numpy(), 1)
    np.add.at(change, runs.values.field("stop").to_numpy(), -1)
    stay = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    if not len(stay):
        return len(starts), len(starts), b""
    # neighbouring words that stay are one slice
    cut = np.concatenate([[0], np.flatnonzero(np.diff(stay) > 1) + 1])
    a, z = stay[cut], stay[np.append(cut[1:], len(stay)) - 1]
    kept = b" ".join([joined[p:q] for p, q in zip(starts[a].tolist(), ends[z].tolist())])
    return len(starts), len(starts) - len(stay), kept

"""Suffix-array removal of repeated byte strings.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller document, or same document, earlier start).  Suffixes that
share their first ``LENGTH`` bytes stand next to each other in suffix order,
so the work is suffix sorting with a difference cover (:func:`suffix_array`):
sort the triples at sampled positions (1 and 2 mod 3), recurse on their names
until a name covers ``LENGTH`` bytes, merge the remaining suffixes, compare
adjacent prefixes.

To sort in parallel the text is dealt out by content.  The k-gram of least
hash within every string of ``LENGTH`` bytes is its anchor: equal strings
have equal anchors at the same place.  The bytes around an anchor that strings
with this anchor can reach are its window.

1. Tasks list the anchors of each document with hashes of anchor and window.
   Of equal windows all but the first are repeats as a whole; a batch of
   documents sends on only its own first, so a passage of very many
   documents is a row per batch.  Rows are dealt by anchor and sorted by
   (anchor, window, document, place).  Anchors with one window are done with
   that.
2. Anchors with several different windows: their first windows are fetched,
   dealt by anchor again and cut down to the reach that any other window of
   the anchor shares, of equal ones the first stays, and these are
   suffix-sorted together, at most ``BLOCK`` windows of an anchor.  Where an anchor has more windows than that, the range of places at
   which strings begin is halved, and windows are dealt by the longer run of
   bytes that all strings of a half cover; the last two strings of a range
   are dealt out by their 128-bit digest.
3. The removed runs of each document meet its text again.

Defined results: null texts are empty; documents shorter than ``LENGTH``
lose nothing; a null id counts as the largest; rows with equal id and text
are one document and get the same result; different texts under one id are
told apart and ordered by a 64-bit hash of the text; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.session import materialize

from .text import named

LENGTH = 100
GRAM = 32
TOGETHER = 4096  # windows of small anchors that are sorted together
BLOCK = 16384  # most windows of one anchor that a task holds
NARROW = 2  # strings of a window that are left when a range is halved no more
_LAST = (1 << 63) - 1
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)


# -- suffix sorting ---------------------------------------------------------

def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``symbols`` (integers of at least 1) in an order that is
    right on their first ``depth`` symbols; ties in any order."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    t = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    at = np.arange(n + (n % 3 == 1))  # a sampled position beyond the end closes the first half
    sample = np.concatenate([at[at % 3 == 1], at[at % 3 == 2]])
    names = _name_triples(t, sample)
    rank = np.zeros(n + 3, np.int64)
    if depth <= 3 or names.max() == len(sample):
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_array(names, -(-depth // 3))
    sampled = sample[order]
    rank[sampled] = np.arange(1, len(sampled) + 1)
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], t[rest]))]
    return _merge(t, rank, sampled, rest)


def _name_triples(t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names 1.. of the triples at the given positions, in triple order."""
    a, b, c = t[at], t[at + 1], t[at + 2]
    bits = max(int(t.max()).bit_length(), 1)
    if 3 * bits <= 63:
        return np.unique((a << (2 * bits)) | (b << bits) | c, return_inverse=True)[1] + 1
    order = np.lexsort((c, b, a))
    new = np.ones(len(at), np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]) | (c[order][1:] != c[order][:-1])
    names = np.empty(len(at), np.int64)
    names[order] = np.cumsum(new)
    return names


def _merge(t: np.ndarray, rank: np.ndarray, sampled: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Sampled and remaining suffixes, each in order, in one order.

    A remaining suffix at i compares with a sampled one at j by (t, rank of
    the next) when j = 1 mod 3 and by (t, t, rank after these) when j = 2.
    """
    one = sampled % 3 == 1
    ahead = np.zeros(len(rest), np.int64)  # sampled suffixes before each remaining one
    for those, keys in ((sampled[one], lambda i: (t[i], rank[i + 1])), (sampled[~one], lambda i: (t[i], t[i + 1], rank[i + 2]))):
        both = np.concatenate([those, rest])
        order = np.lexsort(keys(both)[::-1])
        is_rest = order >= len(those)
        before = np.cumsum(~is_rest)
        ahead[order[is_rest] - len(those)] += before[is_rest]
    out = np.empty(len(sampled) + len(rest), np.int64)
    # suffixes equal as far as they were sorted may stand in another order
    # under the other key
    place = np.arange(len(rest)) + np.maximum.accumulate(ahead)
    out[place] = rest
    free = np.ones(len(out), bool)
    free[place] = False
    out[free] = sampled
    return out


def same_prefix(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For neighbours of ``at``: whether ``length`` bytes are equal."""
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)[:, ::1].copy().view(np.uint64)[:, 0]
    alive = np.arange(len(at) - 1)
    for k in [*range(0, length - 8, 8), length - 8]:
        alive = alive[eight[at[alive] + k] == eight[at[alive + 1] + k]]
    out = np.zeros(max(len(at) - 1, 0), bool)
    out[alive] = True
    return out


# -- anchors ----------------------------------------------------------------

def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Anchors:
    """Anchors of byte arrays, with powers kept for the longest one so far."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.span = length, gram, length - gram + 1
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(data), self.gram
        if n < self.length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        if len(self.up) < n:
            self.up, self.down = _powers(_ODD, 2 * n), _powers(pow(_ODD, -1, 2 ** 64), 2 * n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * self.up[:n])])
        h = (sums[k:] - sums[:-k]) * self.down[:n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        least = _sliding(h, self.span, np.minimum, np.uint64(2 ** 64 - 1))
        pad = np.zeros(self.span - 1, np.uint64)
        at = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), self.span, np.maximum, np.uint64(0)) == h)
        return at, h[at]


def _sliding(x: np.ndarray, w: int, f: np.ufunc, fill: np.uint64) -> np.ndarray:
    n = len(x)
    y = np.full(-(-n // w) * w + w, fill, x.dtype)
    y[:n] = x
    y = y.reshape(-1, w)
    left = f.accumulate(y, axis=1).ravel()
    right = f.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(right[:n - w + 1], left[w - 1:n])


# -- the distributed steps --------------------------------------------------

def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(named(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(F.coalesce(named(text), F.lit(""))).alias("sub"), F.coalesce(named(text), F.lit("")).alias("text"))


def list_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``anchor``, ``window`` (hashes), ``doc``, ``sub``, ``at``, and how far
    the window reaches to the left and right of ``at``; ``anchor`` is null
    for repeats of a window within a batch of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, digest = Anchors(length, gram), xxhash.xxh3_64_intdigest
        for b in batches:
            doc, sub, text = b.column("doc").to_numpy(), b.column("sub").to_numpy(), b.column("text")
            out: list[list[np.ndarray]] = []
            for i in np.lexsort((sub, doc)).tolist():
                raw = text[i].as_py().encode()
                at, h = find(np.frombuffer(raw, np.uint8))
                if not len(at):
                    continue
                left, right = np.minimum(at, length - gram), np.minimum(len(raw) - at, length)
                hashes = [digest(raw[p - x:p + y], x) for p, x, y in zip(at.tolist(), left.tolist(), right.tolist())]
                out.append([h, np.array(hashes, np.uint64), np.full(len(at), doc[i]), np.full(len(at), sub[i]),
                            at.astype(np.int32), left.astype(np.int16), right.astype(np.int16)])
            if out:
                c = [np.concatenate(x) for x in zip(*out)]
                again = _later_of_equal(c[0], c[1], c[2:5])
                yield pa.RecordBatch.from_arrays([pa.array(c[0].view(np.int64), mask=again), pa.array(c[1].view(np.int64), mask=again),
                                                  *map(pa.array, c[2:])], names=names)

    names = ["anchor", "window", "doc", "sub", "at", "left", "right"]
    return docs.mapInArrow(run, "anchor bigint, window bigint, doc bigint, sub bigint, at int, left smallint, right smallint")


def _later_of_equal(anchor: np.ndarray, window: np.ndarray, place: list[np.ndarray]) -> np.ndarray:
    """Rows, in order of place, whose anchor and window were there before at
    another place."""
    order = np.argsort(anchor ^ (window * np.uint64(_ODD)), kind="stable")
    a, w = anchor[order], window[order]
    same = np.zeros(len(order), bool)
    same[1:] = (a[1:] == a[:-1]) & (w[1:] == w[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    other = np.logical_or.reduce([p[order] != p[order][first] for p in place])
    out = np.zeros(len(order), bool)
    out[order] = same & other
    return out


_FOUND = "doc bigint, sub bigint, at int, start int, stop int, anchor bigint"


def split_windows(anchors: DataFrame) -> DataFrame:
    """Repeats of a whole window (``anchor`` null) and first windows of
    anchors with several (``anchor`` set), as ``doc``, ``sub``, ``at``,
    ``start``, ``stop``.

    One pass over sorted runs; between batches it remembers one row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # first window of the current anchor, alone so far
        last = None  # anchor and window of the row before
        first = np.zeros(3, np.int64)  # document and place of the current window's first row
        for b in batches:
            known = b.filter(pc.is_null(b.column("anchor")))
            if known.num_rows:  # sorted first
                at, start, stop = (known.column(n).to_numpy() for n in ("at", "left", "right"))
                yield pa.RecordBatch.from_arrays(
                    [known.column("doc"), known.column("sub"), known.column("at"), pa.array(at - start), pa.array(at + stop),
                     pa.nulls(known.num_rows, pa.int64())], names=["doc", "sub", "at", "start", "stop", "anchor"])
                b = b.filter(pc.is_valid(b.column("anchor")))
            c = {n: b.column(n).to_numpy() for n in ("anchor", "window", "doc", "sub", "at", "left", "right")}
            n = len(c["at"])
            if not n:
                continue
            same_a, same_w = np.zeros(n, bool), np.zeros(n, bool)
            same_a[1:] = c["anchor"][1:] == c["anchor"][:-1]
            same_w[1:] = same_a[1:] & (c["window"][1:] == c["window"][:-1])
            if last is not None:
                same_a[0] = c["anchor"][0] == last[0]
                same_w[0] = same_a[0] and c["window"][0] == last[1]
            last = (c["anchor"][-1], c["window"][-1])
            row = np.arange(n)
            firsts = row[~same_w]  # first of a window
            # repeated input rows of that very place are no repeats
            places = np.concatenate([first[None, :], np.stack([c["doc"], c["sub"], c["at"]], 1)])
            own = places[np.maximum.accumulate(np.where(same_w, 0, row + 1))]
            first = own[-1]
            repeat = same_w & (own != places[1:]).any(axis=1)
            # a window's anchor has several when the next or the previous
            # window belongs to the same anchor
            again = same_a[firsts]
            several = again.copy()
            several[:-1] |= again[1:]
            pick = lambda i, alone: [c["doc"][i], c["sub"][i], c["at"][i], (c["at"] - c["left"])[i], (c["at"] + c["right"])[i],
                                     c["anchor"][i], np.full(len(c["at"][i]), alone)]
            out = [pick(repeat, True)]
            if len(firsts):
                if held is not None and again[0]:
                    out.append(held)
                out.append(pick(firsts[several], False))
                # the last first window may get company in the next batch
                held = None if several[-1] else pick(firsts[-1:], False)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.concatenate(x)) for x in list(zip(*out))[:5]),
                 pa.array(np.concatenate([x[5] for x in out]), mask=np.concatenate([x[6] for x in out]))],
                names=["doc", "sub", "at", "start", "stop", "anchor"])

    # known repeats go anywhere
    dealt = anchors.repartition(F.coalesce("anchor", F.xxhash64("doc", "at"))).sortWithinPartitions(
        F.col("anchor").asc_nulls_first(), "window", "doc", "sub", "at")
    return dealt.mapInArrow(run, _FOUND)


def fetch_windows(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``anchor``, ``doc``, ``sub``, ``start``, ``left`` (bytes before the
    anchor) and ``bytes`` of the windows."""
    wanted = firsts.groupBy(F.col("doc").alias("_d"), F.col("sub").alias("_s")).agg(
        F.collect_list(F.struct("anchor", "at", "start", "stop")).alias("windows"))
    wanted = materialize(wanted, "suffix-wanted")
    rows = docs.join(wanted, (F.col("doc") == F.col("_d")) & (F.col("sub") == F.col("_s"))).select("doc", "sub", "text", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc, sub, t, windows in zip(b.column("doc").to_pylist(), b.column("sub").to_pylist(), b.column("text"), b.column("windows")):
                raw = t.as_py().encode()
                for w in windows.as_py():
                    for o, v in zip(out, (w["anchor"], doc, sub, w["start"], w["at"] - w["start"], raw[w["start"]:w["stop"]])):
                        o.append(v)
                if len(out[0]) >= TOGETHER:
                    yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=names)

    names = ["anchor", "doc", "sub", "start", "left", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return rows.mapInArrow(run, "anchor bigint, doc bigint, sub bigint, start int, left int, bytes binary")


def repeated_starts(windows: list[bytes], order: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Window index and offset of every string of ``length`` bytes in
    ``windows`` that also starts earlier in one of them; ``order`` ranks the
    documents, ``start`` is a window's place in its document."""
    sizes = np.array([len(w) for w in windows], np.int64)
    text = np.frombuffer(b"\0".join(windows) + bytes(length), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols = text[:int(sizes.sum()) + len(windows)].astype(np.int64) + 2
    ends = first + sizes
    symbols[ends] = 1  # between windows: less than any byte
    sorted_ = suffix_array(symbols, length)
    owner = np.repeat(np.arange(len(windows)), sizes + 1)
    offset = np.arange(len(symbols)) - first[owner]
    sorted_ = sorted_[offset[sorted_] + length <= sizes[owner[sorted_]]]
    if len(sorted_) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    w, o = owner[sorted_], offset[sorted_]
    by = np.lexsort((start[w] + o, order[w]))
    key = np.empty(len(sorted_), np.int64)
    place = np.stack([order[w], start[w] + o], 1)[by]
    key[by] = np.cumsum(np.concatenate([[0], (place[1:] != place[:-1]).any(axis=1)]))
    runs = np.concatenate([[0], np.flatnonzero(~same_prefix(text, sorted_, length)) + 1])
    least = np.repeat(np.minimum.reduceat(key, runs), np.diff(np.append(runs, len(key))))
    late = key > least
    return w[late], o[late]


def shared_reach(anchor: np.ndarray, windows: list[bytes], left: list[int], gram: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper bounds of the bytes before and after the anchor that a window
    shares with any other of its anchor: unshared at k bytes, at most k - 1."""
    out = (np.full(len(windows), reach), np.full(len(windows), reach))
    size, at = np.array([len(w) for w in windows], np.int64), np.array(left, np.int64)
    begin = np.cumsum(size) - size
    text = np.frombuffer(b"".join(windows), np.uint8)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[text] * _powers(_ODD, len(text)))])
    down = _powers(pow(_ODD, -1, 2 ** 64), len(text))
    salt = anchor.astype(np.uint64) * np.uint64(_ODD)
    for k in sorted({max(1, reach * q // 16) for q in range(1, 17)}, reverse=True):
        for bound, first, there in ((out[0], begin + at - k, at), (out[1], begin + at + gram, size - at - gram)):
            long = there >= k
            a = np.where(long, first, 0)
            h = (sums[np.minimum(a + k, len(text))] - sums[a]) * down[a]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) ^ salt
            _, which, n = np.unique(h, return_inverse=True, return_counts=True)
            bound[~long | (n[which] < 2)] = k - 1
    return out


def first_of_equal(rows: list[tuple[int, int, int, bytes]], length: int) -> tuple[list[tuple], list[tuple]]:
    """Of rows ``(doc, sub, start, bytes)`` with equal bytes the one that
    starts first, and ``(doc, sub, start, stop)`` of the others: whatever
    string they hold starts earlier in the first."""
    first: dict[bytes, tuple] = {}
    late = []
    for r in sorted(rows, key=lambda r: r[:3]):
        other = first.setdefault(r[3], r)
        if other[:3] != r[:3] and len(r[3]) >= length:
            late.append((*r[:3], r[2] + len(r[3])))
    return list(first.values()), late


def sort_windows(windows: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc``, ``sub``, ``start``, ``stop``: removed runs, from suffix
    sorting the windows of whole anchors together, about ``TOGETHER`` at a
    time; windows equal after the cut to their shared reach are sorted once."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            rows = list(zip(*(b.column(n).to_pylist() for n in ("key", "doc", "sub", "start", "left", "bytes"))))
            for r in rows:
                if len(held) >= min(TOGETHER, BLOCK) and r[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(r)
        if held:
            yield solve(held)

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        before, after = shared_reach(np.array([r[0] for r in rows], np.int64), [r[5] for r in rows], [r[4] for r in rows], gram, reach)
        kept = []
        for i in np.flatnonzero(before + after >= reach).tolist():
            _, doc, sub, start, left, raw = rows[i]
            a = max(left - int(before[i]), 0)
            kept.append((doc, sub, start + a, raw[a:left + gram + int(after[i])]))
        kept, late = first_of_equal(kept, length)
        ids = sorted({r[:2] for r in kept})
        rank = {d: i for i, d in enumerate(ids)}
        start = np.array([r[2] for r in kept], np.int64)
        w, o = repeated_starts([r[3] for r in kept], np.array([rank[r[:2]] for r in kept], np.int64), start, length)
        by = np.lexsort((o, w))
        w, o = w[by], o[by]
        # neighbouring starts make one run
        cut = np.concatenate([[True], (w[1:] != w[:-1]) | (o[1:] != o[:-1] + 1)]) if len(w) else np.empty(0, bool)
        a = np.flatnonzero(cut)
        z = np.append(a[1:], len(w))[:len(a)] - 1
        lo, hi = (start[w[a]] + o[a]).tolist(), (start[w[a]] + o[z] + length).tolist()
        found = [(kept[i][0], kept[i][1], x, y) for i, x, y in zip(w[a].tolist(), lo, hi)] + late
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                          names=["doc", "sub", "start", "stop"])

    return windows.repartition("key").sortWithinPartitions("key", "doc", "sub", "start").mapInArrow(
        run, "doc bigint, sub bigint, start int, stop int")


def deal_strings(windows: DataFrame, length: int) -> DataFrame:
    """Removed runs among the strings that begin ``least`` to ``most - 1``
    bytes before the anchor: every such string is dealt out by its digest
    and compared with the first of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for doc, sub, start, left, least, most, raw in zip(*(b.column(n).to_pylist() for n in columns)):
                at = range(max(left - most + 1, 0), min(left - least, len(raw) - length) + 1)
                out[0] += [hashlib.md5(raw[k:k + length]).digest() for k in at]
                out[1] += [doc] * len(at)
                out[2] += [sub] * len(at)
                out[3] += [start + k for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=["digest", "doc", "sub", "start"])

    columns = ("doc", "sub", "start", "left", "least", "most", "bytes")
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    strings = materialize(windows.select(*columns).mapInArrow(run, "digest binary, doc bigint, sub bigint, start int"), "suffix-strings")
    place = F.struct("doc", "sub", "start")
    first = materialize(strings.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
                        "suffix-first")
    return strings.join(first, "digest").where(place > F.col("first")).select(
        "doc", "sub", "start", (F.col("start") + length).alias("stop"))


def compare_windows(windows: DataFrame, length: int, gram: int) -> list[DataFrame]:
    """Removed runs of windows dealt by anchor.

    A row stands for the strings that begin ``least`` to ``most - 1`` bytes
    before the anchor; its key is the bytes that all of these cover.  Windows
    of one key are sorted together; where they are more than ``BLOCK``, the
    range is halved, which makes the key longer, until ``NARROW`` strings are
    left, which are dealt out by digest.
    """
    reach, out = length - gram, []
    pending = windows.withColumns({"least": F.lit(0), "most": F.lit(reach + 1), "key": F.col("anchor")})
    width = reach + 1
    while True:
        sizes = pending.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        large = materialize(sizes.where(F.col("n") > BLOCK).select("key"), "suffix-large")
        if large.isEmpty():
            return [*out, sort_windows(pending, length, gram)]
        out.append(sort_windows(pending.join(large, "key", "left_anti"), length, gram))
        split = materialize(pending.join(large, "key", "left_semi"), "suffix-split")
        if width <= NARROW:
            return [*out, deal_strings(split, length)]
        middle = F.floor((F.col("least") + F.col("most")) / 2).cast("int")
        halves = split.withColumn("half", F.explode(F.array(F.struct(F.col("least").alias("a"), middle.alias("b")),
                                                            F.struct(middle.alias("a"), F.col("most").alias("b")))))
        halves = halves.withColumns({"least": F.col("half.a"), "most": F.col("half.b")}).drop("half")
        after = F.lit(reach + 1) - F.col("most")  # bytes behind the anchor that all strings cover
        halves = halves.where((F.col("least") < F.col("most")) & (F.col("left") >= F.col("least"))
                              & (F.octet_length("bytes") >= F.col("left") + gram + after))
        shared = F.expr("substring(bytes, left - least + 1, least + int(%d) + %d - most)" % (gram, reach + 1))
        pending = halves.withColumn("key", F.xxhash64("anchor", "least", "most", shared))
        # a key of one window has no repeat
        twice = materialize(pending.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "suffix-twice")
        pending = materialize(pending.join(twice, "key", "left_semi").select(*split.columns), "suffix-halves")
        width = -(-width // 2)


def removed_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc``, ``sub``, ``start``, ``stop``: byte runs to remove, which may
    overlap; ``docs`` has ``doc``, ``sub``, ``text``."""
    found = materialize(split_windows(list_anchors(docs, length, gram)), "suffix-found")
    windows = materialize(fetch_windows(docs, found.where("anchor is not null")), "suffix-windows")
    runs = found.where("anchor is null").select("doc", "sub", "start", "stop")
    for more in compare_windows(windows, length, gram):
        runs = runs.unionByName(more)
    return runs


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept`` (the remaining bytes) of every row."""
    keyed = _documents(docs, doc_id, text)
    runs = removed_runs(keyed, length, gram).groupBy(F.col("doc").alias("_d"), F.col("sub").alias("_s")).agg(
        F.collect_list(F.struct("start", "stop")).alias("runs"))
    runs = materialize(runs, "suffix-runs")
    rows = keyed.join(runs, (F.col("doc") == F.col("_d")) & (F.col("sub") == F.col("_s")), "left").select("doc", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t, found in zip(b.column("text"), b.column("runs")):
                raw = t.as_py().encode()
                for o, v in zip(out, (len(raw), *_cut(raw, found.as_py() or []))):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc"), *(pa.array(x, k) for x, k in zip(out, kinds))], names=names)

    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    done = rows.mapInArrow(run, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return done.select(F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def _cut(raw: bytes, runs: list[dict]) -> tuple[int, int, bytes]:
    kept, end, spans, removed = [], 0, 0, 0
    for r in sorted((r["start"], r["stop"]) for r in runs):
        if r[0] > end or not spans:
            kept.append(raw[end:r[0]])
            spans += 1
            removed += r[1] - r[0]
            end = r[1]
        elif r[1] > end:
            removed += r[1] - end
            end = r[1]
    kept.append(raw[end:])
    return removed, spans, b"".join(kept)

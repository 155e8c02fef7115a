"""SimHash near-duplicates with the generalised pigeonhole principle.

1. A fingerprint per text: the bitwise majority over the XXH64 values of its
   word shingles.  Equal fingerprints collapse to one row (their smallest
   document id stands for them), so groups of copies cost one row each.
2. The 64 bits are cut into parts.  Bits that vary together share a part.
   With thresholds t_1..t_m, sum(t_i + 1) = d + 1, two fingerprints at most
   ``d`` bits apart agree up to t_i bits in some part i, so probing every
   part up to its own threshold finds every pair.  The thresholds come from a
   dynamic program over the estimated probes and candidates of each part,
   estimated from bit statistics of all fingerprints.
3. Probing writes one row per fingerprint, part and part value within reach.
   Rows of one value form a bucket; fingerprints of a bucket are compared in
   numpy and leave a spanning forest of their verified links, never all
   pairs.  A bucket larger than ``BLOCK`` is cut into blocks, and every pair
   of blocks becomes a task of its own.
4. Components by alternating large-star and small-star rounds, each round's
   edges written to the shared checkpoint folder.

Defined results: null or empty texts have no shingle and fingerprint zero,
linked like any other; a text shorter than a shingle is one shingle; repeated
rows share a component; a null id is linked but never the smallest unless its
group has no other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcredit.session import materialize

from .text import map_texts, named

BITS = 64
SEED = 42
BLOCK = 1024  # most fingerprints of a bucket that one comparison loads per side


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = _shingle_hashes(words, shingle)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())), np.uint64, len(starts))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) and ``text_hash`` of
    every row."""
    rows = docs.select(named(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(named(text)).alias("text_hash"), named(text).alias("_text"))
    make = lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]
    return map_texts(rows, "_text", [T.StructField("fp", T.LongType())], make, drop=("_text",))


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int  # -1: the part is not probed


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, ones per bit and joint ones per bit pair over all of ``fp``:
    4,161 numbers whatever the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, joint = 0, np.zeros((BITS, BITS))
        for b in batches:
            m = _bit_matrix(b.column("fp").to_numpy()).astype(np.float32)
            n += len(m)
            joint += m.T @ m
        yield pa.RecordBatch.from_pydict({"cell": np.arange(BITS * BITS + 1, dtype=np.int32), "v": np.append(joint.ravel(), n)})

    got = fps.select("fp").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(BITS * BITS + 1)
    for r in got:
        out[r["cell"]] = r["v"]
    joint = out[:-1].reshape(BITS, BITS)
    return int(out[-1]), np.diag(joint).copy(), joint


def _bit_matrix(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, ones: np.ndarray, joint: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Cut the bits into ``parts`` groups of nearly equal size; each group
    grows by the free bit most correlated with it."""
    p = ones / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(tuple(sorted(group)))
    return out


def _within(p: np.ndarray, t: int) -> float:
    """Chance that two rows differ in at most ``t`` of bits with density p."""
    dist = np.zeros(t + 1)
    dist[0] = 1
    for q in 2 * p * (1 - p):
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return float(dist.sum())


def allocate(n: int, ones: np.ndarray, groups: list[tuple[int, ...]], distance: int) -> tuple[float, list[int]]:
    """Thresholds with sum(t + 1) = distance + 1 of least estimated cost.

    A part probed up to t costs its probe rows (2 microseconds each: shuffle
    and sort) and its expected candidate comparisons (10 nanoseconds each).
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for g in groups:
        p = ones[list(g)] / max(n, 1)
        cost = {-1: 0.0}
        for t in range(min(distance, 2, len(g)) + 1):
            probes = n * sum(comb(len(g), j) for j in range(t + 1))
            pairs = n * n / 2 * _within(p, t) * (1 if t == 0 else sum(comb(len(g), j) for j in range(t + 1)))
            cost[t] = 2e-6 * probes + 1e-8 * pairs
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t, more in cost.items():
                u = used + t + 1
                if u <= distance + 1 and c + more < step.get(u, (np.inf, []))[0]:
                    step[u] = (c + more, [*ts, t])
        best = step
    return best.get(distance + 1, (np.inf, []))


def plan_parts(n: int, ones: np.ndarray, joint: np.ndarray, distance: int) -> list[Part]:
    """The cheapest partition over the possible numbers of parts."""
    options = []
    for m in range(2, distance + 2):
        groups = group_bits(n, ones, joint, m)
        cost, ts = allocate(n, ones, groups, distance)
        options.append((cost, m, [Part(g, t) for g, t in zip(groups, ts)]))
    options = [o for o in options if np.isfinite(o[0])]
    if not options:  # distance 0: whole fingerprints are equal already
        return [Part(tuple(range(BITS)), 0)]
    return min(options, key=lambda o: o[:2])[2]


def _masks(part: Part) -> tuple[np.uint64, np.ndarray]:
    mask = np.uint64(sum(1 << b for b in part.bits))
    flips = [sum(1 << b for b in c) for j in range(part.threshold + 1) for c in combinations(part.bits, j)]
    return mask, np.array(flips, dtype=np.uint64)


def probe_rows(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """``part``, ``value``, ``fp``, ``own``: each fingerprint under every part
    value within the part's threshold; ``own`` marks its very own value."""
    probed = [(i, *_masks(p)) for i, p in enumerate(parts) if p.threshold >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for i, mask, flips in probed:
                v = (fp & mask)[:, None] ^ flips[None, :]
                own = np.zeros(v.shape, bool)
                own[:, 0] = True
                yield pa.RecordBatch.from_pydict({
                    "part": np.full(v.size, i, np.int32), "value": v.ravel().view(np.int64),
                    "fp": np.repeat(fp, len(flips)).view(np.int64), "own": own.ravel()})

    return fps.select("fp").mapInArrow(run, "part int, value bigint, fp bigint, own boolean")


def _forest(fp: np.ndarray, own: np.ndarray, left: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the verified links among the rows of a bucket.

    Of two rows one must stand under its own value (the other reached it by
    flips); in a block pair the sides are compared with each other only.
    """
    n = len(fp)
    if n < 2:
        return []
    if n <= 64:
        ok = (np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance) & (own[:, None] | own[None, :])
        ok &= left[:, None] != left[None, :] if left.any() and not left.all() else True
        a, b = np.nonzero(np.triu(ok, 1))
        if len(a) < n:
            return list(zip(a.tolist(), b.tolist()))
    mixed = left.any() and not left.all()
    out, seen = [], np.zeros(n, bool)
    for s in range(n):
        if seen[s]:
            continue
        seen[s] = True
        queue = [s]
        while queue:
            x = queue.pop()
            ok = ~seen & (np.bitwise_count(fp ^ fp[x]) <= distance)
            if not own[x]:
                ok &= own
            if mixed:
                ok &= left != left[x]
            new = np.flatnonzero(ok)
            seen[new] = True
            found = new.tolist()
            queue += found
            out += [(x, y) for y in found]
    return out


def links(spark: SparkSession, fps: DataFrame, parts: list[Part], distance: int) -> DataFrame:
    """``a`` < ``b``: verified links whose components are those of all pairs
    of distinct fingerprints at most ``distance`` bits apart."""
    probes = materialize(probe_rows(fps, parts), "simhash-probes")
    sizes = probes.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any"))
    sizes = materialize(sizes.where((F.col("n") > 1) & F.col("any")).select("part", "value", "n"), "simhash-buckets")
    # only buckets that hold two rows can link; large ones are cut into blocks
    rows = probes.join(sizes, ["part", "value"]).withColumn(
        "blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("part", "value", "fp", "own", F.least("block", "other").alias("i"),
                       F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left"))

    columns = ("part", "value", "i", "j", "fp", "own", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for b in batches:
            c = [b.column(n).to_numpy(zero_copy_only=False) for n in columns]
            c = c if carry is None else [np.concatenate(x) for x in zip(carry, c)]
            cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in c[:4]])) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            carry = [x[last:] for x in c]
            if last:
                yield emit([x[:last] for x in c], cuts[:-1].tolist())
        if carry is not None:
            yield emit(carry, [])

    def emit(c: list[np.ndarray], cuts: list[int]) -> pa.RecordBatch:
        _, _, i, j, fp, own, left = c
        fp, same = fp.view(np.uint64), i == j
        out_a, out_b = [], []
        for s, e in zip([0, *cuts], [*cuts, len(fp)]):
            side = left[s:e] if not same[s] else np.ones(e - s, bool)
            for x, y in _forest(fp[s:e], own[s:e], side, distance):
                out_a.append(s + x)
                out_b.append(s + y)
        a, b = fp[np.array(out_a, int)].view(np.int64), fp[np.array(out_b, int)].view(np.int64)
        return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    keys = ["part", "value", "i", "j"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint")
    return found.where("a < b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of
    ``edges`` (``a``, ``b``; longs), by large-star and small-star rounds.

    Every round replaces the edges by stars around smaller nodes and stops
    when nothing changes; both sides of each join are stored tables, so a
    node with very many links is split by the adaptive join.
    """
    def stars(links: DataFrame, name: str) -> DataFrame:
        """Smallest of every ``a`` and its neighbours beside its links."""
        low = materialize(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), f"cc-{name}")
        return links.join(low, "a")

    def stored(links: DataFrame) -> tuple[DataFrame, tuple]:
        out = materialize(links.where("a > b").distinct(), "cc-edges")
        return out, tuple(out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current, sign = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        both = current.union(current.select("b", "a"))
        large = stars(both, "large").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a > b").distinct(), "cc-stars")
        small = stars(large, "small").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                             F.col("m").alias("b"))
        before = sign
        current, sign = stored(small)
        if sign == before:  # a round that changes nothing: every edge names its root
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b"), F.col("b")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``root`` (a fingerprint naming the
    component) and ``component_id`` of every row: the smallest id reachable
    over fingerprints at most ``distance`` bits apart."""
    spark = docs.sparkSession
    marked = materialize(fingerprints(docs, doc_id, text, shingle), "simhash-docs")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    n, ones, joint = bit_statistics(distinct)
    edges = links(spark, distinct, plan_parts(n, ones, joint, distance), distance)
    groups = components(spark, edges)
    placed = materialize(distinct.join(groups, distinct["fp"] == groups["node"], "left")
                         .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    least = materialize(placed.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    named = materialize(placed.join(least, "root").select("fp", "root", "component_id"), "simhash-named")
    return marked.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
               distance: int = 4) -> DataFrame:
    """``docs`` with one row per component: that of the smallest id; of
    several texts under that id, the one of least hash; of rows with equal id
    and text, the one whose other columns have the least hash (map columns
    do not count)."""
    names = docs.columns
    found = near_duplicates(docs, doc_id, text, shingle, distance)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("doc_id").alias("_id"), F.min("text_hash").alias("_hash"))
    hashed = [named(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    boxed = docs.select(F.struct(*[named(c) for c in names]).alias("_row"),
                        named(doc_id).cast("bigint").alias("_i"), F.xxhash64(named(text)).alias("_h"), F.xxhash64(*hashed).alias("_all"))
    first = materialize(first.select("_id", "_hash"), "simhash-first")
    kept = boxed.join(first, boxed["_i"].eqNullSafe(first["_id"]) & (boxed["_h"] == first["_hash"]), "left_semi")
    return kept.groupBy("_i", "_h").agg(F.min_by("_row", "_all").alias("_row")).select("_row.*")

"""Cross-tokenizer alignment with an identity map as fast path.

Every text is encoded by a byte-level vocabulary (A, with a space in front)
and by a piece model (B, which adds that space itself).  Byte offsets where
tokens of both end cut the text into groups; tokens of the two sides link
where their byte ranges overlap.

A map from A ids to the B ids of the same bytes is made once.  A group of one
A token and the B token of that map is exact: such groups are counted in
vectors as long as the vocabulary.  Only the links of all other groups become
(A id, B id) rows.

1. A task takes texts in parts of about ``PART_BYTES``.  It cuts them at
   single spaces between other characters, where tokens of both sides always
   end, and encodes and aligns each different piece of a part once.  A part
   becomes one row: the results that need no corpus counts, the pieces of each
   text, the links of each piece, and the part's counts: of exact groups by A
   id, of other links by pair.
2. The counts are added up; a pair's count is compared with the highest of its
   B id.
3. Each part asks for the pairs that it holds - a row per part and pair,
   however many texts have it - and gets their counts beside its own row; the
   counts of exact groups are a vector of bounded length that all tasks get.

Defined results: null and empty texts, and texts whose tokens do not give
their bytes back, have no tokens: zeros and an empty digest; they add nothing
to the counts.  Repeated rows count each on their own; null ids are kept; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.session import materialize

PART_BYTES = 4 << 20
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"
_B_BITS = 32  # a pair is A id * 2^32 + B id


def byte_of_symbol() -> dict[str, int]:
    """Byte of each symbol of byte-level vocabularies: printable characters
    of Latin-1 stand for themselves, the others for 256 and on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """The two tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)
        symbol = byte_of_symbol()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(symbol[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        merged = [ranks[bytes(symbol[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))] for m in model["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids of the vocabulary do not follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        # without a piece over such a place, both sides end a token there
        self.cut = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        first: dict[bytes, int] = {}
        for i, raw in enumerate(self.b_bytes):
            if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i):
                first.setdefault(raw, i)
        self.same = np.array([first.get(raw, -1) for raw in self.a_bytes], np.int64)
        names = lambda n: np.array([str(i) for i in range(n)], object)
        self.a_name, self.b_name = names(len(self.a_bytes)), names(len(self.b_bytes))

    def pieces(self, text: str) -> list[str]:
        """The text cut where tokens of both sides end; each piece follows a space."""
        return _BETWEEN.split(text) if self.cut else [text]

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and numbers of tokens of each piece on both sides, and whether
        both give its bytes back; other pieces have no tokens."""
        a = [self.a.encode_ordinary(" " + p) for p in pieces]
        b = self.b.encode(pieces, num_threads=1)
        whole = [b" " + p.encode() for p in pieces]
        right = np.ones(len(pieces), bool)
        for found, table in ((a, self.a_bytes), (b, self.b_bytes)):
            right &= np.array([b"".join([table[i] for i in ids]) == raw for ids, raw in zip(found, whole)], bool)
        for i in np.flatnonzero(~right).tolist():
            a[i] = b[i] = []
        flat = lambda lists: np.fromiter((i for ids in lists for i in ids), np.int64)
        size = lambda lists: np.fromiter(map(len, lists), np.int64, len(lists))
        return flat(a), size(a), flat(b), size(b), right


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str, pattern: str) -> Pair:
    """One pair of tokenizers per Python worker."""
    return Pair(path_a, path_b, pattern)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - sizes]


class Aligned:
    """Groups and links of a list of pieces."""

    def __init__(self, pair: Pair, pieces: list[str]):
        a, n_a, b, n_b, self.right = pair.encode(pieces)
        self.n_a, self.n_b = n_a, n_b
        end_a, end_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        # a link ends at each byte offset where a token of either side does
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = (end_a[at_a] == ends) & (end_b[at_b] == ends) if len(ends) else np.empty(0, bool)
        group = np.cumsum(both) - both
        self.link_a, self.link_b = a[at_a], b[at_b]
        self.exact = (np.bincount(group, minlength=1)[group] == 1) & (pair.same[self.link_a] == self.link_b)
        owner = np.repeat(np.arange(len(pieces)), n_a)[at_a]
        self.n_links = np.bincount(owner, minlength=len(pieces))
        self.n_groups = np.bincount(owner[both], minlength=len(pieces))
        self.text = self._texts(pair, a, b, group, at_a, at_b)

    def _texts(self, pair: Pair, a: np.ndarray, b: np.ndarray, group: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
        """The groups of each piece as ``a1,a2|b1;``."""
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[at_a], group_b[at_b] = group, group
        n = int(group[-1]) + 1 if len(group) else 0
        till_a, till_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
        # A tokens of a group stand before its B tokens
        place_a = np.arange(len(a)) + (np.concatenate([[0], till_b])[group_a] if n else 0)
        place_b = np.arange(len(b)) + (till_a[group_b] if n else 0)
        out = np.empty((len(a) + len(b), 2), object)
        out[place_a, 0], out[place_b, 0] = pair.a_name[a], pair.b_name[b]
        out[:, 1] = ","
        if n:
            out[place_a[till_a - 1], 1] = "|"
            out[place_b[till_b - 1], 1] = ";"
        flat, ends = out.ravel().tolist(), np.cumsum(2 * (self.n_a + self.n_b)).tolist()
        return ["".join(flat[x:y]) for x, y in zip([0, *ends], ends)]


def _packed(values: np.ndarray) -> bytes:
    """32-bit integers, byte by byte of equal weight, compressed."""
    planes = values.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view(np.int32).ravel()


_PART = ("part bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
         "groups_sha256 array<string>, n_pieces array<int>, pieces binary, n_piece_links array<int>, links binary, "
         "exact array<int>, n_exact array<bigint>, pair array<bigint>, n_pair array<bigint>")


def _align_part(pair: Pair, number: int, ids: list, texts: list[str]) -> list:
    """One row of ``_PART``.  A link is the place of its pair among the
    part's pairs, or -1 - A id in an exact group."""
    place: dict[str, int] = {}
    rows = []
    for t in texts:
        cut = pair.pieces(t) if t else []
        at = list(map(place.get, cut))
        if None in at:
            at = [place.setdefault(p, len(place)) for p in cut]
        rows.append(np.array(at, np.int32))
    found = Aligned(pair, list(place))
    # a text with a piece that is not given back has no tokens
    rows = [r if found.right[r].all() else r[:0] for r in rows]
    sizes, flat = np.array([len(r) for r in rows], np.int64), np.concatenate([np.empty(0, np.int32), *rows])
    times = np.bincount(flat, minlength=len(place))
    weight = np.repeat(times, found.n_links)
    exact = np.bincount(found.link_a[found.exact], weight[found.exact], minlength=len(pair.a_bytes)).astype(np.int64)
    used = np.flatnonzero(exact)
    link = -1 - found.link_a
    other = ~found.exact
    pairs, at = np.unique((found.link_a[other] << _B_BITS) | found.link_b[other], return_inverse=True)
    link[other] = at
    n_pairs = np.bincount(at, weight[other], minlength=len(pairs)).astype(np.int64)
    digests = [hashlib.sha256("".join([found.text[p] for p in r.tolist()])[:-1].encode()).hexdigest() if len(r) else "" for r in rows]
    return [number, ids, *(_sums(n[flat], sizes) for n in (found.n_a, found.n_b, found.n_groups, found.n_links)), digests,
            sizes, _packed(flat), found.n_links, _packed(link), used, exact[used], pairs, n_pairs]


def align_parts(docs: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """One row of ``_PART`` for each part of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = tokenizers(*paths), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def close() -> pa.RecordBatch:
            row = _align_part(pair, number, ids, texts)
            return pa.RecordBatch.from_arrays([pa.array([v if isinstance(v, (int, bytes, list)) else v.tolist()], f.type) for v, f in zip(row, schema)], schema=schema)

        for b in batches:
            for i, raw in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids.append(i)
                texts.append(raw.as_py() or "")
                size += len(texts[-1])
                if size >= PART_BYTES:
                    yield close()
                    ids, texts, size = [], [], 0
                    number += 1
        if ids:
            yield close()

    large = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(n, pa.list_(large[k[6:-1]]) if k.startswith("array") else pa.binary() if k == "binary" else large[k])
                        for n, k in (f.split(" ") for f in _PART.split(", "))])
    return docs.mapInArrow(run, _PART)


def pair_counts(parts: DataFrame, same: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links that hold it) and ``best``: whether no other
    pair of its B id has more."""
    irregular = parts.select(F.explode(F.arrays_zip("pair", "n_pair")).alias("x")).groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.n_pair").alias("n"))
    exact = parts.select(F.explode(F.arrays_zip("exact", "n_exact")).alias("x")).groupBy(F.col("x.exact").alias("a")).agg(F.sum("x.n_exact").alias("n"))
    together = irregular.unionByName(exact.join(same, "a").select("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(together.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))), "alignment-pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    return materialize(counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-counts")


_DONE = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, numbers of tokens of both sides, groups and links,
    ``n_best`` (links whose pair is a most frequent one of its B id),
    ``count_sum`` (corpus counts of the pairs, over links) and
    ``groups_sha256`` (of ``a1,a2|b1;a3|b2``)."""
    spark, paths = docs.sparkSession, (path_a, path_b, pattern)
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    rows = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).cast("string").alias("text"))
    parts = materialize(align_parts(rows, paths), "alignment-parts")
    identity = tokenizers(*paths).same  # as long as the vocabulary
    mapped = [(int(a), (int(a) << _B_BITS) | int(identity[a])) for a in np.flatnonzero(identity >= 0)]
    same = spark.createDataFrame(mapped, "a int, pair bigint")
    counts = pair_counts(parts, same)
    count, best = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
    for r in counts.join(same, "pair").collect():
        count[r.a], best[r.a] = r.n, r.best
    shared = spark.sparkContext.broadcast((count, best))
    asked = parts.select(F.col("part").alias("to"), F.posexplode("pair").alias("at", "pair"))
    answers = asked.join(counts, "pair").select("to", "at", "n", "best")

    def finish(key: tuple, part: pa.Table, answers: pa.Table) -> pa.Table:
        row = {n: part.column(n)[0] for n in part.column_names}
        a_count, a_best = shared.value
        list_of = lambda n: row[n].values.to_numpy()
        n_pieces, n_links = list_of("n_pieces").astype(np.int64), list_of("n_piece_links").astype(np.int64)
        pieces, links = _unpacked(row["pieces"].as_py(), int(n_pieces.sum())), _unpacked(row["links"].as_py(), int(n_links.sum()))
        out = []
        for of_exact, name in ((a_best, "best"), (a_count, "n")):
            of_pair = np.zeros(len(row["pair"].values), np.int64)
            of_pair[answers.column("at").to_numpy()] = answers.column(name).to_numpy()
            value = of_exact[np.maximum(-1 - links, 0)]
            value[links >= 0] = of_pair[links[links >= 0]]
            out.append(pa.array(_sums(_sums(value, n_links)[pieces], n_pieces)))
        n_best, count_sum = out
        return pa.Table.from_arrays([*(row[n].values for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), n_best, count_sum, row["groups_sha256"].values],
                                    names=[f.split(" ")[0] for f in _DONE.split(", ")])

    return parts.groupBy("part").cogroup(answers.groupBy("to")).applyInArrow(finish, _DONE)

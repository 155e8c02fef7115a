"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its
encoding: the one that is compatible with the last token of the prefix it
leaves.  ``Prefixes`` stores that token per prefix.  The encoding is read
backwards from the end; appending bytes only adds entries, and after an edit
entries are recomputed from the edit on until as many consecutive ones as the
longest token has bytes agree with the old table, from where the rest is
copied.

Two neighbouring tokens are compatible when merging their bytes afresh gives
the same two tokens; this is decided by undoing merges at the boundary, most
recent first.

Defined results: null texts encode like empty ones (no ids); a piece that is
a token as a whole is that token; invalid ids raise; repeated rows are
encoded one by one; extra columns are kept by :func:`encode` unless they bear
the name of a result, which replaces them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import map_texts, named

HEAD = 5  # bytes of a piece whose table is kept for pieces that begin alike
CACHE = 1 << 17  # distinct pieces of at most 64 bytes that a task remembers
PAIRS = 1 << 18  # pairs of tokens whose test it remembers
HEADS = 1 << 15  # beginnings of pieces whose table it keeps


class Remembered(dict):
    """Results of ``make`` by argument; emptied when ``most`` are held."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        got = self[key] = self.make(key)
        return got


class Vocabulary:
    """Ranks, the merge that made each token, and the pair test."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        # every ending of a token, with its rank where it is a token itself
        self.suffixes = {b[i:]: -1 for b in ranks for i in range(1, len(b))} | ranks
        self._halves: dict[int, tuple[int, int]] = {}
        self.own: dict[int, bool] = {}
        self.compatible = Remembered(self._separate, PAIRS).__getitem__

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge gives ``token``; a byte is its own."""
        got = self._halves.get(token)
        if got is None:
            whole = self.bytes[token]
            parts = [self.ranks[whole[i:i + 1]] for i in range(len(whole))]
            while len(parts) > 2:
                ranked = [(self.ranks.get(self.bytes[a] + self.bytes[b], token), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(ranked)
                if rank >= token:
                    raise ValueError(f"no merges lead to token {token}")
                parts[i:i + 2] = [rank]
            got = self._halves[token] = (parts[0], parts[-1])
        return got

    def reachable(self, token: int) -> bool:
        """Whether a token's bytes encode to it alone."""
        if len(self.bytes[token]) == 1:
            return True
        try:
            left, right = self.halves(token)
        except ValueError:
            return False
        return self.ranks.get(self.bytes[left] + self.bytes[right]) == token

    def _separate(self, pair: tuple[int, int]) -> bool:
        """Whether no merge across the boundary comes before those that made
        the two tokens.  ``limit``: merges of this rank and above come too
        late."""
        left, right = pair
        limit = 1 << 62
        while True:
            joint = self.ranks.get(self.bytes[left] + self.bytes[right])
            if joint is not None and joint < limit:
                return False
            left_made, right_made = len(self.bytes[left]) > 1, len(self.bytes[right]) > 1
            if not left_made and not right_made:
                return True
            # undo the later of the two merges; of equal ones the right one
            # came later, as merging goes from left to right
            if left_made and (not right_made or left > right):
                limit, left = left, self.halves(left)[1]
            else:
                limit, right = right + 1, self.halves(right)[0]


class Prefixes:
    """The last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        start = len(self.piece)
        self.piece += more
        self._fill(start, len(self.piece))

    def _fill(self, start: int, stop: int) -> None:
        """Entries for the prefixes that end after ``start``: of the tokens
        that end there, shortest first, the one that is compatible with the
        entry before it.  The walk ends where no token is that long."""
        piece, last = self.piece, self.last
        suffix, compatible, put = self.vocabulary.suffixes.get, self.vocabulary.compatible, last.append
        for end in range(start + 1, stop + 1):
            begin = end - 1
            while (token := suffix(piece[begin:end])) is not None:
                if token >= 0 and (compatible((last[begin - 1], token)) if begin else self._own(token)):
                    put(token)
                    break
                if not begin:
                    raise ValueError("no encoding")
                begin -= 1
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def copy(self) -> Prefixes:
        out = Prefixes.__new__(Prefixes)
        out.vocabulary, out.piece, out.last = self.vocabulary, self.piece, self.last.copy()
        return out

    def _own(self, token: int) -> bool:
        got = self.vocabulary.own.get(token)
        if got is None:
            got = self.vocabulary.own[token] = self.vocabulary.reachable(token)
        return got

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start to stop; return how many
        entries were computed anew."""
        old_last, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = old_last[:start]
        done, agree = start + len(new), 0
        self._fill(start, done)
        while done < len(self.piece) and agree < self.vocabulary.longest:
            self._fill(done, done + 1)
            agree = agree + 1 if self.last[done] == old_last[done - shift] else 0
            done += 1
        self.last += old_last[done - shift:]
        return done - start

    def ids(self) -> list[int]:
        out, end = [], len(self.piece)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to ids and back, with a bounded memory of frequent pieces.

    Ids of a piece are kept as decimal text, so that a text of known pieces
    is two dictionary passes.
    """

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary.load(path)
        self.split = regex.compile(pattern).findall
        self._ids: dict[str, str] = {}
        self._older: dict[str, str] = {}  # the memory before the present one
        self._heads: dict[bytes, Prefixes] = {}
        self._bytes: dict[str, bytes] = {}

    def piece(self, piece: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        # pieces that begin alike share the table of their beginning
        head = self._heads.get(piece[:HEAD])
        if head is None:
            if len(self._heads) >= HEADS:
                self._heads.clear()
            head = self._heads[piece[:HEAD]] = Prefixes(self.vocabulary, piece[:HEAD])
        table = head.copy()
        table.append(piece[HEAD:])
        return table.ids()

    def pieces(self, text: str | None) -> list[str]:
        """The decimal ids of each piece, joined by one space."""
        found = self.split(text or "")
        out = list(map(self._ids.get, found))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    out[i] = self._learn(found[i])
        return out

    def _learn(self, piece: str) -> str:
        ids = self._older.get(piece)
        if ids is None:
            ids = " ".join(map(str, self.piece(piece.encode())))
        if len(piece) <= 64:
            if len(self._ids) >= CACHE:
                self._older, self._ids = self._ids, {}
            self._ids[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        return list(map(int, " ".join(self.pieces(text)).split()))

    def as_array(self, pieces: list[str]) -> np.ndarray:
        """Ids given as decimal text, piece by piece, as 32-bit integers."""
        return np.fromstring(" ".join(pieces), np.int32, sep=" ") if pieces else np.empty(0, np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        table = self.vocabulary.bytes
        return b"".join([table[i] for i in ids])

    def decode_pieces(self, pieces: list[str]) -> bytes:
        """The bytes of ids given as decimal text, piece by piece."""
        out = list(map(self._bytes.get, pieces))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    out[i] = got = self.decode(map(int, pieces[i].split()))
                    if len(got) <= 256:
                        if len(self._bytes) >= CACHE:
                            self._bytes.clear()
                        self._bytes[pieces[i]] = got
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, pattern)


def _id_lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Lists of ids as one buffer and its offsets."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *rows]))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int)."""
    def make(texts: list) -> list[list]:
        enc = encoder(path, pattern)
        return [_id_lists([enc.as_array(enc.pieces(t)) for t in texts])]

    return map_texts(docs, text, [T.StructField("ids", T.ArrayType(T.IntegerType()))], make)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (the bytes of ``ids``; null ids: none)
    instead of the ids."""
    def make(lists: list) -> list[list]:
        enc = encoder(path, pattern)
        return [[enc.decode(x or ()) for x in lists]]

    return map_texts(rows, ids, [T.StructField("decoded", T.BinaryType())], make, drop=(ids,))


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one
    space) and ``decoded_sha256`` (bytes decoded from these ids) per row, in
    one pass: neither ids nor bytes leave the task."""
    def make(texts: list) -> list[list]:
        enc = encoder(path, pattern)
        counts, digests, back = [], [], []
        for t in texts:
            pieces = enc.pieces(t)
            ids = " ".join(pieces)
            counts.append(ids.count(" ") + 1 if ids else 0)
            digests.append(hashlib.sha256(ids.encode()).hexdigest())
            back.append(hashlib.sha256(enc.decode_pieces(pieces)).hexdigest())
        return [counts, digests, back]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    rows = docs.select(named(doc_id).alias("doc_id"), named(text).alias("_text"))
    return map_texts(rows, "_text", fields, make, drop=("_text",))


def checked_ids(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``exact``: whether decoding the
    ids gives the text's bytes back."""
    def make(texts: list) -> list[list]:
        enc = encoder(path, pattern)
        ids, exact = [], []
        for t in texts:
            pieces = enc.pieces(t)
            ids.append(enc.as_array(pieces))
            exact.append(enc.decode_pieces(pieces) == (t or "").encode())
        return [_id_lists(ids), list(map(len, ids)), exact]

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
              T.StructField("exact", T.BooleanType())]
    return map_texts(docs, text, fields, make)

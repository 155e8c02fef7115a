"""Secret scans weighed by corpus-wide ownership.

Candidates are spans of a text: of the base kinds (``assign``, ``access``,
``hex``) and of further kinds whose form alone marks a credential.  Every
candidate value is hashed; over the whole corpus the distinct repositories
and owners of each hash are counted.  A value of many owners is a widely
copied example, a value of few owners looks live.

Defined results: null texts have no candidate; null repositories or owners
count as one unknown name; spans are code points, end exclusive; repeated
rows each keep their spans and add no owner; an empty corpus gives no rows;
extra columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcredit.session import materialize

from .text import map_texts, named

# The three base kinds, in the order that breaks ties.
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Forms that mark a credential without a keyword before it; one starts only
# where no character of its own stands before, so that a long run is read once.
FORMS = (
    ("jwt", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+")),
    ("hosted", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("provider", re.compile(r"(?<![A-Za-z0-9_-])(?:AIza[A-Za-z0-9_-]{35}|xox[abeoprs]-[A-Za-z0-9-]{10,}|[rs]k_live_[A-Za-z0-9]{16,}"
                            r"|glpat-[A-Za-z0-9_-]{20,}|github_pat_[A-Za-z0-9_]{40,})")),
    ("userinfo", re.compile(r"(?<=://)[^\s/:@]++:[^\s/:@]++(?=@)")),
)
# What a text must hold for a form to be looked for.
_GATES = {"jwt": ("eyJ",), "hosted": ("gh",), "provider": ("AIza", "xox", "k_live_", "glpat-", "github_pat_"), "userinfo": ("://",)}
KINDS = (*BASE, "pem", *(k for k, _ in FORMS))
# Armoured private keys: from the BEGIN line to the END line that follows it;
# where none does, over the headers and the key characters after it.  Line
# breaks may be escaped.
_ARMOUR = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_BREAK = r"(?:\r?\n|\\+[nr]|\\+u000[aAdD])"
_HEADERS = re.compile(rf"(?:\s|{_BREAK})*+(?:[A-Za-z][A-Za-z0-9-]*+: [^\n\\]*+{_BREAK}+)*+")
_KEY_RUN = re.compile(r"[A-Za-z0-9+/=\s\\]*")
_NO_KEY = re.compile(r"[\"']\s*+[+.]?\s*+[\"']|\\+u000[aAdD]|\\+[nrt]|[^A-Za-z0-9+/=]+")
_KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
WIDE_OWNERS = 3  # a value of this many owners is a widely copied example


def _armoured(text: str) -> list[tuple[int, str, int, str]]:
    """The private keys; the value is the key material, without headers,
    line breaks and escapes (the whole span when there is none)."""
    marks = list(_ARMOUR.finditer(text))
    out = []
    for m, after in zip(marks, [*marks[1:], None]):
        if m[1] == "END":
            continue
        body = _HEADERS.match(text, m.end(), after.start() if after else len(text)).end()
        if after and after[1] == "END":
            stop, end = after.start(), after.end()
        else:
            stop = end = _KEY_RUN.match(text, body, after.start() if after else len(text)).end()
        out.append((m.start(), "pem", end, _NO_KEY.sub("", text[body:stop]) or text[m.start():end]))
    return out


def find(text: str | None) -> list[tuple[int, str, int, str]]:
    """``(start, kind, end, value)`` of every candidate, by start, then kind."""
    text = text or ""
    out = []
    if _KEYWORDS.search(text):
        out += [(m.start(), "assign", m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), "access", m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), "hex", m.end(), m[0]) for m in _HEX.finditer(text)]
    out += _armoured(text)
    for kind, form in FORMS:
        if any(g in text for g in _GATES[kind]):
            out += [(m.start(), kind, m.end(), m[0]) for m in form.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()),
                      T.StructField("end", T.LongType()), T.StructField("hash", T.StringType())])


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "source",
               owner: str = "source") -> DataFrame:
    """``doc_id``, ``text_hash``, ``repository``, ``owner`` and ``found``
    (array of start, kind, end, hash of the value) of every row."""
    rows = docs.select(*_identity(doc_id, text, repository, owner), named(text).alias("_text"))
    return _with_found(rows).drop("_text")


def _identity(doc_id: str, text: str, repository: str, owner: str) -> list[Column]:
    return [named(doc_id).alias("doc_id"), F.xxhash64(named(text)).alias("text_hash"),
            F.coalesce(named(repository).cast("string"), F.lit("")).alias("repository"),
            F.coalesce(named(owner).cast("string"), F.lit("")).alias("owner")]


def _with_found(rows: DataFrame) -> DataFrame:
    def make(texts: list) -> list[list]:
        digest = lambda v: hashlib.sha256(v.encode()).hexdigest()
        return [[[{"start": s, "kind": k, "end": e, "hash": digest(v)} for s, k, e, v in find(t)] for t in texts]]

    return map_texts(rows, "_text", [T.StructField("found", T.ArrayType(_SPAN))], make)


def ownership(found: DataFrame) -> DataFrame:
    """``hash``, ``n_repositories``, ``n_owners``, ``n_spans`` over all
    candidates; distinct owners are counted from already distinct pairs, so a
    value that fills a third of the corpus is small before it is shuffled."""
    each = found.select("repository", "owner", F.explode("found.hash").alias("hash"))
    pairs = each.groupBy("hash", "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("hash").agg(F.countDistinct("repository", "owner").alias("n_repositories"),
                                     F.countDistinct("owner").alias("n_owners"), F.sum("n").alias("n_spans"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "source",
         owner: str = "source", wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``spans`` of every row: array of start,
    kind, end, hash, ``n_repositories``, ``n_owners``, ``live`` (fewer than
    ``wide_owners`` owners), by start, then kind."""
    found = materialize(candidates(docs, doc_id, text, repository, owner), "secrets-found")
    per_text = _spans(found, wide_owners)
    kind = per_text.schema["spans"].dataType.simpleString()
    return found.select("doc_id", "text_hash").join(
        per_text, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left").select(
        "doc_id", "text_hash", F.coalesce("spans", F.array().cast(kind)).alias("spans"))


def _spans(found: DataFrame, wide_owners: int) -> DataFrame:
    """``_d``, ``_h``, ``spans`` of every id and text that has any."""
    owners = materialize(ownership(found), "secrets-owners")
    # one row per span, so that a value of very many texts is only many rows
    each = found.where(F.size("found") > 0).select("doc_id", "text_hash", "repository", "owner", F.posexplode("found").alias("at", "s"))
    each = each.join(owners, F.col("s.hash") == owners["hash"]).select(
        "doc_id", "text_hash", "at", F.struct(
            "s.start", "s.kind", "s.end", "s.hash", "n_repositories", "n_owners",
            (F.col("n_owners") < wide_owners).alias("live")).alias("span"))
    per_text = each.distinct().groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "span"))), lambda x: x["span"]).alias("spans"))
    return materialize(per_text, "secrets-spans")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "source",
           owner: str = "source", wide_owners: int = WIDE_OWNERS, length: str | None = None) -> DataFrame:
    """``docs`` with every live span of ``text`` replaced by ``<kind>``;
    overlapping spans are replaced once, by the first.  ``length`` names a
    column to set to the new text's code points.  Only texts with candidates
    are shuffled."""
    names = docs.columns
    rest = F.struct(F.lit(0).alias("_"), *[named(c) for c in names if c != text]).alias("_row")
    marked = materialize(_with_found(docs.select(rest, *_identity(doc_id, text, repository, owner), named(text).alias("_text"))), "secrets-found")
    live = _spans(marked.select("doc_id", "text_hash", "repository", "owner", "found"), wide_owners).select(
        "_d", "_h", F.filter("spans", lambda s: s["live"]).alias("_live")).where(F.size("_live") > 0)
    live = materialize(live, "secrets-live")
    touched = marked.where(F.size("found") > 0).join(
        live, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col("_text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        merged = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(piece, F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], merged).otherwise(longer)

    def finish(acc: Column) -> Column:
        rest = F.substring(F.col("_text"), (acc["at"] + 1).cast("int"), F.length("_text"))
        return F.concat(F.array_join(acc["out"], ""), rest)

    clean = F.when(F.col("_live").isNull(), F.col("_text")).otherwise(F.aggregate("_live", start, step, finish))
    same = marked.where(F.size("found") == 0).select("_row", F.col("_text").alias("_clean"))
    out = touched.select("_row", clean.alias("_clean")).unionByName(same)
    put = {text: F.col("_clean")} | ({length: F.length("_clean").cast("bigint")} if length else {})
    return out.select(*[put.get(c, F.col("_row")[c]).alias(c) for c in names])

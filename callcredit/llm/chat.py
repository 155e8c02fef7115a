"""Chat formatting in Spark expressions.

Turns of a conversation are collected as structs, sorted, and concatenated;
neighbours of one role share a block:

    [INST]role[/INST]text<s>text</s>[INST]role[/INST]text</s>

Control strings inside roles and texts are broken by a backslash after their
first character and backslashes are doubled, so that an unbroken control
string is always a mark and :func:`read_back` restores every turn.

Defined results: turns are ordered by turn (null first), then role, then
text, so ties and repeated rows have one order and all stay; null roles and
texts count as empty; rows with a null conversation id form one conversation;
an empty table gives no conversation; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bind

# The control strings of the template.
OPEN, HEAD, AGAIN, CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
CONTROL = (OPEN, HEAD, AGAIN, CLOSE)
CHUNK = 256


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _sums_before(lengths: Column) -> Column:
    """Sum of the elements before each element, in steps of ``CHUNK`` so that
    a long array costs a small multiple of its length."""
    def chunk_starts(sums: Column) -> Column:
        return F.transform(sums, lambda _, i: _total(F.slice(sums, F.lit(1), i)))

    def starts(xs: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")),
                           lambda c: _total(F.slice(xs, (c * CHUNK + 1).cast("int"), F.lit(CHUNK))))
        return bind(bind(sums, chunk_starts), lambda first: F.transform(xs, lambda _, i: F.get(first, F.floor(i / CHUNK).cast("int")) + _total(
            F.slice(xs, (F.floor(i / CHUNK) * CHUNK + 1).cast("int"), (i % CHUNK).cast("int")))))

    return bind(lengths, starts)


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", learn: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` (start and end, in code
    points of ``formatted``, of every text of the role ``learn``)."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    ts = F.col("turns")

    def mark(t: Column, i: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD))
        return F.when(i == 0, head).when(F.get(ts, i - 1)["role"] == t["role"], F.lit(AGAIN)).otherwise(F.concat(F.lit(CLOSE), head))

    pieces = F.transform(ts, lambda t, i: F.struct(
        mark(t, i).alias("mark"), escape(t["text"]).alias("text"), (t["role"] == learn).alias("loss")))
    chats = chats.select("conv_id", pieces.alias("pieces"))
    ps = F.col("pieces")
    whole = F.concat(F.array_join(F.transform(ps, lambda p: F.concat(p["mark"], p["text"])), ""), F.lit(CLOSE))
    before = _sums_before(F.transform(ps, lambda p: F.length(p["mark"]) + F.length(p["text"])))
    spans = F.filter(F.zip_with(ps, before, lambda p, b: F.struct(
        (b + F.length(p["mark"])).alias("start"), (b + F.length(p["mark"]) + F.length(p["text"])).alias("end"),
        p["loss"].alias("loss"))), lambda s: s["loss"])
    return chats.select("conv_id", whole.alias("formatted"),
                        F.transform(spans, lambda s: F.struct(s["start"], s["end"])).alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` (role, text) parsed from ``formatted`` and
    ``loss_text``, the unescaped text under the loss spans."""
    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, HEAD, 1)
        texts = F.split(F.substring(block, F.length(role) + len(HEAD) + 1, F.length(block)), AGAIN)
        return F.transform(texts, lambda t: F.struct(unescape(F.substring(role, len(OPEN) + 1, F.length(role))).alias("role"),
                                                     unescape(t).alias("text")))

    blocks = F.filter(F.split("formatted", CLOSE), lambda b: b != "")
    under = F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    return chats.withColumns({"turns": F.flatten(F.transform(blocks, turns_of)), "loss_text": unescape(F.array_join(under, ""))})

"""WARC archives: write one record per page, verify and read them back.

Writing: records are text rows joined by the record separator, so Spark's own
text writer makes valid archives (gzip), of at most ``RECORDS`` records each.
Of pages with equal payloads the one with the largest id is a ``response``;
the others are ``revisit`` records that name it.

Reading: a payload may hold text that looks like a record.  Tasks scan the
archives for every place where a record could start and emit candidates with
the offset of their successor (header length plus Content-Length).  Only
candidates on the chain from the start of a file are records: the set of
reached offsets doubles its depth per round by pointer jumping, all files at
once, in log2(records per file) rounds whatever the number of files.  Then the
payloads of true records alone are read and hashed.  Both readers inflate a
file piece by piece: they hold its compressed bytes, never the whole archive.

Defined results: null html is an empty payload; null page ids are written as
an empty id and read back as null, after all others in the choice of the
response; repeated rows each get a record of the same type; rows of one id
with different payloads are separate pages; an empty table gives no record;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from callcredit.session import materialize, scratch_path

from .text import PART_BYTES

RECORDS = 2048  # most records per archive
PREFIX = "urn:page:"
_MAGIC = re.compile(rb"(?<=\r\n\r\n)WARC/1\.[01]\r\n")
_BIGINT = range(-(1 << 63), 1 << 63)
_CHUNK = 1 << 20
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string or binary column: every 5
    hex digits (20 bits) are 4 digits of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), digits, _B32)


def plan_records(pages: DataFrame, page_id: str = "page_id", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``payload_digest``, ``payload_bytes``, ``record_type``,
    ``refers_to`` of every distinct page id and payload."""
    payload = F.coalesce(F.col(html), F.lit(""))
    keys = materialize(pages.select(F.col(page_id).alias("page_id"), sha1_base32(payload).alias("payload_digest"),
                                    F.octet_length(payload).cast("bigint").alias("payload_bytes")).distinct(), "warc-keys")
    # one row per payload: partial maxima keep a payload of very many pages small
    last = materialize(keys.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("last")), "warc-last")
    joined = keys.join(last, ["payload_digest", "payload_bytes"], "left")
    response = F.col("page_id").eqNullSafe(F.col("last")) | F.col("last").isNull()
    return joined.select("page_id", "payload_digest", "payload_bytes",
                         F.when(response, "response").otherwise("revisit").alias("record_type"),
                         F.when(~response, F.col("last")).alias("refers_to"))


def _record(payload: Column, url: Column, date: str) -> Column:
    """Text of one record, without the separator that ends it."""
    line = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x], F.lit("\r\n"))
    uri = lambda c: F.concat(F.lit(PREFIX), F.coalesce(c.cast("string"), F.lit("")))
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=utf-8"),
                    line("Content-Length: ", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, payload))
    head = F.concat(
        line("WARC/1.0"), line("WARC-Type: ", F.col("record_type")), line("WARC-Record-ID: <", uri(F.col("page_id")), ">"),
        line("WARC-Date: ", date),
        # a line break in an address would end the header
        line("WARC-Target-URI: ", F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "%0A")),
        line("Content-Type: application/http; msgtype=response"), line("WARC-Payload-Digest: sha1:", F.col("payload_digest")),
        F.when(revisit, F.concat(line("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                                 line("WARC-Refers-To: <", uri(F.col("refers_to")), ">"))).otherwise(""),
        line("Content-Length: ", F.octet_length(block).cast("string")))
    return F.concat(head, F.lit("\r\n"), block)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", html: str = "html", url: str = "url",
                   least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` under ``path``."""
    plan = materialize(plan_records(pages, page_id, html, least_bytes), "warc-plan")
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("_id"), sha1_base32(payload).alias("_digest"), payload.alias("_payload"),
                        F.col(url).alias("_url"))
    rows = rows.join(plan, F.col("_id").eqNullSafe(F.col("page_id")) & (F.col("_digest") == F.col("payload_digest")))
    rows.select(_record(F.col("_payload"), F.col("_url"), date).alias("value")).write.mode("overwrite").option(
        "lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


def _inflated(data: bytes) -> Iterator[bytes]:
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    rest = data
    while rest:  # one gzip member after another
        z = zlib.decompressobj(31)
        while rest and not z.eof:
            out = z.decompress(rest, _CHUNK)
            rest = z.unconsumed_tail if not z.eof else z.unused_data
            if out:
                yield out
        yield z.flush()


_LINE = re.compile(rb"([^\s:]+):[ \t]*(.*?)[ \t]*", re.S)


def _fields(lines: list[bytes]) -> dict[bytes, bytes] | None:
    """Header fields, the first of each name; None if a line is not one."""
    out: dict[bytes, bytes] = {}
    for line in lines:
        m = _LINE.fullmatch(line)
        if m:
            out.setdefault(m[1].lower(), m[2])
        elif line[:1] not in (b" ", b"\t"):  # a folded value goes on
            return None
    return out


def _candidates(path: str, data: bytes) -> Iterator[dict]:
    """Every place where a record could start, with its successor.

    A record starts the file or follows the two line breaks that end another,
    so headers of candidates never overlap and the scan is linear.  A
    successor may lie beyond the end of the file.  Memory: one inflated piece
    and the header read."""
    pieces = _inflated(data)
    text, base, look = bytearray(b"\r\n\r\n"), -4, 4  # text[0] is the byte at offset base
    ended = False

    def pull() -> None:
        nonlocal text, ended
        piece = next(pieces, None)
        if piece is None:
            ended = True
        else:
            text += piece

    while True:
        found = _MAGIC.search(text, look)
        if found is None:
            if ended:
                break
            gone = max(look, len(text) - 9) - 4  # what a start split by the pieces needs
            del text[:gone]
            base, look = base + gone, 4
            pull()
            continue
        if found.start() > _CHUNK:
            gone = found.start() - 4
            del text[:gone]
            base, look = base + gone, 4
            continue
        lines, at, whole = [], found.end(), False
        while True:
            end = text.find(b"\r\n", at)
            while end < 0 and not ended:
                seen = max(at, len(text) - 1)
                pull()
                end = text.find(b"\r\n", seen)
            whole = end == at
            if end <= at:
                break
            lines.append(bytes(text[at:end]))
            at = end + 2
        look = found.start() + 1
        fields = _fields(lines) if whole else None
        length = (fields or {}).get(b"content-length", b"")
        if length.isdigit() and len(length) <= 18:
            body = base + at + 2
            stop = body + int(length)
            yield {"file": path, "at": base + found.start(), "next": stop + 4, "body": body, "stop": stop, **_stated(fields)}


def _stated(fields: dict[bytes, bytes]) -> dict:
    """What the header of a record says."""
    said = lambda k: fields.get(k, b"").decode(errors="replace")
    named = lambda k: _number(said(k).removeprefix(f"<{PREFIX}").removesuffix(">"))
    kind, digest = said(b"warc-type"), said(b"warc-payload-digest")
    ids = named(b"warc-record-id"), named(b"warc-refers-to") if kind == "revisit" else None
    return {"record_type": kind, **{k: v if v is not None and v in _BIGINT else None for k, v in zip(("page_id", "refers_to"), ids)},
            "beyond": next((str(v) for v in ids if v is not None and v not in _BIGINT), None), "url": said(b"warc-target-uri"),
            "http": said(b"content-type").lower().startswith("application/http"), "digest": digest}


def _contents(data: bytes, records: list[dict], payloads: bool) -> Iterator[dict]:
    """The records, in their order, with size and digest of their payloads; a
    last one that the end of the file cuts off is left out.  Memory: one
    inflated piece and, if wanted, one payload."""
    pieces, text, base = _inflated(data), b"", 0
    for r in records:
        at, size, sha, head, stated = r["body"], 0, hashlib.sha1(), bytearray() if r["http"] else None, b""
        revisit = r["record_type"] == "revisit"
        kept = bytearray() if payloads and not revisit else None
        while at < r["next"]:
            while at >= base + len(text):
                base += len(text)
                text = next(pieces, None)
                if text is None:
                    return
            piece = text[at - base:r["next"] - base]
            at += len(piece)
            piece = piece[:max(len(piece) - max(at - r["stop"], 0), 0)]
            if head is not None:  # the payload is what follows the HTTP header
                seen = max(len(head) - 3, 0)
                head += piece
                end = head.find(b"\r\n\r\n", seen)
                if end < 0:
                    continue
                stated = (_fields(bytes(head[:end]).split(b"\r\n")[1:]) or {}).get(b"content-length", b"")
                piece, head = bytes(head[end + 4:]), None
            size += len(piece)
            sha.update(piece)
            if kept is not None:
                kept += piece
        actual, given = base64.b32encode(sha.digest()).decode(), r["digest"].removeprefix("sha1:")
        yield {**{k: r[k] for k in ("at", "next", "page_id", "record_type", "refers_to", "url", "beyond")},
               # a revisit states what its response holds
               "payload_digest": given if revisit else actual,
               "payload_bytes": int(stated) if revisit and stated.isdigit() and len(stated) <= 18 else size,
               "intact": True if revisit else actual == given if r["digest"].startswith("sha1:") else None,
               "payload": None if kept is None else bytes(kept)}


def _number(text: str) -> int | None:
    """The value of a page id; None for other ids."""
    if not re.fullmatch(r"-?[0-9]+", text):
        return None
    # too many digits to be in range, and for int() on a long text
    return int(text) if len(text.lstrip("-0")) <= 19 else 10 ** 19


_FOUND = ("file string, at bigint, next bigint, body bigint, stop bigint, page_id bigint, record_type string, refers_to bigint, "
          "url string, beyond string, http boolean, digest string")
_SCHEMA = ("file string, at bigint, next bigint, page_id bigint, record_type string, refers_to bigint, url string, "
           "payload_digest string, payload_bytes bigint, intact boolean, payload binary, beyond string")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")


def _batches(rows: Iterator[dict], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most 256, or of some megabytes of payload."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row.get("payload") or b"")
        if len(some) == 256 or size > PART_BYTES:
            yield pa.RecordBatch.from_pylist(some, schema=arrow)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=arrow)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All candidate records of the files under ``path``: offsets and what
    their headers say, no payloads; ``beyond`` is a page id outside the range
    of bigint."""
    arrow = to_arrow_schema(StructType.fromDDL(_FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("file"), b.column("content")):
                yield from _batches(_candidates(name.as_py(), content.as_py()), arrow)

    return _files(spark, path).mapInArrow(run, _FOUND)


def contents(spark: SparkSession, path: str, records: DataFrame, payloads: bool = False) -> DataFrame:
    """``records`` (true ones) with what their blocks hold: every file meets
    the list of its records and is inflated once more, each payload hashed
    once."""
    listed = records.groupBy("file").agg(F.array_sort(F.collect_list(F.struct(
        "at", *[c for c in records.columns if c not in ("at", "file")]))).alias("records"))
    arrow = to_arrow_schema(StructType.fromDDL(_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content, true in zip(b.column("file"), b.column("content"), b.column("records")):
                file = name.as_py()
                yield from _batches(({"file": file, **r} for r in _contents(content.as_py(), true.as_py(), payloads)), arrow)

    return _files(spark, path).join(listed, "file").select("file", "content", "records").mapInArrow(run, _SCHEMA)


def reachable(found: DataFrame) -> DataFrame:
    """The rows of ``found`` (a stored table of ``file``, ``at``, ``next``)
    on the chain from offset zero of their file."""
    jumps = found.select("file", "at", "next").distinct()
    reached = jumps.where("at = 0").select("file", "at")
    n = -1
    while True:
        reached = materialize(reached, "warc-reached")
        before, n = n, reached.count()
        if n == before:
            break
        # reached offsets and those one jump further; jumps twice as long
        jumps = materialize(jumps, "warc-jumps")
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = reached.union(ahead).distinct()
        far = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("_far"))
        jumps = jumps.join(far, ["file", "next"]).select("file", "at", F.col("_far").alias("next"))
    return found.join(reached, ["file", "at"], "left_semi")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The true records under ``path``: ``file``, ``at``, ``next``,
    ``page_id``, ``record_type``, ``refers_to``, ``url``, ``payload_digest``,
    ``payload_bytes``, ``intact`` (stated and actual digest agree; null where
    no SHA-1 is stated) and, if wanted, ``payload``.  Ids other than page
    numbers are null; a record with a page number that no bigint holds is an
    error."""
    true = reachable(materialize(candidates(spark, path), "warc-candidates"))
    # stored: each file is inflated for it, which later scans need not repeat
    found = materialize(contents(spark, path, true, payloads), "warc-records")
    error = F.raise_error(F.concat(F.lit("page id out of range: "), F.col("beyond"))).cast("bigint")
    return found.withColumn("page_id", F.when(F.col("beyond").isNotNull(), error).otherwise(F.col("page_id"))).drop("beyond")


def round_trip(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url", least_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` under the shared folder, read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, page_id, html, url, least_bytes)
    return read_archives(spark, path)

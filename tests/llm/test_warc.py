import base64
import hashlib
import random
from collections import defaultdict

import pytest

from callcredit.llm import warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def brute(rows):
    groups = defaultdict(list)
    for i, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for p, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        out += [(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if i == last else "revisit", None if i == last else last) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("records", [3, 2048])
def test_round_trip(spark, monkeypatch, records):
    monkeypatch.setattr(warc, "RECORDS", records)
    rng = random.Random(4)
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, FAKE), (6, "x" + FAKE * 2), (7, FAKE * 5), (8, "WARC/1.0\r\n"), (9, "\r\n\r\n"), (10, "é" * 100000),
            (11, "a"), (11, "a"), (12, "b"), (12, "c"), (None, "a"), (None, "alone")]
    rows += [(100 + i, rng.choice([f"p{i % 7}", FAKE + str(i % 5)])) for i in range(300)]
    df = spark.createDataFrame([(i, h, "u\r\nWARC/1.0", "z") for i, h in rows], "page_id bigint, html string, url string, file string")
    back = warc.round_trip(df)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()), key=repr) == brute(rows)
    assert back.where("not intact").count() == 0


def test_payloads_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, FAKE + "é", "u"), (2, FAKE + "é", "u")], "page_id bigint, html string, url string")
    warc.write_archives(df, str(tmp_path / "w"))
    got = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "w"), payloads=True).collect()}
    assert bytes(got[2].payload).decode() == FAKE + "é" and got[1].payload is None and got[1].refers_to == 2
    found = warc.candidates(spark, str(tmp_path / "w"))
    assert found.count() > 2  # the payloads hold what looks like a record
    assert warc.round_trip(df.limit(0)).count() == 0


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "ab", "u"), (2, "ab", "u"), (3, "abcdef", "u"), (4, "abcdef", "u")], "page_id bigint, html string, url string")
    got = {r.page_id: r.record_type for r in warc.plan_records(df, least_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_ids_of_the_whole_bigint_range(spark):
    ids = [2 ** 63 - 1, -2 ** 63, 10 ** 18, -10 ** 18, 0, 8 * 10 ** 18]
    rows = [(i, "same") for i in ids] + [(10 ** 18 + 7, "alone")]
    back = warc.round_trip(spark.createDataFrame([(i, h, "u") for i, h in rows], "page_id bigint, html string, url string"))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()), key=repr) == brute(rows)


def record(version, id_, block, *more):
    head = [f"WARC/{version}", "WARC-Type: resource", f"WARC-Record-ID: <{id_}>", *more, f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n" + block + "\r\n\r\n").encode()


def test_ordinary_crawl_folder(spark, tmp_path):
    import gzip
    digest = base64.b32encode(hashlib.sha1(b"x\r\n\r\ny").digest()).decode()
    one = record("1.1", "urn:uuid:12345678-1234-1234-1234-123456789012", "software: x\r\n")
    two = record("1.1", "urn:page:5", "x\r\n\r\ny", f"WARC-Payload-Digest: sha1:{digest}")
    (tmp_path / "crawl-00000.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    (tmp_path / "CRAWL.warc").write_bytes(record("1.0", "urn:page:6", "z", "WARC-Payload-Digest: sha1:WRONG"))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.intact) for r in got), key=str) == [(5, 6, True), (6, 1, False), (None, 13, None)]


def test_ids_beyond_bigint_raise(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record("1.0", f"urn:page:{2 ** 63}", "z"))
    with pytest.raises(Exception, match="page id out of range"):
        warc.read_archives(spark, str(tmp_path)).collect()
    # such an id inside a payload is no record
    fake = record("1.0", "urn:page:" + "9" * 5000, "z").decode()
    assert [r.page_id for r in warc.round_trip(spark.createDataFrame([(1, fake, "u")], "page_id bigint, html string, url string")).collect()] == [1]


def test_long_payload_of_false_headers(tmp_path):
    """Time and memory of a file of 100 MB whose payload looks like records."""
    import gzip
    import time
    import tracemalloc

    fake = ("WARC/1.0\r\nContent-Type: application/http\r\nContent-Length: 90000000\r\n\r\n" + "x" * 900 + "\r\n\r\n").encode()
    payload = fake * (100_000_000 // len(fake))
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:3>\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    packed = gzip.compress(head + payload + b"\r\n\r\n" + record("1.0", "urn:page:4", "z"), 1)
    want = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    del payload
    tracemalloc.start()
    start = time.time()
    chain, at, candidates = [], 0, 0
    for r in warc._candidates("f", packed):
        candidates += 1
        if r["at"] == at:
            chain.append(r)
            at = r["next"]
    got = list(warc._contents(packed, chain, False))
    spent, (_, peak) = time.time() - start, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [(r["page_id"], r["payload_digest"] == want) for r in got] == [(3, True), (4, False)]
    assert candidates > 100_000 and spent < 60 and peak < 20_000_000, (candidates, spent, peak)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_starts_split_by_the_pieces(monkeypatch, piece):
    """Records and headers may be cut anywhere by the inflated pieces."""
    monkeypatch.setattr(warc, "_inflated", lambda data: (data[i:i + piece] for i in range(0, len(data), piece)))
    http = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    data = (record("1.0", "urn:page:1", FAKE) + record("1.1", "urn:page:2", http, "Content-Type: application/http; msgtype=response")
            + record("1.0", "urn:page:3", "") + record("1.0", "urn:page:4", "cut")[:-3])
    found = {r["at"]: r for r in warc._candidates("f", data)}
    chain, at = [], 0
    while at in found:
        chain.append(found[at])
        at = found[at]["next"]
    got = list(warc._contents(data, chain, True))
    assert [(r["page_id"], r["payload"]) for r in got] == [(1, FAKE.encode()), (2, b"abc"), (3, b"")]
    assert len(found) == 5  # with the one inside a payload and the one cut off


def test_lines_that_are_no_header():
    bad = b"WARC/1.0\r\nno field\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    assert not list(warc._candidates("f", bad)) and not list(warc._candidates("f", b"")) and not list(warc._candidates("f", b"WARC/1.0\r\n"))
    folded = record("1.0", "urn:page:1", "x", "X-Long: a\r\n b: c")
    assert [r["page_id"] for r in warc._candidates("f", folded)] == [1]

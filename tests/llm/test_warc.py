import hashlib
import random

import duckdb
import pytest

from ravel.llm import warc as W

TRAP = b"\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n0\r\n\r\n"


@pytest.mark.parametrize("size", [1, 7, 16_384])
def test_chunked_framing_round_trip(size):
    rng = random.Random(size)
    for body in (b"", b"x", TRAP, rng.randbytes(5000)):
        assert W.dechunked(W.chunked(body, size)) == body
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcX"):
        with pytest.raises(ValueError):
            W.dechunked(bad)


def test_records_round_trip_through_an_archive():
    rng = random.Random(1)
    bodies = [b"", TRAP * 50, rng.randbytes(300_000), b"plain"]
    records = [r for i, b in enumerate(bodies)
               for r in W.page_records(i, f"http://x/{i}\r\nA: b", b, hashlib.sha256(b).hexdigest(), None)]
    archive = b"".join(r + b"\r\n\r\n" for r in records)
    got = list(W.parse_archive(archive))
    assert len(got) == len(records) and len(records) > len(bodies)
    assert got[0][0]["warc-target-uri"] == "http://x/0%0D%0AA: b"
    assert all(len(b) <= W.SEGMENT for _, b in got)
    with pytest.raises(ValueError):
        list(W.parse_archive(archive[:-30]))


def parts_of(body, digest=None):
    digest = digest or hashlib.sha256(body).hexdigest()
    out = []
    for f, block in W.parse_archive(b"".join(
            r + b"\r\n\r\n" for r in W.page_records(7, "u", body, digest, None))):
        out.append({"segment": int(f["warc-segment-number"]), "data": block, "page_id": 7, "uri": "u",
                    "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                    "type": f["warc-type"], "digest": f.get("warc-payload-digest", "").removeprefix("sha256:") or None})
    return out


def test_reassembly_checks_order_total_and_digest():
    body = random.Random(2).randbytes(250_000)
    parts = parts_of(body)
    assert len(parts) == 4
    whole = ("o", 7, "u", body, len(body), hashlib.sha256(body).hexdigest(), True)
    assert W.reassemble("o", parts) == [whole]
    assert W.reassemble("o", sorted(parts * 2, key=lambda p: p["segment"])) == [whole] * 2
    for broken in (parts[:-1], parts[1:], parts[:1] + parts[2:], parts_of(body, "0" * 64)):
        assert [x[-1] for x in W.reassemble("o", broken)] == [False]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view pages as from '{sf}/pages.parquet'")
    got = W.op6_warc(spark, sf)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.sql(W.ORACLE["op6_warc"]).fetchall())


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip_with_revisits_segments_and_odd_rows(spark, tmp, compression):
    rng = random.Random(3)
    long = "".join(rng.choice("aé語\r\n<") for _ in range(200_000))
    trap = TRAP.decode() * 9
    rows = [(1, "http://a/1", "x" * 99), (2, "http://a/2", "x" * 99), (5, None, "y" * 100),
            (4, "u", "y" * 100), (9, "u", "y" * 100), (10, "u", long), (11, "u\nv", long),
            (12, "u", None), (13, "u", ""), (14, "u", trap), (14, "u", trap), (None, "u", "y" * 100),
            (15, "w", long + "z"), (15, "w", long + "z"), (None, "n", "q" * 200), (None, "n", "q" * 200)]
    pages = spark.createDataFrame([(*r, "response", "d") for r in rows],
                                  "page_id long, url string, html string, type string, digest string")
    W.write_archives(pages, f"{tmp}/w", compression=compression)
    got = W.read_archives(spark, f"{tmp}/w").collect()
    assert all(r.complete for r in got)
    bare = W.read_archives(spark, f"{tmp}/w", payloads=False)
    assert bare.where("payload is not null").count() == 0
    assert sorted(str(r) for r in bare.drop("payload").collect()) == sorted(
        str(r) for r in spark.createDataFrame(got, bare.schema).drop("payload").collect())
    firsts = {}
    for i, _, t in rows:
        if i is not None and t and len(t.encode()) >= 100:
            firsts[t] = min(firsts.get(t, i), i)
    want = []
    for i, u, t in rows:
        data = (t or "").encode()
        first = firsts.get(t)
        back = first if first is not None and first != i else None
        want.append((i, None if u is None else u.replace("\n", "%0A"), "response" if back is None else "revisit",
                     back, len(data), hashlib.sha256(data).hexdigest(), data if back is None else None))
    key = lambda r: str(r)
    assert sorted(((r.page_id, r.uri, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)


def test_empty(spark, tmp):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    W.write_archives(pages, f"{tmp}/w")
    assert W.read_archives(spark, f"{tmp}/w").count() == 0


def test_copies_of_segments_are_counted_not_listed(spark, tmp):
    """Many pages without an id share one large payload and its record id: no
    list is longer than one payload's segments, and every page comes back."""
    body = "x<é>" * 60_000
    n = 300
    pages = spark.range(n).selectExpr("cast(null as long) page_id", "'u' url", f"repeat('x<é>', 60000) html")
    W.write_archives(pages, f"{tmp}/w")
    records = W.pinned(W.archive_records(spark, f"{tmp}/w"))
    per = records.where("segment is not null").groupBy("record_id").count().collect()
    segments = -(-len(W._HTTP + W.chunked(body.encode())) // W.SEGMENT)
    assert [r["count"] for r in per] == [n * segments]
    seen = spark.sparkContext.accumulator(0)
    plain = W._message

    def counting(origin, parts):
        seen.add(len(parts))
        return plain(origin, parts)

    W._message = counting
    try:
        out = W.read_responses(records, payloads=False)
        assert out.count() == n and out.where("not complete").count() == 0
        assert out.select("payload_digest").distinct().collect()[0][0] == \
            hashlib.sha256(body.encode()).hexdigest()
    finally:
        W._message = plain


def test_damaged_and_foreign_archives(spark, tmp):
    """Whole records before the damage are read; the job goes on."""
    import gzip
    import os
    whole = [r + b"\r\n\r\n" for i in range(4) for r in
             W.page_records(i, "u", b"p%d" % i * 90, hashlib.sha256(b"p%d" % i * 90).hexdigest(), None)]
    packed = b"".join(gzip.compress(r) for r in whole)
    bad = bytearray(packed)
    bad[len(packed) // 2 + 40] ^= 255
    odd = b"WARC/1.0\r\nWARC-Type: response\r\nPage-ID: none\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    files = {"plain": b"".join(whole), "packed": packed, "cut": packed[:-40], "bad": bytes(bad),
             "noise": b"no archive at all", "empty": b"", "short": b"".join(whole)[:-30],
             "lengthless": whole[0] + b"WARC/1.0\r\nWARC-Type: response\r\n\r\nab\r\n\r\n",
             "negative": odd.replace(b"Length: 2", b"Length: -2"), "odd": odd}
    os.makedirs(f"{tmp}/w")
    for i, (name, data) in enumerate(files.items()):
        with open(f"{tmp}/w/part-{i}-{name}", "wb") as f:
            f.write(data)
    got = W.archive_records(spark, f"{tmp}/w").collect()
    pages = sorted(r.page_id for r in got if r.complete)
    # plain, packed: 4 each; cut, short: 3; bad: 2; lengthless: 1
    assert pages == sorted([0, 1, 2, 3] * 2 + [0, 1, 2] * 2 + [0, 1] + [0])
    assert [(r.page_id, r.complete) for r in got if not r.complete] == [(None, False)]

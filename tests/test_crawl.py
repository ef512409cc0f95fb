"""Crawl segments: multi-member gzip records, invalid UTF-8, truncated and
missing segments, index routing, counters; the phone job end to end."""

import gzip
import os

from ravel.plans.programs import phone_job


def record(headers, payload: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + \
        f"Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def write_segment(path, records, members=True):
    with open(path, "wb") as f:
        if members:
            for r in records:
                f.write(gzip.compress(r))
        else:
            f.write(gzip.compress(b"".join(records)))


def test_phone_job(spark, tmp):
    info = record([("WARC-Type", "warcinfo")], b"software: x")
    good = record([("WARC-Type", "conversion"), ("WARC-Target-URI", "http://a.nl/1")],
                  "bel +31 6 12345678 of 0031612345678, Zoë".encode())
    bad = record([("WARC-Type", "conversion"), ("WARC-Target-URI", "http://b.nl/2")],
                 b"+31612345679 \xff\xfe broken")
    other = record([("WARC-Type", "conversion"), ("WARC-Target-URI", "http://c.nl/3")],
                   b"tel (+31) 20-1234567")
    os.makedirs(f"{tmp}/seg")
    write_segment(f"{tmp}/seg/s1.wet.gz", [info, good, bad])
    write_segment(f"{tmp}/seg/s2.wet.gz", [info, other, good], members=False)
    data = open(f"{tmp}/seg/s1.wet.gz", "rb").read()
    with open(f"{tmp}/seg/s3.wet.gz", "wb") as f:  # truncated inside the 2nd member
        f.write(data[: len(gzip.compress(info)) + 10])
    with open(f"{tmp}/index.txt", "w") as f:
        f.write(f"file:{tmp}/seg/s1.wet.gz\nfile://{tmp}/seg/s2.wet.gz\nfile:{tmp}/seg/s3.wet.gz\n"
                f"file:{tmp}/seg/missing.wet.gz\ns3://nokey\nhttp://x/y.gz\n")
    counters = phone_job(spark, f"{tmp}/index.txt", f"{tmp}/out")
    rows = {r.num: sorted(r.urls) for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert rows == {"+31612345678": ["http://a.nl/1", "http://a.nl/1"],
                    "+31201234567": ["http://c.nl/3"]}
    assert counters["failed_parses"] == 1           # the bad record of s1
    # missing file, invalid s3 uri and the truncated segment (no records) fail;
    # the unknown scheme is ignored.
    assert counters["failed_segments"] == 3


def read_all(spark, tmp, uris, partitions=None):
    from ravel.sources.crawl import CrawlRead, read_index
    with open(f"{tmp}/index.txt", "w") as f:
        f.write("\n".join(uris) + "\n")
    r = CrawlRead(spark, read_index(spark, f"{tmp}/index.txt"), partitions)
    rows = sorted((x.uri, x.body) for x in r.valid_records().collect())
    return rows, r


def test_framing_by_content_length(spark, tmp):
    """Payloads that hold version lines, record heads or trailing line ends,
    and records of another version, come back whole."""
    trap = b"a\r\n\r\nWARC/1.0\r\nWARC-Target-URI: x\r\nContent-Length: 2\r\n\r\nzz\r\n\r\n"
    parts = [("u1", trap), ("u2", b"plain\r\n\r\n"), ("u3", b""), ("u4", "Zoë".encode() * 400_000)]
    recs = [record([("WARC-Target-URI", u)], p) for u, p in parts]
    recs[1] = recs[1].replace(b"WARC/1.0", b"WARC/1.1", 1)
    os.makedirs(f"{tmp}/a b{{1}}")
    for members in (True, False):
        write_segment(f"{tmp}/a b{{1}}/s.gz", recs, members)
        rows, r = read_all(spark, tmp, [f"file:{tmp}/a b{{1}}/s.gz"])
        assert rows == [(u, p.decode()) for u, p in parts]
        assert (r.failed_segments(), r.failed_parses()) == (0, 0)


def test_repeated_lines_and_damaged_segments(spark, tmp):
    recs = [record([("WARC-Target-URI", f"u{i}")], b"x" * 50) for i in range(4)]
    whole = b"".join(map(gzip.compress, recs))
    bad = bytearray(whole)
    bad[len(whole) // 2 + 25] ^= 0xFF       # in the data of the third member
    files = {"good": whole, "cut": whole[:-5], "bad": bytes(bad), "noise": b"no segment",
             "plain": b"".join(recs), "inside": b"".join(recs)[:-30]}
    for name, data in files.items():
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(data)
    uris = [f"file:{tmp}/{n}" for n in ["good", "good", *files]]
    rows, r = read_all(spark, tmp, uris)
    n = {u: sum(1 for x, _ in rows if x == u) for u, _ in rows}
    # good x 3, plain, cut (all but its checksum); bad and inside keep their first
    assert n["u0"] == 3 + 4 and n["u3"] == 3 + 2
    assert r.failed_segments() == 4


def test_partitions_take_effect(spark, tmp):
    from ravel.sources.crawl import read_segments
    paths = []
    for i in range(12):
        write_segment(f"{tmp}/s{i}.gz", [record([("WARC-Target-URI", f"u{i}")], b"x")])
        paths.append(f"file:{tmp}/s{i}.gz")
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = [read_segments(spark, paths, n).rdd.getNumPartitions() for n in (1, 2, 12)]
        assert got[0] < got[1] < got[2] == 12
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
        spark.conf.set("spark.sql.files.minPartitionNum", old) if old else \
            spark.conf.unset("spark.sql.files.minPartitionNum")


def test_missing_connector_is_an_error(spark, tmp):
    import pytest
    with pytest.raises(Exception, match="S3A|s3a|No FileSystem|ClassNotFound"):
        read_all(spark, tmp, ["s3://bucket/key.gz"])


def test_segment_over_two_gib_is_read_in_slices(tmp):
    """What a task holds does not grow with the segment: unwanted payloads
    are passed by, and records behind 2 GiB are found."""
    import resource

    from ravel.sources.segments import segment_batches
    path, blank = f"{tmp}/big", 700 << 20
    with open(path, "wb") as f:
        for i in range(4):
            f.write(f"WARC/1.0\r\nWARC-Type: x\r\nContent-Length: {blank}\r\n\r\n".encode())
            f.seek(blank, 1)                # a hole in the file
            f.write(b"\r\n\r\n" + record([("WARC-Target-URI", f"u{i}")], b"y" * i))
    assert os.path.getsize(path) > 1 << 31
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    rows = [r for b in segment_batches(f"file:{path}", {}) for r in b.to_pylist()]
    assert [(r["uri"], r["payload"], r["ok"]) for r in rows] == [
        *((f"u{i}", b"y" * i, None) for i in range(4)), (None, None, True)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200 << 10     # KiB


def test_unpacking_in_bounded_pieces():
    import random
    import zlib

    import pytest

    from ravel.sources import segments
    rng = random.Random(4)
    parts = [b"", b"a" * 5_000_000, rng.randbytes(100_000), b"tail" * 300_000, b"b" * segments.SLICE]
    packed = b"".join(map(gzip.compress, parts))
    for step in (1 << 20, 777, 64):
        slices = [packed[i:i + step] for i in range(0, len(packed), step)]
        got = list(segments.unpacked(slices))
        assert b"".join(got) == b"".join(parts) and max(map(len, got)) <= segments.SLICE
        with pytest.raises(EOFError):
            list(segments.unpacked([*slices[:-1], slices[-1][:-1]]))
    with pytest.raises(zlib.error):
        list(segments.unpacked([packed[:50] + bytes([packed[50] ^ 255]) + packed[51:]]))


def test_reads_are_packed_by_size():
    import random

    from ravel.sources.segments import plan_reads
    rng = random.Random(1)
    for _ in range(200):
        sizes = {f"p{i}": rng.choice([0, 1, rng.randrange(1000), 10_000])
                 for i in range(rng.randrange(1, 60))}
        tasks = rng.choice([None, 1, 2, 7, 100])
        plan = plan_reads(sizes, tasks, 3000)
        assert sorted(p for t in plan for p in t) == sorted(sizes)
        wanted = tasks or max(1, -(-sum(sizes.values()) // 3000))
        assert len(plan) == min(wanted, len(sizes)) and all(plan)
        held = [sum(sizes[p] for p in t) for t in plan]
        assert max(held) <= sum(held) / len(held) + max(sizes.values()) + len(sizes)
        assert plan == plan_reads(dict(reversed(sizes.items())), tasks, 3000)
    assert plan_reads({}, 5) == []
    # by default so many bytes a task, but a task for every core
    some = {f"s{i}": 100 for i in range(30)}
    assert len(plan_reads(some, None, 300)) == 10
    assert len(plan_reads(some, None, 3000, least=8)) == 8
    assert len(plan_reads(some, None, 300, least=8)) == 10
    assert len(plan_reads(some, None, 3000, least=50)) == 30
    assert len(plan_reads(some, 2, 300, least=8)) == 2


def test_objects_of_a_store(tmp, monkeypatch):
    """S3 objects through a stand-in store: listing, reading, a missing one."""
    from pyarrow import fs

    from ravel.sources import segments
    made = {}
    os.makedirs(f"{tmp}/bucket/dir")
    write_segment(f"{tmp}/bucket/dir/a.gz", [record([("WARC-Target-URI", "u")], b"pay")])

    def store(**options):
        made.update(options)
        return fs.SubTreeFileSystem(tmp, fs.LocalFileSystem())

    monkeypatch.setattr(fs, "S3FileSystem", store)
    paths = ["s3a://bucket/dir/a.gz", "s3a://bucket/dir/b.gz", "s3a://bucket/none/c.gz"]
    sizes = segments.sizes_of(paths, {"s3_region": "eu-west-1"})
    assert list(sizes) == paths[:1] and made["anonymous"] and made["region"] == "eu-west-1"
    rows = [r for p in paths[:2] for b in segments.segment_batches(p, {"s3_anonymous": "false"})
            for r in b.to_pylist()]
    assert [(r["uri"], r["ok"]) for r in rows] == [("u", None), (None, True), (None, False)]
    assert made["anonymous"] is False


def test_settings_stay_as_they_were(spark, tmp):
    from ravel.sources.crawl import read_segments
    write_segment(f"{tmp}/s.gz", [record([("WARC-Target-URI", "u")], b"x")])
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    df = read_segments(spark, [f"file:{tmp}/s.gz", f"file:{tmp}/none/t.gz"], 3)
    assert df.rdd.getNumPartitions() == 1 and df.count() == 2
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before

"""WARC archives: writing with revisits and segments, reading with reassembly.

Writing: equal payloads of at least ``MIN_REVISIT`` bytes become one response,
the one with the smallest page_id, and revisits that refer to it. A response
holds an HTTP message in chunked transfer framing; a block over ``SEGMENT``
bytes is cut into a first record and continuation records with the first
one's id as their origin, numbered, the last with the total length. Spark's
text writer stores records as lines that end in the records' own separator,
compressed, at most ``RECORDS_PER_FILE`` to a file, so an archive has a bounded
size.

Reading: each archive is cut into records by Content-Length, whatever the
payloads hold. Continuations are grouped by origin, ordered by segment number
and checked against the total length; then the chunked framing is decoded and
the payload compared with its digest. A record that fails a check is returned
with ``complete`` false. Revisits take length and digest from the response
they refer to.

Scale: payloads are moved once, with the revisit decision, and only when some
payload repeats; unsegmented records are decoded where they are read, and only
segments are shuffled, by origin. A payload in a third of all pages is counted
with partial aggregation; its revisits meet one row in joins whose hot side
Spark may split.

Edge cases: a null payload is empty. A null URL has no target header, line
breaks in a URL are percent-encoded. A null page_id is never the response of
others while some page with an id holds the payload; pages without ids only
are all responses. Rows that repeat page_id and payload are written and read
back as often as they occur: each segment is kept once, with a count. Of a
damaged archive, or a file that is none, the whole records before the damage
are read; fields that should be numbers and are none count as missing. An
empty table gives no archives and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm.common import bound_batches, pinned, read
from ravel.session import remove_path, scratch_path

MIN_REVISIT = 100
SEGMENT = 65_536
CHUNK = 16_384
RECORDS_PER_FILE = 1000
_END = b"\r\n\r\n"
_SLICE = 1 << 20
_DATE = "1970-01-01T00:00:00Z"
_NAMES = uuid.UUID("8d7e4f66-5b1c-4a53-9a55-0d2e6a4c9b10")   # of record ids
_HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
         b"Transfer-Encoding: chunked\r\n\r\n")


def record_id(page_id, digest: str, kind: str = "response") -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{kind}|{page_id}|{digest}')}>"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = []
    for at in range(0, len(body), size):
        part = body[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """Body of a chunked message; raises ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk without end")
        parts.append(data[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP message block, without its transfer framing."""
    head, found, body = block.partition(_END)
    if not found:
        raise ValueError("no end of HTTP headers")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in
              (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    return dechunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def page_records(page_id, url, payload: bytes, digest: str, refers_to) -> list[bytes]:
    """The records of one page, without their separators. ``refers_to`` is
    the response's page_id of a revisit, else null."""
    uri = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    common = [("WARC-Target-URI", uri), ("WARC-Date", _DATE), ("Page-ID", page_id)]
    if refers_to is not None:
        return [_record([("WARC-Type", "revisit"),
                         ("WARC-Record-ID", record_id(page_id, digest, "revisit")),
                         ("WARC-Refers-To", record_id(refers_to, digest)),
                         ("WARC-Payload-Digest", f"sha256:{digest}"), *common], b"")]
    block, first = _HTTP + chunked(payload), record_id(page_id, digest)
    parts = [block[at:at + SEGMENT] for at in range(0, len(block), SEGMENT)]
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", first),
                    ("Content-Type", "application/http;msgtype=response"),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("WARC-Segment-Number", 1 if len(parts) > 1 else None), *common], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        out.append(_record([("WARC-Type", "continuation"),
                            ("WARC-Record-ID", record_id(page_id, digest, f"segment {n}")),
                            ("WARC-Segment-Origin-ID", first), ("WARC-Segment-Number", n),
                            ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None),
                            *common], part))
    return out


def unpacked(data: bytes) -> bytes:
    """Content of an archive, gzip members after one another or plain; of a
    damaged one, what stands before the damage."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        try:
            for at in range(0, len(data), _SLICE):
                out.append(member.decompress(data[at:at + _SLICE]))
                if member.eof:
                    break
        except zlib.error:
            break
        data = member.unused_data + data[at + _SLICE:] if member.eof else b""
    return b"".join(out)


def parse_archive(data: bytes):
    """(fields, block) of each record, cut by Content-Length. Raises ValueError
    or KeyError where what follows is no whole record."""
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        end = data.index(_END, at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if stop < start or data[stop:stop + 4] != _END:
            raise ValueError(f"record at byte {at} has a wrong length")
        yield fields, data[start:stop]
        at = stop + 4


def first_pages(pages: DataFrame, digest, size, page_id) -> DataFrame:
    """(digest, first): payloads that occur in several pages and are long
    enough for revisits, with the smallest page_id."""
    rows = pages.select(digest.alias("first_digest"), page_id.alias("id"))
    return (rows.where(size >= MIN_REVISIT).groupBy("first_digest")
            .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and first is not null").select("first_digest", "first"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", compression: str = "gzip") -> None:
    """Write a record for every row of ``pages`` into archives under ``path``
    (``compression``: gzip or none)."""
    bound_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    digest = F.sha2("payload", 256)
    firsts = first_pages(rows, digest, F.octet_length("payload"), F.col("page_id"))
    rows = rows.withColumn("digest", digest)
    rows = rows.join(firsts, rows.digest == firsts.first_digest, "left")
    own = F.col("first").isNull() | F.col("first").eqNullSafe(F.col("page_id"))
    rows = rows.select("page_id", "url", "payload", "digest",
                       F.when(~own, F.col("first")).alias("refers_to"))

    def run(batches):
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                out += page_records(*row)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", compression).text(path))


_FIELDS = [("record_id", "string", pa.string()), ("type", "string", pa.string()),
           ("page_id", "long", pa.int64()), ("uri", "string", pa.string()),
           ("refers_to_id", "string", pa.string()), ("digest", "string", pa.string()),
           ("segment", "int", pa.int32()), ("total", "long", pa.int64()),
           ("payload_bytes", "long", pa.int64()), ("payload_digest", "string", pa.string()),
           ("complete", "boolean", pa.bool_()), ("data", "binary", pa.binary())]


def archive_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per WARC record under ``path``. For a segment ``record_id`` is
    its origin's id and ``data`` its part of the block; a whole response has
    its payload's length, digest and check, and the payload itself in ``data``
    if ``payloads`` are wanted."""
    bound_batches(spark)

    def row(f, block):
        # numbers that are none are like missing ones
        number = {k: int(f[n]) if f.get(n, "").isascii() and f.get(n, "").isdigit()
                  and len(f[n]) < 19 else None for k, n in
                  (("segment", "warc-segment-number"), ("total", "warc-segment-total-length"),
                   ("page", "page-id"))}
        if number["segment"] is not None and number["segment"] >= 1 << 31:
            number["segment"] = None
        digest = f.get("warc-payload-digest", "").removeprefix("sha256:") or None
        size = found = complete = None
        if f.get("warc-type") == "response" and number["segment"] is None:
            block, size, found, complete = _decoded(block, digest)
            block = block if payloads else None
        return (f.get("warc-segment-origin-id", f.get("warc-record-id")), f.get("warc-type"),
                number["page"], f.get("warc-target-uri"), f.get("warc-refers-to"), digest,
                number["segment"], number["total"], size, found, complete, block)

    def run(batches):
        for b in batches:
            for content in b["content"].to_pylist():
                out = []
                try:
                    for f, block in parse_archive(unpacked(content)):
                        out.append(row(f, block))
                except (ValueError, KeyError):
                    pass                # what stands before the damage is kept
                for at in range(0, len(out), 256):
                    part = out[at:at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in part], t) for i, (_, _, t) in enumerate(_FIELDS)],
                        [n for n, _, _ in _FIELDS])

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("content").mapInArrow(run, ", ".join(f"{n} {t}" for n, t, _ in _FIELDS)))


def _decoded(block: bytes, digest):
    """(payload, its length, its digest, complete) of a whole block; nulls
    where the framing is broken."""
    try:
        payload = payload_of(block)
    except ValueError:
        return None, None, None, False
    found = hashlib.sha256(payload).hexdigest()
    return payload, len(payload), found, digest in (None, found)


_OUT = ["record_id string", "page_id long", "uri string", "payload binary", "payload_bytes long",
        "payload_digest string", "complete boolean"]
_OUT_KINDS = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]


def read_responses(records: DataFrame, payloads: bool = True) -> DataFrame:
    """(record_id, page_id, uri, payload, payload_bytes, payload_digest,
    complete) of every response."""
    names = [x.split()[0] for x in _OUT]

    def together(batches):
        for b in batches:
            rows = [_message(r["record_id"], r["parts"]) for r in b.to_pylist()]
            if not payloads:
                rows = [(*r[:3], None, *r[4:]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[i] for r in rows], t) for i, t in enumerate(_OUT_KINDS)),
                 b["times"]], [*names, "times"])

    whole = records.where("type = 'response' and segment is null") \
        .withColumnRenamed("data", "payload").select(*names)
    # rows written twice have each segment twice: each is kept once, with how
    # often the first one occurs, so that no list grows with the copies
    parts = (records.where("segment is not null").groupBy("record_id", "segment")
             .agg(F.first(F.struct("total", "type", "page_id", "uri", "digest", "data")).alias("p"),
                  F.count(F.lit(1)).alias("times"))
             .groupBy("record_id")
             .agg(F.sort_array(F.collect_list(F.struct("segment", "p.*"))).alias("parts"),
                  F.max(F.when(F.col("segment") == 1, F.col("times"))).alias("times")))
    parts = parts.select("record_id", "parts", F.coalesce("times", F.lit(1)).alias("times")) \
        .mapInArrow(together, ", ".join([*_OUT, "times long"]))
    parts = parts.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return whole.unionByName(parts.select(*names))


def reassemble(origin: str, parts: list[dict]) -> list[tuple]:
    """Responses of one origin id from segments of any number: one for each
    first segment."""
    by_number = {p["segment"]: p for p in parts}
    times = sum(p["segment"] == 1 for p in parts)
    return [_message(origin, [by_number[n] for n in sorted(by_number)])] * max(1, times)


def _message(origin: str, parts: list[dict]) -> tuple:
    """The response of one origin id, from its segments ordered by number, each
    once."""
    head = parts[0]
    block = b"".join(p["data"] or b"" for p in parts)
    total = next((p["total"] for p in parts if p["total"] is not None), None)
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or total != len(block):
        out = None, None, None, False
    else:
        out = _decoded(block, head["digest"])
    return (origin, head["page_id"], head["uri"], *out)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload_bytes, payload_digest,
    complete, payload) of every page in the archives; a revisit's payload is
    null, its length and digest are its response's. Without ``payloads`` the
    archives are read once and what remains of the records is pinned."""
    records = archive_records(spark, path, payloads)
    if not payloads:
        records = pinned(records)
    out = read_responses(records, payloads)
    named = out.select(F.col("record_id").alias("refers_to_id"),
                       F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest",
                       "complete").dropDuplicates(["refers_to_id"])
    revisits = records.where("type = 'revisit'").select("page_id", "uri", "refers_to_id", "digest")
    revisits = revisits.join(named, "refers_to_id", "left").select(
        "page_id", "uri", F.lit("revisit").alias("record_type"), "refers_to", "payload_bytes",
        "payload_digest",
        F.coalesce(F.col("complete") & (F.col("digest") == F.col("payload_digest")), F.lit(False))
        .alias("complete"), F.lit(None).cast("binary").alias("payload"))
    responses = out.select("page_id", "uri", F.lit("response").alias("record_type"),
                           F.lit(None).cast("long").alias("refers_to"), "payload_bytes",
                           "payload_digest", "complete", "payload")
    return responses.unionByName(revisits)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``pages``: write archives, read them back."""
    path = scratch_path(spark, "warc")
    try:
        write_archives(read(spark, sf_dir, "pages"), path)
        return pinned(read_archives(spark, path, payloads=False).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    finally:
        remove_path(spark, path)


QUERIES = {"op6_warc": op6_warc}
ORACLE = {"op6_warc": f"""
with p as (
  select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest
  from pages),
f as (select *, min(page_id) over (partition by digest) as first from p)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when n >= {MIN_REVISIT} and page_id <> first then 'revisit' else 'response' end
         as record_type,
       case when n >= {MIN_REVISIT} and page_id <> first then first end as refers_to
from f
"""}

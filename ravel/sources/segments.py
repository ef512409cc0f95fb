"""Crawl segments as a Spark data source (``crawl_segments``).

A task opens its segments as streams, one after the other, and takes slices of
``SLICE`` bytes: they are unpacked, cut into records and handed to Spark in
Arrow batches of about ``BATCH_BYTES``. What a task holds is one slice, one
record and one batch, whatever a segment's size; the payload of a record that
is not wanted is skipped as it passes by.

Reads are planned without session settings: ``plan_reads`` packs segments into
at least the wanted number of tasks (a segment is the smallest unit), longest
first into the emptiest task, so that tasks end together.

``file:`` paths are opened on the executor, ``s3:`` and ``s3a:`` objects by
Arrow's S3 client (unsigned unless ``s3_anonymous`` is false; ``s3_region`` and
``s3_endpoint`` may be set). A segment that is not there when its task opens it
ends like a damaged one (``ok`` false); a store that cannot be reached or
refuses access is an error.
"""

from __future__ import annotations

import heapq
import json
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "segment string, uri string, payload binary, ok boolean"
SLICE = 1 << 20
BATCH_BYTES = 8 << 20
# Bytes a task reads if no number of tasks is asked for, about.
TASK_BYTES = 256 << 20
# Fixed value: the header that holds a record's URI.
URI_HEADER = "WARC-Target-URI"
_KINDS = [pa.string(), pa.string(), pa.binary(), pa.bool_()]


# ------------------------------------------------------------------ files
def filesystem(path: str, options: dict) -> tuple[fs.FileSystem, str]:
    """File system of ``path`` and the path inside it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3", "s3a"):
        anonymous = options.get("s3_anonymous", "true").lower() != "false"
        more = {k: options[f"s3_{o}"] for k, o in
                (("region", "region"), ("endpoint_override", "endpoint")) if options.get(f"s3_{o}")}
        return fs.S3FileSystem(anonymous=anonymous, connect_timeout=10, request_timeout=60,
                               retry_strategy=fs.AwsStandardS3RetryStrategy(max_attempts=3),
                               **more), rest.lstrip("/")
    raise ValueError(f"no reader for {path!r}")


def sizes_of(paths: list[str], options: dict | None = None) -> dict[str, int]:
    """Bytes of each of ``paths`` that exists: one listing per parent folder."""
    by_folder: dict[str, dict[str, list[str]]] = {}
    for p in paths:
        folder, _, name = p.rpartition("/")
        by_folder.setdefault(folder, {}).setdefault(name, []).append(p)
    found = {}
    for folder, names in by_folder.items():
        try:
            system, inside = filesystem(folder + "/", options or {})
            listed = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
        except NotADirectoryError:
            continue
        except OSError as e:
            raise OSError(f"cannot list {folder}: {e}") from e
        for info in listed:
            if info.type == fs.FileType.File:
                for p in names.get(info.base_name, ()):
                    found[p] = info.size
    return found


def plan_reads(sizes: dict[str, int], tasks: int | None = None,
               task_bytes: int = TASK_BYTES, least: int = 1) -> list[list[str]]:
    """Paths of each task: at least ``tasks`` of them (as far as there are
    segments), else about ``task_bytes`` each but at least ``least`` tasks; the
    longest segment first, into the task with the fewest bytes."""
    if not sizes:
        return []
    wanted = tasks or max(least, -(-sum(sizes.values()) // task_bytes))
    bins: list[list[str]] = [[] for _ in range(min(len(sizes), max(1, wanted)))]
    heap = [(0, i) for i in range(len(bins))]
    for path in sorted(sizes, key=lambda p: (-sizes[p], p)):
        held, i = heap[0]
        bins[i].append(path)
        # an empty segment counts, so that none is left without a task
        heapq.heapreplace(heap, (held + max(1, sizes[path]), i))
    return bins


# ---------------------------------------------------------------- records
def unpacked(slices):
    """Pieces of a segment's content from slices of its bytes; gzip members
    follow one another. Raises zlib.error on damage, EOFError if the last
    member is cut."""
    member, first = None, True
    packed = False
    for rest in slices:
        if first:
            packed, first = rest[:2] == b"\x1f\x8b", False
        if not packed:
            yield rest
            continue
        while rest:
            member = member or zlib.decompressobj(31)
            piece = member.decompress(rest, SLICE)
            while piece or member.unconsumed_tail:
                yield piece
                if member.eof:
                    break
                # what did not fit waits in the tail or inside the member
                piece = member.decompress(member.unconsumed_tail, SLICE)
            rest = member.unused_data
            if member.eof:
                member = None
    if member:
        raise EOFError("segment ends inside a member")


class _Pieces:
    """Bytes of a stream of pieces, taken by count or up to a mark."""

    def __init__(self, pieces):
        self._pieces = iter(pieces)
        self._held = bytearray()

    def _fill(self) -> bool:
        for piece in self._pieces:
            if piece:
                self._held += piece
                return True
        return False

    def skip_line_ends(self) -> bool:
        """Pass CR and LF; False at the end of the stream."""
        while True:
            left = self._held.lstrip(b"\r\n")
            if left:
                del self._held[:len(self._held) - len(left)]
                return True
            self._held.clear()
            if not self._fill():
                return False

    def up_to(self, mark: bytes) -> bytes:
        at = 0
        while (end := self._held.find(mark, at)) < 0:
            at = max(0, len(self._held) - len(mark) + 1)
            if not self._fill():
                raise EOFError("segment ends inside a header")
        out = bytes(self._held[:end])
        del self._held[:end + len(mark)]
        return out

    def starts_with(self, mark: bytes) -> bool:
        while len(self._held) < len(mark) and self._fill():
            pass
        return self._held.startswith(mark)

    def take(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._fill():
                raise EOFError("segment ends inside a payload")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out

    def skip(self, n: int) -> None:
        while len(self._held) < n:
            n -= len(self._held)
            self._held.clear()
            if not self._fill():
                raise EOFError("segment ends inside a payload")
        del self._held[:n]


def records_of(pieces, wanted=lambda headers: True):
    """(headers, payload) of each wanted record, cut by Content-Length; header
    names in lower case. Raises ValueError where no record starts, KeyError
    without a length, EOFError inside a record."""
    stream = _Pieces(pieces)
    while stream.skip_line_ends():
        if not stream.starts_with(b"WARC/"):
            raise ValueError("no record where one should start")
        lines = stream.up_to(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        if size < 0:
            raise ValueError("a record of negative length")
        if wanted(headers):
            yield headers, stream.take(size)
        else:
            stream.skip(size)


def _slices(path: str, options: dict):
    system, inside = filesystem(path, options)
    with system.open_input_stream(inside, compression=None) as f:
        while data := f.read(SLICE):
            yield data


def segment_batches(path: str, options: dict):
    """Arrow batches of one segment: a row for each record with a URI (``ok``
    null), and one for its end (``ok``: whether it was read whole)."""
    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)],
            ["segment", "uri", "payload", "ok"])

    rows, size, ok = [], 0, True
    key = URI_HEADER.lower()
    try:
        for headers, payload in records_of(unpacked(_slices(path, options)),
                                           lambda h: h.get(key)):
            rows.append((path, headers[key], payload, None))
            size += len(payload)
            if size > BATCH_BYTES:
                yield batch(rows)
                rows, size = [], 0
    except (zlib.error, EOFError, ValueError, KeyError, FileNotFoundError):
        ok = False          # records read so far are kept
    yield batch([*rows, (path, None, None, ok)])


# ------------------------------------------------------------- data source
class _Task(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self._options = {k: v for k, v in options.items() if k != "plan"}
        self._plan = json.loads(options["plan"])

    def partitions(self):
        return [_Task(paths) for paths in self._plan]

    def read(self, partition):
        for path in partition.paths:
            yield from segment_batches(path, self._options)


class SegmentSource(DataSource):
    """Option ``plan``: JSON list of the paths of each task."""

    @classmethod
    def name(cls) -> str:
        return "crawl_segments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        # options come with names in any case
        return _Reader({str(k).lower(): v for k, v in self.options.items()})


def read_planned(spark: SparkSession, plan: list[list[str]],
                 options: dict | None = None) -> DataFrame:
    """(segment, uri, payload, ok) of the planned segments, a task for each
    list of paths."""
    if not plan:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(SegmentSource)
    return (spark.read.format(SegmentSource.name()).options(**(options or {}))
            .option("plan", json.dumps(plan)).load())

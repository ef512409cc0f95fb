"""Web-crawl text segments (WARC/WET): index, routing, records, counters.

* The segment index is a text file with one URI per line; ``file:`` URIs
  are local/shared-filesystem paths, ``s3://bucket/key`` URIs objects read
  without signing by default, anything else yields nothing and is not counted.
  A line that occurs twice is read twice.
* A segment is a gzip file (one member per record or not) or a plain one, of
  any size. Its task reads it as a stream (``sources.segments``) and cuts it
  into records by their Content-Length, whatever version line they carry and
  whatever their payloads hold.
* A record without a target URI is skipped; a record whose payload is not
  valid UTF-8 is dropped whole and counted (``failed_parses``).
* Failed segments: a missing file, an invalid S3 URI, and a segment that is
  corrupt or ends inside a record (the records before the damage are kept).
  A folder that does not exist makes its segments missing; a store that cannot
  be reached or refuses access is an error of the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ravel.sources.segments import URI_HEADER, plan_reads, read_planned, sizes_of

# The version line our own segments carry, and the URI pattern
# of S3 objects.
VERSION_LINE = "WARC/1.0\r\n"
S3_URI = r"^s3://([^/]+)/(.+)"
__all__ = ["URI_HEADER", "VERSION_LINE", "CrawlRead", "read_index", "read_segments", "route"]


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    """(uri) per non-empty line of the index file(s)."""
    idx = spark.read.text(index_path).select(F.trim("value").alias("uri"))
    return idx.where(F.col("uri") != "")


def route(index: DataFrame) -> DataFrame:
    """(uri, scheme, path): scheme 'file' / 's3' / NULL (ignored); ``path``
    is what Spark reads (NULL for an invalid S3 URI)."""
    u = F.col("uri")
    scheme = F.when(u.startswith("file:"), F.lit("file")).when(u.startswith("s3:/"), F.lit("s3"))
    s3_ok = u.rlike(S3_URI)
    local = F.concat(F.lit("file:"), F.regexp_replace(F.substr(u, F.lit(6)), "^/+", "/"))
    s3 = F.concat(F.lit("s3a://"), F.regexp_extract(u, S3_URI, 1), F.lit("/"),
                  F.regexp_extract(u, S3_URI, 2))
    path = F.when(scheme == "file", local).when((scheme == "s3") & s3_ok, s3)
    return index.select("uri", scheme.alias("scheme"), path.alias("path"))


def read_segments(spark: SparkSession, paths: list[str], partitions: int | None = None,
                  options: dict | None = None) -> DataFrame:
    """(segment, uri, payload, ok) of those of ``paths`` that exist: a row for
    every record with a URI (``ok`` null), and one for the end of each segment
    (``ok``: whether it was read whole). ``partitions``: read with at least as
    many tasks, segments permitting; by default enough for every core."""
    plan = plan_reads(sizes_of(paths, options), partitions,
                      least=spark.sparkContext.defaultParallelism)
    return read_planned(spark, plan, options)


class CrawlRead:
    """Records of an index's segments plus the two counters."""

    def __init__(self, spark: SparkSession, index: DataFrame, partitions: int | None = None,
                 options: dict | None = None):
        # one row per file name: bounded by the number of segments, and what
        # the driver needs to plan the file scan
        lines = (route(index).where(F.col("scheme").isNotNull())
                 .groupBy("path").agg(F.count(F.lit(1)).alias("times")))
        times = {r.path: r.times for r in lines.collect()}
        segments = read_segments(spark, [p for p in times if p], partitions, options)
        weights = lines.where("path is not null").withColumnRenamed("path", "segment")
        rows = segments.join(weights, "segment")
        body = F.col("payload").cast("string")
        named = F.col("ok").isNull() & (F.col("uri") != "")
        self._routed = sum(times.values())
        self._obs = Observation("crawl")
        rows = rows.withColumn("valid", F.is_valid_utf8(body)).observe(
            self._obs,
            F.coalesce(F.sum(F.when(named & ~F.col("valid"), F.col("times"))), F.lit(0))
            .alias("failed_parses"),
            F.coalesce(F.sum(F.when(F.col("ok"), F.col("times"))), F.lit(0)).alias("read"))
        self._records = rows.where(named & F.col("valid")).select(
            "segment", "uri", body.alias("body"),
            F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_time")).drop("_time")

    def valid_records(self) -> DataFrame:
        """(segment, uri, body) of the records with a URI and valid text."""
        return self._records

    def failed_parses(self) -> int:
        """Available after an action ran on ``valid_records()``."""
        return int(self._obs.get.get("failed_parses", 0))

    def failed_segments(self) -> int:
        """Index lines whose segment is invalid, missing, or not read whole.
        Available after an action ran on ``valid_records()``."""
        return self._routed - int(self._obs.get.get("read", 0))

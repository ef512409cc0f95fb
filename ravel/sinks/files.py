"""Writers of the two input file formats the programs read.

Both write line rows with Spark's text writer (one file per task, no
driver involvement); they let the readers run on data derived from any
table, at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.sources.casts import END_MARKER, LATIN1, START_MARKER
from ravel.sources.crawl import URI_HEADER, VERSION_LINE

# The header and footer lines written around cast records.
CAST_HEADER = ["CAST LIST", "=========", "", "Name\t\t\tTitles", START_MARKER]
CAST_FOOTER = ["", END_MARKER, "end of list"]


def write_wet_segments(records: DataFrame, path: str, rows_per_segment: int = 20_000,
                       compression: str = "gzip") -> None:
    """(uri, body) records as segment files of 'conversion' records (version
    line, headers, blank line, payload), at most ``rows_per_segment`` in each.
    ``body`` may hold any bytes; an optional column ``version`` replaces the
    version line, an optional ``missing`` is what Content-Length is over."""
    cols = records.columns
    version = F.col("version") if "version" in cols else F.lit(VERSION_LINE)
    size = F.octet_length("body") + (F.col("missing") if "missing" in cols else F.lit(0))
    head = F.concat(version, F.lit("WARC-Type: conversion\r\n" + URI_HEADER + ": "),
                    F.col("uri"), F.lit("\r\nContent-Length: "), size.cast("string"),
                    F.lit("\r\n\r\n"))
    # The writer adds one CRLF after each row: payload + CRLF CRLF.
    rec = F.concat(head.cast("binary"), F.col("body").cast("binary"), F.lit("\r\n").cast("binary"))
    (records.select(rec.cast("string").alias("value"))
     .write.mode("errorifexists").option("lineSep", "\r\n").option("compression", compression)
     .option("maxRecordsPerFile", rows_per_segment).text(path))


def write_segment_index(spark: SparkSession, segments_path: str, index_path: str) -> None:
    """Index file listing every segment file under ``segments_path``."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
             .load(segments_path).select(F.col("path").alias("value")))
    files.write.mode("append").text(index_path)


def write_cast_list(rows: DataFrame, path: str, files: int, key: str = "actor_id",
                    name: str = "name", title: str = "raw_title",
                    gender: str = "is_male", in_order: bool = False) -> None:
    """Cast-list files in Latin-1 from (key, name, title, gender) rows, in
    folders ``<gender>=true`` and ``<gender>=false`` with ``files`` files each:
    a header ending in the start marker, then per actor a blank line, the name
    line and one TAB-TAB-TAB title line per title, then the footer.

    One pass over ``rows``: actors are spread over files by a hash of the key,
    name lines are rows of their own (one per distinct actor), and each file
    is a sorted part; nothing is gathered per actor or per file. With
    ``in_order`` (whole-number keys) actors are spread by ranges of the key, so
    that the files, by name, have all actors in the order of their keys."""
    spark = rows.sparkSession
    f = F.pmod(F.xxhash64(key), F.lit(files)).cast("int")
    if in_order:
        low, high = rows.agg(F.min(key), F.max(key)).first()
        f = F.floor((F.col(key) - F.lit(low)) * F.lit(files) / F.lit((high or 0) - (low or 0) + 1)) \
            .cast("int")
    # names of one length, so that their order is that of the numbers
    f = F.lpad(f.cast("string"), 9, "0")
    key_type = rows.schema[key].dataType
    g = F.col(gender).cast("boolean")
    titles = rows.select(g.alias("g"), f.alias("f"), F.lit(1).alias("sec"), F.col(key).alias("a"),
                         F.lit(1).alias("o"), F.concat(F.lit("\t\t\t"), F.col(title)).alias("t"))
    names = rows.select(g.alias("g"), f.alias("f"), F.lit(1).alias("sec"), F.col(key).alias("a"),
                        F.lit(0).alias("o"), F.concat(F.lit("\n"), F.col(name)).alias("t")).distinct()
    ids = spark.range(2 * files).select((F.col("id") % 2 == 0).alias("g"),
                                        F.lpad(F.floor(F.col("id") / 2).cast("string"), 9, "0").alias("f"))

    def edge(sec: int, texts: list[str]) -> DataFrame:
        return ids.select("g", "f", F.lit(sec).alias("sec"), F.lit(None).cast(key_type).alias("a"),
                          F.posexplode(F.array(*[F.lit(x) for x in texts])).alias("o", "t"))

    lines = (titles.unionByName(names).unionByName(edge(0, CAST_HEADER))
             .unionByName(edge(2, CAST_FOOTER)))
    latin = F.encode("t", LATIN1).cast("string")
    (lines.repartition("g", "f").sortWithinPartitions("g", "f", "sec", "a", "o", "t")
     .select(F.col("g").alias(gender), "f", latin.alias("line"))
     .write.mode("errorifexists").partitionBy(gender, "f").option("lineSep", "\n").text(path))

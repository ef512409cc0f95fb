"""Phone number -> URLs index over crawl records.

``phone_pairs``: one (num, uri) row per distinct number per record --
a narrow, per-record stage (regex inside the task, no shuffle).

``phone_index``: number -> list of URLs. A URL appears once per record
that holds the number (several records with one URL repeat it). The list
of a number spread over a huge share of the crawl would be one unbounded
row, so every number's URLs are split over consecutive rows of at most
``max_urls_per_row`` (``chunk`` 0..k-1, by URL rank); every URL is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravel.functions.phones import numbers_in


def phone_pairs(records: DataFrame, country: str = "31", digits: int = 9,
                uri_col: str = "uri", body_col: str = "body") -> DataFrame:
    """(num, uri) for every distinct number of every record with a uri."""
    recs = records.where(F.col(uri_col).isNotNull() & (F.col(uri_col) != ""))
    return recs.select(F.explode(numbers_in(F.col(body_col), country, digits)).alias("num"),
                       F.col(uri_col).alias("uri"))


def phone_index(pairs: DataFrame, max_urls_per_row: int = 100_000,
                pinned: bool = False) -> DataFrame:
    """(num, chunk, n_urls, urls array<string>) from (num, uri) pairs.

    Every number's URLs are ranked with the distributed numbering (range
    sort, no single task per number) and chunk k holds ranks k*max+1 ..
    (k+1)*max, so the chunks in order are the whole sorted list. Equal
    (num, uri) rows get a number of their own as last sort key, so that one
    URL repeated many times is spread over several partitions too.
    ``pinned``: the pairs are checkpointed already."""
    from ravel.operators.ordering import number_rows

    rows = pairs.select("num", "uri", F.monotonically_increasing_id().alias("_row"))
    ranked = number_rows(rows, "num", [F.asc("uri"), F.asc("_row")], pinned=pinned)
    chunk = F.floor((F.col("idx") - 1) / max_urls_per_row).cast("int")
    return (ranked.groupBy("num", chunk.alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n_urls"),
                 F.sort_array(F.collect_list("uri")).alias("urls")))


def phone_index_flat(pairs: DataFrame, **kw) -> DataFrame:
    """``phone_index`` with the URL list rendered space-separated."""
    return phone_index(pairs, **kw).select(
        "num", "chunk", "n_urls", F.array_join("urls", " ").alias("urls"))


# Folders of an index that is looked up by number.
BUCKETS = 64


def bucket_of(num, buckets: int = BUCKETS):
    """The folder of a number: a hash of it, the same on any cluster."""
    return F.pmod(F.xxhash64(num), F.lit(buckets)).cast("int")


def write_phone_index(index: DataFrame, path: str, mode: str = "errorifexists",
                      buckets: int | None = None) -> None:
    """Parquet output; the default mode fails when ``path`` exists. With
    ``buckets`` the rows go into as many folders by a hash of the number, each
    sorted by number, so that a lookup opens one of them; a number with very
    many chunks is spread over several files of its folder."""
    if buckets is None:
        index.write.mode(mode).parquet(path)
        return
    rows = index.withColumn("bucket", bucket_of(F.col("num"), buckets))
    (rows.repartition("bucket", F.pmod("chunk", F.lit(16))).sortWithinPartitions("bucket", "num", "chunk")
     .write.mode(mode).partitionBy("bucket").parquet(path))


def lookup_numbers(spark, path: str, numbers: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows of an index written in ``buckets``, of the given numbers: their
    folders' names are known before anything is read, and the sorted files
    skip row groups without them."""
    rows = spark.read.parquet(path)
    if not numbers:
        return rows.where(F.lit(False)).drop("bucket")
    # the buckets are worked out here, so that the scan is planned with them
    folders = {r[0] for r in spark.createDataFrame([(n,) for n in set(numbers)], "num string")
               .select(bucket_of(F.col("num"), buckets)).collect()}
    return (rows.where(F.col("bucket").isin(sorted(folders)) & F.col("num").isin(sorted(set(numbers))))
            .drop("bucket"))


def lookup_join(spark, path: str, numbers: DataFrame, num_col: str = "num",
                buckets: int = BUCKETS) -> DataFrame:
    """Rows of an index written in ``buckets`` whose number is in a table of
    numbers of any size (nulls and repeats do no harm): a semi join on folder
    and number, for which Spark leaves out the folders that hold none of them
    where the table is small, and shuffles or broadcasts by the sizes it finds."""
    wanted = numbers.select(F.col(num_col).alias("num")).where("num is not null").distinct() \
        .withColumn("bucket", bucket_of(F.col("num"), buckets))
    return spark.read.parquet(path).join(wanted, ["bucket", "num"], "left_semi").drop("bucket")

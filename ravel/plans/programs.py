"""The four end-to-end programs: files in, reports / parquet out.

Each is a thin composition of sources, operators and sinks; all work runs
as Spark jobs, the driver only plans and collects counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.operators import graph, phones, words
from ravel.sinks import text as sinks
from ravel.session import ensure_checkpoint_dir
from ravel.sources import casts, crawl


# --------------------------------------------------------------- words
def word_job(spark: SparkSession, input_path, report_path: str) -> None:
    """Word frequencies with ranked predecessors of a text file, written as
    the CRLF report (word:n, then TAB prev:k lines)."""
    lines = spark.read.text(input_path).withColumnRenamed("value", "line")
    sinks.write_predecessor_report(words.word_prev_counts_all(lines), report_path)


# -------------------------------------------------------------- phones
def phone_job(spark: SparkSession, index_path: str, output_dir: str, country: str = "31",
              digits: int = 9, partitions: int | None = None,
              max_urls_per_row: int = 100_000) -> dict[str, int]:
    """Phone number -> URLs index of the crawl segments named in the index,
    written as parquet (fails when ``output_dir`` exists). Returns the
    counters ``failed_segments`` and ``failed_parses``."""
    read = crawl.CrawlRead(spark, crawl.read_index(spark, index_path), partitions)
    ensure_checkpoint_dir(spark)
    # pinned: the segments are read, and the counters filled, in one pass
    pairs = phones.phone_pairs(read.valid_records(), country, digits).checkpoint(eager=True)
    phones.write_phone_index(phones.phone_index(pairs, max_urls_per_row, pinned=True),
                             output_dir)
    return {"failed_segments": read.failed_segments(), "failed_parses": read.failed_parses()}


# --------------------------------------------------------------- graph
def find_actor(people: DataFrame, name: str):
    """Id of the first actor with exactly this name; fails when absent."""
    hit = people.where(F.col("name") == name).select("actor_id").orderBy("actor_id").limit(1).collect()
    if not hit:
        raise ValueError(f"actor not found: {name!r}")
    return hit[0][0]


def degrees_job(spark: SparkSession, male_path, female_path, source_name: str,
                report_path: str, min_year: int = graph.DEFAULT_MIN_YEAR,
                max_hops: int = graph.MAX_HOPS, encoding: str | None = casts.LATIN1):
    """Degrees of separation from ``source_name`` over two cast-list files
    (male, female); writes the summary report. Returns the distances."""
    m = graph.parse_cast_records(casts.read_cast_file(spark, male_path, encoding), True, min_year)
    f = graph.parse_cast_records(casts.read_cast_file(spark, female_path, encoding), False,
                                 min_year)
    ensure_checkpoint_dir(spark)
    people = graph.cast_actor_ids(m, f).checkpoint(eager=True)  # pins the ids
    edges = graph.actor_movie_pairs(people).checkpoint(eager=True)
    source = find_actor(people, source_name)
    dist = graph.degrees(edges, source, max_hops)
    who = people.select("actor_id", "name", "is_male")
    lines = sinks.degree_report_lines(
        graph.degree_summary(dist, who, edges, max_hops),
        graph.degree_histogram(dist, who, max_hops),
        graph.farthest(dist, who, max_hops), max_hops)
    sinks.write_degree_report(lines, report_path)
    return dist

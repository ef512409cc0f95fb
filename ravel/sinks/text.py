"""Text reports, written by executors (no collect to the driver).

A report is a DataFrame of lines plus sort-key columns; a global sort
(range-partitioned, so a word with many lines spreads over tasks) followed
by ``write.text`` lays the part files out in report order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: line terminator of the word report.
CRLF = "\r\n"


def predecessor_report_lines(counts: DataFrame) -> DataFrame:
    """Lines of the word report from the (word, prev, n) counts that include
    the NULL-predecessor bucket.

    Format per word: ``word:n`` then ``\\tprev:k`` for each listed
    predecessor (count descending, name ascending); every line ends with
    CRLF when written. Columns: word_n, word, kind (0 = word line,
    1 = predecessor line), prev_n, prev, line.

    The counts are checkpointed once and read twice: word lines come from
    the per-word totals, predecessor lines from a join of the counts with
    those totals on word (AQE splits a hot word's partition or broadcasts
    small totals), so no word is handled by one task alone.
    """
    from ravel.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint(eager=True)
    totals = counts.groupBy("word").agg(F.sum("n").alias("word_n"))
    head = totals.select(
        "word_n", "word", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("prev_n"),
        F.lit(None).cast("string").alias("prev"),
        F.concat(F.col("word"), F.lit(":"), F.col("word_n").cast("string")).alias("line"))
    prevs = (counts.where(F.col("prev").isNotNull())
             .join(totals, "word")
             .select("word_n", "word", F.lit(1).alias("kind"), F.col("n").alias("prev_n"),
                     "prev",
                     F.concat(F.lit("\t"), F.col("prev"), F.lit(":"),
                              F.col("n").cast("string")).alias("line")))
    return head.unionByName(prevs)


def report_order() -> list[Column]:
    """Words by count, each word's line before its predecessors'."""
    return [F.desc("word_n"), F.asc("word"), F.asc("kind"), F.desc("prev_n"), F.asc("prev")]


def write_predecessor_report(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the word report as text with CRLF line ends, in report order."""
    (predecessor_report_lines(counts).orderBy(*report_order()).select("line")
     .write.mode(mode).option("lineSep", CRLF).text(path))


# The sentences of the degrees report below are fixed values.
def degree_report_lines(summary: DataFrame, histogram: DataFrame, farthest: DataFrame,
                        max_hops: int = 6, last: int | None = None) -> DataFrame:
    """Lines (sec, sub, line) of the degrees summary report: totals, one line
    per distance, reach totals and ratios, then the numbered names at the
    last distance (``max_hops``, or ``last`` where nobody is that far) for each
    gender. Sort by (sec, sub) to write."""
    last = max_hops if last is None else last
    s = summary
    c = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    st = lambda name: F.col(name).cast("string")
    head = s.select(F.posexplode(F.array(
        c("Total number of actors = ", st("n_actors"), ", out of which ", st("n_male"), " (",
          st("pct_male"), "%) are males while ", st("n_female"), " (", st("pct_female"),
          "%) are females."),
        c("Total number of movies = ", st("n_movies")),
        F.lit(""))).alias("sub", "line")).select(F.lit(0).alias("sec"), "sub", "line")
    per = histogram.select(
        F.lit(1).alias("sec"), F.col("distance").alias("sub"),
        c("There are ", st("actors"), " (", F.col("pct_actors"), "%) actors and ",
          st("actresses"), " (", F.col("pct_actresses"), "%) actresses at distance ",
          st("distance")).alias("line"))
    tail = s.select(F.posexplode(F.array(
        F.lit(""),
        c(f"Total number of actors from distance 1 to {max_hops} = ", st("reached"),
          ", ratio = ", st("ratio")),
        c(f"Total number of male actors from distance 1 to {max_hops} = ", st("reached_male"),
          ", ratio = ", st("ratio_male")),
        c(f"Total number of female actors (actresses) from distance 1 to {max_hops} = ",
          st("reached_female"), ", ratio = ", st("ratio_female")),
        F.lit(""),
        F.lit(f"List of male actors at distance {last}:"))).alias("sub", "line")) \
        .select(F.lit(2).alias("sec"), "sub", "line")
    names = farthest.select(
        F.when(F.col("is_male"), F.lit(3)).otherwise(F.lit(5)).alias("sec"),
        F.col("idx").alias("sub"), c(st("idx"), ". ", F.col("name")).alias("line"))
    mid = s.select(F.posexplode(F.array(
        F.lit(""), F.lit(f"List of female actors (actresses) at distance {last}:")))
        .alias("sub", "line")).select(F.lit(4).alias("sec"), "sub", "line")
    return (head.unionByName(per).unionByName(tail).unionByName(names).unionByName(mid)
            .select(F.col("sec").cast("int"), F.col("sub").cast("bigint"), "line"))


def write_degree_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.orderBy("sec", "sub").select("line").write.mode(mode).option("lineSep", "\n").text(path)

"""Word frequencies with ranked predecessors.

Per line: a sentinel is put in front, the line is lower-cased and cut at
'--'; inside each segment every token ``a`` is paired with the token ``b``
before it. The word is ``a`` without ASCII punctuation (but '-'), after
dropping its first character when that is not a letter. The predecessor
``b`` is valid only when ``a`` starts with a letter and ``b`` ends with
one; invalid predecessors count towards the word total but are not listed.

Plan shape: one narrow stage (split/explode/zip, no shuffle), then a
partial+final aggregation -- on word for the totals, on (word, prev) for the
predecessors -- so map-side combine bounds what a frequent word sends through
the shuffle. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravel.functions.text import (adjacent_pairs, ends_with_letter, sentinel_segments,
                                  space_tokens, starts_with_letter, strip_punct,
                                  drop_first_char)


def word_pairs(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, prev) for every adjacent token pair; ``prev`` NULL when invalid."""
    pairs = (lines
             .select(F.explode(sentinel_segments(F.col(line_col))).alias("seg"))
             .select(space_tokens("seg").alias("t"))  # tokens computed once per segment
             .select(F.explode(adjacent_pairs("t")).alias("p")))
    a, b = F.col("p.a"), F.col("p.b")
    lead = starts_with_letter(a)
    word = F.when(lead, strip_punct(a)).otherwise(strip_punct(drop_first_char(a)))
    prev = F.when(lead & ends_with_letter(b), strip_punct(b))
    return pairs.select(word.alias("word"), prev.alias("prev"))


def word_prev_counts_all(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, prev, n) including the NULL (invalid) predecessor bucket."""
    return (word_pairs(lines, line_col)
            .groupBy("word", "prev")
            .agg(F.count(F.lit(1)).alias("n")))


def word_totals(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, n): occurrences of each word as the second token of a pair.
    One aggregation by word; the predecessors are not computed."""
    return word_pairs(lines, line_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_prev_counts(lines: DataFrame, line_col: str = "line",
                     counts: DataFrame | None = None) -> DataFrame:
    """(word, prev, n) for valid predecessors only -- the flat form of the
    nested lists, and the one to store at scale (one row per pair)."""
    counts = counts if counts is not None else word_prev_counts_all(lines, line_col)
    return counts.where(F.col("prev").isNotNull())


def predecessor_lists(lines: DataFrame, line_col: str = "line",
                      max_prevs_per_row: int = 100_000) -> DataFrame:
    """The nested result: (word, chunk, n, prevs array<struct<prev, n>>),
    prevs by count descending then name ascending.

    A list holds one entry per *distinct* predecessor. Every word's
    predecessors are ranked with the distributed numbering (range sort, no
    single task per word) and chunk k holds ranks k*max+1 .. (k+1)*max, so no
    row is longer than ``max_prevs_per_row`` and concatenating the chunks in
    order gives the whole list."""
    from ravel.operators.ordering import number_rows
    from ravel.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(lines.sparkSession)
    counts = word_prev_counts_all(lines, line_col).checkpoint(eager=True)  # read twice
    totals = counts.groupBy("word").agg(F.sum("n").alias("n"))
    ranked = number_rows(counts.where(F.col("prev").isNotNull()), "word",
                         [F.desc("n"), F.asc("prev")], pinned=True)
    entry = F.struct("idx", "prev", "n")
    lists = (ranked.groupBy("word", F.floor((F.col("idx") - 1) / max_prevs_per_row)
                            .cast("int").alias("chunk"))
             .agg(F.array_sort(F.collect_list(entry)).alias("s")))
    # Words whose every predecessor is invalid still get their (empty) row.
    return totals.join(lists, "word", "left").select(
        "word", F.coalesce("chunk", F.lit(0)).alias("chunk"), "n",
        F.coalesce(F.transform("s", lambda e: F.struct(e["prev"].alias("prev"), e["n"].alias("n"))),
                   F.array().cast("array<struct<prev:string,n:bigint>>")).alias("prevs"))


def predecessor_lists_flat(lines: DataFrame, line_col: str = "line", **kw) -> DataFrame:
    """``predecessor_lists`` with the list rendered as 'prev:n,prev:n,..'."""
    return predecessor_lists(lines, line_col, **kw).select(
        "word", "chunk", "n",
        F.array_join(F.transform("prevs", lambda e: F.concat(
            e["prev"], F.lit(":"), e["n"].cast("string"))), ",").alias("prevs"))

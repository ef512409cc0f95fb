"""Trending hashtags of retweeted posts over sliding event-time windows.

Per window: every retweeted original (``id``) counts its retweets; its
hashtags (or the tag 'None') each get the number of distinct originals
carrying them in that window (0 for 'None'); each (original, tag) row is
reported with tag count, tag, author, retweets + 1 and text, sorted by tag
count, then tweet count (both descending), then tag, then id.

Plan shape. Rows are first aggregated per (slide-sized pane, id) -- one
row per retweet becomes one row per pane and original, combined map-side
-- and only those partials are copied to the window/slide windows a pane
belongs to, then summed per (window, id). Tag counts are a second partial
aggregation; the join back is on (window, tag), where AQE splits a hot
tag. The same functions run inside ``foreachBatch`` of the stream.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravel.functions.text import NO_TAG, clean_for_language, hashtags_or_none, language_override
from ravel.functions.time import utc_instant
from ravel.operators.ordering import place_in_run

# Languages that pass the filter, and the console report's
# limits (rows per run of one tag, rows overall).
LANGUAGES = ("en", "no")
PER_RUN = 3
TOTAL = 10

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", duration)
    if not m:
        raise ValueError(f"duration like '120 seconds' expected: {duration!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def flat_statuses(statuses: DataFrame) -> DataFrame:
    """Statuses with the original's fields at the top: those of a nested
    ``retweeted`` struct (id, username, text) where there is one, a null
    struct meaning no retweet; the status's own text becomes ``status``."""
    if "retweeted" not in statuses.columns:
        return statuses
    own = [c for c in statuses.columns if c not in ("retweeted", "id", "username", "text")]
    if "text" in statuses.columns and "status" not in own:
        own.append(F.col("text").alias("status"))
    return statuses.where("retweeted is not null").select(
        *own, "retweeted.id", "retweeted.username", "retweeted.text")


def retweets(statuses: DataFrame, languages=LANGUAGES, status_text: str | None = None) -> DataFrame:
    """Retweets in the wanted languages: (ts, id, username, text) of the
    retweeted original, from flat or nested statuses. With ``status_text`` (the retweet's own text) the
    'lt' -> 'ja'/'ko' script override is applied before the test."""
    statuses = flat_statuses(statuses)
    lang = F.col("lang")
    if status_text:
        lang = language_override(lang, clean_for_language(F.col(status_text)))
    return (statuses.where(F.col("is_retweet") & lang.isin(*languages))
            .select(utc_instant(statuses, "ts").alias("ts"), "id", "username", "text"))


def _info() -> Column:
    return F.struct("username", "text")


def windowed_counts(rt: DataFrame, window: str, slide: str) -> DataFrame:
    """(window struct<start,end>, id, n, username, text): retweets per
    original per sliding window, via pane partials."""
    win_s, slide_s = seconds(window), seconds(slide)
    if win_s % slide_s:
        return windowed_counts_direct(rt, window, slide)
    k = win_s // slide_s
    step = slide_s * 1_000_000
    pane = F.floor(F.unix_micros("ts") / F.lit(step)) * F.lit(step)
    # Over the raw rows only a hash aggregation with fixed-width buffers:
    # author and text (a function of the original) are grouping keys, so
    # no string sits in an aggregation buffer. The earliest retweet's info
    # is picked per window from these partials.
    panes = (rt.groupBy(pane.alias("pane"), "id", "username", "text")
             .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"))
             .select("pane", "id", "n", _info().alias("i"), "t0"))
    starts = panes.select(
        F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("j"), "pane", "id", "n", "i", "t0")
    starts = starts.withColumn("start", F.col("pane") - F.col("j") * F.lit(step))
    agg = (starts.groupBy("start", "id")
           .agg(F.sum("n").alias("n"), F.min_by("i", F.col("t0")).alias("i")))
    start_ts = F.timestamp_micros("start")
    return agg.select(
        F.struct(start_ts.alias("start"),
                 (start_ts + F.expr(f"INTERVAL {win_s} SECONDS")).alias("end")).alias("window"),
        "id", "n", F.col("i.username").alias("username"), F.col("i.text").alias("text"))


def windowed_counts_direct(rt: DataFrame, window: str, slide: str) -> DataFrame:
    """Same result with Spark's ``window()`` (every row copied to each of
    its windows before the partial aggregation), for windows that are no
    multiple of their slide."""
    return (rt.groupBy(F.window("ts", window, slide).alias("window"), "id")
            .agg(F.count(F.lit(1)).alias("n"), F.min_by(_info(), F.col("ts")).alias("i"))
            .select("window", "id", "n", F.col("i.username").alias("username"),
                    F.col("i.text").alias("text")))


def tweet_tags(wc: DataFrame) -> DataFrame:
    """One row per (window, id, tag): distinct tags of the original's text,
    or 'None'."""
    return wc.select("window", "id", "n", "username", "text",
                     F.explode(hashtags_or_none(F.col("text"))).alias("tag"))


def tag_counts(tags: DataFrame) -> DataFrame:
    """(window, tag, tag_count): distinct originals per tag; 0 for 'None'."""
    # count("n"), never NULL: keeps ``n`` in this branch, so both sides of
    # the join in ``trending_rows`` stay the same plan and share one shuffle.
    return (tags.groupBy("window", "tag").agg(F.count("n").alias("c"))
            .select("window", "tag",
                    F.when(F.col("tag") == NO_TAG, F.lit(0)).otherwise(F.col("c"))
                    .cast("int").alias("tag_count")))


def trending_rows(wc: DataFrame) -> DataFrame:
    """(window, id, tag_count, tag, username, tweet_count, text). Untagged
    posts, which may be most of a window, count 0 and need no join."""
    tags = tweet_tags(wc)
    tagged, untagged = tags.where(F.col("tag") != NO_TAG), tags.where(F.col("tag") == NO_TAG)
    rows = tagged.join(tag_counts(tagged), ["window", "tag"]).unionByName(
        untagged.withColumn("tag_count", F.lit(0)))
    return rows.select("window", "id", "tag_count", "tag", "username",
                       (F.col("n") + 1).cast("int").alias("tweet_count"), "text")


def trending(statuses: DataFrame, window: str = "120 seconds", slide: str = "2 seconds",
             languages=LANGUAGES, start=None) -> DataFrame:
    """Trending rows of a batch of statuses. ``start`` (a timestamp) drops
    windows that open before it -- the stream's warm-up."""
    wc = windowed_counts(retweets(statuses, languages), window, slide)
    if start is not None:
        wc = wc.where(F.col("window.start") >= F.lit(start).cast("timestamp"))
    return trending_rows(wc)


def report_order() -> list[Column]:
    return [F.desc("tag_count"), F.desc("tweet_count"), F.asc("tag"), F.asc("id")]


def run_limited_top(rows: DataFrame, per_run: int = PER_RUN, total: int = TOTAL,
                    by: str = "window", partitions: int | None = None) -> DataFrame:
    """Top rows per ``by`` group in report order, where a run -- consecutive
    rows with one tag -- shows at most ``per_run`` rows and the group at
    most ``total``; a tag can come back in a later run. Adds ``rank``.

    Three exact reductions come first, each a rank filter that Spark also
    applies before its shuffle (so a burst window is cut down map-side):
    rows with equal (tag_count, tweet_count, tag) are consecutive and in
    one run, so only the first ``per_run`` of each such block can show;
    inside one (tag_count, tweet_count) sub-level every tag has one block
    and each block after the first starts a new run, so only the first
    ``total`` tags of a sub-level can show; a tag has one tag count per
    group, so runs never span tag-count levels and every level reached
    shows a row -- only the top ``total`` levels can show.

    The runs of what is left are found per slice of a range-partitioned sort
    and stitched at slice borders (``ordering.place_in_run``), and a slice shows
    at most its first ``total`` rows of a group, so no group is one task's."""
    block = Window.partitionBy(by, "tag_count", "tweet_count", "tag").orderBy("id")
    r = rows.withColumn("_b", F.row_number().over(block)).where(F.col("_b") <= per_run)
    sub = Window.partitionBy(by, "tag_count", "tweet_count").orderBy("tag")
    r = r.withColumn("_s", F.dense_rank().over(sub)).where(F.col("_s") <= total)
    level = Window.partitionBy(by).orderBy(F.desc("tag_count"))
    r = r.withColumn("_l", F.dense_rank().over(level)).where(F.col("_l") <= total)
    r = r.drop("_l", "_s", "_b")
    r = place_in_run(r, by, "tag", report_order(), out="_k", partitions=partitions)
    r = r.where(F.col("_k") <= per_run)
    inside = Window.partitionBy("_pid", by).orderBy("_pos")
    r = r.withColumn("_i", F.row_number().over(inside)).where(F.col("_i") <= total)
    w = Window.partitionBy(by).orderBy("_pid", "_pos")
    r = r.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= total)
    return r.drop("_k", "_i", "_pid", "_pos")


def report_line(rank: Column) -> Column:
    """'<rank>. <tag_count> <tag>:<username>:<tweet_count> <text>'."""
    return F.concat(rank.cast("string"), F.lit(". "), F.col("tag_count").cast("string"),
                    F.lit(" "), F.col("tag"), F.lit(":"), F.col("username"), F.lit(":"),
                    F.col("tweet_count").cast("string"), F.lit(" "), F.col("text"))

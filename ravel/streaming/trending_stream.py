"""Trending hashtags as a Structured Streaming query.

One stateful operator: the windowed retweet count per (window, id) with a
watermark, in append mode, so each window is emitted once, complete, when
the watermark passes its end (all ids of a window leave in the same
micro-batch). The rest of the program -- tags, tag counts, join, ranking --
is batch logic on the emitted windows inside ``foreachBatch``, always keyed
by window because one batch may close many windows. Outputs are written
per epoch and committed by a manifest (``streaming.outputs``): a replayed or
half-written epoch is never read twice or in part; the checkpoint location
holds offsets and state, from which a stopped query goes on.
"""

from __future__ import annotations

import math
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ravel.functions.text import NO_TAG, hashtags_or_none
from ravel.operators import trending as tr
from ravel.operators.ordering import number_rows, slices_of
from ravel.session import remove_path, scratch_path
from ravel.sources.tables import table, tweets_from_events
from ravel.streaming.outputs import Outputs


def windowed_stream(statuses: DataFrame, window: str, slide: str, watermark: str,
                    languages=tr.LANGUAGES) -> DataFrame:
    """Streaming (window, id, username, text, n, t0) in append mode.

    Two chained event-time aggregations: retweets are first counted per pane
    (one state update per retweet), then each closed pane's partial is added
    to the windows it belongs to (``window_time`` of the pane lies in exactly
    those), so a burst of retweets of one post within a pane costs one update
    per window instead of one per retweet. A pane is as long as the greatest
    common divisor of window and slide, so it never crosses a window's edge.
    Author and text (a function of the original) are grouping keys, so the
    state holds fixed-width values; ``settle`` reduces an emitted batch to
    one row per (window, id)."""
    rt = tr.retweets(statuses, languages).withWatermark("ts", watermark)
    keys = ["id", "username", "text"]
    pane = f"{math.gcd(tr.seconds(window), tr.seconds(slide))} seconds"
    part = (rt.groupBy(F.window("ts", pane).alias("pane"), *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0")))
    return (part.groupBy(F.window(F.window_time("pane"), window, slide).alias("window"), *keys)
            .agg(F.sum("n").alias("n"), F.min("t0").alias("t0")))


# Shares of the untagged posts of a window in the streaming join.
SALTS = 16


def joined_stream(statuses: DataFrame, window: str, slide: str, watermark: str,
                  languages=tr.LANGUAGES) -> DataFrame:
    """Streaming (window, id, tag_count, tag, username, tweet_count, text), the
    whole program as one plan in append mode: chained aggregations count
    retweets per pane, per window, per (window, id) and then tags per window,
    and a stream-stream join on (window, tag) puts each post beside its tag's
    count. Every stage carries the window as its event time, so one watermark
    closes a window in all of them and clears their states.

    Untagged posts need no count, only a partner: they are joined in
    ``SALTS`` shares, so that a window full of them is not one key."""
    settled = (windowed_stream(statuses, window, slide, watermark, languages)
               .groupBy("window", "id")
               .agg(F.sum("n").alias("n"),
                    F.min_by(F.struct("username", "text"), "t0").alias("i")))
    tags = settled.select("window", "id", "n", "i.username", "i.text",
                          F.explode(hashtags_or_none(F.col("i.text"))).alias("tag"))
    share = F.when(F.col("tag") == NO_TAG, F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0)
    tags = tags.withColumn("share", share)
    counts = tags.groupBy("window", "tag", "share").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select(F.col("window").alias("c_window"), F.col("tag").alias("c_tag"),
                           F.col("share").alias("c_share"), "c")
    rows = tags.join(counts, F.expr("window = c_window and tag = c_tag and share = c_share"))
    return rows.select(
        "window", "id", F.when(F.col("tag") == NO_TAG, F.lit(0)).otherwise(F.col("c")).cast("int")
        .alias("tag_count"), "tag", "username",
        (F.col("n") + 1).cast("int").alias("tweet_count"), "text")


def start_joined(statuses: DataFrame, out_path: str, checkpoint_location: str,
                 window: str = "120 seconds", slide: str = "2 seconds",
                 watermark: str = "10 seconds", processing_time: str | None = "2 seconds",
                 available_now: bool = False) -> StreamingQuery:
    """Start ``joined_stream`` into parquet files under ``out_path``, whose
    log of committed files Spark's readers follow."""
    rows = joined_stream(statuses, window, slide, watermark)
    w = (rows.withColumn("window", F.struct(F.col("window.start").alias("start"),
                                            F.col("window.end").alias("end")))
         .writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint_location))
    return _triggered(w, processing_time, available_now).start()


def _triggered(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer


def settle(batch: DataFrame) -> DataFrame:
    """(window, id, n, username, text) of an emitted batch: counts summed
    per (window, id), author and text of the earliest retweet."""
    win = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"))
    return (batch.select(win.alias("window"), "id", "n", "t0",
                         F.struct("username", "text").alias("i"))
            .groupBy("window", "id")
            .agg(F.sum("n").alias("n"), F.min_by("i", F.col("t0")).alias("i"))
            .select("window", "id", "n", F.col("i.username").alias("username"),
                    F.col("i.text").alias("text")))


# The report's rule lines.
RULE = "=" * 38
ROW_RULE = "-" * 35


def log_lines(rows: DataFrame) -> DataFrame:
    """The per-window log: a header with the window's end time (HH:mm:ss),
    then every row numbered in report order, each followed by a rule line.
    Columns (window, k, line); sort by them to write. Numbering is the
    distributed one (range sort, per-partition offsets), so a burst window
    is not numbered by one task; the first row of a window also carries
    the header, so the log is one pass over the numbered rows."""
    n = number_rows(rows, "window", tr.report_order(), out="i", partitions=slices_of(rows))
    head = [F.lit(""), F.lit(RULE),
            F.concat(F.lit("Time: "), F.date_format("window.end", "HH:mm:ss")), F.lit(RULE)]
    body = [tr.report_line(F.col("i")), F.lit(ROW_RULE)]
    lines = F.when(F.col("i") == 1, F.array(*head, *body)).otherwise(F.array(*body))
    first = F.when(F.col("i") == 1, F.lit(0)).otherwise(F.lit(len(head)) + (F.col("i") - 1) * 2)
    return n.select("window", first.alias("k0"), F.posexplode(lines).alias("j", "line")) \
        .select("window", (F.col("k0") + F.col("j")).alias("k"), "line")


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive execution for what is derived from an emitted batch. A stream
    runs with it off, as its state has a fixed number of partitions; the batch
    has been planned by then, and its outputs need tasks by their size only."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _writer(out_path: str, start, per_run: int, total: int, print_top: bool):
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write_epoch(batch, epoch_id)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        out = Outputs(batch.sparkSession, out_path)
        if out.committed(epoch_id):
            # replayed after its outputs were committed: only the state moves on
            batch.write.format("noop").mode("overwrite").save()
            return
        # ``settle`` also gives a fresh window column: the emitted one carries
        # event-time metadata that the self-join of tags and tag counts
        # cannot resolve. What is emitted is written first and read from there:
        # tasks of a plan that holds the state's operators send the metrics of
        # every state partition to the driver, each of them.
        spark = batch.sparkSession
        settled = settle(batch)
        if start is not None:  # warm-up: no window that opened before the stream
            settled = settled.where(F.col("window.start") >= F.lit(start).cast("timestamp"))
        path = scratch_path(spark, "settled")
        rows = None
        try:
            settled.write.parquet(path)
            wc = spark.read.schema(settled.schema).parquet(path)
            if wc.isEmpty():  # this tick closed no window
                return
            rows = tr.trending_rows(wc).persist()  # read by all three outputs
            rows.write.mode("overwrite").parquet(out.folder("rows", epoch_id))
            slices = slices_of(rows)
            (log_lines(rows).repartitionByRange(slices, "window", "k")
             .sortWithinPartitions("window", "k").select("line")
             .write.mode("overwrite").text(out.folder("log", epoch_id)))
            top = tr.run_limited_top(rows, per_run, total, partitions=slices)
            top.write.mode("overwrite").parquet(out.folder("top", epoch_id))
            out.commit(epoch_id)
            if print_top:  # at most ``total`` lines per window closed in this tick
                for r in top.orderBy("window", "rank").select(
                        F.date_format("window.end", "HH:mm:ss").alias("t"),
                        tr.report_line(F.col("rank")).alias("line")).collect():
                    print(f"[{r.t}] {r.line}")
        finally:
            if rows is not None:
                rows.unpersist()
            remove_path(spark, path)
    return per_batch


# Settings of a stream with large state: kept in RocksDB on the executors, its
# changes uploaded with each epoch.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# State partitions of such a stream at most. Every task over RocksDB state sends
# a metric of each state partition to the driver, so what it receives grows with
# the square of their number; the state is on disk, and partitions may be large.
STATE_PARTITIONS = 64


def stream_session(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A session of the same application with the settings of ``spark`` and
    its own ``settings`` (by default RocksDB state in at most
    ``STATE_PARTITIONS`` partitions); ``spark`` keeps its own."""
    own = spark.newSession()
    now = {r.key: r.value for r in own.sql("SET").collect()}
    for r in spark.sql("SET").collect():
        if now.get(r.key) != r.value and own.conf.isModifiable(r.key):
            own.conf.set(r.key, r.value)
    if settings is None:
        key = "spark.sql.shuffle.partitions"
        settings = ROCKSDB | {key: str(min(int(spark.conf.get(key)), STATE_PARTITIONS))}
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def start_trending(statuses: DataFrame, out_path: str, checkpoint_location: str,
                   window: str = "120 seconds", slide: str = "2 seconds",
                   watermark: str = "10 seconds", start=None,
                   processing_time: str | None = "2 seconds", available_now: bool = False,
                   per_run: int = tr.PER_RUN, total: int = tr.TOTAL,
                   print_top: bool = False) -> StreamingQuery:
    """Start the trending stream over a streaming ``statuses`` frame.

    ``out_path/rows`` gets every trending row of each closed window,
    ``out_path/log`` the numbered text log, ``out_path/top`` the
    run-limited top rows (the console report, printed with ``print_top``)."""
    wc = windowed_stream(statuses, window, slide, watermark)
    w = (wc.writeStream.outputMode("append")
         .foreachBatch(_writer(out_path, start, per_run, total, print_top))
         .option("checkpointLocation", checkpoint_location))
    return _triggered(w, processing_time, available_now).start()


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, one file or a folder of part files, as a file
    stream (schema from the table). No limit of files per trigger: files come
    in any order of their event times, and rows of one micro-batch are never
    late for each other."""
    # as a pattern: a file stream takes a plain path for a folder's
    path = f"{sf_dir.rstrip('/')}/{{events.parquet}}"
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)


def write_in_time_order(rows: DataFrame, path: str, parts: int, time_col: str = "ts",
                        files: int = 1) -> None:
    """``rows`` as ``parts`` groups of files that follow one another in event
    time and in the order a file stream takes them. Every group has ``files``
    files, however many tasks read ``rows`` (a task without rows writes none,
    so empty files fill a group up): a stream with that ``maxFilesPerTrigger``
    takes one group a tick, and no tick's rows are late for its others."""
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    cuts = rows.agg(F.percentile_approx(at, [i / parts for i in range(1, parts)])).first()[0] or []
    edges = [None, *cuts, None]
    for k, (low, high) in enumerate(zip(edges, edges[1:]), 1):
        part = rows.where(F.lit(True) if low is None else at > low)
        part = part.where(F.lit(True) if high is None else at <= high)
        part.repartition(files).write.mode("append").parquet(path)
        written = sum(f.getPath().getName().startswith("part-") for f in fs.listStatus(folder))
        for _ in range(k * files - written):
            rows.limit(0).write.mode("append").parquet(path)


def late_rows(query: StreamingQuery) -> int:
    """Rows the query's state dropped because they came after the watermark."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress
               for op in p.stateOperators)


def run_to_end(spark: SparkSession, sf_dir: str, out_path: str, checkpoint_location: str,
               window: str, slide: str, watermark: str, start=None) -> int:
    """Process everything available (availableNow), however long it takes, and
    stop; returns the number of rows dropped as late."""
    q = start_trending(tweets_from_events(events_stream(spark, sf_dir)), out_path,
                       checkpoint_location, window, slide, watermark, start=start,
                       available_now=True)
    return finish(q)


def finish(query: StreamingQuery) -> int:
    """Wait for a query that ends by itself, raise what it raised, and return
    the number of rows dropped as late."""
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return late_rows(query)


def stop_after(query: StreamingQuery, epochs: int, patience: float = 600.0) -> int:
    """Stop a running query once it has committed ``epochs`` epochs; returns
    how many it had. Raises what the query raised."""
    deadline = time.monotonic() + patience
    done = 0
    while query.isActive and done < epochs and time.monotonic() < deadline:
        query.awaitTermination(0.2)
        last = query.lastProgress
        done = last.batchId + 1 if last else 0
    query.stop()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return done


def forget_last_commit(spark: SparkSession, checkpoint_location: str) -> int | None:
    """Remove the newest entry of a stopped query's commit log, as if it had
    ended between its outputs and that entry: the epoch is replayed when the
    query starts again. Returns the epoch."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{checkpoint_location.rstrip('/')}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    epochs = [int(n) for n in names if n.isdigit()]
    if not epochs:
        return None
    for name in (str(max(epochs)), f".{max(epochs)}.crc"):
        fs.delete(path(folder, name), False)
    return max(epochs)

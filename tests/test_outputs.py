"""Committed stream outputs, resuming, and the streaming join on small data."""

import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ravel.operators import trending as tr
from ravel.streaming import outputs, trending_stream as ts

T0 = datetime(2024, 1, 1)
SCHEMA = ("ts timestamp, is_retweet boolean, lang string, id long, username string, text string")


def statuses(n=240, step=10):
    return [(T0 + timedelta(seconds=i * step), i % 7 != 3, ("en", "no", "fr")[i % 3], i % 11,
             f"u{i % 11}", "plain" if i % 11 % 3 == 0 else f"hi #t{i % 11 % 4} #x #2017")
            for i in range(n)]


def closed(df, last, watermark=10, window="120 seconds", slide="40 seconds"):
    rows = tr.trending(df, window, slide)
    return rows.where(F.col("window.end") <= F.lit(last - timedelta(seconds=watermark)))


def last_retweet(rows):
    return max(r[0] for r in rows if r[1] and r[2] in ("en", "no"))


def same(a, b):
    cols = [F.col("window.start").alias("s"), "id", "tag_count", "tag", "username",
            "tweet_count", "text"]
    return sorted(map(tuple, a.select(*cols).collect())) == \
        sorted(map(tuple, b.select(*cols).collect()))


def test_manifest(spark, tmp, monkeypatch):
    monkeypatch.setattr(outputs, "FOLD", 5)
    out = outputs.Outputs(spark, f"{tmp}/o")
    assert out.epochs() == set() and not out.committed(0)
    for n in range(14):
        spark.range(n, n + 2).write.parquet(out.folder("rows", n))
        assert not out.committed(n)
        if n != 9:                      # epoch 9 ends before its commit
            out.commit(n)
    again = outputs.Outputs(spark, f"{tmp}/o")
    assert again.epochs() == set(range(14)) - {9}
    assert len(again._names()) <= 6 and again.committed(0) and not again.committed(9)
    got = outputs.read_committed(spark, f"{tmp}/o", "rows")
    assert sorted(r.id for r in got.collect()) == sorted(
        x for n in range(14) if n != 9 for x in (n, n + 1))
    again.commit(9)
    assert outputs.read_committed(spark, f"{tmp}/o", "rows").count() == 28


def test_failed_epoch_is_replayed_and_half_of_it_never_read(spark, tmp, monkeypatch):
    """The writer fails after its rows are written, then once more after the
    manifest has the epoch; the query goes on and nothing is lost or twice."""
    rows = statuses()
    df = spark.createDataFrame(rows, SCHEMA)
    ts.write_in_time_order(df, f"{tmp}/in", 3)

    def start():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
            .parquet(f"{tmp}/in")
        return ts.start_trending(stream, f"{tmp}/out", f"{tmp}/ck", "120 seconds", "40 seconds",
                                 "10 seconds", available_now=True)

    lines, commit, left = ts.log_lines, outputs.Outputs.commit, [1, 1]

    def broken_lines(rows):
        if left[0]:
            left[0] = 0
            raise RuntimeError("lost in the middle")
        return lines(rows)

    def broken_commit(self, epoch):
        commit(self, epoch)
        if left[1]:
            left[1] = 0
            raise RuntimeError("lost after the manifest")

    monkeypatch.setattr(ts, "log_lines", broken_lines)
    monkeypatch.setattr(outputs.Outputs, "commit", broken_commit)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            ts.finish(start())
        manifest = outputs.Outputs(spark, f"{tmp}/out").epochs()
    assert left == [0, 0] and manifest
    ts.finish(start())
    got = outputs.read_committed(spark, f"{tmp}/out", "rows")
    assert same(got, closed(df, last_retweet(rows)))
    log = outputs.read_committed(spark, f"{tmp}/out", "log", "text")
    heads = got.select("window").distinct().count()
    assert log.count() == 4 * heads + 2 * got.count()
    assert got.sparkSession.read.parquet(f"{tmp}/in").count() == len(rows)


def test_stopped_stream_goes_on(spark, tmp):
    """Stopped after a tick of the timed trigger, its last commit lost, resumed
    with RocksDB state; the caller's session keeps its settings."""
    rows = statuses()
    df = spark.createDataFrame(rows, SCHEMA)
    ts.write_in_time_order(df, f"{tmp}/in", 3)
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    own = ts.stream_session(spark)
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before
    assert own.conf.get("spark.sql.shuffle.partitions") == \
        spark.conf.get("spark.sql.shuffle.partitions")
    assert "RocksDB" in own.conf.get("spark.sql.streaming.stateStore.providerClass")

    def start(**how):
        stream = own.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
            .parquet(f"{tmp}/in")
        return ts.start_trending(stream, f"{tmp}/out", f"{tmp}/ck", "120 seconds", "40 seconds",
                                 "10 seconds", **how)

    assert ts.stop_after(start(processing_time="1 second"), 1) >= 1
    assert ts.forget_last_commit(spark, f"{tmp}/ck") is not None
    assert ts.finish(start(available_now=True)) == 0
    got = outputs.read_committed(spark, f"{tmp}/out", "rows")
    assert same(got, closed(df, last_retweet(rows)))


def test_tick_takes_a_whole_group_whatever_the_tasks(spark, tmp):
    """Rows of one group lie in many tasks, each over the group's whole time; the
    groups have as many files as asked for, so no tick makes rows late."""
    rows = statuses()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for files in (1, 4):
        ts.write_in_time_order(df, f"{tmp}/in{files}", 3, files=files)
        assert len(glob.glob(f"{tmp}/in{files}/part-*")) == 3 * files
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files) \
            .parquet(f"{tmp}/in{files}")
        q = ts.start_trending(stream, f"{tmp}/out{files}", f"{tmp}/ck{files}", "120 seconds",
                              "40 seconds", "10 seconds", available_now=True)
        assert ts.finish(q) == 0
        assert len({p.batchId for p in q.recentProgress if p.numInputRows}) == 3
        got = outputs.read_committed(spark, f"{tmp}/out{files}", "rows")
        assert same(got, closed(df, last_retweet(rows)))


def test_group_without_rows_has_its_files(spark, tmp):
    df = spark.createDataFrame([(T0, k) for k in range(6)], "ts timestamp, k int")
    ts.write_in_time_order(df, f"{tmp}/in", 3, files=2)
    assert len(glob.glob(f"{tmp}/in/part-*")) == 6
    assert spark.read.parquet(f"{tmp}/in").count() == 6


def test_state_partitions_are_bounded(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "600")
        assert int(ts.stream_session(spark).conf.get(key)) == ts.STATE_PARTITIONS
        assert ts.stream_session(spark, {}).conf.get(key) == "600" == spark.conf.get(key)
    finally:
        spark.conf.set(key, before)


def test_joined_plan_equals_batch_and_clears_its_state(spark, tmp):
    rows = statuses()
    df = spark.createDataFrame(rows, SCHEMA)
    ts.write_in_time_order(df, f"{tmp}/in", 2)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    q = ts.start_joined(stream, f"{tmp}/out", f"{tmp}/ck", "120 seconds", "40 seconds",
                        "10 seconds", available_now=True)
    assert ts.finish(q) == 0
    got = spark.read.parquet(f"{tmp}/out")
    assert same(got, closed(df, last_retweet(rows)))
    joins = [op for op in q.recentProgress[-1].stateOperators if "oin" in op.operatorName]
    # what is left belongs to windows that are still open
    assert joins and sum(op.numRowsTotal for op in joins) < got.count()


def test_recorded_arrivals_give_the_same_windows(spark, tmp):
    """Stamps are taken once per tick and stay; reruns over the record agree."""
    from ravel.streaming.arrivals import by_arrival, record_arrivals
    df = spark.createDataFrame(statuses(60), SCHEMA)
    ts.write_in_time_order(df, f"{tmp}/in", 2)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    ts.finish(record_arrivals(stream, f"{tmp}/record", f"{tmp}/ck", available_now=True))
    kept = spark.read.parquet(f"{tmp}/record")
    assert kept.count() == 60 and 1 < kept.select("arrived").distinct().count() <= 4
    runs = [tr.trending(by_arrival(spark.read.parquet(f"{tmp}/record")), "120 seconds", "40 seconds")
            for _ in range(2)]
    assert same(*runs) and runs[0].count() > 0
    # the windows are those of the arrivals, not of the statuses' own times
    assert runs[0].agg(F.min("window.start")).first()[0] > T0 + timedelta(days=30)


def test_language_names(spark):
    from ravel.sources import languages
    df = spark.createDataFrame([("en",), ("NO",), ("zz",), (None,), ("",)], "lang string")
    names = languages.language_names(spark)
    want = {"en": "English", "NO": "Norwegian", "zz": "zz", None: None, "": ""}
    assert {r.lang: r.language for r in languages.with_language_name(df, names).collect()} == want
    long = names.unionByName(spark.range(languages.MAX_BROADCAST).selectExpr(
        "concat('x', id) as code", "'n' as name"))
    joined = languages.with_language_name(df, long)
    assert {r.lang: r.language for r in joined.collect()} == want
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()

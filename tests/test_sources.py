"""Segment index routing: file / S3 / ignored schemes."""

from ravel.sources.crawl import route


def test_route(spark):
    uris = ["file:/data/a.gz", "file:///data/b.gz", "s3://bucket/crawl/c.gz", "s3://nokey",
            "s3:/x", "http://h/d.gz", "ftp://e"]
    df = spark.createDataFrame([(u,) for u in uris], "uri string")
    got = {r.uri: (r.scheme, r.path) for r in route(df).collect()}
    assert got == {
        "file:/data/a.gz": ("file", "file:/data/a.gz"),
        "file:///data/b.gz": ("file", "file:/data/b.gz"),
        "s3://bucket/crawl/c.gz": ("s3", "s3a://bucket/crawl/c.gz"),
        "s3://nokey": ("s3", None),      # invalid S3 URI: a failed segment
        "s3:/x": ("s3", None),
        "http://h/d.gz": (None, None),   # unknown scheme: ignored, not counted
        "ftp://e": (None, None),
    }


def test_cast_cut_survives_other_splits(spark, tmp):
    """The header and footer cut is the same when the split size changes
    between building the frame and reading it; accented names round-trip."""
    from pyspark.sql import functions as F

    from ravel.sinks.files import write_cast_list
    from ravel.sources.casts import read_cast_file

    rows = spark.range(4000).select(
        (F.col("id") % 1500).alias("actor_id"), (F.col("id") % 1500 % 2 == 0).alias("is_male"),
        F.concat(F.lit("Müller, Jörg "), (F.col("id") % 1500).cast("string")).alias("name"),
        F.concat(F.lit("Ça ira "), F.col("id").cast("string"), F.lit(" (2012)")).alias("raw_title"))
    write_cast_list(rows, f"{tmp}/c", 2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for build, read in (("4k", "64k"), ("64k", "2k")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", build)
            frames = [read_cast_file(spark, f"{tmp}/c/is_male={g}") for g in ("true", "false")]
            spark.conf.set("spark.sql.files.maxPartitionBytes", read)
            got.append(sorted(r.value.strip("\n") for f in frames for r in f.collect() if r.value.strip("\n")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {}
    for r in rows.collect():
        want.setdefault(r.name, []).append("\t\t\t" + r.raw_title)
    want = sorted("\n".join([n, *sorted(t)]) for n, t in want.items())
    assert got[0] == got[1] == want

"""Command line: ``python -m ravel <program> ...`` (or via spark-submit).

  words    INPUT OUTPUT                      word report (CRLF text)
  phones   --input INDEX --output DIR        phone index (parquet) + counters
           [--partitions N] [--name APP] [--country 31] [--digits 9]
  degrees  MALE FEMALE OUTPUT                degrees report
           [--source NAME] [--min-year 2011] [--hops 6]
  trending --input DIR --output DIR          trending stream over JSON/parquet
           [--format parquet] [--window "120 seconds"] [--slide "2 seconds"]
           [--watermark "10 seconds"] [--start TIMESTAMP] [--checkpoint DIR]
           [--once] [--print-top]
           status files hold ts, is_retweet, lang, id, username, text (the
           last three describe the retweeted original), or ts, is_retweet, lang and
           a struct retweeted (id, username, text)

The session comes from spark-submit's configuration (master, resources,
``spark.checkpoint.dir``); ravel adds only its SQL defaults.
"""

from __future__ import annotations

import argparse
import json
import sys

from ravel.session import build_session, ensure_checkpoint_dir

# Fixed value: the reference's source actor.
DEFAULT_SOURCE = "Bacon, Kevin (I)"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ravel")
    sub = p.add_subparsers(dest="cmd", required=True)

    w = sub.add_parser("words")
    w.add_argument("input")
    w.add_argument("output")

    ph = sub.add_parser("phones")
    ph.add_argument("--input", "-i", required=True)
    ph.add_argument("--output", "-o", required=True)
    ph.add_argument("--partitions", "-p", type=int)
    ph.add_argument("--name", "-n", default="Phone Numbers")
    ph.add_argument("--country", default="31")
    ph.add_argument("--digits", type=int, default=9)

    d = sub.add_parser("degrees")
    d.add_argument("male")
    d.add_argument("female")
    d.add_argument("output")
    d.add_argument("--source", default=DEFAULT_SOURCE)
    d.add_argument("--min-year", type=int, default=2011)
    d.add_argument("--hops", type=int, default=6)

    t = sub.add_parser("trending")
    t.add_argument("--input", required=True, help="folder of status files")
    t.add_argument("--output", required=True)
    t.add_argument("--format", default="parquet")
    t.add_argument("--window", default="120 seconds")
    t.add_argument("--slide", default="2 seconds")
    t.add_argument("--watermark", default="10 seconds")
    t.add_argument("--start", help="warm-up: drop windows opening before this time")
    t.add_argument("--checkpoint")
    t.add_argument("--once", action="store_true", help="process what is there, then stop")
    t.add_argument("--print-top", action="store_true")

    a = p.parse_args(argv)
    spark = build_session(app=getattr(a, "name", None) or f"ravel-{a.cmd}")

    if a.cmd == "words":
        from ravel.plans.programs import word_job
        word_job(spark, a.input, a.output)
    elif a.cmd == "phones":
        from ravel.plans.programs import phone_job
        counters = phone_job(spark, a.input, a.output, a.country, a.digits, a.partitions)
        print(json.dumps(counters))
    elif a.cmd == "degrees":
        from ravel.plans.programs import degrees_job
        degrees_job(spark, a.male, a.female, a.source, a.output, a.min_year, a.hops)
    elif a.cmd == "trending":
        from ravel.session import scratch_path
        from ravel.streaming.trending_stream import start_trending
        ensure_checkpoint_dir(spark)
        # Schema of the status files: taken from what is there now.
        schema = spark.read.format(a.format).load(a.input).schema
        statuses = spark.readStream.format(a.format).schema(schema).load(a.input)
        q = start_trending(statuses, a.output, a.checkpoint or scratch_path(spark, "trending"),
                           a.window, a.slide, a.watermark, start=a.start, available_now=a.once,
                           print_top=a.print_top)
        q.awaitTermination()
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

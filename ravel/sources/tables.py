"""Bindings of the programs' inputs onto the given parquet tables.

Each binding is a projection/filter over a table, so Catalyst prunes the
scan to the columns used and pushes the filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.functions.time import utc_instant

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of every document (``line string``), like reading
    the texts as line files. Every third document has its commas written as
    '--', the segment break the prose itself does not hold."""
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.replace("text", F.lit(", "), F.lit("--"))) \
        .otherwise(F.col("text"))
    return docs.select(F.explode(F.split(text, "\n")).alias("line"))


def crawl_records_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uri, body) records: every page's html under its url, and every
    document's text under a ``doc:<id>`` uri."""
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("uri"),
                                                  F.col("html").alias("body"))
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("uri"),
        F.col("text").alias("body"))
    return pages.unionByName(docs)


def dutch_phone_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uri, body) with Dutch-style numbers written six ways, one per
    customer (the data holds no +31 numbers of its own)."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    n = F.lpad(F.col("c_custkey").cast("string"), 8, "1")
    k = F.pmod(F.col("c_custkey"), F.lit(6))
    body = (F.when(k == 0, F.concat(F.lit("call +31 (0)6-"), n, F.lit(" now")))
             .when(k == 1, F.concat(F.lit("tel 0031"), F.lit("6"), n))
             .when(k == 2, F.concat(F.lit("0031 6 "), n))
             .when(k == 3, F.concat(F.lit("+31(0)"), n))
             .when(k == 4, F.concat(F.lit("+316"), n, F.lit("99")))
             .otherwise(F.concat(F.lit("x +31 6 "), n, F.lit(" or 00316"), n)))
    return c.select(F.concat(F.lit("cust:"), F.col("c_custkey").cast("string")).alias("uri"),
                    body.alias("body"))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows from the ``events`` table (see ``tweets_from_events``)."""
    return tweets_from_events(table(spark, sf_dir, "events"))


def tweets_from_events(events: DataFrame) -> DataFrame:
    """Status rows (event_id, ts, is_retweet, lang, id, username, text) --
    ``id``/``username``/``text`` describe the retweeted original; ``ts`` is
    an event-time timestamp (UTC session). Pure projection, so it serves a
    batch or a streaming ``events`` frame alike."""
    e = events.select("event_id", "ts", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.select("event_id", utc_instant(e, "ts").alias("ts"), "event_type", k.alias("k"))
    tag1 = F.substring(F.lit("abcdefg"), (F.pmod(F.col("k"), F.lit(7)) + 1).cast("int"), 1)
    tag2 = F.substring(F.lit("xyz"), (F.pmod(F.col("k"), F.lit(3)) + 1).cast("int"), 1)
    text = F.when(F.pmod(F.col("k"), F.lit(5)) == 0,
                  F.concat(F.lit("plain post "), F.col("k").cast("string"))) \
        .otherwise(F.concat(F.lit("post "), F.col("k").cast("string"), F.lit(" #t"), tag1,
                            F.lit(" #"), tag2, F.lit("! #2017 end")))
    return e.select(
        "event_id", "ts",
        (F.col("event_type") != "signup").alias("is_retweet"),
        F.when(F.col("event_type") == "error", "no").when(F.col("event_type") == "view", "fr")
         .otherwise("en").alias("lang"),
        F.col("k").cast("bigint").alias("id"),
        F.concat(F.lit("user"), F.pmod(F.col("k"), F.lit(17)).cast("string")).alias("username"),
        text.alias("text"))


def cast_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (actor, raw title): (actor_id, name, is_male, raw_title)
    in the cast-list title format 'Title (year)  [role]'; every 50th part
    has an unknown year, line 7 of an order is a TV title (leading quote)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                 "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
         .join(c, F.col("c_custkey") == F.col("o_custkey"))
         .join(p, F.col("p_partkey") == F.col("l_partkey")))
    year = F.when(F.pmod(F.col("p_partkey"), F.lit(50)) == 0, F.lit(" (????)")) \
        .otherwise(F.concat(F.lit(" ("), F.year("l_shipdate").cast("string"), F.lit(")")))
    title = F.concat(F.when(F.col("l_linenumber") == 7, F.lit('"')).otherwise(F.lit("")),
                     F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"), year,
                     F.lit("  [role]"))
    return j.select(F.col("c_custkey").alias("actor_id"), F.col("c_name").alias("name"),
                    (F.col("c_acctbal") >= 5000).alias("is_male"), title.alias("raw_title"))

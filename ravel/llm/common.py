"""Helpers the corpus operators share: table access, Arrow batch bounds,
lineage cuts and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.session import ensure_checkpoint_dir

# Rows per Arrow batch where whole texts go to Python. Texts have no length
# bound, so a batch is kept to a few hundred of them and to a size.
TEXT_ROWS_PER_BATCH = 256
BYTES_PER_BATCH = 32 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = TEXT_ROWS_PER_BATCH) -> None:
    """Lower the session's Arrow batch to ``rows`` rows and to
    ``BYTES_PER_BATCH`` bytes (never raise it)."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder (lineage cut; the
    files survive lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges``
    (``u``, ``v`` long, any direction, repeats allowed; nulls and loops are
    dropped). Alternating large-star and small-star rounds: every round
    re-links nodes to their smallest neighbour, so a hub's rows only meet in
    a partially aggregated ``min`` and in a join whose hub side Spark may
    split. Ends when the links no longer change; each round is checkpointed.
    """
    e = pinned(edges.where("u is not null and v is not null and u <> v")
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct())
    before = _signature(e)
    while before[0]:
        e = pinned(_small_star(_large_star(e)))
        after = _signature(e)
        if after == before:
            break
        before = after
    # at the fixed point every remaining link is (node, its root)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(e.select("v", "v").distinct())


def _signature(e: DataFrame):
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"),
                                                    F.col("m").alias("v"))
    return (linked.union(low.select("u", F.col("m").alias("v")))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())

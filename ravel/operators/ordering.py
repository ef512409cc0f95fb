"""Distributed row numbering and runs in a sort order.

``row_number() over (partition by g order by ...)`` runs each group in one
task. For reports over few, large groups (e.g. the two genders, or a window
that holds most posts) this module works on range-partitioned, sorted slices
instead: every task does its own slice, and a small table with a row per
(partition, group) tells each slice what came before it. A slice in which a
group goes on is stitched to the one before by that table.

The input is pinned before the range partitioning, which samples it: what
leads to it runs once. Callers that have pinned it already say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravel.session import ensure_checkpoint_dir


# Rows of a slice by ``slices_of``.
SLICE_ROWS = 50_000


def slices_of(df: DataFrame) -> int:
    """Slices for the rows of ``df`` (kept, for it is counted), at most as many
    as the session has shuffle partitions. The range partitioning sends 300
    sampled keys a slice to the driver, so small batches are cut into few."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, -(-df.count() // SLICE_ROWS)))


def sorted_slices(df: DataFrame, keys: list[Column], partitions: int | None = None,
                  pinned: bool = False) -> DataFrame:
    """``df`` range partitioned and sorted by ``keys``, with ``_pid``, the slice
    (slices follow one another in order), and ``_pos``, which rises inside it."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df if pinned else df.checkpoint(eager=True)
    return (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_pos", F.monotonically_increasing_id())
            .checkpoint(eager=True))  # pins the ids that the tables refer to


def number_rows(df: DataFrame, group: str, order: list[Column], out: str = "idx",
                partitions: int | None = None, pinned: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its ``group`` in
    the order ``[group] + order`` (``order`` must make it total)."""
    s = sorted_slices(df, [F.col(group), *order], partitions, pinned)
    per = (s.groupBy("_pid", group)
           .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # Spark broadcasts the table if its size allows, or splits a hot group
    numbered = s.join(per.select("_pid", group, "_before", "_first"), ["_pid", group])
    return numbered.withColumn(out, F.col("_before") + F.col("_pos") - F.col("_first") + 1) \
        .drop("_pid", "_pos", "_before", "_first")


def place_in_run(df: DataFrame, group: str, value: str, order: list[Column],
                 out: str = "place", partitions: int | None = None,
                 pinned: bool = False) -> DataFrame:
    """Add ``out`` = 1-based place of each row in its run: consecutive rows of
    a ``group`` (in the order ``[group] + order``) with one ``value``. Keeps
    ``_pid`` and ``_pos``, by which the rows can be put in order.

    Runs are found per slice. The table of slices has, for each slice of a
    group, its first and last value, whether it is all one run, and the length
    of its last run; a slice that begins with the value its predecessor ended
    with continues that run, and what it carries on is a difference of prefix
    sums of those lengths, back to the slice in which the run began. Values
    are not null."""
    s = sorted_slices(df, [F.col(group), *order], partitions, pinned)
    inside = Window.partitionBy("_pid", group).orderBy("_pos")
    before = F.lag(value).over(inside)
    s = s.withColumn("_new", F.when(before.isNull() | (before != F.col(value)), 1).otherwise(0))
    s = s.withColumn("_run", F.sum("_new").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("_pid", group, "_run").orderBy("_pos")
    s = s.withColumn("_here", F.row_number().over(run))

    per = s.groupBy("_pid", group).agg(
        F.min_by(value, "_pos").alias("_first"), F.max_by(value, "_pos").alias("_last"),
        F.max("_run").alias("_runs"), F.max_by("_here", "_pos").alias("_tail"))
    slices = Window.partitionBy(group).orderBy("_pid")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag("_last").over(slices) == F.col("_first"), F.lit(False))
    per = (per.withColumn("_goes_on", goes_on)
           .withColumn("_sum", F.coalesce(F.sum("_tail").over(earlier), F.lit(0))))
    # slices whose last run began in them
    begins = F.when(~F.col("_goes_on") | (F.col("_runs") > 1), F.col("_sum"))
    per = per.withColumn("_begins", begins)
    carried = F.when(F.col("_goes_on"), F.col("_sum") - F.max("_begins").over(earlier))
    per = per.select("_pid", group, F.coalesce(carried, F.lit(0)).alias("_carried"))
    # a row for each slice of a group: Spark broadcasts it if its size allows
    s = s.join(per, ["_pid", group])
    place = F.col("_here") + F.when(F.col("_run") == 1, F.col("_carried")).otherwise(0)
    return s.withColumn(out, place).drop("_new", "_run", "_here", "_carried")


def dense_index(rows: DataFrame, blocks: list[str], place: str, out: str = "idx") -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... over all rows in the order of ``blocks``, then
    ``place``. A block (say an input, a file and a split of it) is bounded; its
    rows are counted from its start, and the table with a row per block gives
    the rows before it as a prefix sum. No sort spans blocks, and the numbers
    follow from the order alone: a rerun, or blocks read by other tasks, gives
    the same. ``rows`` are pinned already and ``place`` is unique in a block."""
    inside = Window.partitionBy(*blocks).orderBy(place)
    rows = rows.withColumn("_i", F.row_number().over(inside) - 1)
    every = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(*blocks, F.coalesce(F.sum("_n").over(every), F.lit(0)).alias("_before"))
    return rows.join(before, blocks).withColumn(out, F.col("_before") + F.col("_i")) \
        .drop("_i", "_before")

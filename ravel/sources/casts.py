"""Cast-list files: blank-line separated actor records between a header
and a footer, in Latin-1.

The file is read as records split on a blank line (``lineSep='\\n\\n'``,
splittable, no whole-file read). The header ends at the first start-marker
line and the footer starts at the next end-marker line; both are found per
file from the few records holding a marker, ordered by (split offset, row
id) -- the file order -- and every record is kept or cut against them. A file without a
start marker yields no records (the reference's script fails there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The header's last line and the footer's first line.
START_MARKER = "----\t\t\t------"
END_MARKER = "-" * 77
LATIN1 = "ISO-8859-1"


def read_records(spark: SparkSession, path, encoding: str | None = LATIN1) -> DataFrame:
    """(file, ord struct<block,row>, value) per blank-line separated record.
    ``ord`` orders records within a file. Bytes are decoded with
    ``encoding`` (None: as UTF-8, which is how a plain text read sees them)."""
    raw = spark.read.option("lineSep", "\n\n").text(path)
    value = F.col("value")
    if encoding:
        value = F.decode(value.cast("binary"), encoding)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("ord"),
        value.alias("value"))


def between_markers(records: DataFrame, start_marker: str = START_MARKER,
                    end_marker: str = END_MARKER) -> DataFrame:
    """Records (file, ord, value) cut to the lines strictly between the
    first start-marker line of each file and the next end-marker line (or
    the end of the file).

    The records are pinned first (checkpoint): their order within a file
    names splits of one scan, so both the marker positions and the cut must
    come from that scan. The positions per file come from the few records that
    hold a marker string; the others are kept or left whole."""
    from ravel.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(records.sparkSession)
    records = records.checkpoint(eager=True)
    has_mark = (F.instr("value", start_marker) > 0) | (F.instr("value", end_marker) > 0)
    marks = records.where(has_mark).withColumn("_l", F.split("value", "\n"))
    sp = F.array_position("_l", start_marker)
    starts = (marks.where(sp > 0)
              .groupBy("file").agg(F.min(F.struct("ord", sp.alias("pos"))).alias("s")))
    # Position of the first end marker after the start (1-based in its record).
    j = marks.join(starts, "file").where(F.col("ord") >= F.col("s.ord"))
    after = F.slice("_l", F.col("s.pos") + 1, F.greatest(F.size("_l") - F.col("s.pos"), F.lit(0)))
    in_start = F.when(F.array_position(after, end_marker) > 0,
                      F.array_position(after, end_marker) + F.col("s.pos"))
    later = F.when(F.array_position("_l", end_marker) > 0, F.array_position("_l", end_marker))
    ep = F.when(F.col("ord") == F.col("s.ord"), in_start).otherwise(later)
    ends = (j.withColumn("_ep", ep).where(F.col("_ep").isNotNull())
            .groupBy("file").agg(F.min(F.struct("ord", F.col("_ep").alias("pos"))).alias("e")))
    # starts / ends: one row per input file; Spark broadcasts them by size
    k = (records.join(starts, "file")
         .join(ends, "file", "left")
         .where((F.col("ord") >= F.col("s.ord"))
                & (F.col("e").isNull() | (F.col("ord") <= F.col("e.ord")))))
    is_start = F.col("ord") == F.col("s.ord")
    is_end = F.col("e").isNotNull() & (F.col("ord") == F.col("e.ord"))
    lines = F.split("value", "\n")
    lo = F.when(is_start, F.col("s.pos") + 1).otherwise(F.lit(1))
    hi = F.when(is_end, F.col("e.pos") - 1).otherwise(F.size(lines))
    cut = F.array_join(F.slice(lines, lo, F.greatest(hi - lo + 1, F.lit(0))), "\n")
    return k.select("file", "ord", F.when(is_start | is_end, cut).otherwise(F.col("value"))
                    .alias("value"))


def read_cast_file(spark: SparkSession, path, encoding: str | None = LATIN1,
                   start_marker: str = START_MARKER, end_marker: str = END_MARKER) -> DataFrame:
    """Actor records of a cast-list file (header and footer removed)."""
    return between_markers(read_records(spark, path, encoding), start_marker, end_marker)

"""Arrival time: windows over when statuses came in, not over their own time.

The arrival of a status is stamped once, when it is taken in, and kept with
it: ``record_arrivals`` writes every status with its stamp to files that a log
commits per epoch, and windows are taken over the recorded stamps. A rerun
over the record gives the same windows; stamping anew would not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ARRIVED = "arrived"


def record_arrivals(statuses: DataFrame, out_path: str, checkpoint_location: str,
                    stamp: Column | None = None, processing_time: str | None = "2 seconds",
                    available_now: bool = False) -> StreamingQuery:
    """Start a stream that adds ``arrived`` to ``statuses`` and appends them to
    parquet files under ``out_path``. The stamp is the time of the tick, which
    the checkpoint holds, so a replayed tick has the same; ``stamp`` replaces it
    where the source brings one."""
    rows = statuses.withColumn(ARRIVED, F.current_timestamp() if stamp is None else stamp)
    w = (rows.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint_location))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def by_arrival(statuses: DataFrame) -> DataFrame:
    """Recorded statuses with their arrival as the time of all windows."""
    return statuses.drop("ts").withColumnRenamed(ARRIVED, "ts")

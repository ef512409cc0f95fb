"""Session construction and the few cluster-level helpers the operators share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every ravel job wants. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Rank filters (row_number <= k) get a partial limit below the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Checkpoint files (BFS hops, numbering tables) are removed once no
    # DataFrame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "ravel",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with ravel's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data
    (about 128-256 MB per partition), AQE coalesces from there.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it from the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local-mode session without the setting (tests,
    benchmarks on one machine) gets a fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="ravel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, inside the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}ravel-{name}-{os.getpid()}-{next(_counter)}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table this library wrote, wherever it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()

"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every builder relies on. UTC keeps timestamp arithmetic identical to
# a zone-less SQL engine; AQE re-plans joins (runtime broadcast of small sides,
# skew-join splitting) and coalesces shuffle partitions from measured sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove a ranking's checkpoint files once its DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no call-site capture (a JVM round trip) on every DataFrame/Column call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "agora",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so one shuffle partition holds roughly 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none exists.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used. Only a local-mode session without any setting (tests) gets a
    fresh folder of its own; a cluster session without one is an error, since
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
            "for reliable checkpoints")
    folder = tempfile.mkdtemp(prefix="agora-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()

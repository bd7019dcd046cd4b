"""Session construction and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job here relies on.  AQE re-plans joins and coalesces
# small shuffle partitions at runtime; UTC keeps timestamp_ntz <-> string exact.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "ledgerlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``shuffle_partitions`` should be sized to the data: about input bytes /
    128 MB for the widest shuffle.  AQE coalesces it down for small stages.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        pass
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (``spark.default.parallelism`` without a SparkContext)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return int(spark.conf.get("spark.default.parallelism", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only a local-mode session without one gets a
    private temporary folder (tests); a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        return configured
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/...) before running jobs that materialize data"
            )
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/ledgerlens/{kind}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``scratch_path`` named, once nothing reads it any more."""
    root = f"{checkpoint_root(spark).rstrip('/')}/ledgerlens/"
    if not path.startswith(root) or len(path) <= len(root):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

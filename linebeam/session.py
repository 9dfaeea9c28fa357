"""Session construction and shared-folder resolution."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every entry point uses; all are plain public Spark confs.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

_SCRATCH: dict[str, list[str]] = {}   # application id -> folders made by scratch_dir


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "linebeam", extra: dict | None = None) -> SparkSession:
    """Return a SparkSession with the library defaults.

    The master and the number of shuffle partitions are set only when given;
    otherwise ``spark-submit`` and the cluster's own configuration decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A private folder is made only where the setting is absent and the master is
    local; on a cluster a missing setting is an error, since no machine-local
    folder is visible to all executors.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="linebeam-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    path = f"{_checkpoint_root(spark)}/linebeam-stage/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the staged folders this application made; call it once their
    results are no longer read. Returns how many were removed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        done += bool(p.getFileSystem(conf).delete(p, True))
    return done

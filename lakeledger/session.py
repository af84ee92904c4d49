"""Session setup and the shared folder every job writes to.

Jobs never use a machine-local temporary folder on a cluster: intermediate
tables and lakes built by the registered queries live under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests, the bench) do we create one and register it on the context; a
cluster without it is an error.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the library relies on for correct results.
REQUIRED_CONF = {
    # timestamps in the run log and the lake are UTC wall-clock values
    "spark.sql.session.timeZone": "UTC",
    # lake partition values (month=199501, server=srv-001) stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a lake has a folder for each unit: list them in this many tasks, not in
    # one task a folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}

# Settings for throughput; a cluster deployment may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lakeledger", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update(REQUIRED_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on (idempotent, session-scoped)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


_SCOPED: dict[str, tuple[int, str | None]] = {}
_LOCK = threading.Lock()


@contextmanager
def conf_scope(spark: SparkSession, values: dict[str, str]):
    """Session settings for the actions inside the block.  Blocks of several
    threads may overlap if they set the same values: the last one restores."""
    with _LOCK:
        for k, v in values.items():
            n, old = _SCOPED.get(k, (0, None))
            _SCOPED[k] = (n + 1, old if n else spark.conf.get(k, None))
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _LOCK:
            for k in values:
                n, old = _SCOPED.pop(k)
                if n > 1:
                    _SCOPED[k] = (n - 1, old)
                elif old is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, old)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` if set.

    When unset (tests, single-machine runs) a folder is created once and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` and the
    tables written here share one location.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lakeledger-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder under the shared folder for one job's outputs."""
    base = shared_dir(spark)
    path = f"{base}/lakeledger/{label}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path

"""Session settings and the shared work folder.

Everything that touches disk (snapshots, stream checkpoints, stream versions)
goes below the folder the cluster names in ``spark.checkpoint.dir``. On a
cluster that folder must be shared (HDFS, S3, ...); a machine-local temporary
folder is only created when the setting is missing *and* the master is local,
as in tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that matter at scale. Shuffle partitions are sized by the caller;
# AQE coalesces small partitions and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Broadcast only what Spark's own size estimate proves small.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Upload only the changes of each micro-batch, with periodic snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tablevault", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``spark.checkpoint.dir`` is read from the configuration (including
    spark-defaults); only a local master without one gets a fresh local
    folder. Cluster sessions must bring their own.
    """
    builder = SparkSession.builder.appName(app_name)
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
    shared_root(spark)  # honours a configured folder; local sessions without one get their own
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for disk work, read from ``spark.checkpoint.dir``.

    Falls back to a new local folder only when the master is local and no
    folder is configured (tests); raises on a cluster without the setting.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root and sc.getCheckpointDir():
        # set earlier with setCheckpointDir(); Spark appends a per-context folder
        root = sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    if not root:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tablevault-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_MADE: list[str] = []


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder below the shared root."""
    path = f"{shared_root(spark)}/tablevault/{label}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def remove_work_dirs(spark: SparkSession) -> int:
    """Delete the work folders this process has made; call it once the results that
    read them have been written elsewhere. Returns how many there were."""
    from tablevault.sources import fs

    n = len(_MADE)
    while _MADE:
        fs.delete(spark, _MADE.pop())
    return n


@contextmanager
def session_conf(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings (``__`` for a dot) that hold for a few actions and are put back afterwards."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


__all__ = ["build_session", "shared_root", "new_work_dir", "remove_work_dirs", "session_conf", "DEFAULT_CONF"]

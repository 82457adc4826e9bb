"""Session defaults and the shared scratch area.

Everything that has to survive an executor loss (checkpointed DataFrames,
stream checkpoints, tables written between stages) lives under the folder the
cluster names in ``spark.checkpoint.dir``. We only ever *read* that setting;
a folder of our own is set only when it is unset on a local master (tests).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves (tests, bench). On a cluster the
# operator passes their own session; we never change its global confs except
# the checkpoint folder when (and only when) it is missing on a local master.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Recommended settings for a large cluster (not applied automatically; pass as
# ``extra`` or put them in the cluster's defaults). Shuffle partitions start
# high and AQE coalesces them to ~256 MB; skewed join partitions are split;
# scans cut files into 256 MB splits; per-(window, road) stream state lives in
# RocksDB instead of the executor heap.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "hexflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("HEXFLOW_MASTER", "local[8]"))
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or an already set RDD checkpoint dir).
    When neither is set and the master is local, a fresh folder is made and
    registered; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
    root = tempfile.mkdtemp(prefix="hexflow-ckpt-")
    sc.setCheckpointDir(root)
    return root


_OWNERS: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, removed with
    the innermost ``owned_scratch`` around, if there is one."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/hexflow/{name}-{uuid.uuid4().hex[:12]}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


@contextlib.contextmanager
def owned_scratch(spark: SparkSession):
    """Removes the scratch folders made within, once the block ends. For jobs
    whose results are written elsewhere by then, not for lazy results."""
    mine: list[str] = []
    _OWNERS.append(mine)
    try:
        yield
    finally:
        _OWNERS.remove(mine)
        jvm = spark.sparkContext._jvm
        for path in mine:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

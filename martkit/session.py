"""Session defaults and shared-storage helpers.

Nothing here starts a server: the UI is off. Scratch output (staged tables,
stream checkpoints) always lives under the cluster's shared
``spark.checkpoint.dir``; a local temp folder is only used when that setting
is unset (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner/AQE has measured under this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "martkit", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARTKIT_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir). Only a local master (tests, laptops) gets a temporary folder when
    neither is set: on a cluster every machine would write to its own disk.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset config raises
            root = None
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="martkit-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_OWN_FOLDERS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path in the application's folder under the shared
    checkpoint root; the folder is removed when the driver's JVM ends."""
    own = f"{checkpoint_root(spark)}/martkit/{spark.sparkContext.applicationId}"
    if own not in _OWN_FOLDERS:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _OWN_FOLDERS.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back:
    cuts the lineage at a place that survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

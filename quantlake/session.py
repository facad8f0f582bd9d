"""Session defaults and shared-folder helpers.

``spark.checkpoint.dir`` names the shared folder that lineage cuts and
intermediate tables go to.  On a cluster it is set by the operator; we only
fill it in when it is unset (local tests).
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
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, partitions: int = 8, app: str = "quantlake",
              driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20,
               max_partitions: int = 200_000) -> dict:
    """Session settings sized to the input: ~``partition_bytes`` per scan split and shuffle partition.

    The shuffle starts with about one partition per ``partition_bytes`` of
    input (at least two per core, at most ``max_partitions``); AQE coalesces
    small ones and splits skewed join partitions at run time.  For 100 TB and
    256 MB that is the 200,000 cap, i.e. ~500 MB per shuffle partition.
    """
    n = max(2 * cores, min(max_partitions, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we never
    replace it.  Without one a ``local`` session (tests) gets a fresh folder
    under the system temp directory; on any other master this raises, as
    executors would not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quantlake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system (failures of the store are raised, not read as absence)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_scratch: dict[str, list[str]] = {}          # intermediate tables by application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has made; call it when no frame built on them is needed any more.

    Returns how many there were.  Only paths handed out by :func:`scratch_path` go.
    """
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Survives executor loss: the written files live in shared storage, unlike
    cached blocks or local checkpoints.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

"""Session helpers: a session for tests and the bench, the shared folder,
and stage tables written into it.  The library never changes session
configuration; only ``build_session``, where *we* own the session, sets any.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "hearth", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for stage tables, checkpoints and stream state that the driver
    and every executor see.

    Read from ``spark.checkpoint.dir``.  Where it is unset, a ``local``
    master (tests, the bench) gets a scratch folder, because there driver
    and executors are one machine; on a cluster it is an error, as a
    machine-local folder would lose the other executors' files.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _local_scratch()
    return folder


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="hearth-")


def fresh_subdir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder (never reused).  Spark's
    writers create it, so any file system that Spark reads will do."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared folder and return the
    stored table.  This cuts the lineage (a lost executor recomputes from
    the stored files, not from the sources) in ONE job — ``checkpoint()``
    computes its input twice unless it is also persisted — and the stored
    table is columnar, so later narrow reads scan only their columns."""
    spark = df.sparkSession
    path = fresh_subdir(spark, name) + "/data"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)

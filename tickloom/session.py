"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time (streaming watermarks and the
# oracle compare both assume it), AQE for runtime coalescing / skew splits, and
# the Spark UI switched off (no listening web server).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    # A cluster's own shuffle and memory settings stay; only local runs get
    # small defaults.
    if master and master.startswith("local"):
        shuffle_partitions = shuffle_partitions or 8
        conf["spark.driver.memory"] = os.environ.get("TICKLOOM_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset and
    the master is local (tests) a private scratch folder is created and
    registered.  On a cluster an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if current is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tickloom-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for materialised tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}"


#: Rows of one task where a query says how its rows are spread.
ROWS_PER_TASK = 1 << 19


def spread(df, rows: int, *keys):
    """``df`` hash-partitioned by ``keys`` so that a task gets about
    ``ROWS_PER_TASK`` of its ``rows`` rows, however many there are: what a task
    holds does not grow with the input."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.repartition(tasks, *keys)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: one computation (``checkpoint()`` without a cache computes
    its input twice), lineage cut, and the files survive executor loss.
    Each call takes a fresh folder; nothing is overwritten.  ``release_tables``
    removes them once the results that read them are done."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders that ``materialize`` wrote in this process and nobody released yet.
_WRITTEN: list[str] = []


def release_tables(spark: SparkSession) -> int:
    """Delete the intermediates this process has materialised so far and return
    their number.  Call it between queries, when no DataFrame that reads them is
    used any more; results that were written elsewhere are not touched."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = len(_WRITTEN)
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
    return n

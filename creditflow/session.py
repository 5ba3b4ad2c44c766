"""Session settings and lineage cutting.

The settings here are what the job relies on at scale: AQE (runtime
coalescing and skew-join splitting), runtime bloom filters so that big
dimension scans are reduced by the few recent orders, and UTC session time
(all timestamps are zone-less and converted explicitly).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle (the
    # grouping above the order join would otherwise pin a hot order to one task).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The JVM never compiles a method of over 8000 bytes: a stage whose rule
    # chains would make one runs as a chain of smaller generated projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "creditflow") -> SparkSession:
    """Local session for tests and the benchmark (UI off, no ports beyond Spark's own)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one; only a local-mode session (tests, bench) gets a
    private temporary folder when the setting is absent.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running the job")
    local = tempfile.mkdtemp(prefix="creditflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


#: Shuffle files go when the write that made them ends.
FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, free: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    The plan above is computed exactly once (``DataFrame.checkpoint`` would
    compute it twice: once to count, once to write), later stages and lost
    executors re-read the written files instead of recomputing the scans
    and joins, and the columnar copy keeps column pruning and filter
    pushdown for its readers.  Never a machine-local folder on a cluster:
    the folder is ``spark.checkpoint.dir``; tables of one application sit
    under ``creditflow/<application id>/`` so they can be expired together.
    With ``free`` the write's own shuffle files are removed at its end.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/creditflow/{app}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_CONF, None)
    if free:
        spark.conf.set(FREE_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(FREE_CONF) if before is None else spark.conf.set(FREE_CONF, before)
    return spark.read.parquet(path)

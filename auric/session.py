"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session clock, AQE re-planning (coalesce,
# skew-join splitting, runtime broadcast conversion) and a bounded broadcast.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # rule lists compile to wide CASE projections; inferring constraints over
    # them costs more planning time than it saves
    "spark.sql.constraintPropagation.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "auric") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("AURIC_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local-mode session
    (tests, the bench) without one gets a private scratch folder; on a cluster
    a missing setting is an error, never a machine-local directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="auric-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a job's intermediate tables, under the shared
    checkpoint root (so it survives executor loss on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    import uuid

    return f"{root.rstrip('/')}/auric-{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str = "stage"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from that table (the staging table of a pipeline step).

    This cuts the lineage like a reliable checkpoint and survives the loss
    of the executor that computed it, but unlike a checkpoint (an opaque RDD
    scan) later readers get column pruning and pushed filters: a quality
    test reading two columns of a staged Silver table reads two columns."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def together(**calls):
    """Results by name of calls that submit independent jobs, run side by side so that small jobs do not wait for each
    other; the first error is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(calls)))) as pool:
        running = {name: pool.submit(call) for name, call in calls.items()}
    return {name: r.result() for name, r in running.items()}

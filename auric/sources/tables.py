"""Driver tables: one Parquet file per table under an ``sf`` folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Free-text tables: every query over them runs regexes or hashes whole texts
# per row, so their scans are spread over all cores (see ``spread``).
TEXT_TABLES = frozenset({"documents", "pages", "conversations"})
# Scans smaller than this are left alone: a shuffle costs more than it saves.
SPREAD_MIN_BYTES = 64 * 1024
# Larger ones have splits enough of their own; shuffling them whole would cost more than idle cores.
SPREAD_MAX_BYTES = 512 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool | None = None) -> DataFrame:
    """Lazy scan; callers select the columns they need so the Parquet
    reader prunes (``ReadSchema``) and receives pushed filters. Free-text
    tables (and any caller asking for it) are spread over all cores."""
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_rows if spread_rows is not None else name in TEXT_TABLES:
        df = spread(df)
    return df


def spread(df: DataFrame, min_bytes: int = SPREAD_MIN_BYTES) -> DataFrame:
    """Make sure the per-row work after a scan uses every core.

    A Parquet file is split by row group, so a file written as one row group
    is read by one task, and every projection before the first shuffle
    (parsing, rules, regex scans, hashing) would run on a single core. When
    the scan has fewer splits than the cluster's default parallelism, the
    rows are spread round-robin over that many partitions. On a large input
    the scan already has far more splits than cores and nothing is added.
    Filters and column pruning still reach the scan: Catalyst pushes both
    through the repartition."""
    from auric.operators.joins import estimated_bytes

    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if not min_bytes <= estimated_bytes(df) <= SPREAD_MAX_BYTES:
        return df
    if df._jdf.queryExecution().executedPlan().execute().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def require_sources(spark: SparkSession, paths: list[str]) -> None:
    """Presence check before any load: every required source must exist
    (works on any Hadoop-compatible file system)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError(f"required sources missing: {missing}")

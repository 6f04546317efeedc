"""Columnar export, manifest, cross-format reconciliation, keyed upsert and
publish of plain tables (see :mod:`auric.sources.store`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.sources.store import PublishRefused, TableStore

# full microsecond precision in text formats (the JSON default keeps milliseconds)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_partitioned(df: DataFrame, path: str, partition_col: str = "mes") -> None:
    """Hive-layout Parquet by month; with dynamic partition overwrite only
    the months present in ``df`` are replaced.

    Rows are rebalanced by the partition column first, so each month is
    written by few tasks (not every task writing a small file per month);
    AQE splits a month that holds a large share of the rows over several
    tasks and coalesces small months."""
    df.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(path)


def manifest(spark: SparkSession, path: str, partition_col: str = "mes") -> DataFrame:
    """(particoes, linhas, colunas, lista de particoes) of an exported table,
    computed from the data written (not from the writer's memory)."""
    df = spark.read.parquet(path)
    ncols = len([c for c in df.columns if c != partition_col])
    per = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("particoes"), F.sum("n").alias("linhas"),
        F.array_join(F.sort_array(F.collect_list(F.col(partition_col).cast("string"))), ",").alias("lista"),
    ).withColumn("colunas", F.lit(ncols))


def write_formats(df: DataFrame, base: str) -> dict[str, str]:
    paths = {f: f"{base}/{f}" for f in ("parquet", "csv", "json")}
    df.write.mode("overwrite").parquet(paths["parquet"])
    df.write.mode("overwrite").option("header", True).csv(paths["csv"])
    df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT).json(paths["json"])
    return paths


def reconcile_formats(spark: SparkSession, paths: dict[str, str], schema, id_col: str) -> DataFrame:
    """(formato, linhas, soma_ids) per format — equal across formats or the
    export is wrong. One aggregate per format, no data through the driver."""
    readers = {
        "parquet": lambda p: spark.read.parquet(p),
        "csv": lambda p: spark.read.schema(schema).option("header", True).csv(p),
        "json": lambda p: spark.read.schema(schema).option("timestampNTZFormat", TS_FORMAT).json(p),
    }
    out = None
    for fmt, p in paths.items():
        a = readers[fmt](p).agg(F.count(F.lit(1)).alias("linhas"), F.sum(id_col).alias("soma_ids")).select(
            F.lit(fmt).alias("formato"), "linhas", "soma_ids")
        out = a if out is None else out.unionByName(a)
    return out


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keyed upsert: every new row, plus old rows whose key is not in the
    new delivery. Written back with overwrite (no MERGE on plain Parquet)."""
    return new.unionByName(old.join(new.select(*key), key, "left_anti"))


def removed_keys(current: DataFrame, sources: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key left the sources (a NULL key never matches)."""
    cond = F.col(key[0]).isNotNull()
    for k in key[1:]:
        cond = cond & F.col(k).isNotNull()
    src = sources.select(*key).where(cond)
    return current.join(src, key, "left_anti")


def upsert_counts(old: DataFrame, new: DataFrame, key: list[str], value_cols: list[str]) -> DataFrame:
    """(inseridos, atualizados, removidos, inalterados) from one full outer join."""
    o = old.select(*key, F.struct(*value_cols).alias("_o"), F.lit(True).alias("_in_o"))
    n = new.select(*key, F.struct(*value_cols).alias("_n"), F.lit(True).alias("_in_n"))
    j = o.join(n, key, "full")
    return j.agg(
        F.count_if(F.col("_in_o").isNull()).alias("inseridos"),
        F.count_if(F.col("_in_o") & F.col("_in_n") & ~F.col("_o").eqNullSafe(F.col("_n"))).alias("atualizados"),
        F.count_if(F.col("_in_n").isNull()).alias("removidos"),
        F.count_if(F.col("_in_o") & F.col("_in_n") & F.col("_o").eqNullSafe(F.col("_n"))).alias("inalterados"),
    )


# ---------------------------------------------------------------- publish
def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, DataFrame],
            checks: dict[str, DataFrame] | None = None) -> dict:
    """Publish ``tables`` as one version of the store at ``root`` if each of ``checks`` has no rows; the commit."""
    store = TableStore(spark, root)
    draft = store.draft(run_id)
    for name, df in tables.items():
        draft.add(name, df)
    for name, check in (checks or {}).items():
        if not check.isEmpty():
            raise PublishRefused(f"publish check failed: {name}")
    return store.publish(draft)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return TableStore(spark, root).read(table)

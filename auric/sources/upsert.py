"""Keyed tables with stable surrogate ids, in hash buckets.

A table is a folder of ``bucket=<n>`` partitions by the hash of the key. A
delivery reads and rewrites only the buckets that its keys fall into; known
keys keep their ids and new ones get the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.operators.ids import assign_ids
from auric.session import stage
from auric.sources.store import list_names

BUCKETS = 64


def bucket_of(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    return any(n.startswith("bucket=") for n in list_names(spark, path))


def upsert_buckets(spark: SparkSession, path: str, delivery: DataFrame, key: list[str], id_col: str, stamp: str, buckets: int = BUCKETS) -> list[int]:
    """Merge ``delivery`` into the table at ``path`` and return the buckets rewritten.

    A delivered row replaces the row of its key and takes its id; every delivered row carries the load ``stamp``. Of
    several rows of one key in a delivery the largest (by all columns) is kept; rows with a null in the key are left
    out. An empty delivery changes nothing. Each bucket is replaced as a whole, so a load that was interrupted is
    repeated with the same result."""
    values = [c for c in delivery.columns if c not in key]
    kinds = {f.name: f.dataType for f in delivery.schema.fields}
    rows = delivery.dropna(subset=key).groupBy(*key).agg(F.max(F.struct(*values)).alias("_v"))
    rows = stage(rows.select(*key, *[F.col("_v")[c].alias(c) for c in values]).withColumn("bucket", bucket_of(key, buckets)), "delivery")
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most ``buckets``
    if not touched:
        return []
    columns = [id_col, *key, *values, "_carga"]
    if exists(spark, path):
        table = spark.read.parquet(path)
        highest = table.agg(F.max(id_col)).first()[0]
        old = table.where(F.col("bucket").isin(touched))
    else:
        empty = [f"cast(null as long) {id_col}", *[f"cast(null as {kinds[c].simpleString()}) {c}" for c in (*key, *values)], "cast(null as string) _carga", "cast(null as int) bucket"]
        highest, old = 0, spark.range(0).selectExpr(*empty)
    ids = assign_ids(old, rows, key, id_col, highest)
    new = rows.join(ids, key).withColumn("_carga", F.lit(stamp)).select(*columns, "bucket")
    kept = old.join(rows.select(*key), key, "left_anti").select(*columns, "bucket")
    merged = stage(new.unionByName(kept), "merged")  # the folder read is the one written
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return touched


def delete_stale(spark: SparkSession, path: str, stamp: str) -> int:
    """After a full delivery: delete the rows that it did not carry, bucket by bucket; the number deleted."""
    table = spark.read.parquet(path)
    stale = table.where(F.col("_carga") != stamp).groupBy("bucket").agg(F.count("*").alias("n")).collect()
    if not stale:
        return 0
    hit = [r["bucket"] for r in stale]
    rest = stage(table.where(F.col("bucket").isin(hit) & (F.col("_carga") == stamp)), "rest")
    left = {r["bucket"] for r in rest.select("bucket").distinct().collect()}
    rest.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    from auric.sources.store import file_system

    for b in sorted(set(hit) - left):  # nothing left of it to overwrite it with
        fs, p = file_system(spark, f"{path}/bucket={b}")
        fs.delete(p, True)
    return sum(r["n"] for r in stale)

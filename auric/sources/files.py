"""Raw deliveries → Bronze: readers with explicit all-string schemas, exact
record positions and audit columns.

* CSV by header name (BOM tolerated, a missing/renamed column is an error)
  or positionally (Bronze-compatible legacy mode).
* JSON arrays: the top level must be a list; a truncated file fails.
  Record positions (``_linha``) are exact: the file text is parsed as an
  array and exploded with its index. A JSON array is one unit per file, so
  each file is read by one task; large deliveries should come as JSON lines.
* Bronze is append-only, partitioned by run id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_by_header(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return (spark.read.schema(string_schema(columns)).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def read_csv_positional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.schema(string_schema(columns)).option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.schema(string_schema(columns)).option("mode", "FAILFAST").json(path)



def read_json_array(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of JSON-array files with their 1-based position per file.

    Fails when a file is not a JSON array (object, scalar) or is truncated."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_arquivo"), F.col("value"))
    rec = T.ArrayType(string_schema(columns))
    parsed = raw.select("_arquivo", F.trim("value").alias("v")).select(
        "_arquivo", F.col("v").startswith("[").alias("_lista"), F.from_json("v", rec).alias("_r"))
    checked = parsed.select(
        "_arquivo",
        F.when(~F.col("_lista") | F.col("_r").isNull(),
               F.raise_error(F.concat(F.lit("not a complete JSON array: "), F.col("_arquivo"))))
        .otherwise(F.col("_r")).alias("_r"))
    return checked.select("_arquivo", F.posexplode("_r").alias("_pos", "_rec")).select(
        "_arquivo", (F.col("_pos") + 1).cast("int").alias("_linha"), "_rec.*")


def with_audit(df: DataFrame, run_id: str, root: str, origin_col: str = "_arquivo") -> DataFrame:
    """Audit columns: run id, origin relative to ``root``, ingestion time."""
    rel = F.regexp_replace(F.col(origin_col), "^(file:)?" + root.rstrip("/") + "/", "")
    return df.withColumn("_execucao_id", F.lit(run_id)).withColumn("_origem", rel) \
        .withColumn("_ingerido_em", F.current_timestamp()).drop(origin_col)


def append_bronze(df: DataFrame, path: str) -> None:
    """Append-only Bronze sink, one partition per run."""
    df.write.mode("append").partitionBy("_execucao_id").parquet(path)

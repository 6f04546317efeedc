"""Exactly-once Bronze pickup of new delivery files.

A Structured Streaming file source over the landing folder with
``trigger(availableNow=True)``: each scheduled run processes every file
that arrived since the previous run (tracked in the checkpoint), appends
the records to Bronze with audit columns and stops. A re-run after a
failure resumes from the checkpoint, so no file is loaded twice. The
checkpoint stands beside the Bronze table it belongs to, so each source has
its own and the next run finds it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from auric.sources.files import string_schema


def ingest_available(spark: SparkSession, landing: str, columns: list[str], bronze: str, run_id: str,
                     checkpoint: str | None = None, fmt: str = "json") -> int:
    """Append every not-yet-seen file of ``landing`` to ``bronze``; returns
    the number of records written by this run."""
    ckpt = checkpoint or f"{bronze.rstrip('/')}-checkpoint"
    stream = (spark.readStream.schema(string_schema(columns)).option("mode", "FAILFAST")
              .format(fmt).load(landing))
    root = landing.rstrip("/") + "/"
    audited = stream.select(
        "*", F.lit(run_id).alias("_execucao_id"),
        F.regexp_replace(F.col("_metadata.file_path"), "^(file:)?" + root, "").alias("_origem"),
        F.current_timestamp().alias("_ingerido_em"))
    q = (audited.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .partitionBy("_execucao_id").outputMode("append").trigger(availableNow=True).start(bronze))
    q.awaitTermination()
    # counted from what was written: the progress list keeps recent batches only
    written = spark.read.schema(string_schema(columns).add("_execucao_id", "string")).parquet(bronze)
    return written.where(F.col("_execucao_id") == run_id).count()

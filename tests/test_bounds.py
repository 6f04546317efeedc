"""What passes through the driver, what is written down, and what a status is computed from."""

from pyspark.sql import functions as F

from auric.operators.joins import BROADCAST_LIMIT_BYTES, estimated_bytes, join_dim
from auric.operators.triage import ID
from auric.plans.registry import REGISTRY, load_all, model_for

SF = "/root/testdata/sf0.001"


def test_a_dimension_of_some_megabytes_is_not_broadcast(spark, tmp_path):
    model_for(spark, SF)
    spark.range(300000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("nome")).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    assert BROADCAST_LIMIT_BYTES < estimated_bytes(dim) < 32 * 1024 * 1024
    plan = join_dim(spark.range(10).withColumnRenamed("id", "k"), dim, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")) <= BROADCAST_LIMIT_BYTES


def test_state_between_the_runs_is_written_without_the_records(spark):
    load_all()
    assert model_for(spark, SF).chain.waiting.columns == [*ID, "regra", "severidade", "status"]


def test_status_rollup_is_computed_from_the_quality_results(spark):
    load_all()
    assert "cls_todos" in REGISTRY["run_status_rollup"].sql
    found = REGISTRY["run_status_rollup"].build(model_for(spark, SF)).collect()
    results = REGISTRY["dq_results"].build(model_for(spark, SF)).collect()
    by_source = {r["fonte"] for r in results}
    failed = {r["fonte"] for r in results if r["severidade"] == "critica" and not r["aprovado"]}
    assert [(r["etapas"], r["etapas_com_falha"]) for r in found] == [(len(by_source), len(failed))]

"""Identities of rejected records are sorted by what tells them apart."""

from pyspark.sql import functions as F

from auric.operators.triage import Triage, identified


def test_identities_are_sorted_by_their_line_first(spark, tmp_path):
    rows = spark.createDataFrame([("a", n, "x") for n in range(1, 4)], "_origem string, _linha long, c string")
    bad = identified(rows, "f", ["c"]).select("*", *[F.lit("r").alias(x) for x in ("chave_registro", "regra", "severidade", "mensagem", "registro")])
    t = Triage(spark, f"{tmp_path}/q", f"{tmp_path}/r")
    t.record_run("e1", {"f": bad})
    t.edit(bad.where("_linha < 3").select("fonte", "_origem", "_linha", "hash_origem", F.lit("c").alias("campo"), F.lit("y").alias("valor")))
    plan = t.state()._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Aggregate":
        plan = plan.children().apply(0)
    assert plan.groupingExpressions().apply(0).toString().startswith("_linha")
    got = t.overlay(identified(rows, "f", ["c"]), "f", ["c"])
    assert got.columns[:3] == ["_origem", "_linha", "hash_origem"]
    assert sorted((r["_linha"], r["c"], r["_substituido"]) for r in got.collect()) == [(1, "y", True), (2, "y", True), (3, "x", False)]

"""What quality tests and counts of rules move and stage of the classified rows."""

import pytest
from pyspark.sql import functions as F

from auric.operators import classify
from auric.plans import model, q_quality
from auric.plans.model import Model
from auric.plans.registry import REGISTRY, load_all

SF = "/root/testdata/sf0.001"


def _nodes(plan, name):
    found = [plan] if plan.nodeName() == name else []
    sides = plan.children()
    for i in range(sides.size()):
        found += _nodes(sides.apply(i), name)
    return found


def _moved(plan):
    """Names of the columns that a node gives."""
    out = plan.output()
    return {out.apply(i).name() for i in range(out.size())}


@pytest.mark.parametrize("key", ["dq_results", "dq_uniqueness", "dq_references"])
def test_quality_stages_no_more_of_the_rows_than_it_reads(spark, monkeypatch, key):
    load_all()
    staged = []
    for module in (model, q_quality):
        monkeypatch.setattr(module, "stage", lambda df, name="stage", real=module.stage: staged.append(df.columns) or real(df, name))
    REGISTRY[key].build(Model(spark, SF))
    assert staged and not any({"registro", "mensagem", "chave_registro"} & set(cols) for cols in staged)
    if key != "dq_results":  # each source is read once, so its rows are not staged at all
        assert not any("regra" in cols and "falhos" not in cols for cols in staged)


def test_counts_of_rules_move_neither_messages_nor_fields_that_were_judged(spark):
    m = Model(spark, SF)
    plan = m._classified("recomendacoes").groupBy("regra").count()._jdf.queryExecution().optimizedPlan()
    dealt = _nodes(plan, "RepartitionByExpression")[0]
    joined = _nodes(plan, "Join")
    assert "falha" in _moved(dealt) and len(joined) == 2
    for node in (dealt, *(j.children().apply(0) for j in joined)):
        assert not {"falha_mensagem", "v_ausentes", "v_classe", "v_pontuacao", "v_posicao", "pontuacao"} & _moved(node)


def test_only_records_with_replaced_fields_are_hashed_anew(spark):
    rows = spark.createDataFrame([("a", 1, "x", "0" * 32, False), ("a", 2, "x", "1" * 32, True)],
                                 "_origem string, _linha long, c string, hash_origem string, _substituido boolean")
    got = classify._prepare(rows, ["c"]).select("_linha", F.lower(F.hex("_hash")).alias("h"), F.hex("hash_origem").alias("d")).collect()
    own = rows.select(classify.content_hash(["c"])).first()[0]
    assert {tuple(r) for r in got} == {(1, "0" * 32, None), (2, own, "1" * 32)}

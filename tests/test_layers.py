"""Triage over several rounds, gated publish of Silver and Gold, and tests with validity."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from auric.operators import classify, layers
from auric.operators import quality as Q
from auric.operators.triage import ID, Triage, identified
from auric.plans import raw
from auric.plans.model import RUN_DATE, RUN_TS
from auric.session import stage
from auric.sources.store import PublishRefused, TableStore

KEY, SALT = "chave-de-teste-longa-1", "salt-de-teste-longo-001"
CAT = list(raw.CATALOG_COLS)
USR = list(raw.USER_COLS)


def delivery(spark, rows, cols):
    return spark.createDataFrame([("f.csv", n, *r) for n, r in enumerate(rows, 1)], "_origem string, _linha long, " + ", ".join(f"{c} string" for c in cols))


def catalog(spark, *rows):
    return delivery(spark, rows, CAT)


def content(i, titulo="T", tipo="curso", nivel="basico", carga="10"):
    return (str(i), titulo, tipo, "Dados", nivel, carga, "2023-01-05", None, "A")


def user(i, email=None, uf="SP", cpf=None):
    return (str(i), f"Ana Maria {i}", email or f"ana{i}@example.com", cpf or f"{i:011d}", "1990-01-01", None, "X", uf, "2021-01-01", None)


def judge_catalog(t, df):
    return stage(classify.catalog(t.overlay(identified(df, "catalogo", CAT), "catalogo", CAT).where("not _descartado")))


def status(t):
    return {(r._linha, r.hash_origem[:6]): r.status for r in t.state().collect()}


def by_line(t, col="status"):
    return {r._linha: r[col] for r in t.state().collect()}


def test_overlay_joins_nothing_before_the_first_run_and_flags_waiting_records(spark, tmp_dir):
    t = Triage(spark, f"{tmp_dir}/q", f"{tmp_dir}/r")
    day1 = catalog(spark, content(1), content(2, tipo="Webinar"), content(3, tipo="Webinar"), content(4, carga="x"))
    rows = identified(day1, "catalogo", CAT)
    first = t.overlay(rows, "catalogo", CAT)
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString() and first.where("_aguardava").count() == 0
    t.record_run("r1", {"catalogo": judge_catalog(t, day1)})
    s = t.state()
    t.edit(s.where("_linha = 2").select(*ID, F.lit("tipo").alias("campo"), F.lit("Curso").alias("valor")))
    t.discard(s.where("_linha = 4"))
    twice = t.overlay(rows.unionByName(rows.where("_linha in (2, 4)")).unionByName(rows.where("_linha = 3").withColumn("_linha", F.lit(None).cast("long"))), "catalogo", CAT)
    got = sorted((r._linha or 0, r.tipo, r._descartado, r._substituido, r._aguardava) for r in twice.collect())
    curso = content(1)[CAT.index("tipo")]
    assert got == [(0, "Webinar", False, False, False), (1, curso, False, False, False), *[(2, "Curso", False, True, True)] * 2,
                   (3, "Webinar", False, False, True), *[(4, curso, True, False, False)] * 2]
    again = judge_catalog(t, day1)
    assert {r._linha for r in again.where("_aguardava").collect()} == {2, 3}
    t.record_run("r2", {"catalogo": again.drop("_aguardava")})  # without the flag all rows are looked up
    assert by_line(t) == {2: "reprocessado", 3: "pendente", 4: "descartado"}


def test_two_rounds_of_triage(spark, tmp_dir):
    t = Triage(spark, f"{tmp_dir}/q", f"{tmp_dir}/r")
    assert t.state().count() == 0 and t.edits(restricted=True).count() == 0
    day1 = catalog(spark, content(1), content(2, tipo="Webinar"), content(3, tipo="Webinar", carga="-4"), content(4, nivel="expert"), content(5, carga="x"))
    t.record_run("r1", {"catalogo": judge_catalog(t, day1)})
    assert by_line(t) == {2: "pendente", 3: "pendente", 4: "pendente", 5: "pendente"}

    s = t.state()
    t.edit(s.where("_linha in (2, 3)").select(*ID, F.lit("tipo").alias("campo"), F.lit("Curso").alias("valor")).unionByName(
        s.where("_linha = 4").select(*ID, F.lit("nivel").alias("campo"), F.lit("Básico").alias("valor"))))
    t.discard(s.where("_linha = 5"))
    assert by_line(t) == {2: "corrigido", 3: "corrigido", 4: "corrigido", 5: "descartado"}
    assert {(r._linha, r.campo, r.antes, r.depois) for r in t.diff().collect()} == {(2, "tipo", "Webinar", "Curso"), (3, "tipo", "Webinar", "Curso"), (4, "nivel", "expert", "Básico")}

    # line 4 is delivered anew with other content: its edit is stale, the new record waits on its own
    day2 = catalog(spark, content(1), content(2, tipo="Webinar"), content(3, tipo="Webinar", carga="-4"), content(4, nivel="expert", titulo="Outro"), content(5, carga="x"))
    again = judge_catalog(t, day2)
    assert again.where("regra is null").count() == 2 and again.count() == 4
    t.record_run("r2", {"catalogo": again})
    states = [(r._linha, r.status, r.regra) for r in t.state().collect()]
    assert sorted(states) == [(2, "reprocessado", "DOMINIO"), (3, "pendente", "VALOR_NEGATIVO"), (4, "corrigido", "DOMINIO"), (4, "pendente", "DOMINIO"), (5, "descartado", "TIPO_INVALIDO")]

    # second round: line 3 needs another field; its first edit still holds
    t.edit(t.state().where("_linha = 3").select(*ID, F.lit("carga_horaria_min").alias("campo"), F.lit("4").alias("valor")))
    third = judge_catalog(t, day2)
    assert sorted(r.conteudo_id for r in third.where("regra is null").collect()) == [1, 2, 3]
    t.record_run("r3", {"catalogo": third})
    assert sorted((r._linha, r.status) for r in t.state().collect()) == [(2, "reprocessado"), (3, "reprocessado"), (4, "corrigido"), (4, "pendente"), (5, "descartado")]
    ids = {r._linha: (r.execucao_id, r.ultima_execucao_id) for r in t.state().where("_linha <> 4").collect()}
    assert ids[3] == ("r1", "r2") and ids[2] == ("r1", "r1")

    # a step that died while writing does not count
    spark.range(1).write.parquet(f"{tmp_dir}/other")
    before = t.state().count()
    import os
    os.makedirs(f"{tmp_dir}/q/eventos/passo=99/_temporary")
    assert t.state().count() == before and t._append(t.events().limit(0)) == 7  # after r1, edits, discards, r2, edits, r3


def test_personal_values_stay_restricted(spark, tmp_dir):
    t = Triage(spark, f"{tmp_dir}/q", f"{tmp_dir}/r")
    day = delivery(spark, [user(1), user(2, email="ana2.example.com"), user(3, uf="XX")], USR)
    judge = lambda: stage(classify.users(t.overlay(identified(day, "usuarios", USR), "usuarios", USR).where("not _descartado"), RUN_DATE, KEY, SALT))
    t.record_run("r1", {"usuarios": judge()})
    s = t.state()
    t.edit(s.where("_linha = 2").select(*ID, F.lit("email").alias("campo"), F.lit("certa@example.com").alias("valor")).unionByName(
        s.where("_linha = 3").select(*ID, F.lit("uf").alias("campo"), F.lit("RJ").alias("valor"))))
    shown = str(t.events().collect()) + str(t.diff().collect())
    assert "certa@" not in shown and "ana2.example" not in shown and "00000000002" not in shown and "c***@example.com" in shown
    ok = judge()
    assert ok.where("regra is null").count() == 3
    assert ok.where("usuario_id = 2").first().email_mascarado == "c***@example.com"
    t.record_run("r2", {"usuarios": ok})
    assert by_line(t) == {2: "reprocessado", 3: "reprocessado"}


def classified(spark, run, users=2, broken_event=False):
    c = stage(classify.catalog(catalog(spark, content(1), content(2, titulo="U"))))
    u = stage(classify.users(delivery(spark, [user(1), user(2, cpf=f"{1:011d}"), user(3)][:users], USR), RUN_DATE, KEY, SALT))
    cols = list(raw.EVENT_COLS)
    ev = [("1", "1", "visualizacao", "2024-01-10T10:00:00", "5", None, None), ("2", "1", "conclusao", "2024-01-11T10:00:00", "5", "100", None), ("9", "1", "inicio", "2024-01-11T10:00:00", "5", "3", None)]
    users_ok, content_ok = classify.accepted_keys(u, "usuario_id"), classify.accepted_keys(c, "conteudo_id", ["data_publicacao"])
    e = stage(classify.events(delivery(spark, ev, cols), RUN_TS, users_ok, content_ok))
    if broken_event:  # an event of nobody slips through
        e = e.withColumn("regra", F.lit(None).cast("string"))
    m = classify.comments(delivery(spark, [("1", "1", "5", "bom", "[]", "2024-01-12")], list(raw.COMMENT_COLS)), RUN_DATE, users_ok, content_ok)
    r = classify.recommendations(delivery(spark, [("1", "1", "80", "2", "positivo", "2024-01-01T00:00:00"), ("2", "1", "70", "1", "positivo", "2024-01-01T00:00:00")], list(raw.REC_COLS)), users_ok, content_ok.select("conteudo_id"))
    out = {"catalogo": c, "usuarios": u, "interacoes": e, "comentarios": stage(m), "recomendacoes": stage(r)}
    return {k: df.withColumn("_execucao_id", F.lit(run)) for k, df in out.items()}


def verdict(spark, run, ok, severity="critica"):
    return spark.createDataFrame([(run, "Q1", ok, severity)], "execucao_id string, teste_id string, aprovado boolean, severidade string")


def test_silver_and_gold_are_published_behind_gates(spark, tmp_dir):
    silver, gold = TableStore(spark, f"{tmp_dir}/s"), TableStore(spark, f"{tmp_dir}/g")
    rows = classified(spark, "r1")
    other = dict(rows, comentarios=rows["comentarios"].withColumn("_execucao_id", F.lit("r0")))
    with pytest.raises(PublishRefused, match="not of run r1"):
        layers.publish_silver(silver, "r1", other, KEY, f"{tmp_dir}/restrito")
    with pytest.raises(PublishRefused, match="no content or no user"):
        layers.publish_silver(silver, "r1", dict(rows, usuarios=rows["usuarios"].limit(0)), KEY, f"{tmp_dir}/restrito")
    with pytest.raises(PublishRefused, match="is of run None"):
        layers.publish_gold(silver, gold, "r1", verdict(spark, "r1", True))
    with pytest.raises(PublishRefused, match="interacao: usuario_id"):
        layers.publish_silver(silver, "r1", classified(spark, "r1", broken_event=True), KEY, f"{tmp_dir}/restrito")
    assert silver.current() is None

    layers.publish_silver(silver, "r1", rows, KEY, f"{tmp_dir}/restrito")
    assert sorted(silver.current()["tabelas"]) == sorted([*layers.SILVER_KEYS, "usuario_pseudonimo"])
    assert "/restrito/" in silver.current()["tabelas"]["usuario_pseudonimo"]["caminho"]
    assert [r.interacao_id for r in silver.read("interacao").orderBy("_linha").collect()] == [1, 2]
    assert silver.read("usuario_mestre").count() == 1  # both accounts have one CPF

    with pytest.raises(PublishRefused, match="has not been judged"):
        layers.publish_gold(silver, gold, "r1", verdict(spark, "r0", True))
    with pytest.raises(PublishRefused, match="critical tests of run r1 failed: Q1"):
        layers.publish_gold(silver, gold, "r1", verdict(spark, "r1", False))
    assert gold.current() is None
    layers.publish_gold(silver, gold, "r1", verdict(spark, "r1", False, "alta"))
    assert len(gold.current()["tabelas"]) == 9 and gold.current()["silver"] == 1
    rec = gold.read("fato_recomendacao").collect()
    assert len(rec) == 1 and rec[0].posicao == 1 and rec[0].convertida_em == dt.datetime(2024, 1, 10, 10)
    assert "usuario_id" not in gold.read("fato_interacao").columns and gold.read("kpi_taxa_conclusao").first().pares_concluidos == 1

    with pytest.raises(PublishRefused, match="is of run r1, not of r2"):
        layers.publish_gold(silver, gold, "r2", verdict(spark, "r2", True))
    layers.publish_silver(silver, "r2", classified(spark, "r2", users=1), KEY, f"{tmp_dir}/restrito")
    assert silver.read("usuario").count() == 1 and silver.read("usuario_pseudonimo").count() == 2  # known accounts stay in the map
    assert gold.current()["execucao_id"] == "r1" and gold.read("dim_usuario").count() == 1


def test_thresholds_hold_from_a_day_on(spark):
    d = dt.date
    test = lambda limit, op=">=": Q.QualityTest("Q1", "n", "d", op, limit, "critica", None)
    defs = Q.definitions(spark, [test(90)], d(2024, 1, 1))
    defs = defs.unionByName(Q.definitions(spark, [test(50)], d(2024, 2, 1), 1)).unionByName(Q.definitions(spark, [test(60)], d(2024, 2, 1), 2))
    measured = spark.createDataFrame([("r", "Q1", "f", 100, 30), ("r", "Q2", "f", 1, 0)], "execucao_id string, teste_id string, fonte string, total long, falhos long")
    at = lambda day: [(r.limite_aceitavel, r.aprovado) for r in Q.judged(measured, Q.as_of(defs, day)).collect()]
    assert at(d(2023, 12, 31)) == [] and at(d(2024, 1, 31)) == [(90.0, False)] and at(d(2024, 2, 1)) == [(60.0, True)]
    old = Q.judged(measured, Q.as_of(defs, d(2024, 1, 5)))
    frozen = old.collect()
    defs = defs.unionByName(Q.definitions(spark, [test(10)], d(2024, 1, 3), 3))
    assert old.collect() == frozen and at(d(2024, 1, 5)) == [(10.0, True)]
    legacy = old.withColumns({"operador": F.lit(None).cast("string"), "limite_aceitavel": F.lit(None).cast("double"), "severidade": F.lit(None).cast("string")})
    runs = spark.createDataFrame([("r", d(2024, 2, 2))], "execucao_id string, dia date")
    assert Q.backfill(legacy, runs, defs).first().limite_aceitavel == 60.0
    assert Q.backfill(old, runs, defs).first().limite_aceitavel == 90.0

"""Classifier behaviour on inline raw rows (cases of the reference's tests)."""

from auric.operators import classify
from auric.plans.raw import CATALOG_COLS

L1 = "dados/brutos/catalogo.csv"
L2 = "dados/brutos/lote_2/catalogo.csv"


def raw(spark, rows):
    cols = list(CATALOG_COLS)
    full = [(o, ln, *[r.get(c) for c in cols]) for o, ln, r in rows]
    schema = "_origem string, _linha int, " + ", ".join(f"{c} string" for c in cols)
    return spark.createDataFrame(full, schema)


def base(i, **kw):
    r = {"conteudo_id": str(i), "titulo": f"Curso {i}", "tipo": "Curso", "categoria": "Banco de Dados",
         "nivel": "Básico", "carga_horaria_min": "30", "data_publicacao": "2024-01-01"}
    r.update(kw)
    return r


def run(spark, rows):
    out = classify.catalog(raw(spark, rows)).collect()
    return {(r["_origem"], r["_linha"]): r for r in out}


def test_normalisation_and_first_spelling(spark):
    got = run(spark, [
        (L1, 2, base(1, categoria="Banco de Dados")),
        (L1, 3, base(2, tipo="  video ", nivel="AVANCADO", categoria="banco   de dados")),
    ])
    r = got[(L1, 3)]
    assert r["regra"] is None and r["tipo"] == "Vídeo" and r["nivel"] == "Avançado"
    assert r["categoria"] == "Banco de Dados"  # first spelling wins


def test_rules_in_order(spark):
    got = run(spark, [
        (L1, 2, base(1)),
        (L1, 3, base(2, carga_horaria_min="-3")),
        (L1, 4, base(3, nivel="expert")),
        (L1, 5, base(4, data_publicacao="31/02/2024")),
        (L1, 6, base(5, conteudo_id="7.9")),
        (L1, 7, base(6, conteudo_id="")),
        (L1, 8, base(7, titulo="   ", carga_horaria_min="x")),
    ])
    assert [got[(L1, i)]["regra"] for i in range(2, 9)] == [
        None, "VALOR_NEGATIVO", "DOMINIO", "DATA_INVALIDA", "TIPO_INVALIDO", "CAMPO_OBRIGATORIO",
        "CAMPO_OBRIGATORIO"]
    assert got[(L1, 3)]["severidade"] == "media" and got[(L1, 7)]["severidade"] == "alta"


def test_copy_version_and_supersession(spark):
    got = run(spark, [
        (L1, 2, base(1)),
        (L1, 3, base(1)),                          # identical copy → DUPLICADO
        (L1, 4, base(2)),
        (L1, 9, base(2, titulo="Curso 2 rev")),    # same file, later line wins → line 4 conflicts
        (L1, 5, base(3)),
        (L2, 2, base(3, titulo="Curso 3 (2a ed.)")),  # newer batch wins; old version silently dropped
    ])
    assert got[(L1, 3)]["regra"] == "DUPLICADO"
    assert got[(L1, 4)]["regra"] == "CONFLITO_VERSAO" and got[(L1, 9)]["regra"] is None
    assert (L1, 5) not in got and got[(L2, 2)]["regra"] is None


def test_rejected_users_keep_a_masked_record(spark):
    from auric.plans.registry import model_for

    rej = model_for(spark, "/root/testdata/sf0.001").cls_usuarios.where("regra is not null")
    assert rej.count() > 0 and rej.where("registro is null").count() == 0
    assert rej.where(r"registro rlike '(?i)cliente[0-9]+@|[0-9]{11}'").count() == 0


def test_classifying_writes_nothing_between_its_steps(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows were written between the steps")

    monkeypatch.setattr(classify, "stage", refuse, raising=False)
    got = run(spark, [(L1, 2, base(1)), (L1, 3, base(1)), (L1, 4, base(2, tipo="x")), (L1, 5, base("")), (L1, 6, base(""))])
    assert [got[(L1, i)]["regra"] for i in range(2, 7)] == [None, "DUPLICADO", "DOMINIO", "CAMPO_OBRIGATORIO", "CAMPO_OBRIGATORIO"]
    assert got[(L1, 2)]["registro"] is None and '"tipo":"x"' in got[(L1, 4)]["registro"]
    assert len(got[(L1, 2)]["hash_origem"]) == 32 and got[(L1, 2)]["hash_origem"] == got[(L1, 3)]["hash_origem"]


def test_rule_counts_move_neither_texts_nor_records(spark):
    from auric.plans.registry import model_for

    plan = model_for(spark, "/root/testdata/sf0.001").cls_todos.groupBy("regra").count()._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.splitlines() if "RepartitionByExpression" in line]
    assert len(dealt) == 5 and "to_json" not in plan
    assert not any("comentario" in line or "v_texto#" in line for line in dealt)


def test_first_of_a_business_key_among_copies_and_rejected(spark):
    from pyspark.sql import functions as F

    from auric.operators import dedupe

    rows = [("a", 1, "k", "h1", None), ("a", 1, "k", "h1", None), ("a", 2, "k", "h1", None), ("a", 3, "k", "h2", None),
            ("a", 0, "k", "h1", "DOMINIO"), ("a", 5, None, "h3", "TIPO"), ("a", 6, None, "h3", "TIPO")]
    df = spark.createDataFrame(rows, "_origem string, _linha long, k string, _hash string, falha string")
    got = sorted((r["_linha"], r["e_copia"], r["conflito"]) for r in dedupe.first_by_business_key(df, ["k"], [F.col("_linha"), F.col("_origem")]).collect() if r["falha"] is None)
    assert got == [(1, False, False), (1, False, False), (2, True, False), (3, False, True)]
    assert all(r["e_copia"] is None for r in dedupe.first_by_business_key(df, ["k"], [F.col("_linha")]).where("falha is not null").collect())


def test_rows_are_sorted_without_a_struct_of_their_order(spark):
    from auric.plans.registry import model_for

    m = model_for(spark, "/root/testdata/sf0.001")
    for fonte in ("interacoes", "comentarios", "recomendacoes"):
        plan = m._classified(fonte).groupBy("regra").count()._jdf.queryExecution().optimizedPlan().toString()
        assert "Window [" in plan and "AS _w0" not in plan


def test_first_of_a_business_key_with_null_places_and_a_given_number_of_partitions(spark):
    from pyspark.sql import functions as F

    from auric.operators import dedupe

    rows = [("a", None, "k", "h2", None), ("b", 1, "k", "h1", None), (None, None, "k", "h1", None), ("a", 1, None, "h1", None)]
    df = spark.createDataFrame(rows, "_origem string, _linha long, k string, _hash string, falha string")
    got = dedupe.first_by_business_key(df, ["k"], [F.col("_linha"), F.col("_origem")], 3).collect()
    assert {(r["_origem"], r["_linha"], r["k"]): (r["e_copia"], r["conflito"], r["primeiro"] and r["primeiro"]["_hash"]) for r in got} == {
        (None, None, "k"): (False, False, "h1"), ("a", None, "k"): (False, True, "h1"), ("b", 1, "k"): (True, False, "h1"), ("a", 1, None): (None, None, None)}


def test_partitions_grow_with_the_table_alone(spark, monkeypatch):
    from auric.operators import dedupe

    df = spark.range(1000)
    assert dedupe.partitions_for(df) == 0
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for times in (2, 20):
        monkeypatch.setattr(dedupe, "estimated_bytes", lambda d: times * session * dedupe.PARTITION_BYTES)
        assert dedupe.partitions_for(df) == times * session + 1
    monkeypatch.setattr(dedupe, "estimated_bytes", lambda d: 1 << 62)
    assert dedupe.partitions_for(df) == 0

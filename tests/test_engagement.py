"""Monthly engagement: two ids of one person, a NULL minutes value
(the reference's runner test), and the associative combine."""

import datetime as dt

from auric.operators import gold


def test_two_ids_one_person(spark):
    ev = spark.createDataFrame(
        [(12, 5, "visualização", dt.datetime(2026, 8, 1, 10), 90),
         (171, 5, "conclusão", dt.datetime(2026, 8, 2, 10), None)],
        "usuario_id long, conteudo_id long, tipo_interacao string, data_hora timestamp_ntz, tempo_consumido int")
    cont = spark.createDataFrame([(5, "Dados")], "conteudo_id long, categoria string")
    corr = spark.createDataFrame([(12, 12), (171, 12)], "usuario_id long, usuario_mestre_id long")
    r = gold.engagement_by_month(ev, cont, corr).first()
    assert (r["mes"], r["categoria"], r["interacoes"], r["pessoas_ativas"], r["conclusoes"],
            r["minutos_consumidos"]) == ("2026-08", "Dados", 2, 1, 1, 90)


def test_missing_person_falls_back_to_account(spark):
    ev = spark.createDataFrame([(1, 5, "início", dt.datetime(2026, 8, 1), 3), (2, 5, "início", dt.datetime(2026, 8, 1), 4),
                                (3, 5, "conclusão", dt.datetime(2026, 8, 3), 10)],
                               "usuario_id long, conteudo_id long, tipo_interacao string, data_hora timestamp_ntz, "
                               "tempo_consumido int")
    cont = spark.createDataFrame([(5, "Dados")], "conteudo_id long, categoria string")
    corr = spark.createDataFrame([(1, 1)], "usuario_id long, usuario_mestre_id long")
    r = gold.engagement_by_month(ev, cont, corr).first()
    assert (r["interacoes"], r["pessoas_ativas"], r["conclusoes"], r["minutos_consumidos"]) == (3, 3, 1, 17)

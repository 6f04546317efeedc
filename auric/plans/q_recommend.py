"""Recommendation, vector and semantic-search queries (SURVEY 2.8, 2.5 #35,
2.7 #2-3, 2.4 #10)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from auric.operators import recommend as RC
from auric.operators import vectors as V
from auric.operators.joins import bounded
from auric.plans.model import MIN_GOOD_GRADE
from auric.plans.registry import query
from auric.plans.sqlmodel import with_

query("reco_indices", with_("r_cat") + "SELECT usuario_id, categoria, ivis, icur FROM r_cat")(
    lambda m: RC.category_indices(m.interacao, m.conteudo, MIN_GOOD_GRADE))

query("reco_score", with_("r_cat") + """
SELECT usuario_id, categoria, round(((ivis + icur) / 2) * 100 * 1, 2) AS pontuacao FROM r_cat""")(
    lambda m: RC.category_indices(m.interacao, m.conteudo, MIN_GOOD_GRADE).select(
        "usuario_id", "categoria", RC.score(F.col("ivis"), F.col("icur"), F.lit(1)).alias("pontuacao")))

query("reco_class", with_("r_cat") + """
SELECT usuario_id, categoria, pontuacao,
       CASE WHEN pontuacao <= 40 THEN 'negativo' WHEN pontuacao >= 70 THEN 'positivo' ELSE 'estavel' END
         AS classificacao
  FROM (SELECT usuario_id, categoria, round(((ivis + icur) / 2) * 100 * 1, 2) AS pontuacao FROM r_cat) s""")(
    lambda m: RC.category_indices(m.interacao, m.conteudo, MIN_GOOD_GRADE).withColumn(
        "pontuacao", RC.score(F.col("ivis"), F.col("icur"), F.lit(1))).select(
        "usuario_id", "categoria", "pontuacao", RC.classify(F.col("pontuacao"), F.lit(1)).alias("classificacao")))

query("recommend_topk", with_("recomendacao") + """
SELECT usuario_id, conteudo_id, pontuacao, posicao, classificacao, round(afinidade, 4) AS afinidade
  FROM recomendacao""")(
    lambda m: m.recomendacao.select("usuario_id", "conteudo_id", "pontuacao", "posicao", "classificacao",
                                    F.round("afinidade", 4).alias("afinidade")))

query("reco_summary", with_("recomendacao", "usuario_raw") + """
SELECT classificacao, count(*) AS recomendacoes, count(DISTINCT usuario_id) AS usuarios_com_recomendacao,
       (SELECT count(*) FROM usuario_raw) AS usuarios
  FROM recomendacao GROUP BY classificacao""")(
    lambda m: m.recomendacao.groupBy("classificacao").agg(
        F.count(F.lit(1)).alias("recomendacoes"),
        F.count_distinct("usuario_id").alias("usuarios_com_recomendacao")).select(
        "*", m.usuario_raw.agg(F.count(F.lit(1))).scalar().alias("usuarios")))

query("embedding_pending", with_("conteudo", "embedding") + """
SELECT c.conteudo_id, c.titulo FROM conteudo c
  LEFT JOIN embedding e ON e.conteudo_id = c.conteudo_id AND e.modelo = 'hash-64'
 WHERE e.conteudo_id IS NULL""")(
    lambda m: m.conteudo.join(m.embedding.where(F.col("modelo") == "hash-64").select("conteudo_id"),
                              "conteudo_id", "left_anti").select("conteudo_id", "titulo"))


def _encode(m):
    from auric.operators import embed

    pending = m.conteudo.join(m.embedding.select("conteudo_id"), "conteudo_id", "left_anti").select(
        "conteudo_id", F.col("titulo").alias("texto"))
    enc = embed.encode(pending, "conteudo_id", "texto", dim=64)
    return enc.select("conteudo_id", F.size("embedding").alias("dimensao"),
                      F.round(V.norm("embedding"), 6).alias("norma"), "falhou")


query("embedding_encode", with_("conteudo", "embedding") + """
SELECT conteudo_id, 64 AS dimensao, 1.0::DOUBLE AS norma, FALSE AS falhou FROM conteudo
 WHERE conteudo_id NOT IN (SELECT conteudo_id FROM embedding)""")(_encode)

query("vector_normalize", """
SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norma,
       round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(
             CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))))), 6) AS soma_normalizada,
       len(embedding) = 64 AS dimensao_ok
  FROM embeddings""")(
    lambda m: m.t("embeddings").select(
        "vec_id", F.round(V.norm("embedding"), 6).alias("norma"),
        F.round(F.aggregate(V.normalize("embedding"), F.lit(0.0), lambda s, x: s + x), 6).alias("soma_normalizada"),
        V.check_dimension("embedding", 64).alias("dimensao_ok")))

query("vector_profile", with_("r_perfil") + """
SELECT usuario_id, len(perfil) AS dimensao, round(list_sum(perfil), 6) AS soma, round(perfil[1], 6) AS primeiro
  FROM r_perfil""")(
    lambda m: RC.user_profiles(m.interacao, m.embedding).select(
        "usuario_id", F.size("perfil").alias("dimensao"),
        F.round(F.aggregate("perfil", F.lit(0.0), lambda s, x: s + x), 6).alias("soma"),
        F.round(F.col("perfil")[0], 6).alias("primeiro")))


def _semantic_topk(m, k: int = 5):
    """Nearest neighbours of one query vector (the first embedding): the
    query is a scalar subquery, the corpus is scanned once and each task
    keeps its own top k before the final merge."""
    e = m.t("embeddings").select("vec_id", "embedding")
    q = e.agg(F.min_by("embedding", "vec_id")).scalar()
    s = e.select("vec_id", "embedding", q.alias("consulta")) \
        .select("vec_id", V.cosine("embedding", "consulta").alias("sim"))
    return s.orderBy(F.col("sim").desc(), "vec_id").limit(k).select(
        F.row_number().over(Window.orderBy(F.col("sim").desc(), "vec_id")).alias("posicao"),
        F.col("vec_id").alias("conteudo_id"), F.round("sim", 4).alias("similaridade"))


COS = ("list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))")
query("semantic_topk", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings),
q AS (SELECT a AS b FROM e ORDER BY vec_id LIMIT 1),
s AS (SELECT vec_id, {COS} AS sim FROM e CROSS JOIN q)
SELECT row_number() OVER (ORDER BY sim DESC, vec_id) AS posicao, vec_id AS conteudo_id, round(sim, 4) AS similaridade
  FROM s ORDER BY sim DESC, vec_id LIMIT 5""")(_semantic_topk)


def _semantic_batch(m, k: int = 5):
    """A batch of saved queries — one centroid per label — ranked against
    the whole corpus; the query side has one row per label and is
    broadcast only behind the size check."""
    e = m.t("embeddings").select("vec_id", "embedding", "label")
    queries = V.mean_vector(e.select(F.col("label").alias("consulta"), "embedding"), "consulta", "embedding") \
        .withColumnRenamed("embedding", "qv")
    s = e.crossJoin(bounded(queries)).select("consulta", "vec_id", V.cosine("embedding", "qv").alias("sim"))
    w = Window.partitionBy("consulta").orderBy(F.col("sim").desc(), "vec_id")
    return s.withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= k).select(
        "consulta", "posicao", F.col("vec_id").alias("conteudo_id"), F.round("sim", 4).alias("similaridade"))


query("semantic_batch", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS a FROM embeddings),
q AS (SELECT consulta, list(v ORDER BY pos) AS b FROM (
        SELECT label AS consulta, u.pos, avg(u.x) AS v FROM e, unnest(e.a) WITH ORDINALITY AS u(x, pos)
         GROUP BY label, u.pos) s GROUP BY consulta),
s AS (SELECT q.consulta, e.vec_id, {COS} AS sim FROM e CROSS JOIN q)
SELECT consulta, posicao, conteudo_id, similaridade FROM (
  SELECT consulta, row_number() OVER (PARTITION BY consulta ORDER BY sim DESC, vec_id) AS posicao,
         vec_id AS conteudo_id, round(sim, 4) AS similaridade FROM s) r
 WHERE posicao <= 5""")(_semantic_batch)

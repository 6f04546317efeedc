"""Classifier, rule and survivorship queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from auric.operators import rules as R
from auric.plans import sqlclassify  # noqa: F401  (registers the classifier CTEs)
from auric.plans.chain import RUN1
from auric.plans.registry import query
from auric.plans.sqlmodel import with_

CAT_COLS = ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao",
            "descricao", "autor", "_origem", "_linha", "fonte", "chave_registro", "regra", "severidade"]
USR_COLS = ["usuario_id", "usuario_pseudo", "nome_mascarado", "email_mascarado", "email_hash", "cpf_hash",
            "faixa_etaria", "cidade", "uf", "data_cadastro", "atualizado_em", "_origem", "_linha", "fonte",
            "chave_registro", "regra", "severidade"]
EVT_COLS = ["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao",
            "avaliacao_atribuida", "_origem", "_linha", "fonte", "regra", "severidade"]
COM_COLS = ["usuario_id", "conteudo_id", "avaliacao", "comentario", "tags", "data", "_origem", "_linha", "fonte",
            "regra", "severidade"]
REC_COLS = ["usuario_id", "conteudo_id", "pontuacao", "posicao", "classificacao", "gerado_em", "_origem", "_linha",
            "fonte", "regra", "severidade"]


def _sel(cols):
    return ", ".join(cols)


query("classify_catalog", with_("cls_catalogo") + f"SELECT {_sel(CAT_COLS)} FROM cls_catalogo")(
    lambda m: m.cls_catalogo.select(*CAT_COLS))
query("classify_users", with_("cls_usuarios") + f"SELECT {_sel(USR_COLS)} FROM cls_usuarios")(
    lambda m: m.cls_usuarios.select(*USR_COLS))
query("classify_events", with_("cls_interacoes") + f"SELECT {_sel(EVT_COLS)} FROM cls_interacoes")(
    lambda m: m.cls_interacoes.select(*EVT_COLS))
query("classify_comments", with_("cls_comentarios") + f"SELECT {_sel(COM_COLS)} FROM cls_comentarios")(
    lambda m: m.cls_comentarios.withColumn("tags", F.array_join("tags", ",")).select(*COM_COLS))
query("classify_recs", with_("cls_recomendacoes") + f"SELECT {_sel(REC_COLS)} FROM cls_recomendacoes")(
    lambda m: m.cls_recomendacoes.select(*REC_COLS))

ALL = with_("cls_todos")

query("route_accept_reject", ALL + """
SELECT fonte, count(*) FILTER (WHERE regra IS NULL) AS aprovados, count(*) FILTER (WHERE regra IS NOT NULL) AS rejeitados
  FROM cls_todos GROUP BY fonte""")(
    lambda m: m.cls_todos.groupBy("fonte").agg(F.count_if(F.col("regra").isNull()).alias("aprovados"),
                                               F.count_if(F.col("regra").isNotNull()).alias("rejeitados")))

query("ingest_summary", ALL + """
SELECT fonte, count(*) AS lidos, count(*) FILTER (WHERE regra IS NULL) AS aprovados,
       count(*) FILTER (WHERE severidade = 'alta') AS rejeitados_alta,
       count(*) FILTER (WHERE severidade = 'media') AS rejeitados_media,
       count(*) FILTER (WHERE severidade = 'baixa') AS rejeitados_baixa
  FROM cls_todos GROUP BY fonte""")(
    lambda m: m.cls_todos.groupBy("fonte").agg(
        F.count(F.lit(1)).alias("lidos"), F.count_if(F.col("regra").isNull()).alias("aprovados"),
        *[F.count_if(F.col("severidade") == s).alias(f"rejeitados_{s}") for s in ("alta", "media", "baixa")]))

query("rule_severity", ALL + """
SELECT regra, severidade, count(*) AS registros FROM cls_todos WHERE regra IS NOT NULL GROUP BY regra, severidade""")(
    lambda m: m.cls_todos.where(F.col("regra").isNotNull()).groupBy("regra", "severidade").agg(
        F.count(F.lit(1)).alias("registros")))


def _rule_counts(codes):
    sql = ALL + f"""
SELECT fonte, regra, count(*) AS registros FROM cls_todos
 WHERE regra IN ({', '.join(f"'{c}'" for c in codes)}) GROUP BY fonte, regra"""

    def build(m):
        return m.cls_todos.where(F.col("regra").isin(codes)).groupBy("fonte", "regra").agg(
            F.count(F.lit(1)).alias("registros"))

    return sql, build


for _key, _codes in {
    "rule_required": [R.REQUIRED], "rule_type": [R.TYPE], "rule_date": [R.DATE], "rule_domain": [R.DOMAIN],
    "rule_range": [R.RANGE], "rule_negative": [R.NEGATIVE], "rule_future": [R.FUTURE],
    "rule_reference": [R.REF_USER, R.REF_CONTENT], "rule_before_publication": [R.BEFORE_PUBLICATION],
    "rule_consistency": [R.CONSISTENCY], "rule_format": [R.FORMAT], "rule_duplicate": [R.DUPLICATE],
    "rule_version_conflict": [R.VERSION_CONFLICT],
}.items():
    _sql, _build = _rule_counts(_codes)
    query(_key, _sql)(_build)


# versions that lost to another file, counted by their flag while the first run wrote
query("superseded_versions", with_("cls_catalogo_tudo", "cls_usuarios_tudo") + """
SELECT 'catalogo' AS fonte, count(*) AS lidos, count(*) FILTER (WHERE NOT superado) AS classificados,
       count(*) FILTER (WHERE superado) AS superados FROM cls_catalogo_tudo
UNION ALL SELECT 'usuarios', count(*), count(*) FILTER (WHERE NOT superado), count(*) FILTER (WHERE superado) FROM cls_usuarios_tudo""")(
    lambda m: m.chain.log.stages().where((F.col("execucao_id") == RUN1) & F.col("etapa").isin("silver_conteudo", "silver_usuario")).select(
        F.when(F.col("etapa") == "silver_conteudo", "catalogo").otherwise("usuarios").alias("fonte"), "lidos",
        (F.col("gravados") + F.col("quarentena")).alias("classificados"), "superados"))

query("dedupe_exact_copy", ALL + """
SELECT fonte, _origem, _linha FROM cls_todos WHERE regra = 'DUPLICADO'""")(
    lambda m: m.cls_todos.where(F.col("regra") == R.DUPLICATE).select("fonte", "_origem", "_linha"))

query("survivor_latest_batch", with_("cls_catalogo") + """
SELECT conteudo_id, titulo, _origem, _linha FROM cls_catalogo WHERE regra IS NULL""")(
    lambda m: m.cls_catalogo.where(F.col("regra").isNull()).select("conteudo_id", "titulo", "_origem", "_linha"))

query("survivor_latest_update", with_("cls_usuarios") + """
SELECT usuario_id, cidade, atualizado_em, _origem FROM cls_usuarios WHERE regra IS NULL""")(
    lambda m: m.cls_usuarios.where(F.col("regra").isNull()).select("usuario_id", "cidade", "atualizado_em", "_origem"))

query("canonical_spelling", with_("cls_catalogo") + """
SELECT categoria, count(*) AS conteudos FROM cls_catalogo WHERE regra IS NULL GROUP BY categoria""")(
    lambda m: m.cls_catalogo.where(F.col("regra").isNull()).groupBy("categoria").agg(
        F.count(F.lit(1)).alias("conteudos")))

query("dedupe_event_key", with_("cls_interacoes", "cls_comentarios", "cls_recomendacoes") + """
SELECT fonte, _origem, _linha, regra FROM cls_interacoes WHERE regra IN ('DUPLICADO', 'CONFLITO_VERSAO')
UNION ALL SELECT fonte, _origem, _linha, regra FROM cls_comentarios WHERE regra IN ('DUPLICADO', 'CONFLITO_VERSAO')
UNION ALL SELECT fonte, _origem, _linha, regra FROM cls_recomendacoes WHERE regra IN ('DUPLICADO', 'CONFLITO_VERSAO')
""")(lambda m: m.cls_todos.where(F.col("fonte").isin("interacoes", "comentarios", "recomendacoes") & F.col("regra").isin(R.DUPLICATE, R.VERSION_CONFLICT))
     .select("fonte", "_origem", "_linha", "regra"))

"""First-generation classifiers over the base delivery
of each source, with their oracle SQL (window-based first occurrence)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auric.functions import domain
from auric.operators import classify_v1 as V1
from auric.plans import raw
from auric.plans import sqlclassify as SC
from auric.plans.model import RUN_DATE, RUN_TS
from auric.plans.registry import query
from auric.plans.sqlmodel import CTES, clean, with_

BASE = {"catalogo": "dados/brutos/catalogo.csv", "interacoes": "dados/brutos/interacoes.json",
        "comentarios": "dados/brutos/comentarios.json"}


def _base(m, fonte):
    return m.bronze(fonte).where(F.col("_origem") == BASE[fonte])


def _catalog(m):
    return V1.catalog(_base(m, "catalogo"))


def _published(m):
    return _catalog(m).where(F.col("classe") == "validos").select("conteudo_id", "data_publicacao")


def _first(inner_case: str, key: str) -> str:
    return (f"CASE WHEN classe0 IS NOT NULL THEN classe0 WHEN row_number() OVER (PARTITION BY classe0 IS NULL, {key} "
            f"ORDER BY _linha) = 1 THEN 'validos' ELSE 'duplicados' END")


_CAT_FINALS = {"titulo": clean("titulo"), "tipo": SC.one_of("tipo", domain.CONTENT_TYPES),
               "nivel": SC.one_of("nivel", domain.LEVELS), "carga_horaria_min": "v_carga",
               "conteudo_id": "v_id", "data_publicacao": "v_data", "categoria": "categoria_canonica",
               "descricao": clean("descricao"), "autor": clean("autor")}
_CORR = " OR ".join(f"({k} IS NOT NULL AND trim({k}) IS DISTINCT FROM CAST({v} AS VARCHAR))"
                    for k, v in _CAT_FINALS.items())

CTES["v1_catalogo"] = (("bronze_catalogo",), f"""
WITH t AS (SELECT *, {SC.whole('conteudo_id')} AS v_id, {SC.whole('carga_horaria_min')} AS v_carga,
                  {SC.day('data_publicacao')} AS v_data, {SC.one_of('tipo', domain.CONTENT_TYPES)} AS v_tipo,
                  {SC.one_of('nivel', domain.LEVELS)} AS v_nivel, {SC.absent(raw.CATALOG_REQUIRED)} AS v_aus
             FROM bronze_catalogo WHERE _origem = '{BASE['catalogo']}'),
c AS (SELECT *, CASE WHEN v_aus IS NOT NULL THEN 'incompletos'
                     WHEN v_id IS NULL OR v_id <= 0 OR v_carga IS NULL OR v_carga < 0 OR v_data IS NULL
                          OR v_tipo IS NULL OR v_nivel IS NULL THEN 'invalidos' END AS classe0 FROM t),
d AS (SELECT *, {_first('', 'v_id')} AS classe FROM c),
e AS (SELECT *, CASE WHEN classe = 'validos' THEN first_value({clean('categoria')}) OVER (
                     PARTITION BY classe = 'validos', {SC.folded('categoria')} ORDER BY _linha) END AS categoria_canonica
        FROM d)
SELECT _linha, classe, CASE WHEN classe = 'validos' THEN v_id END AS conteudo_id,
       CASE WHEN classe = 'validos' THEN categoria_canonica END AS categoria,
       CASE WHEN classe = 'validos' THEN v_data END AS data_publicacao,
       (classe = 'validos' AND ({_CORR})) AS corrigido
  FROM e""")

_PRESENT_BAD = lambda raw_c, typed, extra: f"({raw_c} IS NOT NULL AND ({typed} IS NULL OR {extra}))"
CTES["v1_interacoes"] = (("bronze_interacoes", "v1_catalogo"), f"""
WITH t0 AS (SELECT b.*, {SC.whole('usuario_id')} AS v_usuario, {SC.whole('conteudo_id')} AS v_conteudo,
                  {SC.one_of('tipo_interacao', domain.INTERACTION_TYPES)} AS v_tipo, {SC.moment('data_hora')} AS v_data_hora,
                  {SC.whole('tempo_consumido')} AS v_tempo, {SC.number('percentual_conclusao')} AS v_pct,
                  {SC.whole('avaliacao_atribuida')} AS v_nota, {SC.absent(raw.EVENT_REQUIRED)} AS v_aus,
                  1 AS _x
             FROM bronze_interacoes b WHERE b._origem = '{BASE['interacoes']}'),
t AS (SELECT t0.*, p.conteudo_id AS k, p.data_publicacao AS pub FROM t0
        LEFT JOIN (SELECT conteudo_id AS cid, conteudo_id, data_publicacao FROM v1_catalogo WHERE classe = 'validos') p
               ON p.cid = t0.v_conteudo),
c AS (SELECT *, CASE WHEN v_aus IS NOT NULL THEN 'incompletos'
                     WHEN coalesce(v_usuario IS NULL OR v_usuario <= 0, false)
                       OR coalesce(v_conteudo IS NULL OR v_conteudo <= 0, false) OR k IS NULL OR v_tipo IS NULL
                       OR v_data_hora IS NULL OR coalesce(CAST(v_data_hora AS DATE) < pub, false)
                       OR coalesce(v_data_hora > TIMESTAMP '{RUN_TS.isoformat(sep=' ')}', false)
                       OR {_PRESENT_BAD('tempo_consumido', 'v_tempo', 'v_tempo < 0')}
                       OR {_PRESENT_BAD('percentual_conclusao', 'v_pct', 'v_pct NOT BETWEEN 0 AND 100')}
                       OR {_PRESENT_BAD('avaliacao_atribuida', 'v_nota', 'v_nota NOT BETWEEN 1 AND 5')}
                       OR coalesce(v_tipo = 'conclusão' AND v_pct < 100, false)
                       OR coalesce(v_tipo = 'avaliação' AND v_nota IS NULL, false) THEN 'invalidos' END AS classe0
        FROM t)
SELECT _linha, {_first('', '{"u": v_usuario, "c": v_conteudo, "t": v_tipo, "d": v_data_hora}')} AS classe FROM c""")

CTES["v1_comentarios"] = (("bronze_comentarios", "v1_catalogo"), f"""
WITH t0 AS (SELECT b.*, {SC.whole('usuario_id')} AS v_usuario, {SC.whole('conteudo_id')} AS v_conteudo,
                  {SC.whole('avaliacao')} AS v_nota, {clean('comentario')} AS v_texto, {SC.day('data')} AS v_data,
                  {SC.TAGS} AS v_tags, {SC.absent(raw.COMMENT_REQUIRED)} AS v_aus,
                  1 AS _x
             FROM bronze_comentarios b WHERE b._origem = '{BASE['comentarios']}'),
t AS (SELECT t0.*, p.conteudo_id AS k, p.data_publicacao AS pub FROM t0
        LEFT JOIN (SELECT conteudo_id AS cid, conteudo_id, data_publicacao FROM v1_catalogo WHERE classe = 'validos') p
               ON p.cid = t0.v_conteudo),
c AS (SELECT *, CASE WHEN v_aus IS NOT NULL THEN 'incompletos'
                     WHEN coalesce(v_usuario IS NULL OR v_usuario <= 0, false)
                       OR coalesce(v_conteudo IS NULL OR v_conteudo <= 0, false) OR k IS NULL
                       OR coalesce(v_nota IS NULL OR v_nota NOT BETWEEN 1 AND 5, false) OR v_data IS NULL
                       OR coalesce(v_data < pub, false) OR coalesce(v_data > DATE '{RUN_DATE.isoformat()}', false)
                       OR v_tags IS NULL THEN 'invalidos' END AS classe0
        FROM t),
d AS (SELECT *, {_first('', '{"u": v_usuario, "c": v_conteudo, "d": v_data, "x": v_texto}')} AS classe FROM c)
SELECT _linha, classe,
       CASE WHEN classe = 'validos' THEN array_to_string(list_filter(list_transform(v_tags, lambda x: lower(trim(x))),
                                                         lambda x: x IS NOT NULL AND x <> ''), ',') END AS tags
  FROM d""")

query("classify_v1_catalog", with_("v1_catalogo") + """
SELECT _linha, classe, conteudo_id, categoria, data_publicacao, corrigido FROM v1_catalogo""")(_catalog)

query("classify_v1_events", with_("v1_interacoes") + "SELECT _linha, classe FROM v1_interacoes")(
    lambda m: V1.events(_base(m, "interacoes"), RUN_TS, _published(m)))

query("classify_v1_comments", with_("v1_comentarios") + "SELECT _linha, classe, tags FROM v1_comentarios")(
    lambda m: V1.comments(_base(m, "comentarios"), RUN_DATE, _published(m)))

query("ingest_summary_v1", with_("v1_catalogo", "v1_interacoes", "v1_comentarios") + """
SELECT fonte, count(*) FILTER (WHERE classe = 'validos') AS validos,
       count(*) FILTER (WHERE classe = 'invalidos') AS invalidos,
       count(*) FILTER (WHERE classe = 'incompletos') AS incompletos,
       count(*) FILTER (WHERE classe = 'duplicados') AS duplicados,
       count(*) FILTER (WHERE corrigido) AS corrigidos
  FROM (SELECT 'catalogo' AS fonte, classe, corrigido FROM v1_catalogo
        UNION ALL SELECT 'interacoes', classe, NULL FROM v1_interacoes
        UNION ALL SELECT 'comentarios', classe, NULL FROM v1_comentarios) s GROUP BY fonte""")(
    lambda m: _catalog(m).select(F.lit("catalogo").alias("fonte"), "classe", "corrigido").unionByName(
        V1.events(_base(m, "interacoes"), RUN_TS, _published(m)).select(
            F.lit("interacoes").alias("fonte"), "classe", F.lit(None).cast("boolean").alias("corrigido"))).unionByName(
        V1.comments(_base(m, "comentarios"), RUN_DATE, _published(m)).select(
            F.lit("comentarios").alias("fonte"), "classe", F.lit(None).cast("boolean").alias("corrigido")))
    .groupBy("fonte").agg(*[F.count_if(F.col("classe") == c).alias(c)
                            for c in ("validos", "invalidos", "incompletos", "duplicados")],
                          F.count_if("corrigido").alias("corrigidos")))

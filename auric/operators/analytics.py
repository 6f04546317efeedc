"""Analytical views over Silver (account level) and Gold (person level),
plus a registry of reusable ratio metrics defined once as ``Column``
factories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions.domain import CONSUMPTION_TYPES
from auric.operators.gold import completed, pct
from auric.operators.joins import join_dim


# ---------------------------------------------------------------- metric registry
def ratio(num: str, den: str, digits: int = 1) -> Callable[[], Column]:
    """ROUND(100 * SUM(num) / NULLIF(SUM(den), 0), digits)."""
    return lambda: pct(F.sum(num), F.sum(den), digits)


def weighted_mean(mean: str, weight: str, digits: int = 2) -> Callable[[], Column]:
    """ROUND(SUM(mean * weight) / NULLIF(SUM(weight), 0), digits)."""
    return lambda: F.round(F.sum(F.col(mean) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0)), digits)


METRICS: dict[str, Callable[[], Column]] = {
    "taxa_conclusao": ratio("pares_concluidos", "pares_consumo"),
    "conversao": ratio("convertidas", "recomendacoes"),
    "avaliacao_media": weighted_mean("avaliacao_media", "avaliacoes"),
    "pares_consumo": lambda: F.sum("pares_consumo"),
    "recomendacoes": lambda: F.sum("recomendacoes"),
}


def metric(name: str) -> Column:
    return METRICS[name]().alias(name)


# ---------------------------------------------------------------- account-level views
def interactions_enriched(interacao: DataFrame, conteudo: DataFrame) -> DataFrame:
    c = conteudo.select("conteudo_id", "titulo", "tipo", "nivel", "categoria")
    return join_dim(interacao, c, "conteudo_id").select(
        "interacao_id", "usuario_id", "conteudo_id", "tipo_interacao", "data_hora",
        F.trunc(F.to_date("data_hora"), "month").alias("mes"),
        "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida",
        "titulo", "tipo", "nivel", "categoria",
    )


def usage_monthly(vi: DataFrame) -> DataFrame:
    return vi.groupBy("mes", "categoria", "tipo").agg(
        F.count(F.lit(1)).alias("interacoes"),
        F.count_if(F.col("tipo_interacao") == "visualização").alias("visualizacoes"),
        F.count_distinct("usuario_id").alias("usuarios_ativos"),
        F.sum("tempo_consumido").cast("bigint").alias("tempo_total_min"),
    )


def content_popularity(vi: DataFrame) -> DataFrame:
    return vi.groupBy("conteudo_id", "titulo", "categoria", "tipo", "nivel").agg(
        F.count_if(F.col("tipo_interacao") == "visualização").alias("visualizacoes"),
        F.count_distinct("usuario_id").alias("usuarios"),
        F.round(F.avg("tempo_consumido"), 1).alias("tempo_medio_min"),
        F.round(F.avg("avaliacao_atribuida"), 2).alias("avaliacao_media"),
    )


def quality(vi: DataFrame) -> DataFrame:
    g = vi.where(F.col("avaliacao_atribuida").isNotNull()).groupBy("categoria", "tipo", "nivel")
    return g.agg(
        F.count("avaliacao_atribuida").alias("avaliacoes"),
        F.round(F.avg("avaliacao_atribuida"), 2).alias("avaliacao_media"),
        pct(F.count_if(F.col("avaliacao_atribuida") >= 4), F.count("avaliacao_atribuida")).alias("pct_positivas"),
    )


def retention_v1(vi: DataFrame) -> DataFrame:
    """Monthly active accounts, interactions per account and retention into
    the next month; the latest month (a scalar subquery) has none."""
    ativos = vi.groupBy("mes", "usuario_id").agg(F.count(F.lit(1)).alias("interacoes"))
    ultimo = ativos.agg(F.max("mes")).scalar()
    nxt = ativos.select(F.col("usuario_id").alias("_u"), F.col("mes").alias("_m"))
    j = ativos.join(nxt, (ativos["usuario_id"] == nxt["_u"]) & (nxt["_m"] == F.add_months(ativos["mes"], 1)), "left")
    g = j.groupBy("mes").agg(
        F.count(F.lit(1)).alias("usuarios_ativos"), F.sum("interacoes").alias("interacoes"),
        F.count("_u").alias("retidos"),
    )
    last = F.col("mes") == ultimo
    return g.select(
        "mes", "usuarios_ativos", "interacoes",
        F.round(F.col("interacoes") / F.col("usuarios_ativos"), 2).alias("interacoes_por_usuario"),
        F.when(~last, F.col("retidos")).alias("usuarios_retidos"),
        F.when(~last, pct(F.col("retidos"), F.col("usuarios_ativos"))).alias("retencao_pct"),
    )


def recommendation_kpi(recs: DataFrame, conteudo: DataFrame, usuario: DataFrame) -> DataFrame:
    total = usuario.agg(F.count(F.lit(1))).scalar()
    r = join_dim(recs, conteudo.select("conteudo_id", "categoria", "tipo"), "conteudo_id")
    g = r.groupBy("classificacao", "categoria", "tipo").agg(
        F.count(F.lit(1)).alias("recomendacoes"),
        F.count_distinct("usuario_id").alias("usuarios"),
        F.round(F.avg("pontuacao"), 1).alias("pontuacao_media"),
    )
    return g.select("classificacao", "categoria", "tipo", "recomendacoes", "usuarios", "pontuacao_media",
                    pct(F.col("usuarios"), total).alias("cobertura_pct"))


def platform_totals(usuario, interacao, conteudo, recs, embedding) -> DataFrame:
    """Eight platform scalars as one row: each is a global aggregate taken
    as a scalar subquery (Catalyst merges subqueries over the same table)."""
    one = lambda df, c: df.agg(c).scalar()
    usuarios = one(usuario, F.count(F.lit(1)))
    ru = one(recs, F.count_distinct("usuario_id"))
    return usuario.sparkSession.range(1).select(
        usuarios.alias("usuarios"),
        one(interacao, F.count_distinct("usuario_id")).alias("usuarios_ativos"),
        one(conteudo, F.count(F.lit(1))).alias("conteudos"),
        one(interacao, F.count(F.lit(1))).alias("interacoes"),
        one(interacao, F.round(F.avg("tempo_consumido"), 1)).alias("tempo_medio_min"),
        one(recs, F.count(F.lit(1))).alias("recomendacoes"),
        pct(ru, usuarios).alias("cobertura_recomendacao_pct"),
        one(embedding, F.count(F.lit(1))).alias("embeddings"),
    )


# ---------------------------------------------------------------- person-level (Gold) views
def cohort_completion(fato: DataFrame, dim: DataFrame) -> DataFrame:
    """Each (person, content) pair counted once, in the month its consumption began."""
    pares = fato.where(F.col("tipo_interacao").isin(CONSUMPTION_TYPES)).groupBy("usuario_pseudo", "conteudo_id").agg(
        F.trunc(F.to_date(F.min("data_hora")), "month").alias("mes_inicio"),
        F.bool_or(completed(F.col("tipo_interacao"), F.col("percentual_conclusao"))).alias("concluiu"),
        F.min("data_hora").alias("inicio"),
    )
    return join_dim(pares, dim.select("conteudo_id", "categoria", "tipo", "nivel", "carga_horaria_min"),
                    "conteudo_id")


def reco_by_position(fato_rec: DataFrame, dim: DataFrame) -> DataFrame:
    from auric.functions.domain import position_band

    r = join_dim(fato_rec, dim.select("conteudo_id", "categoria", "nivel"), "conteudo_id")
    days = (F.unix_micros(F.col("convertida_em").cast("timestamp")) -
            F.unix_micros(F.col("gerado_em").cast("timestamp"))) / F.lit(86400e6)
    return r.groupBy(
        F.to_date("gerado_em").alias("data_geracao"), "categoria", "nivel", "classificacao",
        position_band(F.col("posicao")).alias("faixa_posicao"),
    ).agg(
        F.count(F.lit(1)).alias("recomendacoes"),
        F.sum(F.when(F.col("convertida"), 1).otherwise(0)).cast("bigint").alias("convertidas"),
        F.round(F.avg(F.when(F.col("convertida"), days)), 1).alias("dias_ate_converter"),
    )


def top_engaged(fato: DataFrame, dim_usuario: DataFrame, k: int = 10) -> DataFrame:
    """Most engaged people, shown only by masked name and pseudonym prefix."""
    per = fato.groupBy("usuario_pseudo").agg(
        F.count(F.lit(1)).alias("interacoes"),
        F.count_distinct("conteudo_id").alias("conteudos"),
        F.sum(F.when(F.col("tipo_interacao") == "conclusão", 1).otherwise(0)).cast("bigint").alias("conclusoes"),
        F.to_date(F.max("data_hora")).alias("ultima_interacao"),
    )
    u = dim_usuario.select("usuario_pseudo", "nome_mascarado", "faixa_etaria", "uf")
    return join_dim(per, u, "usuario_pseudo").orderBy(
        F.col("interacoes").desc(), F.col("conclusoes").desc(), F.col("ultima_interacao").desc(),
        F.col("usuario_pseudo"),
    ).limit(k).select(
        "nome_mascarado", F.left("usuario_pseudo", F.lit(12)).alias("pseudonimo"), "faixa_etaria", "uf",
        "interacoes", "conteudos", "conclusoes", "ultima_interacao",
    )

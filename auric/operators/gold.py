"""Gold layer: star schema (dims + facts) and the five KPI tables.

Aggregations are written so Spark can combine map-side: distinct counts over
(month, person) pairs become plain counts after one pair-level group-by, and
the "latest timestamp" is a scalar subquery over a global aggregate (never a
single-partition window, never a join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions.domain import CONSUMPTION_TYPES
from auric.operators.asof import next_event
from auric.operators.joins import join_dim


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(100 * num / den, digits); NULL when den is 0 or NULL."""
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0)), digits)


def completed(tipo: Column, percent: Column) -> Column:
    """A (person, content) pair counts as completed on a 'conclusão' event
    or a percentage of 100 or more."""
    return (tipo == "conclusão") | (F.coalesce(percent >= 100, F.lit(False)))


def fact_interaction(interacao: DataFrame, person_of: DataFrame) -> DataFrame:
    return join_dim(interacao, person_of, "usuario_id").select(
        "interacao_id", "usuario_pseudo", "conteudo_id", "tipo_interacao", "data_hora",
        F.to_date("data_hora").alias("data"),
        F.trunc(F.to_date("data_hora"), "month").alias("mes"),
        "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida",
    )


def first_consumption_after(keys: DataFrame, fact: DataFrame, person: str = "usuario_pseudo") -> DataFrame:
    """As-of-forward lookup: ``keys`` with ``primeira``, the earliest consumption event of the same person and content
    strictly after ``gerado_em`` (NULL when none). Events are pruned to consumption types; recommendations and events
    of a key are ordered, never paired."""
    ev = fact.where(F.col("tipo_interacao").isin(CONSUMPTION_TYPES)).select(person, "conteudo_id", "data_hora")
    return next_event(keys, ev, [person, "conteudo_id"], "gerado_em", "data_hora", "primeira")


def fact_recommendation(recs: DataFrame, person_of: DataFrame, fato_interacao: DataFrame) -> DataFrame:
    """Recommendations per person: when several accounts of one person got
    the same content at the same time, the best position survives
    (``min`` over a struct, combinable map-side)."""
    r = join_dim(recs, person_of, "usuario_id")
    best = r.groupBy("usuario_pseudo", "conteudo_id", "gerado_em").agg(
        F.min(F.struct("posicao", "pontuacao", "classificacao")).alias("b")
    ).select("usuario_pseudo", "conteudo_id", "gerado_em", "b.posicao", "b.pontuacao", "b.classificacao")
    conv = first_consumption_after(best, fato_interacao)
    return conv.select(
        "usuario_pseudo", "conteudo_id", "pontuacao", "posicao", "classificacao", "gerado_em",
        F.col("primeira").isNotNull().alias("convertida"), F.col("primeira").alias("convertida_em"),
    )


def kpi_engagement(fato: DataFrame, dim_conteudo: DataFrame) -> DataFrame:
    """Monthly engagement by category."""
    f = join_dim(fato, dim_conteudo.select("conteudo_id", "categoria"), "conteudo_id")
    return f.groupBy("mes", "categoria").agg(
        F.count(F.lit(1)).alias("interacoes"),
        F.count_distinct("usuario_pseudo").alias("pessoas_ativas"),
        F.count_if(F.col("tipo_interacao") == "conclusão").alias("conclusoes"),
        F.coalesce(F.sum("tempo_consumido"), F.lit(0)).cast("bigint").alias("minutos_consumidos"),
    ).select(
        F.date_format("mes", "yyyy-MM").alias("mes"), F.col("mes").alias("mes_referencia"),
        "categoria", "interacoes", "pessoas_ativas", "conclusoes", "minutos_consumidos",
    )


def monthly_activity(fato: DataFrame, person: str = "usuario_pseudo", month: str = "mes") -> DataFrame:
    """(month, person, interactions) — one row per active person and month."""
    return fato.groupBy(month, person).agg(F.count(F.lit(1)).alias("interacoes"))


def kpi_active_people(fato: DataFrame, person: str = "usuario_pseudo") -> DataFrame:
    """Active people per month, retention into the next month, and whether
    the month is complete. The last month has no retention (NULL)."""
    ativos = monthly_activity(fato, person)
    ultima = fato.agg(F.max("data_hora")).scalar()  # scalar subquery
    nxt = ativos.select(F.col(person).alias("_p"), F.col("mes").alias("_m"))
    j = ativos.join(nxt, (ativos[person] == nxt["_p"]) & (nxt["_m"] == F.add_months(ativos["mes"], 1)), "left")
    g = j.groupBy("mes").agg(
        F.count(F.lit(1)).alias("pessoas_ativas"),
        F.sum("interacoes").alias("interacoes"),
        F.count("_p").alias("retidas"),
    )
    last = F.col("mes") == F.trunc(F.to_date(ultima), "month")
    return g.select(
        F.col("mes").alias("mes_referencia"),
        "pessoas_ativas",
        "interacoes",
        F.round(F.col("interacoes") / F.col("pessoas_ativas"), 2).alias("interacoes_por_pessoa"),
        F.when(~last, F.col("retidas")).alias("pessoas_retidas"),
        F.when(~last, pct(F.col("retidas"), F.col("pessoas_ativas"))).alias("retencao_pct"),
        (F.add_months("mes", 1) <= F.date_add(F.to_date(ultima), 1)).alias("mes_completo"),
    )


def completion_pairs(fato: DataFrame, person: str = "usuario_pseudo") -> DataFrame:
    """(person, content, concluiu) over consumption events."""
    f = fato.where(F.col("tipo_interacao").isin(CONSUMPTION_TYPES))
    return f.groupBy(person, "conteudo_id").agg(
        F.bool_or(completed(F.col("tipo_interacao"), F.col("percentual_conclusao"))).alias("concluiu")
    )


def kpi_completion(fato: DataFrame, dim_conteudo: DataFrame, person: str = "usuario_pseudo",
                   names=("pares_consumo", "pares_concluidos", "taxa_conclusao_pct")) -> DataFrame:
    pares = join_dim(completion_pairs(fato, person),
                     dim_conteudo.select("conteudo_id", "categoria", "tipo", "nivel"), "conteudo_id")
    n, c, p = names
    return pares.groupBy("categoria", "tipo", "nivel").agg(
        F.count(F.lit(1)).alias(n), F.count_if("concluiu").alias(c),
    ).withColumn(p, pct(F.col(c), F.col(n)))


def kpi_conversion(fato_rec: DataFrame, dim_conteudo: DataFrame) -> DataFrame:
    r = join_dim(fato_rec, dim_conteudo.select("conteudo_id", "categoria"), "conteudo_id")
    return r.groupBy("classificacao", "categoria").agg(
        F.count(F.lit(1)).alias("recomendacoes"), F.count_if("convertida").alias("convertidas"),
    ).withColumn("conversao_pct", pct(F.col("convertidas"), F.col("recomendacoes")))


def kpi_rating(fato: DataFrame, dim_conteudo: DataFrame, by=("categoria", "tipo")) -> DataFrame:
    f = join_dim(fato.where(F.col("avaliacao_atribuida").isNotNull()),
                 dim_conteudo.select("conteudo_id", *by), "conteudo_id")
    return f.groupBy(*by).agg(
        F.count("avaliacao_atribuida").alias("avaliacoes"),
        F.round(F.avg("avaliacao_atribuida"), 2).alias("avaliacao_media"),
        pct(F.count_if(F.col("avaliacao_atribuida") >= 4), F.count("avaliacao_atribuida")).alias("pct_positivas"),
    )


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) — UNION ALL of one count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def engagement_by_month(interacao: DataFrame, conteudo: DataFrame, correspondencia: DataFrame) -> DataFrame:
    """The distributed monthly engagement job: lookups (content → category,
    account → person) joined under the size check, a missing person falls
    back to the account id, then one group-by with partial aggregation per
    (month, category); the per-key sums are associative, so Spark combines
    them map-side."""
    i = interacao.select("usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido")
    c = conteudo.select("conteudo_id", "categoria")
    p = correspondencia.select("usuario_id", "usuario_mestre_id")
    j = join_dim(join_dim(i, c, "conteudo_id"), p, "usuario_id", "left")
    j = j.withColumn("pessoa", F.coalesce("usuario_mestre_id", "usuario_id"))
    return j.groupBy(F.date_format("data_hora", "yyyy-MM").alias("mes"), "categoria").agg(
        F.count(F.lit(1)).alias("interacoes"), F.count_distinct("pessoa").alias("pessoas_ativas"),
        F.count_if(F.col("tipo_interacao") == "conclusão").alias("conclusoes"),
        F.coalesce(F.sum("tempo_consumido"), F.lit(0)).cast("bigint").alias("minutos_consumidos"))

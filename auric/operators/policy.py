"""Column-level privacy policy: which columns may reach which layer.

Personal columns stay in Silver (and the restricted pseudonym map); a Gold
table is projected to the columns the policy allows, and the blocked ones
are reported. The check works on schemas, the projection on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns that may reach Gold. A column that is not listed is blocked there.
GOLD = frozenset(
    "conteudo_id titulo tipo categoria nivel carga_horaria_min data_publicacao usuario_pseudo nome_mascarado "
    "faixa_etaria uf data_cadastro registros_origem interacao_id tipo_interacao data_hora data mes tempo_consumido "
    "percentual_conclusao avaliacao_atribuida mes_referencia interacoes pessoas_ativas conclusoes "
    "minutos_consumidos pontuacao posicao classificacao gerado_em convertida convertida_em interacoes_por_pessoa "
    "pessoas_retidas retencao_pct mes_completo pares_consumo pares_concluidos taxa_conclusao_pct recomendacoes "
    "convertidas conversao_pct avaliacoes avaliacao_media pct_positivas".split())
# Personal columns and the layers below Gold that each may reach.
PERSONAL = {
    "nome": {"bronze", "silver"},
    "email": {"bronze", "silver"},
    "cpf": {"bronze", "silver"},
    "telefone": {"bronze", "silver"},
    "data_nascimento": {"bronze", "silver"},
    "email_hash": {"silver"},
    "cpf_hash": {"silver"},
    "usuario_id": {"bronze", "silver", "restrito"},
}


def allowed(column: str, layer: str) -> bool:
    if layer == "gold":
        return column in GOLD
    return layer in PERSONAL.get(column, {layer})


def enforce(df: DataFrame, layer: str) -> tuple[DataFrame, list[str]]:
    blocked = [c for c in df.columns if not allowed(c, layer)]
    return df.select(*[c for c in df.columns if c not in blocked]), blocked


def report(tables: dict[str, DataFrame], layer: str) -> DataFrame:
    """(tabela, colunas_permitidas, colunas_bloqueadas, linhas) for each table
    projected to the layer's policy."""
    out = None
    for name, df in tables.items():
        kept, blocked = enforce(df, layer)
        r = kept.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("tabela"), F.lit(len(kept.columns)).alias("colunas_permitidas"),
            F.lit(",".join(sorted(blocked))).alias("colunas_bloqueadas"), "linhas")
        out = r if out is None else out.unionByName(r)
    return out

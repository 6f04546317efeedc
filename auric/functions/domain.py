"""Domain canonicalisation, severities and banding rules."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from auric.functions.text import _c, comparison_key

# Comparison key → canonical spelling, per domain.
CONTENT_TYPES = {"curso": "Curso", "video": "Vídeo", "artigo": "Artigo", "podcast": "Podcast"}
LEVELS = {"basico": "Básico", "intermediario": "Intermediário", "avancado": "Avançado"}
INTERACTION_TYPES = {
    "visualizacao": "visualização",
    "inicio": "início",
    "conclusao": "conclusão",
    "curtida": "curtida",
    "avaliacao": "avaliação",
    "compartilhamento": "compartilhamento",
}
RECOMMENDATION_CLASSES = {"positivo": "positivo", "estavel": "estavel", "negativo": "negativo"}

# The 27 Brazilian state codes.
STATE_CODES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# Rule codes by severity.
HIGH_RULES = ["CAMPO_OBRIGATORIO", "TIPO_INVALIDO", "DATA_INVALIDA", "REF_USUARIO", "REF_CONTEUDO"]
LOW_RULES = ["DUPLICADO", "CONFLITO_VERSAO"]

# Consumption interaction types (count towards completion and conversion).
CONSUMPTION_TYPES = ["visualização", "início", "conclusão"]


def domain_map(c, mapping: dict[str, str]) -> Column:
    """Canonical spelling via the comparison key; unknown → NULL."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(lookup, comparison_key(c))


def content_type(c) -> Column:
    return domain_map(c, CONTENT_TYPES)


def level(c) -> Column:
    return domain_map(c, LEVELS)


def interaction_type(c) -> Column:
    return domain_map(c, INTERACTION_TYPES)


def recommendation_class(c) -> Column:
    return domain_map(c, RECOMMENDATION_CLASSES)


def state_code(c) -> Column:
    u = F.upper(F.trim(_c(c)))
    return F.when(u.isin(STATE_CODES), u)


def severity(rule) -> Column:
    r = _c(rule)
    return (
        F.when(r.isNull(), F.lit(None).cast("string"))
        .when(r.isin(HIGH_RULES), F.lit("alta"))
        .when(r.isin(LOW_RULES), F.lit("baixa"))
        .otherwise(F.lit("media"))
    )


def batch_priority(origin) -> Column:
    """Files of the newer delivery win survivorship."""
    return F.when(_c(origin).like("dados/brutos/lote_2/%"), F.lit(2)).otherwise(F.lit(1))


def age_band(birth, as_of) -> Column:
    """Six bands on completed years at ``as_of``."""
    years = F.timestamp_diff("YEAR", _c(birth), _c(as_of))
    return (
        F.when(years.isNull(), F.lit(None).cast("string"))
        .when(years < 18, "0-17")
        .when(years < 25, "18-24")
        .when(years < 35, "25-34")
        .when(years < 45, "35-44")
        .when(years < 60, "45-59")
        .otherwise("60+")
    )


def position_band(pos) -> Column:
    p = _c(pos)
    return F.when(p <= 3, "1 a 3").when(p <= 6, "4 a 6").otherwise("7 a 10")


def duration_band(minutes) -> Column:
    m = _c(minutes)
    return F.when(m <= 30, "ate_30").when(m <= 90, "31_90").otherwise("mais_90")


def quadrant(rating, completion, avg_rating, avg_completion) -> Column:
    """Rating against the global mean first, then completion."""
    hi_r = _c(rating) >= _c(avg_rating)
    lo_c = _c(completion) < _c(avg_completion)
    return (
        F.when(hi_r & lo_c, "bem avaliada, pouco concluída")
        .when(hi_r, "bem avaliada e concluída")
        .when(lo_c, "avaliação e conclusão abaixo da média")
        .otherwise("concluída, avaliação abaixo da média")
    )


def check_secret(value: str | None, name: str) -> str:
    """Driver-side guard run before a plan is built: an unset, short or
    placeholder secret stops the job."""
    if value is None or len(value) < 16 or value.startswith("troque-por") or value.startswith("${"):
        raise ValueError(f"{name} is not configured (use a random value of 16+ characters)")
    return value

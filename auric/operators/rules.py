"""Ordered validation rules with first-failure classification.

A rule set is a list of (code, violated?, message) evaluated in order; the
first violated rule is the record's class (NULL = accepted). The whole list
compiles to one ``coalesce(when …)`` expression, so classification is a
single projection inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from auric.functions.domain import severity

# Rule codes.
REQUIRED = "CAMPO_OBRIGATORIO"
TYPE = "TIPO_INVALIDO"
DATE = "DATA_INVALIDA"
DOMAIN = "DOMINIO"
RANGE = "FAIXA"
NEGATIVE = "VALOR_NEGATIVO"
FUTURE = "DATA_FUTURA"
REF_USER = "REF_USUARIO"
REF_CONTENT = "REF_CONTEUDO"
BEFORE_PUBLICATION = "DATA_ANTES_PUBLICACAO"
CONSISTENCY = "CONSISTENCIA"
FORMAT = "FORMATO"
DUPLICATE = "DUPLICADO"
VERSION_CONFLICT = "CONFLITO_VERSAO"


@dataclass(frozen=True)
class Rule:
    code: str
    violated: Column
    message: Column


def rule(code: str, violated: Column, message: str | Column) -> Rule:
    return Rule(code, violated, F.lit(message) if isinstance(message, str) else message)


def first_failure(rules: list[Rule]) -> Column:
    """struct(regra, mensagem) of the first violated rule, or NULL.

    A rule whose condition is NULL (unknown) does not fire — the same
    three-valued logic as a SQL ``CASE WHEN``."""
    return F.coalesce(*[
        F.when(r.violated, F.struct(F.lit(r.code).alias("regra"), r.message.alias("mensagem"))) for r in rules
    ])


def quoted(c: Column) -> Column:
    """A value quoted as a SQL literal for messages; NULL renders as NULL."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def with_severity(df, col: str = "regra"):
    return df.withColumn("severidade", severity(F.col(col)))

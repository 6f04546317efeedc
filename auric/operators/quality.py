"""Threshold-based quality tests that gate publication.

A test is (id, operator, threshold, severity, measure) where ``measure``
returns ``DataFrame(fonte, total, falhos)``. Results are the union of every
measure with ``valor_medido = round(100 * (total - falhos) / total, 2)``
(100 when total is 0) and ``aprovado`` judged against the threshold frozen
in the result row. The gate is a one-row aggregate; only its boolean
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QualityTest:
    teste_id: str
    nome: str
    dimensao: str
    operador: str
    limite: float
    severidade: str
    measure: Callable[[object], DataFrame]


def result_rows(test: QualityTest, measured: DataFrame, run_id: str) -> DataFrame:
    total, falhos = F.col("total"), F.col("falhos")
    valor = F.when(total == 0, F.lit(100.0)).otherwise(F.round(F.lit(100.0) * (total - falhos) / total, 2))
    ok = valor >= test.limite if test.operador == ">=" else valor <= test.limite
    return measured.select(
        F.lit(run_id).alias("execucao_id"), F.lit(test.teste_id).alias("teste_id"),
        F.col("fonte").cast("string").alias("fonte"), total.cast("bigint").alias("total_registros"),
        falhos.cast("bigint").alias("registros_falhos"), valor.alias("valor_medido"), ok.alias("aprovado"),
        F.lit(test.operador).alias("operador"), F.lit(float(test.limite)).alias("limite_aceitavel"),
        F.lit(test.severidade).alias("severidade"),
    )


def run_tests(tests: list[QualityTest], ctx, run_id: str) -> DataFrame:
    out = None
    for t in tests:
        r = result_rows(t, t.measure(ctx), run_id)
        out = r if out is None else out.unionByName(r)
    return out


def gate(results: DataFrame) -> DataFrame:
    """One row: number of failed critical tests and whether Gold is blocked."""
    crit = (F.col("severidade") == "critica") & ~F.col("aprovado")
    return results.agg(F.count_if(crit).alias("falhas_criticas"),
                       F.count_if(~F.col("aprovado")).alias("reprovados")).withColumn(
        "bloqueado", F.col("falhas_criticas") > 0)


def gate_passes(results: DataFrame) -> bool:
    return not gate(results).first()["bloqueado"]


def registry_frame(spark, tests: list[QualityTest]) -> DataFrame:
    """The test registry as a small table (one row per registered test)."""
    rows = [(t.teste_id, t.nome, t.dimensao, t.operador, float(t.limite), t.severidade) for t in tests]
    return spark.createDataFrame(rows, "teste_id string, nome string, dimensao string, operador string, "
                                       "limite_aceitavel double, severidade string")


# ---------------------------------------------------------------- registry with validity
REGISTRY = "teste_id string, nome string, dimensao string, operador string, limite_aceitavel double, severidade string, vigente_de date, registrado long"


def definitions(spark: SparkSession, tests: list[QualityTest], since, registered: int = 0) -> DataFrame:
    """The definitions of ``tests``, valid from ``since`` on. Definitions are only ever added (by union): a later one of
    a test ends the one before it, and of two for one day the one with the higher ``registrado`` counts."""
    return spark.createDataFrame([(t.teste_id, t.nome, t.dimensao, t.operador, float(t.limite), t.severidade, since, registered) for t in tests], REGISTRY)


def validity(defs: DataFrame) -> DataFrame:
    """Definitions with the interval [vigente_de, vigente_ate) in which they hold; the last one has no end."""
    day = Window.partitionBy("teste_id", "vigente_de").orderBy(F.col("registrado").desc())
    one = defs.withColumn("_n", F.row_number().over(day)).where("_n = 1").drop("_n")
    return one.withColumn("vigente_ate", F.lead("vigente_de").over(Window.partitionBy("teste_id").orderBy("vigente_de")))


def as_of(defs: DataFrame, day) -> DataFrame:
    """The definitions that hold on ``day`` (a date or a date column)."""
    day = F.lit(day) if not hasattr(day, "isNull") else day
    return validity(defs).where((F.col("vigente_de") <= day) & (F.col("vigente_ate").isNull() | (day < F.col("vigente_ate"))))


def judged(measured: DataFrame, defs: DataFrame) -> DataFrame:
    """``measured`` (execucao_id, teste_id, fonte, total, falhos) judged by definitions, whose limits are frozen into
    the rows; a test without a definition is not judged."""
    total, falhos = F.col("total"), F.col("falhos")
    valor = F.when(total == 0, F.lit(100.0)).otherwise(F.round(F.lit(100.0) * (total - falhos) / total, 2))
    ok = F.when(F.col("operador") == ">=", valor >= F.col("limite_aceitavel")).otherwise(valor <= F.col("limite_aceitavel"))
    j = measured.join(defs.select("teste_id", "operador", "limite_aceitavel", "severidade"), "teste_id")
    return j.select("execucao_id", "teste_id", F.col("fonte").cast("string").alias("fonte"), total.cast("bigint").alias("total_registros"),
                    falhos.cast("bigint").alias("registros_falhos"), valor.alias("valor_medido"), ok.alias("aprovado"),
                    "operador", "limite_aceitavel", "severidade")


def measure_all(tests: list[QualityTest], ctx, run_id: str) -> DataFrame:
    """(execucao_id, teste_id, fonte, total, falhos) of every test."""
    out = None
    for t in tests:
        m = t.measure(ctx).select(F.lit(run_id).alias("execucao_id"), F.lit(t.teste_id).alias("teste_id"), F.col("fonte").cast("string").alias("fonte"), "total", "falhos")
        out = m if out is None else out.unionByName(m)
    return out


def backfill(results: DataFrame, runs: DataFrame, defs: DataFrame) -> DataFrame:
    """Older results that lack their limits get those that held on the day of their run (``runs``: execucao_id, dia);
    results that have limits keep them."""
    v = validity(defs).select("teste_id", F.col("operador").alias("_o"), F.col("limite_aceitavel").alias("_l"), F.col("severidade").alias("_s"), "vigente_de", "vigente_ate")
    holds = (F.col("r.teste_id") == F.col("v.teste_id")) & (F.col("v.vigente_de") <= F.col("r.dia")) & (F.col("v.vigente_ate").isNull() | (F.col("r.dia") < F.col("v.vigente_ate")))
    j = results.join(runs, "execucao_id", "left").alias("r").join(v.alias("v"), holds, "left")
    full = {"operador": "_o", "limite_aceitavel": "_l", "severidade": "_s"}
    return j.select(*[F.coalesce(f"r.{c}", F.col(f"v.{full[c]}")).alias(c) if c in full else F.col(f"r.{c}").alias(c) for c in results.columns])

"""Query registry: key → (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from auric.plans.model import Model


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Model], DataFrame]
    text: str | Callable[[], str] | None

    @property
    def sql(self) -> str | None:
        """The oracle SQL; where it needs tables of modules loaded later, it is made when asked for."""
        return self.text() if callable(self.text) else self.text


REGISTRY: dict[str, Query] = {}
_MODELS: dict[tuple[str, str], Model] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Register ``fn(model) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: Callable[[Model], DataFrame]):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    key = (spark.sparkContext.applicationId, sf_dir)  # ids of objects are reused, those of applications are not
    if key not in _MODELS:
        _MODELS[key] = Model(spark, sf_dir)
    return _MODELS[key]


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(model_for(spark, sf_dir))

    run.__name__ = name
    return run


def load_all() -> None:
    # importing the modules registers their queries
    from auric.plans import (  # noqa: F401
        q_analytics, q_functions, q_gold, q_identity, q_io, q_quality, q_quarantine, q_recommend, q_rules,
        q_rules_v1, q_publish,
    )

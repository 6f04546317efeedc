"""Two daily runs of the whole platform over the stand-in deliveries.

Run 1 classifies five sources, publishes Silver, judges its quality and is
refused Gold, as the deliveries are dirtier than the tests allow. Triage then
edits and gives up rejected records, and the tests are defined anew. Run 2
gets the deliveries of the next day, some lines with other content, with the
corrections laid over them, and publishes Gold. Every stage is logged with
the counts measured while it wrote.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.operators import classify, layers
from auric.operators import quality as Q
from auric.operators.triage import ID, KEYS, Triage, identified
from auric.plans import raw
from auric.plans.model import RUN_DATE, RUN_TS, Model
from auric.session import scratch_dir, stage, together
from auric.sources.runlog import RunLog
from auric.sources.store import PublishRefused, TableStore
from auric.sources.tables import require_sources

RUN1, RUN2 = "execucao-teste-0001", "execucao-teste-0002"
DAY1, DAY2 = dt.date(2024, 2, 1), dt.date(2024, 2, 2)
#: Limits of the tests defined anew for the second day.
NEW_LIMITS = {"Q01_VALIDADE_FONTES": 10, "Q08_VALIDADE_POR_ARQUIVO": 0}
#: The sources that others refer to, and what these read of them.
PARENTS = {"catalogo": ("conteudo_id", "data_publicacao"), "usuarios": ("usuario_id",)}


def accepted_keys(classified: DataFrame, *cols: str) -> DataFrame:
    return classified.where("regra is null and not superado").select(*cols).distinct()


class Round:
    """What one run read, classified and published, as the quality tests ask for it."""

    def __init__(self, spark, delivered: dict[str, DataFrame], classified: dict[str, DataFrame]):
        self.spark, self._delivered, self.classified = spark, delivered, classified
        self.published_correspondence: DataFrame | None = None
        for fonte, df in classified.items():
            setattr(self, f"cls_{fonte}", df.where("not superado"))

    def bronze(self, fonte: str, spread_rows: bool = True) -> DataFrame:
        return self._delivered[fonte]

    @cached_property
    def cls_todos(self) -> DataFrame:
        out = None
        for fonte in self.classified:
            d = getattr(self, f"cls_{fonte}").select("fonte", "_origem", "_linha", "regra", "severidade")
            out = d if out is None else out.unionByName(d)
        return out


class Chain:
    def __init__(self, m: Model):
        self.m, self.spark = m, m.spark
        root = scratch_dir(m.spark, "chain")
        self.restricted = f"{root}/restrito"
        self.log = RunLog(m.spark, f"{root}/controle")
        self.silver, self.gold = TableStore(m.spark, f"{root}/silver"), TableStore(m.spark, f"{root}/gold")
        self.triage = Triage(m.spark, f"{root}/quarentena", self.restricted)
        self.rounds: dict[str, Round] = {}
        self.results: DataFrame | None = None
        self.waiting: DataFrame | None = None

    # ---- stages
    def _classify(self, run_id: str, delivered: dict[str, DataFrame]) -> dict[str, DataFrame]:
        out: dict[str, DataFrame] = {}
        accepted: dict[str, DataFrame] = {}  # keys of parents, staged once for three sources: what is broadcast is judged by files of keys alone
        ok = lambda f: accepted[f]
        steps = {
            "catalogo": lambda df: classify.catalog(df, keep_superseded=True),
            "usuarios": lambda df: classify.users(df, RUN_DATE, self.m.key, self.m.salt, keep_superseded=True),
            "interacoes": lambda df: classify.events(df, RUN_TS, ok("usuarios"), ok("catalogo")),
            "comentarios": lambda df: classify.comments(df, RUN_DATE, ok("usuarios"), ok("catalogo")),
            "recomendacoes": lambda df: classify.recommendations(df, ok("usuarios"), ok("catalogo").select("conteudo_id").distinct()),
        }
        def classified(fonte):
            def work(s):
                src = self.triage.overlay(identified(delivered[fonte], fonte, list(raw.SOURCES[fonte][1])), fonte, list(raw.SOURCES[fonte][1]))
                src = s.counting(src, lidos=F.lit(True), descartados=F.col("_descartado")).where("not _descartado").drop("_descartado")
                df = steps[fonte](src).drop("_hash").withColumn("_execucao_id", F.lit(run_id))
                if "superado" not in df.columns:
                    df = df.withColumn("superado", F.lit(False))
                lost = F.col("superado")
                df = s.counting(df, gravados=F.col("regra").isNull() & ~lost, quarentena=F.col("regra").isNotNull(), superados=lost)
                kept = F.when(F.col("regra").isNotNull() | F.col("_aguardava"), F.unhex("hash_origem"))  # triage asks for these alone
                return stage(df.withColumn("hash_origem", kept), f"{run_id}-{fonte}").withColumn("hash_origem", F.lower(F.hex("hash_origem")))

            return self.log.run_stage(run_id, f"silver_{layers.ENTITY[fonte]}", work)

        out |= together(**{f: lambda f=f: classified(f) for f in PARENTS})
        accepted |= together(**{f: lambda f=f, cols=cols: stage(accepted_keys(out[f], *cols), f"{run_id}-{f}-aceitos") for f, cols in PARENTS.items()})
        out |= together(**{f: lambda f=f: classified(f) for f in steps if f not in PARENTS})
        return out

    def _publish_silver(self, run_id: str, current: Round) -> None:
        def work(s):
            rows = {f: getattr(current, f"cls_{f}") for f in current.classified}
            commit = layers.publish_silver(self.silver, run_id, rows, self.m.key, self.restricted)
            s.message = f"{commit['tabelas']['usuario']['linhas']} usuarios, {commit['tabelas']['usuario_mestre']['linhas']} pessoas"

        self.log.run_stage(run_id, "silver_publicacao", work)
        current.published_correspondence = self.silver.read("usuario_correspondencia")

    def _judge(self, run_id: str, current: Round, defs: DataFrame, day: dt.date) -> None:
        from auric.plans.q_quality import TESTS

        def work(s):
            measured = Q.measure_all(TESTS, current, run_id)
            return stage(Q.judged(measured, Q.as_of(defs, day)), "resultados")

        results = self.log.run_stage(run_id, "qualidade", work)
        self.results = results if self.results is None else self.results.unionByName(results)

    def _publish_gold(self, run_id: str) -> None:
        try:
            self.log.run_stage(run_id, "gold", lambda s: layers.publish_gold(self.silver, self.gold, run_id, self.results))
        except PublishRefused:
            pass  # logged; what was published before stays

    def _run(self, run_id: str, delivered: dict[str, DataFrame], defs: DataFrame, day: dt.date) -> None:
        classified = self._classify(run_id, delivered)
        current = self.rounds[run_id] = Round(self.spark, delivered, classified)
        together(triage=lambda: self.triage.record_run(run_id, {f: getattr(current, f"cls_{f}") for f in classified}),
                 silver=lambda: self._publish_silver(run_id, current))
        self._judge(run_id, current, defs, day)
        self._publish_gold(run_id)
        self.log.close_run(run_id)

    # ---- triage between the runs
    def _edit(self, delivered: dict[str, DataFrame]) -> None:
        """Apply the rules of ``raw.TRIAGE`` to the waiting records, with sight of the records as delivered."""
        found = None
        waiting = self.triage.state().select(*ID, "regra")
        for fonte, rules in raw.TRIAGE.items():  # each delivery is read and joined once for all its rules
            seen = waiting.where(F.col("fonte") == fonte).join(identified(delivered[fonte], fonte, list(raw.SOURCES[fonte][1])), KEYS)
            edit = [F.when(F.expr(where), F.struct(F.lit(field).alias("campo"), F.expr(value).alias("valor"))) for where, field, value in rules if field]
            gone = [F.coalesce(F.expr(where), F.lit(False)) for where, field, _ in rules if field is None]
            hit = seen.select(*ID, F.array_compact(F.array(*edit)).alias("edicoes"), F.array_contains(F.array(*gone), True).alias("fora"))
            hit = hit.where((F.size("edicoes") > 0) | F.col("fora"))
            found = hit if found is None else found.unionByName(hit)
        found = stage(found, "triagem")
        self.triage.edit(found.select(*ID, F.explode("edicoes").alias("e")).select(*ID, "e.campo", "e.valor"))
        self.triage.discard(found.where("fora").select(*ID))
        self.waiting = stage(self.triage.state().select(*ID, "regra", "severidade", "status"), "estado")

    def identified2(self, fonte: str) -> DataFrame:
        """The second day's delivery of a source, with the identity of its records."""
        return identified(self.rounds[RUN2].bronze(fonte), fonte, list(raw.SOURCES[fonte][1]))

    def run(self) -> "Chain":
        from auric.plans.q_quality import TESTS

        first = {f: self.m.bronze(f) for f in raw.SOURCES}
        defs = Q.definitions(self.spark, TESTS, dt.date(2024, 1, 1))
        self.log.open_run(RUN1)
        self._run(RUN1, first, defs, DAY1)

        self._edit(first)
        changed = [Q.QualityTest(t.teste_id, t.nome, t.dimensao, t.operador, NEW_LIMITS[t.teste_id], t.severidade, t.measure) for t in TESTS if t.teste_id in NEW_LIMITS]
        defs = defs.unionByName(Q.definitions(self.spark, changed, DAY2, 1))

        second = {f: raw.redelivered(df, f) for f, df in first.items()}
        self.log.open_run(RUN2)
        try:  # the first attempt finds a source missing, the second one all
            self.log.run_stage(RUN2, "fontes", lambda s: require_sources(self.spark, [f"{self.m.sf}/lote_3/catalogo.parquet"]))
        except FileNotFoundError:
            self.log.run_stage(RUN2, "fontes", lambda s: require_sources(self.spark, [f"{self.m.sf}/{t}.parquet" for t, *_ in raw.SOURCES.values()]))
        self._run(RUN2, second, defs, DAY2)
        return self

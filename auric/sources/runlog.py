"""Log of runs and stages, with counts measured while a stage writes.

Every event (a run opened or closed; a stage started, finished, failed or
skipped) is one small file of its own under ``<root>/eventos``; nothing is
updated. State is the fold of the events: attempts of a stage are numbered,
the last one counts, and a run's status follows from its stages.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from auric.sources.store import create_file, list_names

COUNTS = ["lidos", "gravados", "quarentena", "superados", "descartados"]
SCHEMA = "execucao_id string, ordem long, evento string, etapa string, em timestamp_ntz, mensagem string, " + ", ".join(f"{c} long" for c in COUNTS)

# The states of a stage and of a run.
RUNNING, DONE, DONE_WITH_NOTES, FAILED, SKIPPED = "em_andamento", "sucesso", "sucesso_com_ressalvas", "falha", "ignorada"


def new_run_id() -> str:
    return str(uuid.uuid4())


def utc_label(moment: dt.datetime) -> str:
    """A zoned moment as ``YYYY-MM-DDTHH:MM:SSZ`` in UTC; a moment without a zone is an error."""
    if moment.tzinfo is None:
        raise ValueError("the moment has no time zone")
    return moment.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class Stage:
    """A stage under way: what it reads and writes is counted as it passes."""

    def __init__(self):
        self._seen: list[Observation] = []
        self.message: str | None = None

    def counting(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df`` with the rows that fulfil each condition counted when it is next computed. Put it where a plan reads
        its rows once, as right before a write; a plan that reads them twice would count them twice."""
        unknown = set(counts) - set(COUNTS)
        if unknown:
            raise ValueError(f"unknown counts: {sorted(unknown)}")
        seen = Observation(uuid.uuid4().hex)
        self._seen.append(seen)
        return df.observe(seen, *[F.count_if(cond).alias(name) for name, cond in counts.items()])

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for seen in self._seen:
            for name, n in seen.get.items():
                out[name] = out.get(name, 0) + n
        return out


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._last, self._lock = 0, threading.Lock()

    def _append(self, run_id: str, event: str, stage: str | None = None, message: str | None = None, **counts) -> None:
        with self._lock:  # events of one writer are in the order written
            order = self._last = max(self._last + 1, time.time_ns())
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
        row = {"execucao_id": run_id, "ordem": order, "evento": event, "etapa": stage, "em": now, "mensagem": message, **counts}
        create_file(self.spark, f"{self.root}/eventos/{order}-{uuid.uuid4().hex[:8]}.json", json.dumps(row).encode())

    # ---- writing
    def open_run(self, run_id: str | None = None) -> str:
        """Open a run, or open it again to repeat stages; a blank id gets a new one."""
        run_id = (run_id or "").strip() or new_run_id()
        self._append(run_id, "aberta")
        return run_id

    def run_stage(self, run_id: str, name: str, work):
        """Run ``work(stage)`` as a stage and log its outcome with the counts measured; its result is returned. An error
        is logged and raised again."""
        self._append(run_id, "iniciada", name)
        stage = Stage()
        try:
            result = work(stage)
            counts = stage.counts()
        except BaseException as e:
            self._append(run_id, "falha", name, str(e).split("\n")[0][:500])
            raise
        self._append(run_id, "concluida", name, stage.message, **counts)
        return result

    def skip_stage(self, run_id: str, name: str, why: str) -> None:
        self._append(run_id, "ignorada", name, why)

    def close_run(self, run_id: str) -> str:
        """Close a run and return its status."""
        found = self.runs().where(F.col("execucao_id") == run_id).first()
        if found is None:
            raise KeyError(f"run {run_id} does not exist")
        status = FAILED if found["status"] == RUNNING or found["etapas"] == 0 else found["status"]
        self._append(run_id, "finalizada", message=status)
        return status

    # ---- reading
    def events(self) -> DataFrame:
        if not list_names(self.spark, f"{self.root}/eventos"):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(f"{self.root}/eventos")

    def attempts(self) -> DataFrame:
        """(run, stage, attempt, status, started, ended, counts, message, latest): every attempt of every stage. An
        attempt begins with its start, a skipped stage is an attempt of its own; one that never ended is running."""
        e = self.events().where(F.col("etapa").isNotNull())
        so_far = Window.partitionBy("execucao_id", "etapa").orderBy("ordem")
        begins = F.col("evento").isin("iniciada", "ignorada")
        e = e.withColumn("tentativa", F.sum(begins.cast("long")).over(so_far))
        last = lambda c: F.max_by(c, "ordem").alias(c)
        a = e.groupBy("execucao_id", "etapa", "tentativa").agg(
            F.max_by("evento", "ordem").alias("evento"), F.min("em").alias("inicio"),
            F.max(F.when(F.col("evento") != "iniciada", F.col("em"))).alias("fim"), last("mensagem"), *[last(c) for c in COUNTS])
        status = (F.when(F.col("evento") == "iniciada", RUNNING).when(F.col("evento") == "falha", FAILED)
                  .when(F.col("evento") == "ignorada", SKIPPED).when(F.coalesce("quarentena", F.lit(0)) > 0, DONE_WITH_NOTES).otherwise(DONE))
        top = Window.partitionBy("execucao_id", "etapa")
        return a.select("execucao_id", "etapa", "tentativa", status.alias("status"), "inicio", "fim", *COUNTS, "mensagem",
                        (F.col("tentativa") == F.max("tentativa").over(top)).alias("ultima"))

    def stages(self) -> DataFrame:
        """The latest attempt of each stage, with whether its counts add up: what was read must be written,
        quarantined, superseded or discarded. Unknown where a stage reads nothing."""
        rest = sum((F.coalesce(c, F.lit(0)) for c in COUNTS[1:]), F.lit(0))
        return self.attempts().where("ultima").drop("ultima").withColumn("fecha", F.col("lidos") == rest)

    def runs(self) -> DataFrame:
        """(run, status, stages): a failed or unfinished stage fails a run, a stage with notes leaves it with notes."""
        s = self.stages()
        per = s.groupBy("execucao_id").agg(
            F.count("*").alias("etapas"), F.bool_or(F.col("status").isin(FAILED, RUNNING)).alias("_bad"),
            F.bool_or(F.col("status") == DONE_WITH_NOTES).alias("_notes"))
        all_runs = self.events().groupBy("execucao_id").agg(F.bool_or(F.col("evento") == "finalizada").alias("fechada"))
        out = all_runs.join(per, "execucao_id", "left")
        status = F.when(F.col("_bad"), FAILED).when(F.col("_notes"), DONE_WITH_NOTES).when(F.col("_bad").isNotNull(), DONE).otherwise(RUNNING)
        return out.select("execucao_id", status.alias("status"), F.coalesce("etapas", F.lit(0)).alias("etapas"), "fechada")

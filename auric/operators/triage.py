"""Quarantine of all sources as a log of events, folded into its state.

A rejected record is known by (fonte, _origem, _linha, hash_origem): where it
stood and what it held as delivered. Four kinds of event are appended and
never changed: it was rejected (``detectado``) or accepted (``aprovado``) by
a run, a field was edited (``corrigido``), it was given up (``descartado``).
The state follows from the last events of a record; an edit of a line that
is delivered anew with other content has another hash and does not apply.

Edited values of personal fields go to a log in a restricted folder; the
open log has them masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions import privacy
from auric.operators.classify import content_hash
from auric.operators.joins import join_dim
from auric.sources.store import list_names

ID = ["fonte", "_origem", "_linha", "hash_origem"]
#: The identity as it is joined and grouped by: what is sorted by its line first is hardly ever compared by long texts.
KEYS = ["_linha", "hash_origem", "_origem", "fonte"]
EVENTS = ("fonte string, _origem string, _linha long, hash_origem string, evento string, execucao_id string, chave_registro string, "
          "regra string, severidade string, mensagem string, registro string, campo string, valor string")
RESTRICTED = "fonte string, _origem string, _linha long, hash_origem string, campo string, valor string"

# Events, states, and the personal fields of each source.
DETECTED, APPROVED, CORRECTED, DISCARDED = "detectado", "aprovado", "corrigido", "descartado"
PENDING, REPROCESSED = "pendente", "reprocessado"
PERSONAL = {"usuarios": ["nome", "email", "cpf", "data_nascimento", "telefone"]}


def is_personal(fonte: Column, field: Column) -> Column:
    cond = F.lit(False)
    for source, fields in PERSONAL.items():
        cond = cond | ((fonte == source) & field.isin(fields))
    return cond


def masked(field: Column, value: Column) -> Column:
    """A personal value as the open log may show it."""
    return F.when(field == "nome", privacy.mask_name(value)).when(field == "email", privacy.mask_email(value)).otherwise(
        F.when(value.isNotNull(), F.lit("***")))


def identified(bronze: DataFrame, fonte: str, business: list[str]) -> DataFrame:
    """Delivered rows with their source and the hash of their fields."""
    return bronze.withColumn("fonte", F.lit(fonte)).withColumn("hash_origem", content_hash(business))


class Triage:
    """The event log under ``root`` and the restricted log of edits under ``restricted``."""

    def __init__(self, spark: SparkSession, root: str, restricted: str):
        self.spark, self.root, self.restricted = spark, root.rstrip("/"), restricted.rstrip("/")

    # ---- appending: step n is one folder, replaced as a whole when the step is repeated
    def _steps(self) -> list[int]:
        done = [n for n in list_names(self.spark, f"{self.root}/eventos") if n.startswith("passo=")]
        return sorted(int(n.split("=")[1]) for n in done if "_SUCCESS" in list_names(self.spark, f"{self.root}/eventos/{n}"))

    def _append(self, events: DataFrame, restricted: DataFrame | None = None) -> int:
        step = max(self._steps(), default=0) + 1
        if restricted is not None:  # first, as a step counts once its events are complete
            restricted.write.mode("overwrite").parquet(f"{self.restricted}/edicoes/passo={step}")
        kinds = dict(f.strip().split(" ") for f in EVENTS.split(","))
        cols = [F.col(c).cast(k).alias(c) if c in events.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
        events.select(*cols).write.mode("overwrite").parquet(f"{self.root}/eventos/passo={step}")
        return step

    def record_run(self, run_id: str, classified: dict[str, DataFrame]) -> int:
        """Append what a run rejected, and what it accepted of the records that were waiting for it. Where all rows have
        the flag ``_aguardava`` that ``overlay`` gave them, only flagged ones are looked up."""
        rejected, rows = None, None
        keep = [*ID, "chave_registro", "regra", "severidade", "mensagem", "registro"]
        flagged = all("_aguardava" in df.columns for df in classified.values())
        for df in classified.values():
            bad = df.where("regra is not null").select(*keep)
            known = (df.where("_aguardava") if flagged else df).select(*ID, F.col("regra").isNull().alias("_aceito"))
            rejected = bad if rejected is None else rejected.unionByName(bad)
            rows = known if rows is None else rows.unionByName(known)
        events = rejected.withColumn("evento", F.lit(DETECTED))
        if self._steps():  # else nothing waits
            waiting = self.state().where(F.col("status").isin(PENDING, CORRECTED)).select(*ID)
            # rows alike in place and content are one record, which is rejected if one of them is
            resolved = join_dim(rows.where("_aceito").select(*KEYS).distinct(), waiting, KEYS, "left_semi").join(rows.where("not _aceito").select(*KEYS), KEYS, "left_anti")
            events = events.unionByName(resolved.withColumn("evento", F.lit(APPROVED)), allowMissingColumns=True)
        return self._append(events.withColumn("execucao_id", F.lit(run_id)))

    def edit(self, edits: DataFrame) -> int:
        """Append edits (identity, campo, valor) of records; several fields of one record may be edited at once."""
        personal = is_personal(F.col("fonte"), F.col("campo"))
        open_value = F.when(personal, masked(F.col("campo"), F.col("valor"))).otherwise(F.col("valor"))
        return self._append(edits.withColumn("evento", F.lit(CORRECTED)).withColumn("valor", open_value),
                            edits.where(personal).select(*ID, "campo", "valor"))

    def discard(self, records: DataFrame) -> int:
        return self._append(records.select(*ID).withColumn("evento", F.lit(DISCARDED)))

    # ---- folding
    def events(self) -> DataFrame:
        steps = self._steps()
        if not steps:
            return self.spark.createDataFrame([], EVENTS + ", passo int")
        read = self.spark.read.schema(EVENTS + ", passo int").option("basePath", f"{self.root}/eventos")
        return read.parquet(*[f"{self.root}/eventos/passo={n}" for n in steps])

    def _private(self) -> DataFrame:
        steps = {f"passo={n}" for n in self._steps()}
        done = [n for n in list_names(self.spark, f"{self.restricted}/edicoes") if n in steps]
        if not done:
            return self.spark.createDataFrame([], RESTRICTED + ", passo int")
        read = self.spark.read.schema(RESTRICTED + ", passo int").option("basePath", f"{self.restricted}/edicoes")
        return read.parquet(*[f"{self.restricted}/edicoes/{n}" for n in done])

    def state(self) -> DataFrame:
        """One row per rejected record: (identity, chave_registro, regra, severidade, mensagem, registro as rejected last and
        registro_original as rejected first, status, execucao_id of the first and ultima_execucao_id of the last). Rejected again after a correction or an
        approval, a record waits again, under the rule found last; given up, it stays so until it is edited."""
        seen, touched = F.col("evento") == DETECTED, F.col("evento").isin(CORRECTED, DISCARDED)
        last = lambda c: F.max_by(c, F.when(seen, F.col("passo"))).alias(c)
        s = self.events().groupBy(*KEYS).agg(
            F.max_by("evento", "passo").alias("_last"), F.max_by("evento", F.when(touched, F.col("passo"))).alias("_touch"),
            *[last(c) for c in ("chave_registro", "regra", "severidade", "mensagem", "registro")],
            F.min_by("registro", F.when(seen, F.col("passo"))).alias("registro_original"),
            F.min_by("execucao_id", F.when(seen, F.col("passo"))).alias("execucao_id"),
            F.max_by("execucao_id", F.when(seen, F.col("passo"))).alias("ultima_execucao_id"))
        status = (F.when(F.col("_touch") == DISCARDED, DISCARDED).when(F.col("_last") == CORRECTED, CORRECTED)
                  .when(F.col("_last") == APPROVED, REPROCESSED).otherwise(PENDING))
        return s.where(F.col("regra").isNotNull()).withColumn("status", status).select(*ID, *[c for c in s.columns if c not in (*ID, "_last", "_touch")], "status")

    def edits(self, restricted: bool = False) -> DataFrame:
        """(identity, campo, valor) in force: the last edit of each field; with ``restricted`` the personal values too."""
        e = self.events().where(F.col("evento") == CORRECTED).select(*ID, "campo", "valor", "passo")
        if restricted:
            e = e.where(~is_personal(F.col("fonte"), F.col("campo"))).unionByName(self._private().select(*ID, "campo", "valor", "passo"))
        return e.groupBy(*KEYS, "campo").agg(F.max_by("valor", "passo").alias("valor")).select(*ID, "campo", "valor")

    def diff(self) -> DataFrame:
        """(identity, campo, antes, depois) of every edited field whose value differs, personal ones masked."""
        before = F.try_element_at(F.from_json("registro_original", "map<string,string>"), F.col("campo"))
        j = self.edits().join(self.state().select(*ID, "registro_original"), KEYS)
        return j.select(*ID, "campo", before.alias("antes"), F.col("valor").alias("depois")).where("not (antes <=> depois)")

    def overlay(self, bronze: DataFrame, fonte: str, business: list[str]) -> DataFrame:
        """Delivered rows of a source (see ``identified``) as the next run takes them: fields of corrected records
        replaced, ``_descartado`` true for records given up and ``_aguardava`` for those that wait for a run.

        Rows are joined by their place alone, and their content is hashed again after it, so that no hash is moved."""
        if not self._steps():  # nothing was ever rejected
            no = F.lit(False)
            return bronze.select("_origem", "_linha", "hash_origem", *business, no.alias("_descartado"), no.alias("_substituido"), no.alias("_aguardava"))
        line = ["_linha", "_origem"]  # in this order, as in KEYS
        s = self.state().where(F.col("fonte") == fonte).select(*ID, "status").dropna(subset=ID)
        per = self.edits(restricted=True).where(F.col("fonte") == fonte).groupBy(*KEYS).agg(
            F.map_from_entries(F.collect_list(F.struct("campo", "valor"))).alias("_new"))  # at most one entry a field
        known = s.join(per, KEYS, "left").groupBy(*line).agg(F.map_from_entries(F.collect_list(F.struct("hash_origem", F.struct("status", "_new")))).alias("_estados"))
        j = join_dim(bronze.select(*line, *business), known, line, "left").withColumn("hash_origem", content_hash(business))
        j = j.withColumn("_estado", F.try_element_at("_estados", F.col("hash_origem")))
        status, new = F.col("_estado.status"), F.col("_estado._new")
        given_up = F.coalesce(status == DISCARDED, F.lit(False))
        edited = F.coalesce(status.isin(CORRECTED, REPROCESSED), F.lit(False))
        fresh = lambda c: F.when(edited & F.coalesce(F.map_contains_key(new, F.lit(c)), F.lit(False)), F.try_element_at(new, F.lit(c))).otherwise(F.col(c))
        return j.select("_origem", "_linha", "hash_origem", *[fresh(c).alias(c) for c in business], given_up.alias("_descartado"), edited.alias("_substituido"),
                        F.coalesce(status.isin(PENDING, CORRECTED), F.lit(False)).alias("_aguardava"))

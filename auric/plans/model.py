"""Stand-in Silver/Gold entities derived from the driver tables.

The reference's e-learning entities are mapped onto the driver tables
(SURVEY §7.2):

* conteudo  ← part       (category = brand, type from p_type, level from size)
* interacao ← events     (content id = props.k, type from event_type)
* usuario   ← customer   (personal fields derived from the key, so that some
  accounts share a CPF or an e-mail and resolve to one person)
* conteudo_embedding ← embeddings (vec_id = conteudo_id)

Every entity is a lazy DataFrame; the same derivation is written as DuckDB
SQL in :mod:`auric.plans.sqlmodel` for the oracle.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions import domain, privacy
from auric.functions.text import clean_text
from auric.operators import identity
from auric.operators.joins import BROADCAST_LIMIT_BYTES
from auric.session import stage
from auric.sources.tables import table

# Fixed run parameters (determinism: no current_date() inside query keys).
RUN_DATE = dt.date(2024, 2, 1)
RUN_TS = dt.datetime(2024, 2, 1, 0, 0, 0)
RECOMMENDED_AT = dt.datetime(2024, 1, 15, 0, 0, 0)
PSEUDONYM_KEY = "chave-de-teste-pseudonimo-0001"
HASH_SALT = "salt-de-teste-0000000000001"
EMBEDDING_MODEL = "hash-64"
TOP_K = 10
MIN_GOOD_GRADE = 4

TYPE_BY_PTYPE = {
    "ECONOMY": "Curso", "STANDARD": "Curso", "SMALL": "Vídeo",
    "MEDIUM": "Vídeo", "LARGE": "Artigo", "PROMO": "Podcast",
}
INTERACTION_BY_EVENT = {
    "view": "visualização", "signup": "início", "purchase": "conclusão", "click": "avaliação",
    "error": "curtida",
}


def run_date() -> Column:
    return F.lit(RUN_DATE)


def secret(spark: SparkSession, conf_key: str, default: str, name: str) -> str:
    return domain.check_secret(spark.conf.get(conf_key, default), name)


class Model:
    """Lazy stand-in entities for one ``sf`` folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf = sf_dir
        spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_LIMIT_BYTES))  # what Spark broadcasts unasked passes through the driver too
        self.key = secret(spark, "spark.auric.pseudonym.key", PSEUDONYM_KEY, "pseudonym key")
        self.salt = secret(spark, "spark.auric.hash.salt", HASH_SALT, "hash salt")

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)

    # ---- Silver -----------------------------------------------------------
    @cached_property
    def conteudo(self) -> DataFrame:
        p = self.t("part")
        tipo = F.create_map(*[F.lit(x) for kv in TYPE_BY_PTYPE.items() for x in kv])
        return p.select(
            F.col("p_partkey").alias("conteudo_id"),
            F.col("p_name").alias("titulo"),
            F.try_element_at(tipo, F.col("p_type")).alias("tipo"),
            F.col("p_brand").alias("categoria"),
            F.when(F.col("p_size") <= 15, "Básico").when(F.col("p_size") <= 35, "Intermediário")
            .otherwise("Avançado").alias("nivel"),
            (F.col("p_size") * 4).cast("int").alias("carga_horaria_min"),
            F.date_add(F.lit(dt.date(2023, 12, 1)), F.pmod("p_partkey", F.lit(45)).cast("int")).alias("data_publicacao"),
        )

    def interacao_de(self, tipos) -> DataFrame:
        """Interactions of the given types; the filter is put on the event type, where the scan takes it."""
        eventos = [e for e, t in INTERACTION_BY_EVENT.items() if t in tipos]
        return self._interacao(self.t("events").where(F.col("event_type").isin(eventos)))

    @cached_property
    def interacao(self) -> DataFrame:
        return self._interacao(self.t("events"))

    def _interacao(self, e: DataFrame) -> DataFrame:
        tipo = F.create_map(*[F.lit(x) for kv in INTERACTION_BY_EVENT.items() for x in kv])
        return e.select(
            F.col("event_id").alias("interacao_id"),
            F.col("user_id").alias("usuario_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("conteudo_id"),
            F.try_element_at(tipo, F.col("event_type")).alias("tipo_interacao"),
            F.col("ts").alias("data_hora"),
            F.floor("value").cast("int").alias("tempo_consumido"),
            F.when(F.col("event_type") == "purchase", F.lit(100.0))
            .when(F.col("event_type") == "signup", F.pmod("event_id", F.lit(101)).cast("double"))
            .alias("percentual_conclusao"),
            F.when(F.col("event_type") == "click", (F.pmod("event_id", F.lit(5)) + 1).cast("int"))
            .alias("avaliacao_atribuida"),
        )

    @cached_property
    def usuario_raw(self) -> DataFrame:
        """Typed personal data before protection (never leaves Silver)."""
        c = self.t("customer")
        k = F.col("c_custkey")
        seg = F.col("c_mktsegment")
        uf = F.array(*[F.lit(s) for s in domain.STATE_CODES])
        return c.select(
            k.alias("usuario_id"),
            F.concat(F.upper(F.left(seg, F.lit(1))), F.lower(F.substring(seg, 2, 100)), F.lit(" "),
                     F.col("c_name")).alias("nome"),
            F.concat(F.lit("cliente"), F.when(F.pmod(k, F.lit(10)) == 2, k - 1).otherwise(k).cast("string"),
                     F.lit("@example.com")).alias("email"),
            F.lpad(F.when(F.pmod(k, F.lit(10)) == 1, k - 1).otherwise(k).cast("string"), 11, "0").alias("cpf"),
            F.date_add(F.lit(dt.date(1950, 1, 1)), F.pmod(k * 37, F.lit(25000)).cast("int")).alias("data_nascimento"),
            F.concat(F.lit("Cidade "), F.col("c_nationkey").cast("string")).alias("cidade"),
            F.element_at(uf, (F.pmod("c_nationkey", F.lit(27)) + 1).cast("int")).alias("uf"),
            F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(k * 13, F.lit(1400)).cast("int")).alias("data_cadastro"),
        ).withColumn(
            "atualizado_em",
            F.timestamp_add("HOUR", F.pmod(F.col("usuario_id"), F.lit(24)),
                            F.col("data_cadastro").cast("timestamp_ntz")),
        )

    @cached_property
    def usuario(self) -> DataFrame:
        """Silver users: personal fields protected in flight."""
        u = self.usuario_raw
        email = F.lower(clean_text("email"))
        return u.select(
            "usuario_id",
            privacy.pseudonym(F.col("usuario_id"), self.key).alias("usuario_pseudo"),
            privacy.mask_name(clean_text("nome")).alias("nome_mascarado"),
            privacy.mask_email(email).alias("email_mascarado"),
            privacy.salted_hash(email, self.salt).alias("email_hash"),
            privacy.salted_hash(privacy.digits_only(F.col("cpf")), self.salt).alias("cpf_hash"),
            domain.age_band(F.col("data_nascimento"), run_date()).alias("faixa_etaria"),
            "cidade", "uf", "data_cadastro", "atualizado_em",
        )

    @cached_property
    def components(self) -> DataFrame:
        """(usuario_id, usuario_mestre_id): accounts sharing a CPF hash or an
        e-mail hash, transitively, are one person; the min id is the master."""
        comps = identity.resolve(self.spark, self.usuario, "usuario_id",
                                 {"cpf_hash": "cpf_hash", "email_hash": "email_hash"})
        return comps.withColumnRenamed("component", "usuario_mestre_id").checkpoint()

    @cached_property
    def correspondencia(self) -> DataFrame:
        """Member → master with the match reason (own, direct CPF or e-mail
        evidence with the master, else transitive)."""
        return identity.correspondence(self.usuario, self.components)

    @cached_property
    def mestre(self) -> DataFrame:
        return identity.master(self.usuario, self.components, self.key)

    @cached_property
    def person_of(self) -> DataFrame:
        """usuario_id → usuario_pseudo (two-hop resolution)."""
        return stage(self.correspondencia.select("usuario_id", "usuario_mestre_id").join(
            self.mestre.select("usuario_mestre_id", "usuario_pseudo"), "usuario_mestre_id"
        ).select("usuario_id", "usuario_pseudo"), "person")

    @cached_property
    def comentario(self) -> DataFrame:
        """Comments ← documents: free text, a grade and two tags per document."""
        d = self.t("documents")
        return d.select(
            F.col("doc_id").alias("comentario_id"),
            F.col("doc_id").alias("usuario_id"),
            (F.col("doc_id") + 1).alias("conteudo_id"),
            (F.pmod("doc_id", F.lit(5)) + 1).cast("int").alias("avaliacao"),
            F.col("text").alias("comentario"),
            F.array("lang", "source").alias("tags"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod("doc_id", F.lit(30)).cast("int")).alias("data"),
        )

    @cached_property
    def embedding(self) -> DataFrame:
        e = self.t("embeddings")
        return e.select(
            F.col("vec_id").alias("conteudo_id"), F.lit(EMBEDDING_MODEL).alias("modelo"),
            F.col("embedding"),
        )

    # ---- Bronze → classified Silver ---------------------------------------
    def bronze(self, fonte: str, spread_rows: bool = True) -> DataFrame:
        from auric.plans import raw

        return raw.bronze(self.spark, self.sf, fonte, spread_rows)

    def _classified(self, fonte: str) -> DataFrame:
        """The classified rows of a source, not written down: a query that asks for few columns moves few."""
        from auric.operators import classify

        b = self.bronze(fonte)
        return {
            "catalogo": lambda: classify.catalog(b),
            "usuarios": lambda: classify.users(b, RUN_DATE, self.key, self.salt),
            "interacoes": lambda: classify.events(b, RUN_TS, self.users_ok, self.contents_ok),
            "comentarios": lambda: classify.comments(b, RUN_DATE, self.users_ok, self.contents_ok),
            "recomendacoes": lambda: classify.recommendations(b, self.users_ok, self.contents_ok),
        }[fonte]()

    @cached_property
    def users_ok(self) -> DataFrame:
        from auric.operators import classify

        return stage(classify.accepted_keys(self._classified("usuarios"), "usuario_id"), "users_ok")

    @cached_property
    def contents_ok(self) -> DataFrame:
        from auric.operators import classify

        return stage(classify.accepted_keys(self._classified("catalogo"), "conteudo_id", ["data_publicacao"]), "contents_ok")

    @cached_property
    def cls_catalogo(self) -> DataFrame:
        return stage(self._classified("catalogo").drop("hash_origem"))

    @cached_property
    def cls_usuarios(self) -> DataFrame:
        return stage(self._classified("usuarios").drop("hash_origem"))

    @cached_property
    def cls_interacoes(self) -> DataFrame:
        return stage(self._classified("interacoes").drop("hash_origem"))

    @cached_property
    def cls_comentarios(self) -> DataFrame:
        return stage(self._classified("comentarios").drop("hash_origem", "_hash"))

    @cached_property
    def cls_recomendacoes(self) -> DataFrame:
        return stage(self._classified("recomendacoes").drop("hash_origem", "_hash"))

    @cached_property
    def cls_todos(self) -> DataFrame:
        from auric.plans import raw

        out = None
        for fonte in raw.SOURCES:
            d = self._classified(fonte).select("fonte", "_origem", "_linha", "regra", "severidade")
            out = d if out is None else out.unionByName(d)
        return out

    # ---- Gold -------------------------------------------------------------
    @cached_property
    def fato_interacao(self) -> DataFrame:
        from auric.operators import gold

        return stage(gold.fact_interaction(self.interacao, self.person_of), "fact")  # once for all its readers

    @cached_property
    def dim_usuario(self) -> DataFrame:
        """One row per person with the columns that may be published: no account id, e-mail or city."""
        return self.mestre.select("usuario_pseudo", "nome_mascarado", "faixa_etaria", "uf", "data_cadastro",
                                  "registros_origem")

    @cached_property
    def dim_conteudo(self) -> DataFrame:
        return self.conteudo

    @cached_property
    def recomendacao(self) -> DataFrame:
        from auric.operators import recommend

        return stage(recommend.recommend(self, TOP_K), "recommendations")

    @cached_property
    def fato_recomendacao(self) -> DataFrame:
        from auric.operators import gold

        return stage(gold.fact_recommendation(self.recomendacao, self.person_of, self.fato_interacao), "recommended")

    # ---- whole runs
    @cached_property
    def chain(self):
        """Two logged runs of the platform with triage between them, run once."""
        from auric.plans.chain import Chain

        return Chain(self).run()

"""Silver and Gold as published sets of tables.

Silver is published from the classified rows of one run, Gold from the
published Silver of that run once its quality results have no critical
failure. Both are written, checked as written and switched by
:mod:`auric.sources.store`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.operators import gold, identity, policy
from auric.operators.ids import number_rows
from auric.session import together
from auric.sources.store import Draft, PublishRefused, TableStore, duplicates, orphans

# Which source feeds which Silver table, and the columns published.
ENTITY = {"catalogo": "conteudo", "usuarios": "usuario", "interacoes": "interacao", "comentarios": "comentario", "recomendacoes": "recomendacao"}
COLUMNS = {
    "conteudo": ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao", "descricao", "autor"],
    "usuario": ["usuario_id", "usuario_pseudo", "nome_mascarado", "email_mascarado", "email_hash", "cpf_hash", "faixa_etaria", "cidade", "uf",
                "data_cadastro", "atualizado_em"],
    "interacao": ["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida"],
    "comentario": ["usuario_id", "conteudo_id", "avaliacao", "comentario", "tags", "data"],
    "recomendacao": ["usuario_id", "conteudo_id", "pontuacao", "posicao", "classificacao", "gerado_em"],
}
SILVER_KEYS = {"conteudo": ["conteudo_id"], "usuario": ["usuario_id"], "interacao": ["interacao_id"], "comentario": ["comentario_id"],
               "recomendacao": ["usuario_id", "conteudo_id", "gerado_em"], "usuario_mestre": ["usuario_mestre_id"], "usuario_correspondencia": ["usuario_id"]}
GOLD_KEYS = {"dim_conteudo": ["conteudo_id"], "dim_usuario": ["usuario_pseudo"], "fato_interacao": ["interacao_id"],
             "fato_recomendacao": ["usuario_pseudo", "conteudo_id", "gerado_em"]}


def key_checks(keys: dict[str, list[str]]) -> dict[str, Callable[[Draft], DataFrame]]:
    return {f"{name}: key {key}": lambda d, name=name, key=key: duplicates(d.read(name), *key) for name, key in keys.items()}


def parent_check(child: str, parent: str, col: str) -> dict[str, Callable[[Draft], DataFrame]]:
    return {f"{child}: {col} in {parent}": lambda d: orphans(d.read(child), d.read(parent), col)}


def publish_silver(store: TableStore, run_id: str, classified: dict[str, DataFrame], key: str, restricted: str) -> dict:
    """Publish the accepted rows of ``classified`` (by source, stamped ``_execucao_id``) with persons resolved, and the
    map of accounts to pseudonyms in the folder ``restricted``, as one version.

    Refused if a row was staged by another run, or if no content or no user was accepted."""
    staged = None
    for fonte, df in classified.items():
        part = df.select(F.lit(fonte).alias("fonte"), "_execucao_id", F.col("regra").isNull().alias("aceito"))
        staged = part if staged is None else staged.unionByName(part)
    found = staged.groupBy("fonte").agg(F.count_if(~F.col("_execucao_id").eqNullSafe(run_id)).alias("outras"), F.count_if("aceito").alias("aceitos")).collect()
    others = sum(r["outras"] for r in found)
    if others:
        raise PublishRefused(f"{others} staged rows are not of run {run_id}: validate all sources of the run before publishing")
    accepted = {r["fonte"]: r["aceitos"] for r in found}
    if not accepted.get("catalogo") or not accepted.get("usuarios"):
        raise PublishRefused(f"run {run_id} accepted no content or no user: nothing to publish")

    draft = store.draft(run_id)

    def add(fonte, entity):
        rows = classified[fonte].where("regra is null").select(*COLUMNS[entity], "_origem", "_linha", "_execucao_id")
        if entity in ("interacao", "comentario"):  # these have no key of their own
            rows = number_rows(rows, ["_origem", "_linha"], f"{entity}_id")
        return draft.add(entity, rows)

    def persons():
        users = add("usuarios", "usuario")
        comps = identity.resolve(store.spark, users, "usuario_id", {"cpf_hash": "cpf_hash", "email_hash": "email_hash"})
        comps = comps.withColumnRenamed("component", "usuario_mestre_id").checkpoint()
        together(master=lambda: draft.add("usuario_mestre", identity.master(users, comps, key)),
                 members=lambda: draft.add("usuario_correspondencia", identity.correspondence(users, comps)),
                 map=lambda: draft.add("usuario_pseudonimo", pseudonyms(store, users), root=restricted))

    together(persons=persons, **{entity: lambda f=fonte, e=entity: add(f, e) for fonte, entity in ENTITY.items() if entity != "usuario"})
    checks = key_checks(SILVER_KEYS) | parent_check("usuario", "usuario_correspondencia", "usuario_id")
    for child in ("interacao", "comentario", "recomendacao"):
        checks |= parent_check(child, "usuario", "usuario_id") | parent_check(child, "conteudo", "conteudo_id")
    draft.check_all(checks)
    return store.publish(draft)


def pseudonyms(store: TableStore, users: DataFrame) -> DataFrame:
    """The map of accounts to pseudonyms: accounts of this run, and those of earlier runs that it no longer has."""
    new = users.select("usuario_id", "usuario_pseudo")
    now = store.current()
    if now is None or "usuario_pseudonimo" not in now["tabelas"]:
        return new
    return new.unionByName(store.read("usuario_pseudonimo", now).join(new.select("usuario_id"), "usuario_id", "left_anti"))


def gold_tables(read: Callable[[str], DataFrame], write: Callable[[str, DataFrame], DataFrame]) -> None:
    """The nine Gold tables from the Silver tables that ``read`` gives; the KPI tables read the facts as written."""
    person = read("usuario_correspondencia").select("usuario_id", "usuario_mestre_id").join(
        read("usuario_mestre").select("usuario_mestre_id", "usuario_pseudo"), "usuario_mestre_id").select("usuario_id", "usuario_pseudo")
    dims = together(
        content=lambda: write("dim_conteudo", read("conteudo").select(*COLUMNS["conteudo"][:7])),
        person=lambda: write("dim_usuario", read("usuario_mestre").select("usuario_pseudo", "nome_mascarado", "faixa_etaria", "uf", "data_cadastro", "registros_origem")),
        fact=lambda: write("fato_interacao", gold.fact_interaction(read("interacao"), person)))
    content, fact = dims["content"], dims["fact"]

    def recommended():
        recs = write("fato_recomendacao", gold.fact_recommendation(read("recomendacao"), person, fact))
        write("kpi_conversao_recomendacao", gold.kpi_conversion(recs, content))

    together(recommended=recommended,
             engagement=lambda: write("kpi_engajamento_mensal", gold.kpi_engagement(fact, content)),
             active=lambda: write("kpi_usuarios_ativos_mensal", gold.kpi_active_people(fact)),
             completion=lambda: write("kpi_taxa_conclusao", gold.kpi_completion(fact, content)),
             rating=lambda: write("kpi_avaliacao", gold.kpi_rating(fact, content)))


def publish_gold(silver: TableStore, store: TableStore, run_id: str, results: DataFrame) -> dict:
    """Publish the nine Gold tables from the current Silver.

    Refused if that is of another run, if the run has no quality results, or if one of them is a critical failure. Each
    table is cut to the columns that the policy lets into Gold."""
    now = silver.current()
    if now is None or now["execucao_id"] != run_id:
        raise PublishRefused(f"the published Silver is of run {now and now['execucao_id']}, not of {run_id}")
    mine = results.where(F.col("execucao_id") == run_id)
    judged = mine.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(~F.col("aprovado") & (F.col("severidade") == "critica"), F.col("teste_id")))).alias("bad")).first()
    if not judged["n"]:
        raise PublishRefused(f"the quality of run {run_id} has not been judged")
    if judged["bad"]:
        raise PublishRefused(f"critical tests of run {run_id} failed: {', '.join(judged['bad'])}")

    draft = store.draft(run_id)
    gold_tables(lambda name: silver.read(name, now), lambda name, df: draft.add(name, policy.enforce(df, "gold")[0]))
    draft.check_all(key_checks(GOLD_KEYS) | parent_check("fato_interacao", "dim_usuario", "usuario_pseudo") | parent_check("fato_interacao", "dim_conteudo", "conteudo_id"))
    if silver.current()["numero"] != now["numero"]:
        raise PublishRefused("another Silver was published while Gold was written")
    return store.publish(draft, silver=now["numero"])

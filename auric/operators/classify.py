"""Silver classifiers: type every raw field, apply the ordered rule list,
then survivorship. Each returns every surviving record typed, with
``regra`` (NULL = accepted), ``severidade`` and ``mensagem``.

Rejected rows keep their raw record (``registro``) for the reject store (those
of events, comments and recommendations their label ``chave_registro`` too), and
every row the hash of the record as delivered (``hash_origem``), which a
correction laid over the record does not change. With ``keep_superseded``
the versions that lost to another file stay, flagged ``superado``.
Referential rules look at the *accepted* parents of the same run, through
left joins on the parent key. Nothing is written between the steps: a caller
that asks for few columns has only those, the keys and the hash moved.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions import domain, privacy
from auric.functions.parse import json_list, number_double, parse_date, parse_ts, strict_int
from auric.functions.text import clean_text, comparison_key, missing_fields, normalize_tags
from auric.operators import dedupe
from auric.operators import rules as R
from auric.operators.joins import KEYS_LIMIT_BYTES, bounded
from auric.operators.rules import rule

def content_hash(business: list[str]) -> Column:
    """Hash of a record's fields."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in business]), {"ignoreNullFields": "false"}))


def _prepare(raw: DataFrame, business: list[str]) -> DataFrame:
    """Priority and hashes, as the 16 bytes that they are while rows are moved."""
    own = F.unhex(content_hash(business))
    if {"hash_origem", "_substituido"} <= set(raw.columns):  # a record is hashed anew only where the overlay has replaced fields
        own = F.when(F.col("_substituido"), own).otherwise(F.unhex("hash_origem"))
    out = raw.withColumn("prioridade", domain.batch_priority(F.col("_origem"))).withColumn("_hash", own)
    # the hash as delivered is carried only where a correction has changed the fields
    return out.withColumn("hash_origem", F.nullif(F.unhex("hash_origem"), F.col("_hash")) if "hash_origem" in raw.columns else F.lit(None).cast("binary"))


def _audit() -> list[Column]:
    """The audit columns and the content hash, in hexadecimal."""
    return [F.col("_origem"), F.col("_linha"), F.lower(F.hex(F.coalesce("hash_origem", "_hash"))).alias("hash_origem"), F.lower(F.hex("_hash")).alias("_hash")]


def _record(business: list[str]) -> Column:
    """The raw record of a rejected row as JSON."""
    return F.when(F.col("regra").isNotNull(), F.to_json(F.struct(*[F.col(c) for c in business]))).alias("registro")


def _carried(df: DataFrame) -> list[Column]:
    """The flag of records that waited for this run, where the overlay of corrections has set it."""
    return [F.col("_aguardava")] if "_aguardava" in df.columns else []


def _superseded(df: DataFrame, keep: bool) -> tuple[DataFrame, list[Column]]:
    """The rows to go on with, and the flag column where superseded rows stay."""
    flag = F.coalesce(F.col("superado"), F.lit(False))
    return (df, [flag.alias("superado")]) if keep else (df.where(~flag), [])


def _judged(df: DataFrame, rules: list[R.Rule]) -> DataFrame:
    """``df`` with ``falha`` and ``falha_mensagem`` of the first violated rule; those that it has already come first. They
    are columns of their own, so that messages move only if asked for."""
    found = R.first_failure(rules)
    if "falha" not in df.columns:
        return df.withColumns({"falha": found["regra"], "falha_mensagem": found["mensagem"]})
    failed = F.col("falha").isNotNull()
    return df.withColumns({"falha": F.when(failed, F.col("falha")).otherwise(found["regra"]),
                           "falha_mensagem": F.when(failed, F.col("falha_mensagem")).otherwise(found["mensagem"])})


def _finish(df: DataFrame, later: list[R.Rule], fonte: str) -> DataFrame:
    """Rule, message and severity: ``falha`` where there is one, else the first violated rule of ``later``."""
    failed = F.col("falha").isNotNull()
    regra, mensagem = F.when(failed, F.col("falha")), F.when(failed, F.col("falha_mensagem"))
    for r in later:
        regra, mensagem = regra.when(r.violated, F.lit(r.code)), mensagem.when(r.violated, r.message)
    return df.select("*", F.lit(fonte).alias("fonte"), regra.alias("regra"), mensagem.alias("mensagem")) \
        .withColumn("severidade", domain.severity(F.col("regra")))


def _copy_or_conflict(first: str, winner: str, conflict: str) -> list[R.Rule]:
    """What survivorship found: a copy of row ``first``, or a loser to row ``winner``."""
    return [rule(R.DUPLICATE, F.col("e_copia"), F.concat(F.lit("copia identica da linha "), F.col(f"{first}._linha").cast("string"))),
            rule(R.VERSION_CONFLICT, F.col("conflito"), F.concat(F.lit(f"{conflict} da linha "), F.col(f"{winner}._linha").cast("string")))]


def _present_but_invalid(raw: str, typed: Column) -> Column:
    return clean_text(raw).isNotNull() & typed.isNull()


# ---------------------------------------------------------------- catalogue
def catalog(raw: DataFrame, keep_superseded: bool = False) -> DataFrame:
    from auric.plans.raw import CATALOG_COLS, CATALOG_REQUIRED

    df = _prepare(raw, list(CATALOG_COLS)).select(
        "*",
        strict_int("conteudo_id").alias("v_id"),
        clean_text("titulo").alias("v_titulo"),
        domain.content_type(F.col("tipo")).alias("v_tipo"),
        clean_text("categoria").alias("v_categoria"),
        domain.level(F.col("nivel")).alias("v_nivel"),
        strict_int("carga_horaria_min").alias("v_carga"),
        parse_date(F.col("data_publicacao")).alias("v_data"),
        missing_fields(CATALOG_REQUIRED).alias("v_ausentes"),
    )
    rules = [
        rule(R.REQUIRED, F.col("v_ausentes").isNotNull(), F.concat(F.lit("campos ausentes: "), "v_ausentes")),
        rule(R.TYPE, F.col("v_id").isNull(), "conteudo_id nao e inteiro"),
        rule(R.TYPE, F.col("v_carga").isNull(), "carga_horaria_min nao e inteira"),
        rule(R.DATE, F.col("v_data").isNull(), "data_publicacao nao e uma data valida"),
        rule(R.DOMAIN, F.col("v_tipo").isNull(), "tipo fora de Curso, Vídeo, Artigo, Podcast"),
        rule(R.DOMAIN, F.col("v_nivel").isNull(), "nivel fora de Básico, Intermediário, Avançado"),
        rule(R.RANGE, F.col("v_id") <= 0, "conteudo_id deve ser positivo"),
        rule(R.NEGATIVE, F.col("v_carga") < 0, "carga_horaria_min negativa"),
    ]
    df = _judged(df, rules)
    df = dedupe.canonical_spelling(
        df, F.concat(F.col("falha").isNull().cast("string"), F.lit("|"), comparison_key("v_categoria")),
        "v_categoria", [F.col("prioridade"), F.col("_origem"), F.col("_linha")])
    df = dedupe.classify_copies_and_versions(
        df, ["v_id"],
        copy_order=[F.col("prioridade"), F.col("_linha"), F.col("_origem")],
        version_order=[F.col("prioridade"), F.col("_linha"), F.col("_origem")],
        partitions=dedupe.partitions_for(raw),
    )
    df, flag = _superseded(df, keep_superseded)
    out = _finish(df, _copy_or_conflict("copia_de", "vencedor", "mesmo conteudo_id"), "catalogo")
    return out.select(
        F.col("v_id").alias("conteudo_id"), F.col("v_titulo").alias("titulo"), F.col("v_tipo").alias("tipo"),
        F.col("v_categoria_canonica").alias("categoria"), F.col("v_nivel").alias("nivel"),
        F.col("v_carga").alias("carga_horaria_min"), F.col("v_data").alias("data_publicacao"),
        clean_text("descricao").alias("descricao"), clean_text("autor").alias("autor"),
        *_audit(), "fonte", F.coalesce(F.col("conteudo_id"), F.concat(F.lit("linha "), F.col("_linha")))
        .alias("chave_registro"), "regra", "severidade", "mensagem", _record(list(CATALOG_COLS)), *flag, *_carried(out),
    )


# ---------------------------------------------------------------- users
CPF_LAYOUT = r"^([0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}|[0-9]{11})$"


def users(raw: DataFrame, run_date: dt.date, key: str, salt: str, keep_superseded: bool = False) -> DataFrame:
    from auric.plans.raw import USER_COLS, USER_REQUIRED

    today = F.lit(run_date)
    email = F.lower(clean_text("email"))
    df = _prepare(raw, list(USER_COLS)).select(
        "*",
        strict_int("usuario_id").alias("v_id"),
        clean_text("nome").alias("v_nome"),
        email.alias("v_email"),
        privacy.digits_only(F.col("cpf")).alias("v_cpf"),
        parse_date(F.col("data_nascimento")).alias("v_nascimento"),
        domain.state_code(F.col("uf")).alias("v_uf"),
        parse_date(F.col("data_cadastro")).alias("v_cadastro"),
        parse_ts(F.col("atualizado_em")).alias("v_atualizado"),
        missing_fields(USER_REQUIRED).alias("v_ausentes"),
    )
    rules = [
        rule(R.REQUIRED, F.col("v_ausentes").isNotNull(), F.concat(F.lit("campos ausentes: "), "v_ausentes")),
        rule(R.TYPE, F.col("v_id").isNull(), "usuario_id nao e inteiro"),
        rule(R.FORMAT, ~F.col("v_email").rlike(privacy.EMAIL_FORMAT), "e-mail fora do formato nome@dominio"),
        rule(R.FORMAT, ~F.trim("cpf").rlike(CPF_LAYOUT), "CPF fora do formato 000.000.000-00"),
        rule(R.DATE, F.col("v_nascimento").isNull(), "data_nascimento nao e uma data valida"),
        rule(R.DATE, _present_but_invalid("data_cadastro", F.col("v_cadastro")), "data_cadastro invalida"),
        rule(R.DATE, _present_but_invalid("atualizado_em", F.col("v_atualizado")), "atualizado_em invalida"),
        rule(R.DOMAIN, F.col("v_uf").isNull(), "uf nao e uma unidade da federacao"),
        rule(R.RANGE, F.col("v_id") <= 0, "usuario_id deve ser positivo"),
        rule(R.FUTURE, F.col("v_nascimento") > today, "data_nascimento no futuro"),
        rule(R.FUTURE, F.col("v_cadastro") > today, "data_cadastro no futuro"),
    ]
    df = _judged(df, rules)
    df = dedupe.classify_copies_and_versions(
        df, ["v_id"],
        copy_order=[F.col("prioridade"), F.col("_linha"), F.col("_origem")],
        version_order=[F.col("v_atualizado").isNotNull(), F.col("v_atualizado"), F.col("prioridade"),
                       F.col("_linha"), F.col("_origem")],
        partitions=dedupe.partitions_for(raw),
    )
    df, flag = _superseded(df, keep_superseded)
    out = _finish(df, _copy_or_conflict("copia_de", "vencedor", "mesmo usuario_id"), "usuarios")
    return out.select(
        F.col("v_id").alias("usuario_id"),
        privacy.pseudonym(F.col("v_id"), key).alias("usuario_pseudo"),
        privacy.mask_name(F.col("v_nome")).alias("nome_mascarado"),
        privacy.mask_email(F.col("v_email")).alias("email_mascarado"),
        privacy.salted_hash(F.col("v_email"), salt).alias("email_hash"),
        privacy.salted_hash(F.col("v_cpf"), salt).alias("cpf_hash"),
        domain.age_band(F.col("v_nascimento"), today).alias("faixa_etaria"),
        clean_text("cidade").alias("cidade"), F.col("v_uf").alias("uf"),
        F.col("v_cadastro").alias("data_cadastro"), F.col("v_atualizado").alias("atualizado_em"),
        *_audit(), "fonte",
        F.coalesce(F.col("usuario_id"), F.concat(F.lit("linha "), F.col("_linha"))).alias("chave_registro"),
        "regra", "severidade", "mensagem",
        # the record kept of a rejected user: as delivered, but personal fields masked and the document number left out
        F.when(F.col("regra").isNotNull(), F.to_json(F.struct(
            "usuario_id", privacy.mask_name(clean_text("nome")).alias("nome"), privacy.mask_email(clean_text("email")).alias("email"),
            "cidade", "uf", "data_cadastro", "atualizado_em"))).alias("registro"),
        *flag, *_carried(out),
    )


def accepted_keys(df: DataFrame, key: str, extra: list[str] | None = None) -> DataFrame:
    return df.where(F.col("regra").isNull()).select(key, *(extra or [])).distinct()


def _with_parents(df: DataFrame, u: DataFrame, k: DataFrame) -> DataFrame:
    """``df`` with its accepted user and content, NULL where there is none."""
    small = lambda parent: bounded(parent, KEYS_LIMIT_BYTES)
    return df.join(small(u), df["v_usuario"] == u["u_id"], "left").join(small(k), df["v_conteudo"] == k["k_id"], "left")


# ---------------------------------------------------------------- events
def events(raw: DataFrame, run_ts: dt.datetime, users_ok: DataFrame, contents_ok: DataFrame) -> DataFrame:
    from auric.plans.raw import EVENT_COLS, EVENT_REQUIRED

    df = _prepare(raw, list(EVENT_COLS)).select(
        "*",
        strict_int("usuario_id").alias("v_usuario"),
        strict_int("conteudo_id").alias("v_conteudo"),
        domain.interaction_type(F.col("tipo_interacao")).alias("v_tipo"),
        parse_ts(F.col("data_hora")).alias("v_data_hora"),
        strict_int("tempo_consumido").alias("v_tempo"),
        number_double("percentual_conclusao").alias("v_percentual"),
        strict_int("avaliacao_atribuida").alias("v_nota"),
        missing_fields(EVENT_REQUIRED).alias("v_ausentes"),
    )
    u = users_ok.select(F.col("usuario_id").alias("u_id"))
    k = contents_ok.select(F.col("conteudo_id").alias("k_id"), F.col("data_publicacao").alias("k_pub"))
    rules = [
        rule(R.REQUIRED, F.col("v_ausentes").isNotNull(), F.concat(F.lit("campos ausentes: "), "v_ausentes")),
        rule(R.TYPE, F.col("v_usuario").isNull() | F.col("v_conteudo").isNull(), "id nao e inteiro"),
        rule(R.TYPE, _present_but_invalid("tempo_consumido", F.col("v_tempo")), "tempo_consumido nao e inteiro"),
        rule(R.TYPE, _present_but_invalid("percentual_conclusao", F.col("v_percentual")), "percentual nao e numero"),
        rule(R.TYPE, _present_but_invalid("avaliacao_atribuida", F.col("v_nota")), "avaliacao nao e inteira"),
        rule(R.DATE, F.col("v_data_hora").isNull(), "data_hora nao e data e hora ISO valida"),
        rule(R.DOMAIN, F.col("v_tipo").isNull(), "tipo_interacao fora dos seis tipos"),
        rule(R.RANGE, (F.col("v_usuario") <= 0) | (F.col("v_conteudo") <= 0), "ids devem ser positivos"),
        rule(R.RANGE, ~F.col("v_percentual").between(0, 100), "percentual_conclusao fora de 0-100"),
        rule(R.RANGE, ~F.col("v_nota").between(1, 5), "avaliacao_atribuida fora de 1-5"),
        rule(R.NEGATIVE, F.col("v_tempo") < 0, "tempo_consumido negativo"),
        rule(R.FUTURE, F.col("v_data_hora") > F.lit(run_ts).cast("timestamp_ntz"), "data_hora no futuro"),
    ]
    df = _with_parents(_judged(df, rules), u, k)  # before the joins, which move only what is still needed
    rules = [
        rule(R.REF_USER, F.col("u_id").isNull(), "usuario nao existe entre os usuarios aprovados"),
        rule(R.REF_CONTENT, F.col("k_id").isNull(), "conteudo nao existe entre os conteudos aprovados"),
        rule(R.BEFORE_PUBLICATION, F.to_date("v_data_hora") < F.col("k_pub"), "data_hora anterior a publicacao"),
        rule(R.CONSISTENCY, (F.col("v_tipo") == "conclusão") & ~F.col("v_percentual").eqNullSafe(100),
             "conclusao com percentual diferente de 100"),
        rule(R.CONSISTENCY, (F.col("v_tipo") == "avaliação") & F.col("v_nota").isNull(),
             "interacao do tipo avaliacao sem nota"),
    ]
    df = _judged(df, rules)
    df = dedupe.first_by_business_key(df, ["v_usuario", "v_conteudo", "v_tipo", "v_data_hora"],
                                      [F.col("prioridade"), F.col("_linha"), F.col("_origem")], dedupe.partitions_for(raw))
    out = _finish(df, _dup_or_conflict(), "interacoes")
    return out.select(
        F.col("v_usuario").alias("usuario_id"), F.col("v_conteudo").alias("conteudo_id"),
        F.col("v_tipo").alias("tipo_interacao"), F.col("v_data_hora").alias("data_hora"),
        F.col("v_tempo").alias("tempo_consumido"), F.col("v_percentual").alias("percentual_conclusao"),
        F.col("v_nota").alias("avaliacao_atribuida"), *_audit(), "fonte",
        F.when(F.col("regra").isNotNull(), F.concat_ws(", ", F.concat(F.lit("usuario "), F.coalesce("usuario_id", F.lit(""))),
                    F.concat(F.lit("conteudo "), F.coalesce("conteudo_id", F.lit(""))),
                    F.coalesce("data_hora", F.lit("")))).alias("chave_registro"),
        "regra", "severidade", "mensagem", _record(list(EVENT_COLS)), *_carried(out),
    )


def _dup_or_conflict() -> list[R.Rule]:
    return _copy_or_conflict("primeiro", "primeiro", "mesma chave de negocio")


# ---------------------------------------------------------------- comments
def comments(raw: DataFrame, run_date: dt.date, users_ok: DataFrame, contents_ok: DataFrame) -> DataFrame:
    from auric.plans.raw import COMMENT_COLS, COMMENT_REQUIRED

    tags = F.when(clean_text("tags").isNull(), F.array().cast("array<string>")).otherwise(json_list(F.col("tags")))
    df = _prepare(raw, list(COMMENT_COLS)).select(
        "*",
        strict_int("usuario_id").alias("v_usuario"),
        strict_int("conteudo_id").alias("v_conteudo"),
        strict_int("avaliacao").alias("v_nota"),
        clean_text("comentario").alias("v_texto"),
        F.unhex(F.sha2(clean_text("comentario"), 256)).alias("v_texto_id"),  # compared and dealt by, so that texts move only if asked for
        tags.alias("v_tags"),
        parse_date(F.col("data")).alias("v_data"),
        missing_fields(COMMENT_REQUIRED).alias("v_ausentes"),
    )
    u = users_ok.select(F.col("usuario_id").alias("u_id"))
    k = contents_ok.select(F.col("conteudo_id").alias("k_id"), F.col("data_publicacao").alias("k_pub"))
    rules = [
        rule(R.REQUIRED, F.col("v_ausentes").isNotNull(), F.concat(F.lit("campos ausentes: "), "v_ausentes")),
        rule(R.TYPE, F.col("v_usuario").isNull() | F.col("v_conteudo").isNull(), "id nao e inteiro"),
        rule(R.TYPE, F.col("v_nota").isNull(), "avaliacao nao e inteira"),
        rule(R.DATE, F.col("v_data").isNull(), "data nao e uma data valida"),
        rule(R.FORMAT, F.col("v_tags").isNull(), "tags nao e uma lista JSON"),
        rule(R.RANGE, (F.col("v_usuario") <= 0) | (F.col("v_conteudo") <= 0), "ids devem ser positivos"),
        rule(R.RANGE, ~F.col("v_nota").between(1, 5), "avaliacao fora de 1-5"),
        rule(R.FUTURE, F.col("v_data") > F.lit(run_date), "data no futuro"),
    ]
    df = _with_parents(_judged(df, rules), u, k)  # before the joins, which move only what is still needed
    rules = [
        rule(R.REF_USER, F.col("u_id").isNull(), "usuario nao existe entre os usuarios aprovados"),
        rule(R.REF_CONTENT, F.col("k_id").isNull(), "conteudo nao existe entre os conteudos aprovados"),
        rule(R.BEFORE_PUBLICATION, F.col("v_data") < F.col("k_pub"), "data anterior a publicacao"),
    ]
    df = _judged(df, rules)
    df = dedupe.first_by_business_key(df, ["v_usuario", "v_conteudo", "v_data", "v_texto_id"],
                                      [F.col("prioridade"), F.col("_linha"), F.col("_origem")], dedupe.partitions_for(raw))
    out = _finish(df, _dup_or_conflict(), "comentarios")
    return out.select(
        F.col("v_usuario").alias("usuario_id"), F.col("v_conteudo").alias("conteudo_id"),
        F.col("v_nota").alias("avaliacao"), privacy.anonymize_text(F.col("v_texto")).alias("comentario"),
        normalize_tags(F.col("v_tags")).alias("tags"), F.col("v_data").alias("data"),
        *_audit(), "fonte",
        F.when(F.col("regra").isNotNull(), F.concat_ws(", ", F.concat(F.lit("usuario "), F.coalesce("usuario_id", F.lit(""))),
                    F.concat(F.lit("conteudo "), F.coalesce("conteudo_id", F.lit(""))),
                    F.coalesce("data", F.lit("")))).alias("chave_registro"),
        "regra", "severidade", "mensagem", _record(list(COMMENT_COLS)), *_carried(out),
    )


# ---------------------------------------------------------------- recommendations
def recommendations(raw: DataFrame, users_ok: DataFrame, contents_ok: DataFrame) -> DataFrame:
    from auric.plans.raw import REC_COLS, REC_REQUIRED

    df = _prepare(raw, list(REC_COLS)).select(
        "*",
        strict_int("usuario_id").alias("v_usuario"),
        strict_int("conteudo_id").alias("v_conteudo"),
        number_double("pontuacao").alias("v_pontuacao"),
        strict_int("posicao").alias("v_posicao"),
        domain.recommendation_class(F.col("classificacao")).alias("v_classe"),
        parse_ts(F.col("gerado_em")).alias("v_gerado"),
        missing_fields(REC_REQUIRED).alias("v_ausentes"),
    )
    u = users_ok.select(F.col("usuario_id").alias("u_id"))
    k = contents_ok.select(F.col("conteudo_id").alias("k_id"))
    rules = [
        rule(R.REQUIRED, F.col("v_ausentes").isNotNull(), F.concat(F.lit("campos ausentes: "), "v_ausentes")),
        rule(R.TYPE, F.col("v_usuario").isNull() | F.col("v_conteudo").isNull() | F.col("v_posicao").isNull(),
             "id ou posicao nao e inteiro"),
        rule(R.TYPE, F.col("v_pontuacao").isNull(), "pontuacao nao e numero"),
        rule(R.DATE, F.col("v_gerado").isNull(), "gerado_em nao e data e hora ISO valida"),
        rule(R.DOMAIN, F.col("v_classe").isNull(), "classificacao fora de positivo, estavel, negativo"),
        rule(R.RANGE, (F.col("v_usuario") <= 0) | (F.col("v_conteudo") <= 0), "ids devem ser positivos"),
        rule(R.RANGE, ~F.col("v_pontuacao").between(0, 100), "pontuacao fora de 0-100"),
        rule(R.RANGE, F.col("v_posicao") <= 0, "posicao deve ser positiva"),
    ]
    df = _with_parents(_judged(df, rules), u, k)  # before the joins, which move only what is still needed
    rules = [
        rule(R.REF_USER, F.col("u_id").isNull(), "usuario nao existe entre os usuarios aprovados"),
        rule(R.REF_CONTENT, F.col("k_id").isNull(), "conteudo nao existe entre os conteudos aprovados"),
    ]
    df = _judged(df, rules)
    df = dedupe.first_by_business_key(df, ["v_usuario", "v_conteudo", "v_gerado"],
                                      [F.col("prioridade"), F.col("_linha"), F.col("_origem")], dedupe.partitions_for(raw))
    out = _finish(df, _dup_or_conflict(), "recomendacoes")
    return out.select(
        F.col("v_usuario").alias("usuario_id"), F.col("v_conteudo").alias("conteudo_id"),
        F.col("v_pontuacao").alias("pontuacao"), F.col("v_posicao").alias("posicao"),
        F.col("v_classe").alias("classificacao"), F.col("v_gerado").alias("gerado_em"),
        *_audit(), "fonte",
        F.when(F.col("regra").isNotNull(), F.concat_ws(", ", F.concat(F.lit("usuario "), F.coalesce("usuario_id", F.lit(""))),
                    F.concat(F.lit("conteudo "), F.coalesce("conteudo_id", F.lit(""))))).alias("chave_registro"),
        "regra", "severidade", "mensagem", _record(list(REC_COLS)), *_carried(out),
    )

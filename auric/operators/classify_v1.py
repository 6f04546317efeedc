"""First-generation rule set (kept alongside the Silver rules).

Classes: ``incompletos`` (a required field blank), ``invalidos`` (first
failing check), ``duplicados`` (the key was already accepted on an earlier
line) and ``validos``; a valid row whose values changed under normalisation
also counts as ``corrigido``. Differences from the Silver rules: an optional
field present but unparsable is invalid, a completion without a percentage
is valid, there is no user reference check, and the first valid row of a key
wins. The first valid occurrence per key is found with a partial-aggregating
``min`` (no window), the canonical category spelling likewise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions import domain
from auric.functions.parse import json_list, number_double, parse_date, parse_ts, strict_int
from auric.functions.text import clean_text, comparison_key, missing_fields, normalize_tags, was_corrected
from auric.operators import dedupe


def _classes(df: DataFrame, missing: Column, invalid: list[Column], key: list[str]) -> DataFrame:
    bad = F.lit(False)
    for c in invalid:
        bad = bad | F.coalesce(c, F.lit(False))
    df = df.withColumn("_classe", F.when(missing.isNotNull(), "incompletos").when(bad, "invalidos"))
    ok = df.where(F.col("_classe").isNull())
    rest = df.where(F.col("_classe").isNotNull())
    ok = dedupe.mark_first(ok, key, [F.col("_linha")], "_primeiro")
    ok = ok.withColumn("_classe", F.when(F.col("_primeiro_is_me"), "validos").otherwise("duplicados")) \
        .drop("_primeiro", "_primeiro_is_me")
    return ok.unionByName(rest, allowMissingColumns=True)


def catalog(raw: DataFrame) -> DataFrame:
    from auric.plans.raw import CATALOG_REQUIRED

    df = raw.select(
        "*", strict_int("conteudo_id").alias("v_id"), strict_int("carga_horaria_min").alias("v_carga"),
        parse_date(F.col("data_publicacao")).alias("v_data"), domain.content_type(F.col("tipo")).alias("v_tipo"),
        domain.level(F.col("nivel")).alias("v_nivel"), clean_text("titulo").alias("v_titulo"),
        clean_text("categoria").alias("v_categoria"))
    invalid = [F.col("v_id").isNull() | (F.col("v_id") <= 0), F.col("v_carga").isNull() | (F.col("v_carga") < 0),
               F.col("v_data").isNull(), F.col("v_tipo").isNull(), F.col("v_nivel").isNull()]
    out = _classes(df, missing_fields(CATALOG_REQUIRED), invalid, ["v_id"])
    valid = F.col("_classe") == "validos"
    out = dedupe.canonical_spelling(out, F.when(valid, comparison_key("categoria")), "v_categoria",
                                    [F.col("_linha")])
    corr = was_corrected([(F.col("titulo"), F.col("v_titulo")), (F.col("tipo"), F.col("v_tipo")),
                          (F.col("nivel"), F.col("v_nivel")), (F.col("carga_horaria_min"), F.col("v_carga")),
                          (F.col("conteudo_id"), F.col("v_id")), (F.col("data_publicacao"), F.col("v_data")),
                          (F.col("categoria"), F.col("v_categoria_canonica")),
                          (F.col("descricao"), clean_text("descricao")), (F.col("autor"), clean_text("autor"))])
    return out.select("_linha", F.col("_classe").alias("classe"), F.when(valid, F.col("v_id")).alias("conteudo_id"),
                      F.when(valid, F.col("v_categoria_canonica")).alias("categoria"),
                      F.when(valid, F.col("v_data")).alias("data_publicacao"),
                      (valid & corr).alias("corrigido"))


def events(raw: DataFrame, run_ts: dt.datetime, published: DataFrame) -> DataFrame:
    from auric.plans.raw import EVENT_REQUIRED

    df = raw.select(
        "*", strict_int("usuario_id").alias("v_usuario"), strict_int("conteudo_id").alias("v_conteudo"),
        domain.interaction_type(F.col("tipo_interacao")).alias("v_tipo"),
        parse_ts(F.col("data_hora")).alias("v_data_hora"), strict_int("tempo_consumido").alias("v_tempo"),
        number_double("percentual_conclusao").alias("v_pct"), strict_int("avaliacao_atribuida").alias("v_nota"))
    pub = published.select(F.col("conteudo_id").alias("_k"), F.col("data_publicacao").alias("_pub"))
    df = df.join(pub, df["v_conteudo"] == pub["_k"], "left")
    invalid = [
        F.col("v_usuario").isNull() | (F.col("v_usuario") <= 0),
        F.col("v_conteudo").isNull() | (F.col("v_conteudo") <= 0),
        F.col("_k").isNull(), F.col("v_tipo").isNull(), F.col("v_data_hora").isNull(),
        F.to_date("v_data_hora") < F.col("_pub"),
        F.col("v_data_hora") > F.lit(run_ts).cast("timestamp_ntz"),
        F.col("tempo_consumido").isNotNull() & (F.col("v_tempo").isNull() | (F.col("v_tempo") < 0)),
        F.col("percentual_conclusao").isNotNull() & (F.col("v_pct").isNull() | ~F.col("v_pct").between(0, 100)),
        F.col("avaliacao_atribuida").isNotNull() & (F.col("v_nota").isNull() | ~F.col("v_nota").between(1, 5)),
        (F.col("v_tipo") == "conclusão") & F.col("v_pct").isNotNull() & (F.col("v_pct") < 100),
        (F.col("v_tipo") == "avaliação") & F.col("v_nota").isNull(),
    ]
    out = _classes(df, missing_fields(EVENT_REQUIRED), invalid, ["v_usuario", "v_conteudo", "v_tipo", "v_data_hora"])
    return out.select("_linha", F.col("_classe").alias("classe"))


def comments(raw: DataFrame, run_date: dt.date, published: DataFrame) -> DataFrame:
    from auric.plans.raw import COMMENT_REQUIRED

    tags = F.when(clean_text("tags").isNull(), F.array().cast("array<string>")).otherwise(json_list(F.col("tags")))
    df = raw.select(
        "*", strict_int("usuario_id").alias("v_usuario"), strict_int("conteudo_id").alias("v_conteudo"),
        strict_int("avaliacao").alias("v_nota"), clean_text("comentario").alias("v_texto"),
        parse_date(F.col("data")).alias("v_data"), tags.alias("v_tags"))
    pub = published.select(F.col("conteudo_id").alias("_k"), F.col("data_publicacao").alias("_pub"))
    df = df.join(pub, df["v_conteudo"] == pub["_k"], "left")
    invalid = [
        F.col("v_usuario").isNull() | (F.col("v_usuario") <= 0),
        F.col("v_conteudo").isNull() | (F.col("v_conteudo") <= 0),
        F.col("_k").isNull(), F.col("v_nota").isNull() | ~F.col("v_nota").between(1, 5),
        F.col("v_data").isNull(), F.col("v_data") < F.col("_pub"), F.col("v_data") > F.lit(run_date),
        F.col("v_tags").isNull(),
    ]
    out = _classes(df, missing_fields(COMMENT_REQUIRED), invalid, ["v_usuario", "v_conteudo", "v_data", "v_texto"])
    valid = F.col("_classe") == "validos"
    return out.select("_linha", F.col("_classe").alias("classe"),
                      F.when(valid, F.array_join(normalize_tags(F.col("v_tags")), ",")).alias("tags"))

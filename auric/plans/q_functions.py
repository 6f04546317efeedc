"""Scalar function and privacy queries, each applied
to every row of a Bronze stand-in or driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from auric.functions import domain, parse, privacy, text
from auric.plans import sqlclassify as SC
from auric.plans.registry import query
from auric.plans.sqlmodel import anonymize, clean, hmac, mask_email, mask_name, salted, with_

BC, BU, BI, BK, BR = (f"bronze_{f}" for f in ("catalogo", "usuarios", "interacoes", "comentarios", "recomendacoes"))

query("fn_clean_text", with_(BC) + f"""
SELECT _origem, _linha, {clean('titulo')} AS titulo, {clean('descricao')} AS descricao FROM {BC}""")(
    lambda m: m.bronze("catalogo").select("_origem", "_linha", text.clean_text("titulo").alias("titulo"),
                                          text.clean_text("descricao").alias("descricao")))

query("fn_key", with_(BC, BI) + f"""
SELECT 'catalogo' AS fonte, _origem, _linha, {SC.folded('tipo')} AS chave FROM {BC}
UNION ALL SELECT 'interacoes', _origem, _linha, {SC.folded('tipo_interacao')} FROM {BI}""")(
    lambda m: m.bronze("catalogo").select(F.lit("catalogo").alias("fonte"), "_origem", "_linha",
                                          text.comparison_key(F.col("tipo")).alias("chave")).unionByName(
        m.bronze("interacoes").select(F.lit("interacoes").alias("fonte"), "_origem", "_linha",
                                      text.comparison_key(F.col("tipo_interacao")).alias("chave"))))

query("fn_strict_int", with_(BC) + f"""
SELECT _origem, _linha, {SC.whole('conteudo_id')} AS conteudo_id, {SC.whole('carga_horaria_min')} AS carga
  FROM {BC}""")(
    lambda m: m.bronze("catalogo").select("_origem", "_linha", parse.strict_int("conteudo_id").alias("conteudo_id"),
                                          parse.strict_int("carga_horaria_min").alias("carga")))

query("fn_number", with_(BI, BR) + f"""
SELECT 'interacoes' AS fonte, _origem, _linha, {SC.number('percentual_conclusao')} AS numero FROM {BI}
UNION ALL SELECT 'recomendacoes', _origem, _linha, {SC.number('pontuacao')} FROM {BR}""")(
    lambda m: m.bronze("interacoes").select(F.lit("interacoes").alias("fonte"), "_origem", "_linha",
                                            parse.number_double("percentual_conclusao").alias("numero")).unionByName(
        m.bronze("recomendacoes").select(F.lit("recomendacoes").alias("fonte"), "_origem", "_linha",
                                         parse.number_double("pontuacao").alias("numero"))))

query("fn_parse_date", with_(BC, BU) + f"""
SELECT 'catalogo' AS fonte, _origem, _linha, {SC.day('data_publicacao')} AS data FROM {BC}
UNION ALL SELECT 'usuarios', _origem, _linha, {SC.day('data_nascimento')} FROM {BU}""")(
    lambda m: m.bronze("catalogo").select(F.lit("catalogo").alias("fonte"), "_origem", "_linha",
                                          parse.parse_date(F.col("data_publicacao")).alias("data")).unionByName(
        m.bronze("usuarios").select(F.lit("usuarios").alias("fonte"), "_origem", "_linha",
                                    parse.parse_date(F.col("data_nascimento")).alias("data"))))

query("fn_parse_ts", with_(BI, BU) + f"""
SELECT 'interacoes' AS fonte, _origem, _linha, {SC.moment('data_hora')} AS ts FROM {BI}
UNION ALL SELECT 'usuarios', _origem, _linha, {SC.moment('atualizado_em')} FROM {BU}""")(
    lambda m: m.bronze("interacoes").select(F.lit("interacoes").alias("fonte"), "_origem", "_linha",
                                            parse.parse_ts(F.col("data_hora")).alias("ts")).unionByName(
        m.bronze("usuarios").select(F.lit("usuarios").alias("fonte"), "_origem", "_linha",
                                    parse.parse_ts(F.col("atualizado_em")).alias("ts"))))

query("fn_json_list", with_(BK) + f"""
SELECT _origem, _linha,
       CASE WHEN json_type(CASE WHEN json_valid(tags) THEN tags ELSE 'null' END) = 'ARRAY' THEN true ELSE false END AS e_lista,
       array_to_string(CASE WHEN json_type(CASE WHEN json_valid(tags) THEN tags ELSE 'null' END) = 'ARRAY'
                            THEN from_json(CASE WHEN json_valid(tags) THEN tags ELSE '[]' END, '["VARCHAR"]') END,
                       '|') AS itens
  FROM {BK}""")(
    lambda m: m.bronze("comentarios").withColumn("_l", parse.json_list(F.col("tags"))).select(
        "_origem", "_linha", F.col("_l").isNotNull().alias("e_lista"), F.array_join("_l", "|").alias("itens")))

query("array_normalize", with_(BK) + f"""
SELECT _origem, _linha,
       array_to_string(list_filter(list_transform(from_json(CASE WHEN json_valid(tags) THEN tags ELSE '[]' END, '["VARCHAR"]'), lambda x: lower(trim(x))),
                                   lambda x: x IS NOT NULL AND x <> ''), ',') AS tags
  FROM {BK} WHERE json_type(CASE WHEN json_valid(tags) THEN tags ELSE 'null' END) = 'ARRAY'""")(
    lambda m: m.bronze("comentarios").withColumn("_l", parse.json_list(F.col("tags"))).where(
        F.col("_l").isNotNull()).select("_origem", "_linha",
                                        F.array_join(text.normalize_tags(F.col("_l")), ",").alias("tags")))


def _domains(m):
    c = m.bronze("catalogo").select(
        "_origem", "_linha", domain.content_type(F.col("tipo")).alias("tipo"),
        domain.level(F.col("nivel")).alias("nivel"))
    i = m.bronze("interacoes").select(
        "_origem", "_linha", domain.interaction_type(F.col("tipo_interacao")).alias("tipo_interacao"))
    r = m.bronze("recomendacoes").select(
        "_origem", "_linha", domain.recommendation_class(F.col("classificacao")).alias("classificacao"))
    return c.unionByName(i, allowMissingColumns=True).unionByName(r, allowMissingColumns=True)


query("fn_domain_map", with_(BC, BI, BR) + f"""
SELECT _origem, _linha, {SC.one_of('tipo', domain.CONTENT_TYPES)} AS tipo, {SC.one_of('nivel', domain.LEVELS)} AS nivel,
       NULL AS tipo_interacao, NULL AS classificacao FROM {BC}
UNION ALL SELECT _origem, _linha, NULL, NULL, {SC.one_of('tipo_interacao', domain.INTERACTION_TYPES)}, NULL FROM {BI}
UNION ALL SELECT _origem, _linha, NULL, NULL, NULL, {SC.one_of('classificacao', domain.RECOMMENDATION_CLASSES)}
  FROM {BR}""")(_domains)

query("fn_enum_or_null", with_(BU) + f"""
SELECT _origem, _linha, CASE WHEN list_contains({SC.UF}, upper(trim(uf))) THEN upper(trim(uf)) END AS uf FROM {BU}""")(
    lambda m: m.bronze("usuarios").select("_origem", "_linha", domain.state_code(F.col("uf")).alias("uf")))

query("missing_fields", with_(BC) + f"""
SELECT _origem, _linha, {SC.absent(['conteudo_id', 'titulo', 'tipo', 'categoria', 'nivel', 'carga_horaria_min',
                                      'data_publicacao'])} AS ausentes FROM {BC}""")(
    lambda m: m.bronze("catalogo").select("_origem", "_linha", text.missing_fields(
        ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao"])
        .alias("ausentes")))


def _corrected(m):
    b = m.bronze("catalogo")
    finals = {
        "titulo": text.clean_text("titulo"), "tipo": domain.content_type(F.col("tipo")),
        "nivel": domain.level(F.col("nivel")), "carga_horaria_min": parse.strict_int("carga_horaria_min"),
        "data_publicacao": parse.parse_date(F.col("data_publicacao")),
    }
    flag = text.was_corrected([(F.col(k), v) for k, v in finals.items()])
    return b.groupBy("_origem").agg(F.count(F.lit(1)).alias("linhas"), F.count_if(flag).alias("corrigidos"))


def _corr_sql():
    finals = {"titulo": clean("titulo"), "tipo": SC.one_of("tipo", domain.CONTENT_TYPES),
              "nivel": SC.one_of("nivel", domain.LEVELS), "carga_horaria_min": SC.whole("carga_horaria_min"),
              "data_publicacao": SC.day("data_publicacao")}
    conds = " OR ".join(f"({k} IS NOT NULL AND trim({k}) IS DISTINCT FROM CAST({v} AS VARCHAR))"
                        for k, v in finals.items())
    return with_(BC) + f"""
SELECT _origem, count(*) AS linhas, count(*) FILTER (WHERE {conds}) AS corrigidos FROM {BC} GROUP BY _origem"""


query("corrected_count", _corr_sql())(_corrected)

query("row_hash", with_("cls_catalogo", "cls_interacoes") + """
SELECT 'catalogo' AS fonte, count(*) AS linhas, count(DISTINCT _hash) AS hashes FROM cls_catalogo
UNION ALL SELECT 'interacoes', count(*), count(DISTINCT _hash) FROM cls_interacoes""")(
    lambda m: m.cls_catalogo.select(F.lit("catalogo").alias("fonte"), "_hash").unionByName(
        m.cls_interacoes.select(F.lit("interacoes").alias("fonte"), "_hash")).groupBy("fonte").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("_hash").alias("hashes")))

query("date_parts", with_("interacao") + """
SELECT interacao_id, CAST(date_trunc('month', data_hora) AS DATE) AS mes, strftime(data_hora, '%Y-%m') AS rotulo,
       CAST(data_hora AS DATE) AS data, CAST(date_trunc('month', data_hora) + INTERVAL 1 MONTH AS DATE) AS proximo_mes
  FROM interacao""")(
    lambda m: m.interacao.select(
        "interacao_id", F.trunc(F.to_date("data_hora"), "month").alias("mes"),
        F.date_format("data_hora", "yyyy-MM").alias("rotulo"), F.to_date("data_hora").alias("data"),
        F.add_months(F.trunc(F.to_date("data_hora"), "month"), 1).alias("proximo_mes")))

query("text_concat", with_(BC) + f"""
SELECT _origem, _linha, CASE WHEN {clean('descricao')} IS NOT NULL AND {clean('descricao')} <> ''
                            THEN concat_ws('. ', {clean('titulo')}, {clean('descricao')}) ELSE {clean('titulo')} END AS texto
  FROM {BC}""")(
    lambda m: m.bronze("catalogo").select("_origem", "_linha", text.text_concat(
        text.clean_text("titulo"), text.clean_text("descricao")).alias("texto")))

query("band_case", with_("conteudo", "recomendacao") + """
SELECT 'duracao' AS eixo, CASE WHEN carga_horaria_min <= 30 THEN 'ate_30' WHEN carga_horaria_min <= 90 THEN '31_90'
                               ELSE 'mais_90' END AS faixa, count(*) AS n FROM conteudo GROUP BY 2
UNION ALL SELECT 'posicao', CASE WHEN posicao <= 3 THEN '1 a 3' WHEN posicao <= 6 THEN '4 a 6' ELSE '7 a 10' END,
                 count(*) FROM recomendacao GROUP BY 2""")(
    lambda m: m.conteudo.groupBy(domain.duration_band(F.col("carga_horaria_min")).alias("faixa")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("duracao").alias("eixo"), "faixa", "n").unionByName(
        m.recomendacao.groupBy(domain.position_band(F.col("posicao")).alias("faixa")).agg(
            F.count(F.lit(1)).alias("n")).select(F.lit("posicao").alias("eixo"), "faixa", "n")))

query("age_band", with_("usuario") + """
SELECT faixa_etaria, count(*) AS usuarios FROM usuario GROUP BY faixa_etaria""")(
    lambda m: m.usuario.groupBy("faixa_etaria").agg(F.count(F.lit(1)).alias("usuarios")))

# ---------------------------------------------------------------- privacy
query("pii_pseudonym", with_("usuario_raw") + f"""
SELECT usuario_id, {hmac('usuario_id')} AS usuario_pseudo FROM usuario_raw""")(
    lambda m: m.usuario_raw.select("usuario_id", privacy.pseudonym(F.col("usuario_id"), m.key).alias("usuario_pseudo")))

query("pii_salted_hash", with_("usuario_raw") + f"""
SELECT usuario_id, {salted(f"lower({clean('email')})")} AS email_hash,
       {salted("regexp_replace(cpf, '[^0-9]', '', 'g')")} AS cpf_hash FROM usuario_raw""")(
    lambda m: m.usuario_raw.select(
        "usuario_id", privacy.salted_hash(F.lower(text.clean_text("email")), m.salt).alias("email_hash"),
        privacy.salted_hash(privacy.digits_only(F.col("cpf")), m.salt).alias("cpf_hash")))

query("pii_mask_email", with_(BU) + f"""
SELECT _origem, _linha, {mask_email(f"lower({clean('email')})")} AS email_mascarado FROM {BU}""")(
    lambda m: m.bronze("usuarios").select("_origem", "_linha", privacy.mask_email(
        F.lower(text.clean_text("email"))).alias("email_mascarado")))

query("pii_mask_name", with_(BU) + f"""
SELECT _origem, _linha, {mask_name(clean('nome'))} AS nome_mascarado FROM {BU}""")(
    lambda m: m.bronze("usuarios").select("_origem", "_linha", privacy.mask_name(
        text.clean_text("nome")).alias("nome_mascarado")))

query("pii_anonymize_text", f"""
SELECT doc_id, {anonymize('text')} AS texto FROM documents""")(
    lambda m: m.t("documents").select("doc_id", privacy.anonymize_text(F.col("text")).alias("texto")))


def _scan(m):
    d = m.t("documents").select(F.lit("documents").alias("tabela"), F.col("text").alias("t"))
    a = m.t("documents").select(F.lit("documents_anonimizados").alias("tabela"),
                                privacy.anonymize_text(F.col("text")).alias("t"))
    c = m.t("conversations").select(F.lit("conversations").alias("tabela"), F.col("text").alias("t"))
    u = m.bronze("usuarios").select(F.lit("bronze_usuarios").alias("tabela"),
                                    F.concat_ws(" ", "nome", "email", "telefone").alias("t"))
    allt = d.unionByName(a).unionByName(c).unionByName(u)
    for nome, df in (("gold_dim_usuario", m.dim_usuario), ("gold_dim_conteudo", m.dim_conteudo),
                     ("gold_fato_interacao", m.fato_interacao), ("gold_fato_recomendacao", m.fato_recomendacao)):
        # whole rows: every column as text
        allt = allt.unionByName(df.select(F.lit(nome).alias("tabela"), F.concat_ws(
            " ", *[F.col(x).cast("string") for x in df.columns]).alias("t")))
    return allt.groupBy("tabela").agg(F.count(F.lit(1)).alias("linhas"),
                                      F.count_if(privacy.has_pii(F.col("t"))).alias("com_pii"))


_PII = (f"(regexp_matches(t, '{privacy.EMAIL_IN_TEXT}') OR regexp_matches(t, '{privacy.PHONE_ALONE}') "
        f"OR regexp_matches(t, '{privacy.CPF_IN_TEXT}'))")
query("pii_scan", with_(BU, "mestre", "conteudo", "fato_interacao", "fato_recomendacao") + f"""
SELECT tabela, count(*) AS linhas, count(*) FILTER (WHERE {_PII}) AS com_pii
  FROM (SELECT 'documents' AS tabela, text AS t FROM documents
        UNION ALL SELECT 'documents_anonimizados', {anonymize('text')} FROM documents
        UNION ALL SELECT 'conversations', text FROM conversations
        UNION ALL SELECT 'bronze_usuarios', concat_ws(' ', nome, email, telefone) FROM {BU}
        UNION ALL SELECT 'gold_dim_usuario', concat_ws(' ', usuario_pseudo, nome_mascarado, faixa_etaria, uf,
                    data_cadastro, registros_origem) FROM mestre
        UNION ALL SELECT 'gold_dim_conteudo', CAST(x AS VARCHAR) FROM conteudo x
        UNION ALL SELECT 'gold_fato_interacao', CAST(x AS VARCHAR) FROM fato_interacao x
        UNION ALL SELECT 'gold_fato_recomendacao', CAST(x AS VARCHAR) FROM fato_recomendacao x) s
 GROUP BY tabela""")(_scan)

"""Bronze stand-ins: raw, all-string deliveries derived from the driver tables.

Dirty values (blank fields, ``'7.9'``, ``31/02``, unknown domain words,
accents, re-sent versions, identical copies) are derived from keys, so they
grow with the tables. These expressions are the *input*, so they are
written once in the SQL subset both Spark and DuckDB read; the operators
under test are implemented independently on each side.
"""

from __future__ import annotations

S = "STRING"  # both engines accept it as the character type


def _date_text(d: str, selector: str) -> str:
    """Render date ``d`` in one of the three accepted layouts chosen by ``selector``."""
    y = f"CAST(year({d}) AS {S})"
    mo = f"lpad(CAST(month({d}) AS {S}), 2, '0')"
    da = f"lpad(CAST(day({d}) AS {S}), 2, '0')"
    return (f"CASE {selector} WHEN 1 THEN {da} || '/' || {mo} || '/' || {y} "
            f"WHEN 2 THEN {y} || '/' || {mo} || '/' || {da} ELSE {y} || '-' || {mo} || '-' || {da} END")


_PUB = "(DATE '2023-12-01' + CAST(p_partkey % 45 AS INT))"

CATALOG_COLS = {
    "conteudo_id": f"""CASE p_partkey % 97 WHEN 5 THEN '' WHEN 6 THEN 'abc' WHEN 7 THEN CAST(p_partkey AS {S}) || '.0'
                         WHEN 8 THEN '-' || CAST(p_partkey AS {S}) WHEN 9 THEN '  ' || CAST(p_partkey AS {S}) || ' '
                         WHEN 10 THEN CAST(p_partkey AS {S}) || '.9' ELSE CAST(p_partkey AS {S}) END""",
    "titulo": "CASE WHEN p_partkey % 89 = 3 THEN '   ' ELSE '  ' || p_name || '  ' END",
    "tipo": """CASE p_type WHEN 'ECONOMY' THEN 'curso' WHEN 'STANDARD' THEN ' CURSO ' WHEN 'SMALL' THEN 'video'
                 WHEN 'MEDIUM' THEN 'Vídeo' WHEN 'LARGE' THEN 'Artigo'
                 ELSE CASE WHEN p_partkey % 13 = 0 THEN 'Webinar' ELSE 'podcast' END END""",
    "categoria": "CASE p_partkey % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN upper(p_brand) ELSE p_brand END",
    "nivel": """CASE WHEN p_partkey % 53 = 4 THEN 'expert' WHEN p_size <= 15 THEN 'basico'
                  WHEN p_size <= 35 THEN 'Intermediario' ELSE 'AVANÇADO' END""",
    "carga_horaria_min": f"""CASE p_partkey % 71 WHEN 2 THEN '-45' WHEN 3 THEN '7.9' WHEN 4 THEN ''
                              ELSE CAST(p_size * 4 AS {S}) END""",
    "data_publicacao": f"""CASE p_partkey % 59 WHEN 7 THEN '31/02/2023' WHEN 8 THEN '2023-13-01'
                            ELSE {_date_text(_PUB, 'p_partkey % 4')} END""",
    "descricao": "CASE WHEN p_partkey % 2 = 0 THEN 'Sobre ' || p_name END",
    "autor": f"'Autor ' || CAST(p_partkey % 40 AS {S})",
}
CATALOG_REQUIRED = ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao"]

# three deliveries: the base file, a newer batch re-sending every 17th item
# (changed title every 34th → newer version; otherwise an identical copy),
# and a second line in the base file for every 19th item (same-file conflict)
CATALOG_PARTS = [
    ("dados/brutos/catalogo.csv", "p_partkey * 2", "TRUE", {}),
    ("dados/brutos/lote_2/catalogo.csv", "p_partkey + 2", "p_partkey % 17 = 0",
     {"titulo": "CASE WHEN p_partkey % 34 = 0 THEN p_name || ' (2a ed.)' ELSE " + "{titulo}" + " END"}),
    ("dados/brutos/catalogo.csv", "p_partkey * 2 + 1", "p_partkey % 19 = 0",
     {"titulo": "p_name || ' (rev)'"}),
]

_BIRTH = "(DATE '1950-01-01' + CAST((c_custkey * 37) % 25000 AS INT))"
_REG = "(DATE '2020-01-01' + CAST((c_custkey * 13) % 1400 AS INT))"
USER_COLS = {
    "usuario_id": f"CASE WHEN c_custkey % 83 = 5 THEN 'x' || CAST(c_custkey AS {S}) ELSE CAST(c_custkey AS {S}) END",
    "nome": """CASE WHEN c_custkey % 79 = 3 THEN '' ELSE
                 upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || '  ' || c_name END""",
    "email": f"""CASE WHEN c_custkey % 61 = 4 THEN 'cliente' || CAST(c_custkey AS {S}) || '.example.com'
                  ELSE ' Cliente' || CAST(CASE WHEN c_custkey % 10 = 2 THEN c_custkey - 1 ELSE c_custkey END AS {S})
                       || '@Example.com ' END""",
    "cpf": f"""CASE WHEN c_custkey % 67 = 6 THEN substr(lpad(CAST(c_custkey AS {S}), 11, '0'), 2)
                ELSE lpad(CAST(CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS {S}), 11, '0')
                END""",
    "data_nascimento": f"""CASE c_custkey % 73 WHEN 7 THEN '2031-05-05' WHEN 8 THEN '31/09/1990'
                            ELSE {_date_text(_BIRTH, 'c_custkey % 3')} END""",
    "telefone": f"'(11) 9' || lpad(CAST(c_custkey % 10000 AS {S}), 4, '0') || '-0000'",
    "cidade": f"'Cidade ' || CAST(c_nationkey AS {S})",
    "uf": """CASE WHEN c_custkey % 89 = 9 THEN 'XX' ELSE lower(CASE c_nationkey % 27
               WHEN 0 THEN 'AC' WHEN 1 THEN 'AL' WHEN 2 THEN 'AP' WHEN 3 THEN 'AM' WHEN 4 THEN 'BA' WHEN 5 THEN 'CE'
               WHEN 6 THEN 'DF' WHEN 7 THEN 'ES' WHEN 8 THEN 'GO' WHEN 9 THEN 'MA' WHEN 10 THEN 'MT' WHEN 11 THEN 'MS'
               WHEN 12 THEN 'MG' WHEN 13 THEN 'PA' WHEN 14 THEN 'PB' WHEN 15 THEN 'PR' WHEN 16 THEN 'PE'
               WHEN 17 THEN 'PI' WHEN 18 THEN 'RJ' WHEN 19 THEN 'RN' WHEN 20 THEN 'RS' WHEN 21 THEN 'RO'
               WHEN 22 THEN 'RR' WHEN 23 THEN 'SC' WHEN 24 THEN 'SP' WHEN 25 THEN 'SE' ELSE 'TO' END) END""",
    "data_cadastro": _date_text(_REG, "c_custkey % 3"),
    "atualizado_em": f"""CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE
                          {_date_text(_REG, '0')} || 'T' || lpad(CAST(c_custkey % 24 AS {S}), 2, '0') || ':00:00' END""",
}
USER_REQUIRED = ["usuario_id", "nome", "email", "cpf", "data_nascimento", "uf"]
USER_PARTS = [
    ("dados/brutos/usuarios.csv", "c_custkey + 2", "TRUE", {}),
    # newer batch re-sends every 23rd account with a later update time
    ("dados/brutos/lote_2/usuarios.csv", "c_custkey + 2", "c_custkey % 23 = 0",
     {"atualizado_em": f"'2023-06-01T' || lpad(CAST(c_custkey % 24 AS {S}), 2, '0') || ':30:00'",
      "cidade": f"'Nova Cidade ' || CAST(c_nationkey AS {S})"}),
]

_TS = "ts"
EVENT_COLS = {
    "usuario_id": f"CASE WHEN event_id % 101 = 7 THEN NULL WHEN event_id % 101 = 8 THEN '999999999' ELSE CAST(user_id AS {S}) END",
    "conteudo_id": f"""CASE WHEN event_id % 103 = 9 THEN '999999999' ELSE
                        regexp_extract(props, '[0-9]+', 0) END""",
    "tipo_interacao": """CASE event_type WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'VISUALIZACAO' ELSE 'visualização' END
                           WHEN 'signup' THEN 'inicio' WHEN 'purchase' THEN 'Conclusão' WHEN 'click' THEN 'avaliação'
                           ELSE 'download' END""",
    "data_hora": f"""CASE event_id % 107 WHEN 3 THEN 'ontem' WHEN 4 THEN '2027-01-01 10:00:00'
                      ELSE replace(substr(CAST({_TS} AS {S}), 1, 19), ' ', CASE WHEN event_id % 2 = 0 THEN 'T' ELSE ' ' END) END""",
    "tempo_consumido": f"""CASE event_id % 109 WHEN 5 THEN '-15' WHEN 6 THEN 'abc' WHEN 7 THEN ''
                            ELSE CAST(CAST(floor(value) AS INT) AS {S}) END""",
    "percentual_conclusao": f"""CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 13 = 0 THEN '80' ELSE '100' END
                                 WHEN event_type = 'signup' THEN CASE WHEN event_id % 29 = 0 THEN '150'
                                      ELSE CAST(event_id % 101 AS {S}) END END""",
    "avaliacao_atribuida": f"""CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 31 = 0 THEN NULL
                                    WHEN event_id % 37 = 0 THEN '6' ELSE CAST(event_id % 5 + 1 AS {S}) END END""",
}
EVENT_REQUIRED = ["usuario_id", "conteudo_id", "tipo_interacao", "data_hora"]
EVENT_PARTS = [
    ("dados/brutos/interacoes.json", "event_id + 1", "TRUE", {}),
    # the increment re-sends every 41st event: identical copy, or (every 82nd) changed minutes
    ("dados/brutos/lote_2/interacoes.json", "event_id + 1", "event_id % 41 = 0",
     {"tempo_consumido": f"CASE WHEN event_id % 82 = 0 THEN CAST(CAST(floor(value) AS INT) + 1 AS {S}) ELSE "
                         + "{tempo_consumido} END"}),
]

COMMENT_COLS = {
    "usuario_id": f"CAST(doc_id AS {S})",
    "conteudo_id": f"CASE WHEN doc_id % 97 = 11 THEN '999999999' ELSE CAST(doc_id + 1 AS {S}) END",
    "avaliacao": f"CASE WHEN doc_id % 53 = 2 THEN '0' WHEN doc_id % 53 = 3 THEN '7' ELSE CAST(doc_id % 5 + 1 AS {S}) END",
    "comentario": "CASE WHEN doc_id % 59 = 4 THEN '   ' ELSE text END",
    "tags": """CASE WHEN doc_id % 43 = 5 THEN 'python' WHEN doc_id % 43 = 6 THEN '{"a": 1}'
                ELSE '["' || upper(lang) || '", " ' || source || ' ", ""]' END""",
    "data": f"""CASE WHEN doc_id % 61 = 9 THEN '31/09/2024' ELSE
                 {_date_text("(DATE '2023-11-20' + CAST(doc_id % 70 AS INT))", 'doc_id % 3')} END""",
}
COMMENT_REQUIRED = ["usuario_id", "conteudo_id", "avaliacao", "comentario", "data"]
COMMENT_PARTS = [
    ("dados/brutos/comentarios.json", "doc_id + 1", "TRUE", {}),
    ("dados/brutos/lote_2/comentarios.json", "doc_id + 1", "doc_id % 37 = 0", {}),
]

REC_COLS = {
    "usuario_id": f"CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS {S})",
    "conteudo_id": f"CASE WHEN l_orderkey % 89 = 1 THEN '999999999' ELSE CAST(l_partkey AS {S}) END",
    "pontuacao": f"CAST(round(l_discount * 1000, 2) AS {S})",
    "posicao": f"CASE WHEN l_orderkey % 71 = 3 THEN '0' ELSE CAST(l_linenumber AS {S}) END",
    "classificacao": """CASE WHEN l_orderkey % 67 = 2 THEN 'otimo' WHEN l_discount * 1000 >= 70 THEN 'Positivo'
                         WHEN l_discount * 1000 > 40 THEN 'estável' ELSE 'negativo' END""",
    "gerado_em": f"replace(substr(CAST(l_shipdate AS {S}), 1, 19), ' ', 'T')",
}
REC_REQUIRED = ["usuario_id", "conteudo_id", "pontuacao", "posicao", "classificacao", "gerado_em"]
REC_PARTS = [("dados/brutos/recomendacoes.json", "l_orderkey * 8 + l_linenumber", "TRUE", {})]

SOURCES = {
    # fonte: (table, columns, required, parts, key column for the record label)
    "catalogo": ("part", CATALOG_COLS, CATALOG_REQUIRED, CATALOG_PARTS),
    "usuarios": ("customer", USER_COLS, USER_REQUIRED, USER_PARTS),
    "interacoes": ("events", EVENT_COLS, EVENT_REQUIRED, EVENT_PARTS),
    "comentarios": ("documents", COMMENT_COLS, COMMENT_REQUIRED, COMMENT_PARTS),
    "recomendacoes": ("lineitem", REC_COLS, REC_REQUIRED, REC_PARTS),
}


def part_exprs(cols: dict[str, str], overrides: dict[str, str]) -> dict[str, str]:
    out = {}
    for name, expr in cols.items():
        if name in overrides:
            out[name] = overrides[name].replace("{" + name + "}", f"({expr})")
        else:
            out[name] = expr
    return out


def bronze_sql(fonte: str) -> str:
    """DuckDB: the raw delivery of ``fonte`` with origin file and line."""
    table, cols, _, parts = SOURCES[fonte]
    selects = []
    for origem, linha, where, over in parts:
        exprs = part_exprs(cols, over)
        body = ", ".join(f"({e}) AS {n}" for n, e in exprs.items())
        selects.append(f"SELECT '{origem}' AS _origem, CAST({linha} AS BIGINT) AS _linha, {body} "
                       f"FROM {table} WHERE {where}")
    return "\nUNION ALL\n".join(selects)


def bronze(spark, sf_dir: str, fonte: str, spread_rows: bool = True):
    """Spark: same raw delivery as a DataFrame (all business columns strings)."""
    from pyspark.sql import functions as F

    from auric.sources.tables import table as load

    table, cols, _, parts = SOURCES[fonte]
    # parsing and rules run per row on every delivery: use all cores; a mere count needs no spread
    base = load(spark, sf_dir, table, spread_rows=spread_rows)
    out = None
    for origem, linha, where, over in parts:
        exprs = part_exprs(cols, over)
        df = base.where(F.expr(where)).select(
            F.lit(origem).alias("_origem"), F.expr(f"cast({linha} as bigint)").alias("_linha"),
            *[F.expr(e).cast("string").alias(n) for n, e in exprs.items()])
        out = df if out is None else out.unionByName(df)
    return out


# ---------------------------------------------------------------- a second day: lines delivered anew, and what triage did
#: fonte: (field, new value, lines that come with it): the same lines with other content.
REDELIVERED = {
    "catalogo": ("autor", "'Autor revisto'", "_linha % 52 = 0"),
    "usuarios": ("cidade", "'Cidade nova'", "_linha % 10 = 0"),
    "interacoes": ("tempo_consumido", "'1'", "_linha % 10 = 3"),
    "comentarios": ("tags", "'[\"novo\"]'", "_linha % 6 = 1"),
    "recomendacoes": ("pontuacao", "'50'", "_linha % 9 = 4"),
}
#: fonte: (rejected records, edited field, new value); without a field the records are given up.
TRIAGE = {
    "catalogo": [("regra = 'DOMINIO' AND trim(tipo) = 'Webinar'", "tipo", "'Curso'"),
                 ("regra = 'DOMINIO' AND trim(nivel) = 'expert'", "nivel", "'Básico'"),
                 ("regra = 'TIPO_INVALIDO' AND _linha % 2 = 0", None, None)],
    "usuarios": [("regra = 'FORMATO' AND email NOT LIKE '%@%'", "email", "'corrigido' || trim(usuario_id) || '@example.com'"),
                 ("regra = 'DOMINIO'", "uf", "'SP'"), ("regra = 'TIPO_INVALIDO'", None, None)],
    "interacoes": [("regra = 'DOMINIO' AND tipo_interacao = 'download'", "tipo_interacao", "'curtida'"),
                   ("regra = 'VALOR_NEGATIVO'", "tempo_consumido", "'0'"), ("regra = 'REF_USUARIO' AND _linha % 2 = 0", None, None)],
    "comentarios": [("regra = 'FAIXA'", "avaliacao", "'3'"), ("regra = 'FORMATO'", "tags", "'[]'"), ("regra = 'CAMPO_OBRIGATORIO'", None, None)],
    "recomendacoes": [("regra = 'DOMINIO'", "classificacao", "'positivo'"), ("regra = 'FAIXA' AND trim(posicao) = '0'", "posicao", "'1'"),
                      ("regra = 'REF_CONTEUDO' AND _linha % 3 = 0", None, None)],
}


def redelivered(df, fonte: str):
    """Spark: the delivery of ``fonte`` a day later."""
    from pyspark.sql import functions as F

    field, value, where = REDELIVERED[fonte]
    return df.withColumn(field, F.when(F.expr(where), F.expr(value)).otherwise(F.col(field)))

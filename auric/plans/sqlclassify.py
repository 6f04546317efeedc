"""DuckDB oracle of the Silver classifiers, generated from one table of rules.

Unlike the Spark side (CASE chains, then a minimum per key joined back), a
record's rule is the position of the first true condition in a list, and
survivorship is read off a queue per business key: the list of its accepted
records in order. ``classifier`` makes the SQL of a source for any delivery,
so that the same rules also judge a delivery with corrections laid over it.
"""

from __future__ import annotations

from auric.functions.domain import CONTENT_TYPES, INTERACTION_TYPES, LEVELS, RECOMMENDATION_CLASSES, STATE_CODES
from auric.functions.privacy import EMAIL_FORMAT
from auric.functions.text import ACCENTED, PLAIN
from auric.plans import raw
from auric.plans.sqlmodel import CTES, RUN_DATE, age_band, anonymize, clean, hmac, mask_email, mask_name, salted

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
CPF_LAYOUT = "^([0-9]{3}\\.[0-9]{3}\\.[0-9]{3}-[0-9]{2}|[0-9]{11})$"


# ---------------------------------------------------------------- typed values of raw text
def whole(x):
    return f"CASE WHEN regexp_full_match(trim({x}), '-?[0-9]{{1,9}}(\\.0+)?') THEN CAST(CAST(trim({x}) AS DOUBLE) AS INTEGER) END"


def number(x):
    return f"CASE WHEN regexp_full_match(trim({x}), '-?[0-9]{{1,12}}(\\.[0-9]+)?') THEN CAST(trim({x}) AS DOUBLE) END"


def day(x):
    """A date in one of three layouts, turned round to one before it is read."""
    iso = f"regexp_replace(replace(trim({x}), '/', '-'), '^([0-9]{{2}})-([0-9]{{2}})-([0-9]{{4}})$', '\\3-\\2-\\1')"
    layout = "[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
    return f"CASE WHEN regexp_full_match(trim({x}), '{layout}') THEN TRY_CAST({iso} AS DATE) END"


def moment(x):
    return (f"CASE WHEN regexp_full_match(trim({x}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') "
            f"THEN TRY_CAST(replace(trim({x}), 'T', ' ') AS TIMESTAMP) END")


def folded(x):
    return f"lower(translate({clean(x)}, '{ACCENTED}', '{PLAIN}'))"


def one_of(x, words):
    entries = ", ".join(f"'{k}': '{v}'" for k, v in words.items())
    return f"MAP {{{entries}}}[coalesce({folded(x)}, '')]"


def absent(cols):
    names = ", ".join(f"'{c}'" for c in cols)
    flags = ", ".join(f"{clean(c)} IS NULL" for c in cols)
    return f"nullif(array_to_string(list_where([{names}], [{flags}]), ', '), '')"


def bad(raw_col, typed):
    return f"{clean(raw_col)} IS NOT NULL AND {typed} IS NULL"


def content(cols):
    """All fields of a record as one text."""
    return "CAST(to_json([" + ", ".join(cols) + "]) AS VARCHAR)"


SEVERITY = {"alta": ["CAMPO_OBRIGATORIO", "TIPO_INVALIDO", "DATA_INVALIDA", "REF_USUARIO", "REF_CONTEUDO"], "baixa": ["DUPLICADO", "CONFLITO_VERSAO"]}


def severity(r):
    alta, baixa = ("[" + ", ".join(f"'{c}'" for c in SEVERITY[s]) + "]" for s in ("alta", "baixa"))
    return f"CASE WHEN {r} IS NOT NULL THEN CASE WHEN list_contains({alta}, {r}) THEN 'alta' WHEN list_contains({baixa}, {r}) THEN 'baixa' ELSE 'media' END END"


# ---------------------------------------------------------------- sources: typed columns, rules in order, business key, published columns
EMAIL = f"lower({clean('email')})"
TAGS = (f"CASE WHEN {clean('tags')} IS NULL THEN CAST([] AS VARCHAR[]) "
        f"WHEN json_type(CASE WHEN json_valid(tags) THEN tags ELSE 'null' END) = 'ARRAY' THEN from_json(tags, '[\"VARCHAR\"]') END")
UF = "[" + ", ".join(f"'{s}'" for s in STATE_CODES) + "]"
IDS = [("CAMPO_OBRIGATORIO", "v_ausentes IS NOT NULL"), ("TIPO_INVALIDO", "v_usuario IS NULL OR v_conteudo IS NULL")]
POSITIVE = ("FAIXA", "v_usuario <= 0 OR v_conteudo <= 0")
PARENTS = [("REF_USUARIO", "pai_usuario IS NULL"), ("REF_CONTEUDO", "pai_conteudo IS NULL")]

SOURCES = {
    "catalogo": dict(
        typed={"v_id": whole("conteudo_id"), "v_titulo": clean("titulo"), "v_tipo": one_of("tipo", CONTENT_TYPES), "v_categoria": clean("categoria"),
               "v_nivel": one_of("nivel", LEVELS), "v_carga": whole("carga_horaria_min"), "v_data": day("data_publicacao")},
        rules=[IDS[0], ("TIPO_INVALIDO", "v_id IS NULL"), ("TIPO_INVALIDO", "v_carga IS NULL"), ("DATA_INVALIDA", "v_data IS NULL"),
               ("DOMINIO", "v_tipo IS NULL"), ("DOMINIO", "v_nivel IS NULL"), ("FAIXA", "v_id <= 0"), ("VALOR_NEGATIVO", "v_carga < 0")],
        key=["v_id"], newest="CAST(NULL AS TIMESTAMP)", label="coalesce(conteudo_id, 'linha ' || _linha)",
        out={"conteudo_id": "v_id", "titulo": "v_titulo", "tipo": "v_tipo", "categoria": "canonica", "nivel": "v_nivel", "carga_horaria_min": "v_carga",
             "data_publicacao": "v_data", "descricao": clean("descricao"), "autor": clean("autor")}),
    "usuarios": dict(
        typed={"v_id": whole("usuario_id"), "v_nome": clean("nome"), "v_email": EMAIL, "v_cpf": "regexp_replace(cpf, '[^0-9]', '', 'g')",
               "v_nascimento": day("data_nascimento"), "v_uf": f"list_filter({UF}, lambda s: s = upper(trim(uf)))[1]",
               "v_cadastro": day("data_cadastro"), "v_atualizado": moment("atualizado_em")},
        rules=[IDS[0], ("TIPO_INVALIDO", "v_id IS NULL"), ("FORMATO", f"NOT regexp_matches(v_email, '{EMAIL_FORMAT}')"),
               ("FORMATO", f"NOT regexp_matches(trim(cpf), '{CPF_LAYOUT}')"), ("DATA_INVALIDA", "v_nascimento IS NULL"),
               ("DATA_INVALIDA", bad("data_cadastro", "v_cadastro")), ("DATA_INVALIDA", bad("atualizado_em", "v_atualizado")), ("DOMINIO", "v_uf IS NULL"),
               ("FAIXA", "v_id <= 0"), ("DATA_FUTURA", f"v_nascimento > {RUN_DATE}"), ("DATA_FUTURA", f"v_cadastro > {RUN_DATE}")],
        key=["v_id"], newest="v_atualizado", label="coalesce(usuario_id, 'linha ' || _linha)",
        out={"usuario_id": "v_id", "usuario_pseudo": hmac("v_id"), "nome_mascarado": mask_name("v_nome"), "email_mascarado": mask_email("v_email"),
             "email_hash": salted("v_email"), "cpf_hash": salted("v_cpf"), "faixa_etaria": age_band("v_nascimento"), "cidade": clean("cidade"), "uf": "v_uf",
             "data_cadastro": "v_cadastro", "atualizado_em": "v_atualizado"}),
    "interacoes": dict(
        typed={"v_usuario": whole("usuario_id"), "v_conteudo": whole("conteudo_id"), "v_tipo": one_of("tipo_interacao", INTERACTION_TYPES),
               "v_data_hora": moment("data_hora"), "v_tempo": whole("tempo_consumido"), "v_percentual": number("percentual_conclusao"),
               "v_nota": whole("avaliacao_atribuida")},
        rules=[*IDS, ("TIPO_INVALIDO", bad("tempo_consumido", "v_tempo")), ("TIPO_INVALIDO", bad("percentual_conclusao", "v_percentual")),
               ("TIPO_INVALIDO", bad("avaliacao_atribuida", "v_nota")), ("DATA_INVALIDA", "v_data_hora IS NULL"), ("DOMINIO", "v_tipo IS NULL"), POSITIVE,
               ("FAIXA", "v_percentual < 0 OR v_percentual > 100"), ("FAIXA", "v_nota < 1 OR v_nota > 5"), ("VALOR_NEGATIVO", "v_tempo < 0"),
               ("DATA_FUTURA", f"v_data_hora > {RUN_TS}"), *PARENTS, ("DATA_ANTES_PUBLICACAO", "CAST(v_data_hora AS DATE) < pai_data"),
               ("CONSISTENCIA", "v_tipo = 'conclusão' AND v_percentual IS DISTINCT FROM 100"), ("CONSISTENCIA", "v_tipo = 'avaliação' AND v_nota IS NULL")],
        key=["v_usuario", "v_conteudo", "v_tipo", "v_data_hora"], label="NULL",
        out={"usuario_id": "v_usuario", "conteudo_id": "v_conteudo", "tipo_interacao": "v_tipo", "data_hora": "v_data_hora", "tempo_consumido": "v_tempo",
             "percentual_conclusao": "v_percentual", "avaliacao_atribuida": "v_nota"}),
    "comentarios": dict(
        typed={"v_usuario": whole("usuario_id"), "v_conteudo": whole("conteudo_id"), "v_nota": whole("avaliacao"), "v_texto": clean("comentario"),
               "v_tags": TAGS, "v_data": day("data")},
        rules=[*IDS, ("TIPO_INVALIDO", "v_nota IS NULL"), ("DATA_INVALIDA", "v_data IS NULL"), ("FORMATO", "v_tags IS NULL"), POSITIVE,
               ("FAIXA", "v_nota < 1 OR v_nota > 5"), ("DATA_FUTURA", f"v_data > {RUN_DATE}"), *PARENTS, ("DATA_ANTES_PUBLICACAO", "v_data < pai_data")],
        key=["v_usuario", "v_conteudo", "v_data", "v_texto"], label="NULL",
        out={"usuario_id": "v_usuario", "conteudo_id": "v_conteudo", "avaliacao": "v_nota", "comentario": anonymize("v_texto"),
             "tags": "array_to_string(list_filter(list_transform(v_tags, lambda x: lower(trim(x))), lambda x: x <> ''), ',')", "data": "v_data"}),
    "recomendacoes": dict(
        typed={"v_usuario": whole("usuario_id"), "v_conteudo": whole("conteudo_id"), "v_pontuacao": number("pontuacao"), "v_posicao": whole("posicao"),
               "v_classe": one_of("classificacao", RECOMMENDATION_CLASSES), "v_gerado": moment("gerado_em")},
        rules=[IDS[0], ("TIPO_INVALIDO", "v_usuario IS NULL OR v_conteudo IS NULL OR v_posicao IS NULL"), ("TIPO_INVALIDO", "v_pontuacao IS NULL"),
               ("DATA_INVALIDA", "v_gerado IS NULL"), ("DOMINIO", "v_classe IS NULL"), POSITIVE, ("FAIXA", "v_pontuacao < 0 OR v_pontuacao > 100"),
               ("FAIXA", "v_posicao <= 0"), *PARENTS],
        key=["v_usuario", "v_conteudo", "v_gerado"], label="NULL",
        out={"usuario_id": "v_usuario", "conteudo_id": "v_conteudo", "pontuacao": "v_pontuacao", "posicao": "v_posicao", "classificacao": "v_classe",
             "gerado_em": "v_gerado"}),
}


def classifier(fonte: str, v: str = "") -> tuple[tuple[str, ...], str]:
    """(CTEs needed, SQL) of the classified rows of ``bronze_<fonte><v>``, superseded ones flagged. The delivery may
    bring ``entrega``, the content as delivered; else it is the content itself."""
    spec = SOURCES[fonte]
    _, cols, required, _ = raw.SOURCES[fonte]
    versions = "newest" in spec
    needs = [f"bronze_{fonte}{v}"]
    parents = "ruled AS (SELECT *, "
    source = "typed"
    if not versions:
        needs += [f"cls_usuarios{v}", f"cls_catalogo{v}"]
        source = (f"typed LEFT JOIN (SELECT usuario_id AS pai_usuario FROM cls_usuarios{v} WHERE regra IS NULL) ON pai_usuario = v_usuario "
                  f"LEFT JOIN (SELECT conteudo_id AS pai_conteudo, data_publicacao AS pai_data FROM cls_catalogo{v} WHERE regra IS NULL) ON pai_conteudo = v_conteudo")
    typed = ", ".join(f"{sql} AS {name}" for name, sql in spec["typed"].items())
    codes = "[" + ", ".join(f"'{c}'" for c, _ in spec["rules"]) + "]"
    conditions = "[" + ", ".join(f"({cond})" for _, cond in spec["rules"]) + "]"
    key, on = ", ".join(spec["key"]), " AND ".join(f"queues.{k} = ruled.{k}" for k in spec["key"])
    this = "{'p': prioridade, 'l': _linha, 'o': _origem, 'c': corpo, 'n': " + spec.get("newest", "CAST(NULL AS TIMESTAMP)") + "}"
    if versions:
        place = ("list_contains(unicas, eu) AS unica, list_sort(list_transform(unicas, lambda x: {'t': x.n IS NOT NULL, 'n': coalesce(x.n, TIMESTAMP '1900-01-01'), "
                 "'p': x.p, 'l': x.l, 'o': x.o}))[-1] AS vence")
        rule = ("coalesce(falha, CASE WHEN NOT unica THEN 'DUPLICADO' WHEN (vence.l <> _linha OR vence.o <> _origem) AND vence.o = _origem THEN 'CONFLITO_VERSAO' END)")
        lost = "falha IS NULL AND unica AND vence.o <> _origem"
    else:
        place = "fila[1] AS vence"
        rule = "coalesce(falha, CASE WHEN vence <> eu THEN CASE WHEN vence.c = corpo THEN 'DUPLICADO' ELSE 'CONFLITO_VERSAO' END END)"
        lost = "FALSE"
    spelling = ""
    placed = "placed"
    if fonte == "catalogo":
        spelling = f""",
spelled AS (SELECT falha IS NULL AS aceito, {folded('v_categoria')} AS grafia, (list(v_categoria ORDER BY prioridade, _origem, _linha))[1] AS canonica
              FROM ruled GROUP BY ALL)"""
        placed = f"placed LEFT JOIN spelled ON aceito = (falha IS NULL) AND grafia = {folded('v_categoria')}"
    entrega = "" if v else ", corpo AS entrega"
    out = ", ".join(f"{sql} AS {name}" for name, sql in spec["out"].items())
    sql = f"""
WITH typed AS (SELECT *, CASE WHEN starts_with(_origem, 'dados/brutos/lote_2/') THEN 2 ELSE 1 END AS prioridade,
       {content(cols)} AS corpo{entrega}, {typed}, {absent(required)} AS v_ausentes FROM bronze_{fonte}{v}),
{parents}{codes}[list_position({conditions}, true)] AS falha, {this} AS eu FROM {source}),
queues AS (SELECT {key}, fila, list_filter(fila, lambda x, i: list_position(list_transform(fila, lambda y: y.c), x.c) = i) AS unicas
             FROM (SELECT {key}, list(eu ORDER BY eu) AS fila FROM ruled WHERE falha IS NULL GROUP BY {key})),
placed AS (SELECT ruled.*, {place} FROM ruled LEFT JOIN queues ON falha IS NULL AND {on}){spelling},
closed AS (SELECT *, {rule} AS regra, coalesce({lost}, FALSE) AS superado FROM {placed})
SELECT {out}, _origem, _linha, entrega, corpo AS _hash, '{fonte}' AS fonte, {spec['label']} AS chave_registro, regra, {severity('regra')} AS severidade, superado FROM closed"""
    return tuple(needs), sql


def add_round(v: str = "") -> None:
    """The CTEs of all classifiers over the deliveries ``bronze_<fonte><v>``."""
    for fonte in raw.SOURCES:
        CTES[f"cls_{fonte}{v}_tudo"] = classifier(fonte, v)
        CTES[f"cls_{fonte}{v}"] = ((f"cls_{fonte}{v}_tudo",), f"SELECT * EXCLUDE (superado) FROM cls_{fonte}{v}_tudo WHERE NOT superado")
    CTES[f"cls_todos{v}"] = (tuple(f"cls_{f}{v}" for f in raw.SOURCES), "\nUNION ALL ".join(
        f"SELECT fonte, _origem, _linha, entrega, regra, severidade FROM cls_{f}{v}" for f in raw.SOURCES))


for _fonte in raw.SOURCES:
    CTES[f"bronze_{_fonte}"] = ((), raw.bronze_sql(_fonte))
add_round()

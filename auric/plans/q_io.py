"""Sources, sinks and cross-implementation checks.

Round-trip keys write to a fresh folder under the shared checkpoint root and
read back; their oracle is the source table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from auric.operators import gold
from auric.operators.joins import join_dim
from auric.plans.registry import query
from auric.plans.sqlmodel import CONSUMPTION, with_
from auric.session import scratch_dir
from auric.sources import export, files, positions, upsert

RUN_ID = "execucao-teste-0001"
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _csv_roundtrip(m):
    src = m.t("part").select(*[F.col(c).cast("string").alias(c) for c in PART_COLS])
    path = scratch_dir(m.spark, "csv")
    src.write.option("header", True).csv(path)
    return files.read_csv_by_header(m.spark, path, PART_COLS)


query("src_csv_roundtrip", "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PART_COLS)
      + " FROM part")(_csv_roundtrip)

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _json_roundtrip(m):
    path = scratch_dir(m.spark, "json")
    m.t("events").write.option("timestampNTZFormat", export.TS_FORMAT).json(path)
    return m.spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST") \
        .option("timestampNTZFormat", export.TS_FORMAT).json(path)


query("src_json_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")(_json_roundtrip)

query("src_json_path", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.ausente') AS ausente
  FROM events""")(
    lambda m: m.t("events").select("event_id", F.get_json_object("props", "$.k").alias("k"),
                                   F.get_json_object("props", "$.ausente").alias("ausente")))


# ---------------------------------------------------------------- files in many tasks, with positions
def _json_array(m):
    """The events as one JSON array over several lines a record, read back in blocks."""
    path = scratch_dir(m.spark, "array")
    row = F.to_json(F.struct("event_id", "event_type", F.struct(F.col("user_id").alias("id"), "props").alias("quem")))
    first = F.col("event_id") == m.t("events").agg(F.min("event_id")).scalar()
    lines = m.t("events").select(F.col("event_id").alias("k"), F.concat(F.when(first, "[").otherwise(","), F.regexp_replace(row, ",", ",\n ")).alias("value"))
    end = m.spark.createDataFrame([(None, "]")], "k long, value string")
    lines.unionByName(end).coalesce(1).sortWithinPartitions(F.col("k").asc_nulls_last()).select("value").write.text(path)
    r = positions.read_json_array(m.spark, path, ["event_id", "event_type", "quem"])
    return r.select("_linha", F.col("event_id").cast("long").alias("event_id"), "event_type", F.get_json_object("quem", "$.id").cast("long").alias("user_id"),
                    F.get_json_object("quem", "$.props").alias("props"))


query("src_json_array", """
SELECT row_number() OVER (ORDER BY event_id) AS _linha, event_id, event_type, user_id, props FROM events""")(_json_array)


def _csv_positions(m):
    """Comments as one CSV file with line breaks and quotes inside its fields."""
    path = scratch_dir(m.spark, "lines")
    src = m.t("documents").select("doc_id", F.concat(F.lit('"'), F.col("lang"), F.lit('",\n'), F.col("source")).alias("rotulo"), "n_chars")
    src.coalesce(1).sortWithinPartitions("doc_id").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    r = positions.read_csv_positions(m.spark, path, ["n_chars", "doc_id", "rotulo"])
    return r.select("_linha", F.col("doc_id").cast("long").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "rotulo")


query("src_csv_positions", """
SELECT row_number() OVER (ORDER BY doc_id) AS _linha, doc_id, n_chars, '"' || lang || '",' || chr(10) || source AS rotulo FROM documents""")(_csv_positions)


# three loads of a keyed table: two thirds of the accounts, half of them with another balance, then a full one
def _surrogates(m):
    path = scratch_dir(m.spark, "contas")
    c = m.t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    loads = [c.where(F.pmod(key, F.lit(3)) != 0), c.where(F.pmod(key, F.lit(2)) == 0).withColumn("c_mktsegment", F.lit("NOVO")), c.where(F.pmod(key, F.lit(5)) != 1)]
    for n, load in enumerate(loads, 1):
        upsert.upsert_buckets(m.spark, path, load, ["c_custkey"], "id", f"carga-{n}")
    upsert.delete_stale(m.spark, path, "carga-3")
    return m.spark.read.parquet(path).select("id", "c_custkey", "c_nationkey", "c_mktsegment", F.col("_carga").alias("carga"))


query("upsert_surrogate", """
WITH primeira AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 2 ELSE 3 END AS carga FROM customer
                   WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0 OR c_custkey % 5 <> 1),
ids AS (SELECT c_custkey, row_number() OVER (ORDER BY carga, c_custkey) AS id FROM primeira)
SELECT i.id, c.c_custkey, c.c_nationkey, c.c_mktsegment, 'carga-3' AS carga FROM customer c JOIN ids i USING (c_custkey) WHERE c.c_custkey % 5 <> 1""")(_surrogates)


def _bronze_audit(m):
    path = scratch_dir(m.spark, "bronze")
    for fonte in ("catalogo", "usuarios", "interacoes", "comentarios", "recomendacoes"):
        b = m.bronze(fonte).withColumn("_execucao_id", F.lit(RUN_ID)) \
            .withColumn("_ingerido_em", F.current_timestamp()).select("_execucao_id", "_origem", "_linha",
                                                                       "_ingerido_em")
        files.append_bronze(b, f"{path}/{fonte}")
    out = None
    for fonte in ("catalogo", "usuarios", "interacoes", "comentarios", "recomendacoes"):
        r = m.spark.read.parquet(f"{path}/{fonte}").groupBy("_execucao_id", "_origem").agg(
            F.count(F.lit(1)).alias("linhas"), F.max("_linha").alias("ultima_linha")).withColumn(
            "fonte", F.lit(fonte))
        out = r if out is None else out.unionByName(r)
    return out


query("bronze_audit_counts", with_(*[f"bronze_{f}" for f in ("catalogo", "usuarios", "interacoes", "comentarios",
                                                              "recomendacoes")]) + "\nUNION ALL\n".join(
    f"SELECT '{RUN_ID}' AS _execucao_id, _origem, count(*) AS linhas, max(_linha) AS ultima_linha, '{f}' AS fonte "
    f"FROM bronze_{f} GROUP BY _origem"
    for f in ("catalogo", "usuarios", "interacoes", "comentarios", "recomendacoes")))(_bronze_audit)

# keyed upsert: yesterday's catalogue (4 of every 5 items) and today's delivery
# (every item except multiples of 7, with a new title for every 3rd)
OLD_SQL = "SELECT conteudo_id, titulo FROM conteudo WHERE conteudo_id % 5 <> 4"
NEW_SQL = ("SELECT conteudo_id, CASE WHEN conteudo_id % 3 = 0 THEN titulo || ' v2' ELSE titulo END AS titulo "
           "FROM conteudo WHERE conteudo_id % 7 <> 0")


def _old(m):
    return m.conteudo.where(F.pmod("conteudo_id", F.lit(5)) != 4).select("conteudo_id", "titulo")


def _new(m):
    return m.conteudo.where(F.pmod("conteudo_id", F.lit(7)) != 0).select(
        "conteudo_id", F.when(F.pmod("conteudo_id", F.lit(3)) == 0, F.concat("titulo", F.lit(" v2")))
        .otherwise(F.col("titulo")).alias("titulo"))


query("upsert_merge", with_("conteudo") + f"""
, old AS ({OLD_SQL}), new AS ({NEW_SQL})
SELECT conteudo_id, titulo FROM new
UNION ALL SELECT o.conteudo_id, o.titulo FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.conteudo_id = o.conteudo_id)
""")(lambda m: export.upsert(_old(m), _new(m), ["conteudo_id"]))

query("reconcile_removed", with_("conteudo") + f"""
, old AS ({OLD_SQL}), new AS ({NEW_SQL})
SELECT 'conteudo' AS tabela, count(*) AS removidos FROM old WHERE conteudo_id NOT IN (SELECT conteudo_id FROM new)""")(
    lambda m: export.removed_keys(_old(m), _new(m), ["conteudo_id"]).agg(
        F.count(F.lit(1)).alias("removidos")).select(F.lit("conteudo").alias("tabela"), "removidos"))

query("doc_upsert_counts", with_("comentario") + """
, old AS (SELECT comentario_id, avaliacao FROM comentario WHERE comentario_id % 7 <> 0),
new AS (SELECT comentario_id, CASE WHEN comentario_id % 5 = 0 THEN 6 - avaliacao ELSE avaliacao END AS avaliacao
          FROM comentario WHERE comentario_id % 11 <> 0)
SELECT count(*) FILTER (WHERE o.comentario_id IS NULL) AS inseridos,
       count(*) FILTER (WHERE o.comentario_id IS NOT NULL AND n.comentario_id IS NOT NULL
                         AND o.avaliacao IS DISTINCT FROM n.avaliacao) AS atualizados,
       count(*) FILTER (WHERE n.comentario_id IS NULL) AS removidos,
       count(*) FILTER (WHERE o.comentario_id IS NOT NULL AND n.comentario_id IS NOT NULL
                         AND o.avaliacao IS NOT DISTINCT FROM n.avaliacao) AS inalterados
  FROM old o FULL OUTER JOIN new n ON o.comentario_id = n.comentario_id""")(
    lambda m: export.upsert_counts(
        m.comentario.where(F.pmod("comentario_id", F.lit(7)) != 0).select("comentario_id", "avaliacao"),
        m.comentario.where(F.pmod("comentario_id", F.lit(11)) != 0).select(
            "comentario_id", F.when(F.pmod("comentario_id", F.lit(5)) == 0, 6 - F.col("avaliacao"))
            .otherwise(F.col("avaliacao")).alias("avaliacao")),
        ["comentario_id"], ["avaliacao"]))

# ---------------------------------------------------------------- partitioned export (orders span 80 months)
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _export(m):
    path = scratch_dir(m.spark, "export")
    df = m.t("orders").select(*ORDER_COLS, F.date_format("o_orderdate", "yyyy-MM").alias("mes"))
    export.export_partitioned(df, path)
    return path


query("export_partition_counts", """
SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS linhas, sum(o_orderkey) AS soma_ids FROM orders GROUP BY 1""")(
    lambda m: m.spark.read.parquet(_export(m)).groupBy(F.col("mes").cast("string").alias("mes")).agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("o_orderkey").alias("soma_ids")))

query("export_manifest", f"""
SELECT count(*) AS particoes, CAST(sum(n) AS BIGINT) AS linhas, string_agg(mes, ',' ORDER BY mes) AS lista,
       {len(ORDER_COLS)} AS colunas
  FROM (SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS n FROM orders GROUP BY 1) s""")(
    lambda m: export.manifest(m.spark, _export(m)))


def _selective(m):
    df = m.spark.read.parquet(_export(m))
    return df.where(F.col("mes") == "1996-08").select("o_orderkey", "o_custkey", "o_totalprice")


query("selective_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-08'""")(_selective)

ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def _formats(m):
    base = scratch_dir(m.spark, "formats")
    paths = export.write_formats(m.t("orders").select(*ORDER_COLS), base)
    return export.reconcile_formats(m.spark, paths, ORDER_SCHEMA, "o_orderkey")


query("format_reconcile", "\nUNION ALL\n".join(
    f"SELECT '{f}' AS formato, count(*) AS linhas, sum(o_orderkey) AS soma_ids FROM orders"
    for f in ("parquet", "csv", "json")))(_formats)


# ---------------------------------------------------------------- distributed monthly engagement
def engagement_distributed(m):
    return gold.engagement_by_month(m.interacao, m.conteudo, m.correspondencia)


query("engagement_distributed", with_("interacao", "conteudo", "correspondencia") + """
SELECT strftime(i.data_hora, '%Y-%m') AS mes, c.categoria, count(*) AS interacoes,
       count(DISTINCT coalesce(p.usuario_mestre_id, i.usuario_id)) AS pessoas_ativas,
       count(*) FILTER (WHERE i.tipo_interacao = 'conclusão') AS conclusoes,
       CAST(coalesce(sum(i.tempo_consumido), 0) AS BIGINT) AS minutos_consumidos
  FROM interacao i JOIN conteudo c USING (conteudo_id) LEFT JOIN correspondencia p USING (usuario_id)
 GROUP BY 1, 2""")(engagement_distributed)


def _engagement_reconcile(m):
    a = engagement_distributed(m)
    g = gold.kpi_engagement(m.fato_interacao, m.dim_conteudo).select(
        "mes", "categoria", "interacoes", "pessoas_ativas", "conclusoes", "minutos_consumidos")
    n = lambda df, c: df.agg(c).scalar()
    return m.spark.range(1).select(
        n(m.interacao, F.count(F.lit(1))).alias("lidos"),
        n(a, F.sum("interacoes")).alias("agregados"),
        n(a.exceptAll(g), F.count(F.lit(1))).alias("so_no_distribuido"),
        n(g.exceptAll(a), F.count(F.lit(1))).alias("so_na_gold"),
    )


query("engagement_reconcile", with_("interacao", "conteudo", "correspondencia", "fato_interacao") + """
, a AS (SELECT strftime(i.data_hora, '%Y-%m') AS mes, c.categoria, count(*) AS interacoes,
               count(DISTINCT coalesce(p.usuario_mestre_id, i.usuario_id)) AS pessoas_ativas,
               count(*) FILTER (WHERE i.tipo_interacao = 'conclusão') AS conclusoes,
               CAST(coalesce(sum(i.tempo_consumido), 0) AS BIGINT) AS minutos_consumidos
          FROM interacao i JOIN conteudo c USING (conteudo_id) LEFT JOIN correspondencia p USING (usuario_id)
         GROUP BY 1, 2),
g AS (SELECT strftime(f.mes, '%Y-%m') AS mes, d.categoria, count(*) AS interacoes,
             count(DISTINCT f.usuario_pseudo) AS pessoas_ativas,
             count(*) FILTER (WHERE f.tipo_interacao = 'conclusão') AS conclusoes,
             CAST(coalesce(sum(f.tempo_consumido), 0) AS BIGINT) AS minutos_consumidos
        FROM fato_interacao f JOIN conteudo d USING (conteudo_id) GROUP BY f.mes, d.categoria)
SELECT (SELECT count(*) FROM interacao) AS lidos, (SELECT CAST(sum(interacoes) AS BIGINT) FROM a) AS agregados,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM g)) AS so_no_distribuido,
       (SELECT count(*) FROM (SELECT * FROM g EXCEPT ALL SELECT * FROM a)) AS so_na_gold""")(_engagement_reconcile)

query("consumption_events", with_("interacao") + f"""
SELECT tipo_interacao, count(*) AS n FROM interacao WHERE tipo_interacao IN {CONSUMPTION} GROUP BY 1""")(
    lambda m: m.interacao.where(F.col("tipo_interacao").isin("visualização", "início", "conclusão"))
    .groupBy("tipo_interacao").agg(F.count(F.lit(1)).alias("n")))

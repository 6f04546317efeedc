"""Identity resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from auric.operators import identity
from auric.operators.identity_state import IdentityState
from auric.plans.registry import query
from auric.plans.sqlmodel import CTES, with_
from auric.session import scratch_dir, stage


def doc_keys(m):
    """Two whole-text keys per document: exact copy, and a copy up to case
    and whitespace."""
    d = m.t("documents").select("doc_id", "text")
    return d.select(
        "doc_id",
        F.md5("text").alias("copia"),
        F.md5(F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))).alias("normalizado"),
    )


def doc_edges(m):
    k = doc_keys(m)
    return identity.star_edges(k, "doc_id", "copia", "copia").unionByName(
        identity.star_edges(k, "doc_id", "normalizado", "normalizado"))


CTES["doc_keys"] = ((), """
SELECT doc_id, md5(text) AS copia, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS normalizado
  FROM documents""")
CTES["doc_edges"] = (("doc_keys",), """
SELECT k.doc_id AS src, a.dst, 'copia' AS via
  FROM doc_keys k JOIN (SELECT copia, min(doc_id) AS dst FROM doc_keys GROUP BY copia) a USING (copia)
 WHERE k.doc_id <> a.dst
UNION ALL
SELECT k.doc_id, a.dst, 'normalizado'
  FROM doc_keys k JOIN (SELECT normalizado, min(doc_id) AS dst FROM doc_keys GROUP BY normalizado) a USING (normalizado)
 WHERE k.doc_id <> a.dst""")
CTES["doc_und"] = (("doc_edges",), "SELECT src AS a, dst AS b FROM doc_edges UNION SELECT dst, src FROM doc_edges")
CTES["doc_reach"] = (("doc_und",), """
SELECT a AS src, b AS dst FROM doc_und
UNION
SELECT r.src, u.b FROM doc_reach r JOIN doc_und u ON r.dst = u.a""")

query("identity_links", with_("doc_edges") + "SELECT src, dst, via FROM doc_edges")(doc_edges)


def _components(m):
    return identity.connected_components(m.spark, doc_edges(m)).withColumnRenamed("node", "doc_id")


def _with_reach(body: str) -> str:
    # the recursive CTE needs WITH RECURSIVE and the (src, dst) column list
    w = with_("doc_und")
    return (w.replace("WITH ", "WITH RECURSIVE ", 1) + ", doc_reach(src, dst) AS (" + CTES["doc_reach"][1] + ")\n"
            + body)


query("identity_components", _with_reach("""
SELECT src AS doc_id, least(src, min(dst)) AS component FROM doc_reach GROUP BY src"""))(_components)

#: Deliveries that bring all documents, one after the other.
DELIVERIES = 3


def _by_deliveries(m):
    """Components kept from delivery to delivery; copies of a document come in any of them."""
    state = IdentityState(m.spark, scratch_dir(m.spark, "identity"))
    keys = stage(doc_keys(m).withColumn("entrega", F.pmod(F.xxhash64("doc_id"), F.lit(DELIVERIES))), "doc-keys")
    for n in range(DELIVERIES):
        state.deliver(f"entrega-{n + 1}", keys.where(F.col("entrega") == n), "doc_id", {"copia": "copia", "normalizado": "normalizado"})
    return state.labels().withColumnRenamed("node", "doc_id")


query("identity_incremental", _with_reach("""
SELECT d.doc_id, least(d.doc_id, coalesce(min(r.dst), d.doc_id)) AS component
  FROM documents d LEFT JOIN doc_reach r ON r.src = d.doc_id GROUP BY d.doc_id"""))(_by_deliveries)

query("master_registry", with_("mestre") + """
SELECT usuario_mestre_id, usuario_pseudo, nome_mascarado, email_mascarado, faixa_etaria, cidade, uf, data_cadastro,
       atualizado_em, registros_origem FROM mestre""")(lambda m: m.mestre)

query("master_correspondence", with_("correspondencia") + """
SELECT usuario_id, usuario_mestre_id, regra FROM correspondencia""")(lambda m: m.correspondencia)

query("identity_component_sizes", _with_reach("""
SELECT tamanho, count(*) AS componentes FROM (
  SELECT component, count(*) AS tamanho FROM (
    SELECT src AS doc_id, least(src, min(dst)) AS component FROM doc_reach GROUP BY src) c GROUP BY component) s
 GROUP BY tamanho"""))(
    lambda m: _components(m).groupBy("component").agg(F.count(F.lit(1)).alias("tamanho"))
    .groupBy("tamanho").agg(F.count(F.lit(1)).alias("componentes")))

"""Identity resolution: link records sharing a key, then connected components.

Links are *star* edges (every member of a key group → the group's minimum
id), so a key shared by a third of all rows yields one edge per row, never
all pairs. Components come from min-label propagation alternated with
pointer jumping (label := label of label), which halves path lengths every
round; each round's labels are checkpointed to the shared checkpoint folder,
so lineage stays short and a lost executor recomputes one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions import privacy
from auric.session import ensure_checkpoint_dir


def star_edges(df: DataFrame, id_col: str, key_col: str, reason: str) -> DataFrame:
    """(src, dst, via): each row with a non-blank key → min id of its key group."""
    keyed = df.select(F.col(id_col).alias("src"), F.col(key_col).alias("k")).where(
        F.col("k").isNotNull() & (F.trim(F.col("k")) != "")
    )
    anchors = keyed.groupBy("k").agg(F.min("src").alias("dst"))  # partial aggregation, skew-safe
    return (
        keyed.join(anchors, "k")
        .where(F.col("src") != F.col("dst"))
        .select("src", "dst", F.lit(reason).alias("via"))
    )


def connected_components(spark: SparkSession, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node on an edge; component = min node id."""
    ensure_checkpoint_dir(spark)
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    und = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    und = und.checkpoint()
    labels = (
        und.groupBy("a")
        .agg(F.least(F.min("b"), F.first("a")).alias("label"))
        .withColumnRenamed("a", "node")
    ).checkpoint()
    for _ in range(max_rounds):
        # 1. propagate: smallest label among neighbours (partial min per node)
        nbr = (
            und.join(labels.withColumnRenamed("node", "b").withColumnRenamed("label", "nl"), "b")
            .groupBy("a")
            .agg(F.min("nl").alias("nl"))
            .withColumnRenamed("a", "node")
        )
        step = labels.join(nbr, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("nl", "label")).alias("l1")
        )
        # 2. pointer jumping: adopt the label of my label
        jump = labels.select(F.col("node").alias("l1"), F.col("label").alias("l2"))
        new = (
            step.join(jump, "l1", "left")
            .select("node", "old", F.least("l1", F.coalesce("l2", "l1")).alias("label"))
            .select("node", "label", (F.col("label") != F.col("old")).alias("changed"))
            .checkpoint()
        )
        labels = new.select("node", "label")
        if new.where("changed").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    return labels.withColumnRenamed("label", "component")


def resolve(spark: SparkSession, df: DataFrame, id_col: str, key_cols: dict[str, str]) -> DataFrame:
    """(id, component) for every id of ``df``: ids linked through any key
    column share the component (min id); unlinked ids are their own."""
    edges = None
    for reason, col in key_cols.items():
        s = star_edges(df, id_col, col, reason)
        edges = s if edges is None else edges.unionByName(s)
    comps = connected_components(spark, edges)
    ids = df.select(F.col(id_col).alias("node")).distinct()
    return ids.join(comps, "node", "left").select(
        F.col("node").alias(id_col), F.coalesce("component", "node").alias("component")
    )


def correspondence(users: DataFrame, components: DataFrame) -> DataFrame:
    """Account → master with the match reason (own, direct CPF or e-mail evidence with the master, else transitive).
    ``components`` is (usuario_id, usuario_mestre_id)."""
    u = users.select("usuario_id", "cpf_hash", "email_hash")
    m = u.select(F.col("usuario_id").alias("usuario_mestre_id"), F.col("cpf_hash").alias("m_cpf"), F.col("email_hash").alias("m_email"))
    reason = (
        F.when(F.col("usuario_id") == F.col("usuario_mestre_id"), "proprio")
        .when(F.col("cpf_hash") == F.col("m_cpf"), "cpf_hash")
        .when(F.col("email_hash") == F.col("m_email"), "email_hash")
        .otherwise("transitivo")
    )
    return components.join(u, "usuario_id").join(m, "usuario_mestre_id").select("usuario_id", "usuario_mestre_id", reason.alias("regra"))


def master(users: DataFrame, components: DataFrame, key: str) -> DataFrame:
    """One row per person: attributes of the most recently updated account (ties: lowest id), earliest registration,
    member count. The survivor is a partial-aggregating ``max_by``, not a window over a possibly huge group."""
    u = users.join(components, "usuario_id")
    order = F.struct(F.col("atualizado_em").isNotNull(), F.col("atualizado_em"), -F.col("usuario_id"))
    attrs = F.struct("nome_mascarado", "email_mascarado", "faixa_etaria", "cidade", "uf", "atualizado_em")
    g = u.groupBy("usuario_mestre_id").agg(
        F.max_by(attrs, order).alias("s"),
        F.min("data_cadastro").alias("data_cadastro"),
        F.count(F.lit(1)).cast("int").alias("registros_origem"),
    )
    return g.select(
        "usuario_mestre_id",
        privacy.pseudonym(F.col("usuario_mestre_id"), key).alias("usuario_pseudo"),
        "s.nome_mascarado", "s.email_mascarado", "s.faixa_etaria", "s.cidade", "s.uf",
        "data_cadastro", "s.atualizado_em", "registros_origem",
    )

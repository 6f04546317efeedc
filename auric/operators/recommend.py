"""Set-based recommendation engine for every user at once.

Per user and category: Ivis (share of consumed minutes), Icur (share of
likes / good grades); per content: Iconc (0 once completed) and affinity
(cosine between the content vector and the user's mean vector).

score = round((Ivis + Icur) / 2 * 100 * Iconc, 2)
class = negativo if completed or score <= 40; positivo if score >= 70; else estavel

The score depends on (user, category) only and the shares of a user sum to
at most 1 each, so at most two categories of a user can pass 40, and the
worse of the two is looked into only if the better one has too few contents
left. Pairs of users and contents are never rows: blocks of users of a
category meet blocks of its contents in a task, which compares their vectors
as matrices and gives back each user's best contents of the block. A category
that holds a third of the catalogue or of the users is many blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.functions.domain import CONSUMPTION_TYPES
from auric.operators import vectors
from auric.operators.joins import join_dim

#: Rows of a block, and users compared with a block of contents at a time.
USER_BLOCK, CONTENT_BLOCK, SLICE = 2048, 4096, 256


def score(ivis: Column, icur: Column, iconc: Column) -> Column:
    return F.round((ivis + icur) / 2 * 100 * iconc, 2)


def classify(score_col: Column, iconc: Column) -> Column:
    return (
        F.when((iconc == 0) | (score_col <= 40), "negativo")
        .when(score_col >= 70, "positivo")
        .otherwise("estavel")
    )


def category_indices(interacao: DataFrame, conteudo: DataFrame, min_grade: int) -> DataFrame:
    """(usuario_id, categoria, ivis, icur)."""
    ic = join_dim(interacao, conteudo.select("conteudo_id", "categoria"), "conteudo_id")
    tempo = ic.where(F.col("tipo_interacao").isin(CONSUMPTION_TYPES)).groupBy("usuario_id", "categoria").agg(
        F.sum(F.coalesce("tempo_consumido", F.lit(0))).alias("t"))
    aprov = ic.where((F.col("tipo_interacao") == "curtida") | (F.col("avaliacao_atribuida") >= min_grade)) \
        .groupBy("usuario_id", "categoria").agg(F.count(F.lit(1)).alias("n"))
    cat = tempo.join(aprov, ["usuario_id", "categoria"], "full").select(
        "usuario_id", "categoria", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("n", F.lit(0)).alias("n"))
    u = Window.partitionBy("usuario_id")  # ≤ one row per category per user
    return cat.select(
        "usuario_id", "categoria",
        F.coalesce(F.col("t").cast("double") / F.nullif(F.sum("t").over(u), F.lit(0)), F.lit(0.0)).alias("ivis"),
        F.coalesce(F.col("n").cast("double") / F.nullif(F.sum("n").over(u), F.lit(0)), F.lit(0.0)).alias("icur"),
    )


def completed_pairs(interacao: DataFrame) -> DataFrame:
    return interacao.where(
        (F.col("tipo_interacao") == "conclusão") | (F.col("percentual_conclusao") >= 100)
    ).select("usuario_id", "conteudo_id").distinct()


def user_profiles(interacao: DataFrame, embedding: DataFrame) -> DataFrame:
    """Mean vector of the contents a user interacted with (every interaction counts): interactions are counted per user
    and content before vectors come in."""
    n = interacao.groupBy("usuario_id", "conteudo_id").agg(F.count("*").alias("n"))
    ie = n.join(embedding.select("conteudo_id", "embedding"), "conteudo_id")
    return vectors.mean_vector(ie, "usuario_id", "embedding", "n").withColumnRenamed("embedding", "perfil")


def matrix(rows: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, norms); a missing vector is zero."""
    out = np.zeros((len(rows), width))
    for k, v in enumerate(rows):
        if v is not None:
            out[k] = v
    return out, np.sqrt((out * out).sum(1))


def best_of_block(k: int):
    """The function of a task: (users of a category, contents of the category) → each user's ``k`` best contents of the
    block that the user has not completed, by affinity rounded to 4 places, ties to the smaller id."""

    def best(users: pd.DataFrame, contents: pd.DataFrame) -> pd.DataFrame:
        out = {"usuario_id": [], "conteudo_id": [], "afinidade": [], "ivis": [], "icur": []}
        if len(users) and len(contents):
            contents = contents.sort_values("conteudo_id")
            ids = contents["conteudo_id"].to_numpy()
            width = max((len(v) for v in [*users["perfil"], *contents["embedding"]] if v is not None), default=1)
            c, c_norm = matrix(list(contents["embedding"]), width)
            for a in range(0, len(users), SLICE):
                part = users.iloc[a:a + SLICE]
                u, u_norm = matrix(list(part["perfil"]), width)
                norm = u_norm[:, None] * c_norm[None]
                sim = np.divide(u @ c.T, norm, out=np.zeros_like(norm), where=norm > 0)
                rank = -np.round(sim, 4)
                for row, done in enumerate(part["feitos"]):
                    if done is not None and len(done):
                        rank[row, np.isin(ids, done)] = np.inf
                top = np.argsort(rank, axis=1, kind="stable")[:, :k]
                row = np.repeat(np.arange(len(part)), top.shape[1])
                at = top.ravel()
                ok = np.isfinite(rank[row, at])
                row, at = row[ok], at[ok]
                out["usuario_id"].append(part["usuario_id"].to_numpy()[row])
                out["conteudo_id"].append(ids[at])
                out["afinidade"].append(sim[row, at])
                for c_ in ("ivis", "icur"):
                    out[c_].append(part[c_].to_numpy()[row])
        return pd.DataFrame({c_: np.concatenate(v) if v else np.zeros(0, "int64" if c_.endswith("_id") else "float64") for c_, v in out.items()})

    return best


def recommend_top(indices: DataFrame, contents: DataFrame, completed: DataFrame, embedding: DataFrame, profiles: DataFrame, k: int) -> DataFrame:
    """(usuario_id, conteudo_id, ivis, icur, pontuacao, afinidade, posicao): each user's ``k`` best contents that are not
    completed, of the categories whose score passes 40, by score, affinity rounded to 4 places, and id.

    ``indices`` is (usuario_id, categoria, ivis, icur). A content without a vector, or a user without a profile, has the
    affinity 0; a user who has completed everything gets nothing."""
    points = score(F.col("ivis"), F.col("icur"), F.lit(1))
    cat = indices.withColumn("pontuacao", points).where(F.col("pontuacao") > 40)
    listed = contents.select("conteudo_id", "categoria")
    size = listed.groupBy("categoria").agg(F.count("*").alias("conteudos"))
    done = join_dim(completed, listed, "conteudo_id").groupBy("usuario_id", "categoria").agg(F.collect_set("conteudo_id").alias("feitos"))  # at most the catalogue
    cat = join_dim(cat, size, "categoria").join(done, ["usuario_id", "categoria"], "left")
    left = F.col("conteudos") - F.coalesce(F.size("feitos"), F.lit(0))
    mine = Window.partitionBy("usuario_id")  # at most two rows
    cat = cat.withColumn("_left", left).withColumn("_best", F.max(F.struct("pontuacao", "_left")).over(mine))
    cat = cat.where((F.col("pontuacao") == F.col("_best.pontuacao")) | (F.col("_best._left") < k)).drop("_left", "_best", "conteudos")
    users = cat.join(profiles, "usuario_id", "left")
    blocks = cat.groupBy("categoria").agg(F.count("*").alias("u")).join(size, "categoria").select(
        "categoria", F.ceil(F.col("u") / USER_BLOCK).cast("int").alias("nu"), F.ceil(F.col("conteudos") / CONTENT_BLOCK).cast("int").alias("nc"))
    dealt = lambda df, key, own, other, mine_, theirs: join_dim(df, blocks, "categoria").select(  # noqa: E731  each block once for each of the other side
        *df.columns, F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(mine_), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs))
    u = dealt(users.select("usuario_id", "categoria", "ivis", "icur", "feitos", "perfil"), "usuario_id", "nu", "nc", "ub", "cb")
    c = dealt(listed.join(embedding.select("conteudo_id", "embedding"), "conteudo_id", "left"), "conteudo_id", "nc", "nu", "cb", "ub")
    by = ["categoria", "ub", "cb"]
    ids = dict(indices.dtypes)["usuario_id"], dict(contents.dtypes)["conteudo_id"]
    found = u.groupBy(*by).cogroup(c.groupBy(*by)).applyInPandas(best_of_block(k), f"usuario_id {ids[0]}, conteudo_id {ids[1]}, afinidade double, ivis double, icur double")
    w = Window.partitionBy("usuario_id").orderBy(F.col("pontuacao").desc(), F.round("afinidade", 4).desc(), F.col("conteudo_id"))  # k rows a block
    return found.withColumn("pontuacao", points).withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= k)


def recommend(m, k: int, min_grade: int | None = None) -> DataFrame:
    """Top-k per user ordered by (score desc, affinity rounded to 4 desc, id)."""
    from auric.plans.model import MIN_GOOD_GRADE, RECOMMENDED_AT

    indices = category_indices(m.interacao, m.conteudo, MIN_GOOD_GRADE if min_grade is None else min_grade)
    top = recommend_top(indices, m.conteudo, completed_pairs(m.interacao), m.embedding, user_profiles(m.interacao, m.embedding), k)
    return top.select(
        "usuario_id", "conteudo_id", "pontuacao", F.col("posicao").cast("int").alias("posicao"), classify(F.col("pontuacao"), F.lit(1)).alias("classificacao"),
        F.lit(RECOMMENDED_AT).cast("timestamp_ntz").alias("gerado_em"), "ivis", "icur", F.lit(1).alias("iconc"), "afinidade")

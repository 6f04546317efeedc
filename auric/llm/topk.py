"""Exact top-k by inner product with a ball tree per shard.

Vectors are dealt over shards; each shard holds a ball tree whose nodes bound
the inner product with a query by <q, centre> + |q| * radius. Queries come in
blocks. A block first searches one home shard, which gives each query a score
that its k-th best cannot fall below; all other shards start from that score,
skip whole branches by it, and visit what is left in order of the bounds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.session import stage

LEAF = 256
#: Vectors of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Below this the products of 64-bit floats are exact.
EXACT = 1 << 53


class BallTree:
    """Rows (ids in order, integer vectors) in leaves; ``levels`` are arrays of nodes from the root down."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.nodes: list = []  # (centre, radius, first child or -1, begin, end)
        perm = np.arange(len(ids))
        todo = [(0, len(ids))]
        self.nodes.append(None)
        at = 0
        while at < len(todo):
            a, b = todo[at]
            rows = self.vectors[perm[a:b]]
            centre = rows.mean(0)
            away = np.sqrt(((rows - centre) ** 2).sum(1))
            child = -1
            if b - a > LEAF and away.max() > 0:
                one = rows[int(away.argmax())]
                two = rows[int(((rows - one) ** 2).sum(1).argmax())]
                half = (b - a) // 2
                perm[a:b] = perm[a:b][np.argpartition(rows @ (two - one), half)]
                child = len(todo)
                todo += [(a, a + half), (a + half, b)]
                self.nodes += [None, None]
            self.nodes[at] = (centre, float(away.max()) * (1 + 1e-9), child, a, b)
            at += 1
        self.ids, self.vectors = self.ids[perm], self.vectors[perm]
        self.centres = np.stack([n[0] for n in self.nodes])
        self.radii = np.array([n[1] for n in self.nodes])

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple:
        """(query row, id, score) of the rows that can be among a query's k best: none with a score below ``least``."""
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        slack = 1e-9 * (1 + norms)  # of the bounds' floating-point sums, relative to the lengths they bound
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qids)
        floor = least.astype(np.float64).copy()
        alive = np.arange(len(qids))
        frontier = [(0, alive)]
        leaves: list = []
        while frontier:  # downwards: a branch goes on with the queries whose bound reaches their floor
            below = []
            for node, some in frontier:
                centre, radius, child, _, _ = self.nodes[node]
                bound = queries[some] @ centre + norms[some] * radius + slack[some] * (1 + np.abs(centre).max() + radius)
                some, bound = some[bound >= floor[some]], bound[bound >= floor[some]]
                if len(some) and child < 0:
                    leaves.append((node, some, bound))
                elif len(some):
                    below += [(child, some), (child + 1, some)]
            frontier = below
        if not leaves:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        query = np.concatenate([s for _, s, _ in leaves])
        leaf = np.repeat([n for n, _, _ in leaves], [len(s) for _, s, _ in leaves])
        bound = np.concatenate([b for _, _, b in leaves])
        order = np.lexsort((-bound, query))  # each query's leaves by bound
        query, leaf, bound = query[order], leaf[order], bound[order]
        first = np.searchsorted(query, query)
        turn = np.arange(len(query)) - first
        by_turn = np.argsort(turn, kind="stable")
        cuts = np.searchsorted(turn[by_turn], np.arange(turn.max() + 2))
        for t in range(len(cuts) - 1):  # in turn t every query visits its t-th leaf
            some = by_turn[cuts[t]: cuts[t + 1]]
            some = some[bound[some] >= floor[query[some]]]
            some = some[np.argsort(leaf[some], kind="stable")]
            edges = np.flatnonzero(np.diff(leaf[some])) + 1
            for part in np.split(some, edges) if len(some) else ():
                _, _, _, a, b = self.nodes[leaf[part[0]]]
                asked = query[part]
                scores = products(queries[asked], self.vectors[a:b])
                good = (scores >= floor[asked, None]) & (self.ids[None, a:b] != qids[asked, None])
                for row in np.flatnonzero(good.any(1)):
                    q, keep = asked[row], good[row]
                    ids, s = np.concatenate([best[q][0], self.ids[a:b][keep]]), np.concatenate([best[q][1], scores[row][keep]])
                    if len(s) > k:
                        top = np.lexsort((ids, -s))[:k]
                        ids, s = ids[top], s[top]
                    best[q] = (ids, s)
                    if len(s) == k:
                        floor[q] = max(floor[q], s.min())
        rows = np.repeat(np.arange(len(qids)), [len(b[0]) for b in best])
        return rows, np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floats where they are exact, else 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def as_matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as float64 rows, shorter ones filled with zeros."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column):
        out[k, : len(v)] = v
    return out


def top_k(items: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, ``id_col``, score): each query's k best of ``items`` by integer inner product of
    floor(scale * component), ties to the smaller id.

    A vector that is null or holds null or non-finite components takes no part, neither as item nor as query; shorter
    vectors count as filled with zeros, an empty one scores 0. A row is no candidate for a query of its own id; rows
    repeated under one id are one item if equal, else items of their own with that id, and a repeated query is asked
    once. Fewer than k candidates give fewer rows; empty tables none. Ids are integers, null ids take no part.
    Products must fit in 64 bits. Other columns do not matter.

    All queries meet all shards, in blocks: (query, shard) rows of the second pass are the queries times the number
    of shards, each item is read once for each block, and no task holds more than a shard and a block."""
    spark = items.sparkSession

    def clean(df):
        x = F.col(vector_col)
        fit = x.isNotNull() & F.col(id_col).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
        return df.where(F.coalesce(fit, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v")).distinct()

    vectors = stage(clean(items), "vectors")
    asked = stage(clean(queries), "queries")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    wide = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    width = max(size["w"] or 0, wide["w"] or 0, 1)
    shards, blocks = max(1, math.ceil(size["n"] / SHARD_ROWS)), max(1, math.ceil(wide["n"] / BLOCK_ROWS))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(blocks)).cast("int")
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    placed = vectors.withColumn("shard", shard)
    asked = asked.withColumn("block", block).withColumn("home", home)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        if not len(left) or not len(right):
            return out
        tree = BallTree(left["id"].to_numpy(), as_matrix(left["v"], width))
        rows, ids, scores = tree.search(right["id"].to_numpy(), as_matrix(right["v"], width), k, right["least"].to_numpy())
        return pd.DataFrame({"query_id": right["id"].to_numpy()[rows], "id": ids, "score": scores})

    kinds = "query_id long, id long, score long"

    def best(found):
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    lowest = F.lit(-(1 << 62))
    copies = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    first = copies.where(F.col("shard") == home).groupBy("shard", "block").cogroup(
        asked.select(F.col("home").alias("shard"), "block", "id", "v", lowest.alias("least")).groupBy("shard", "block")).applyInPandas(search, kinds)
    first = stage(first, "home")
    floor = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k).select(F.col("query_id").alias("id"), "s")
    second = asked.join(floor, "id", "left").select("id", "v", "block", "home", F.coalesce("s", lowest).alias("least"))
    second = second.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != home").drop("home")
    rest = copies.where(F.col("shard") != home).groupBy("shard", "block").cogroup(second.groupBy("shard", "block")).applyInPandas(search, kinds)
    out = best(first.unionByName(rest) if shards > 1 else first)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""

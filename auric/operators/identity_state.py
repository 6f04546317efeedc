"""Identity resolution delivery by delivery.

The state is two published tables: ``labels`` (node, component), and
``anchors`` (via, chave, ancora) with one member of every key group seen. A
delivery links its own rows to the anchors of their keys, so components are
computed over edges of the delivery only, between the labels that their ends
have by then. Stored rows are read by two narrow joins with the delivery and
rewritten with the labels that merged; earlier links are never walked again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.operators import identity
from auric.operators.joins import bounded, join_dim
from auric.session import stage
from auric.sources.store import TableStore, duplicates

KEY = ["via", "chave"]


class IdentityState:
    """The components of all records delivered so far, under ``root``.

    ``labels()`` equals ``identity.resolve`` over all deliveries together: a component is named by its smallest id.
    A link once seen stays, also if a record comes again with other keys; taking links back demands a full run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, TableStore(spark, root)

    def labels(self) -> DataFrame:
        """(node, component) of the last published delivery."""
        return self.store.read("labels")

    def _stored(self, kind: str) -> tuple[DataFrame, DataFrame]:
        if self.store.current() is not None:
            return self.store.read("labels"), self.store.read("anchors")
        empty = self.spark.createDataFrame
        return empty([], f"node {kind}, component {kind}"), empty([], f"via string, chave string, ancora {kind}")

    def deliver(self, run_id: str, rows: DataFrame, id_col: str, key_cols: dict[str, str]) -> dict:
        """Add the records of ``rows`` and return the commit, with the numbers of new ids and of labels replaced.

        ``key_cols`` is reason -> column. Null ids are left out; null and blank keys link nothing; an id may come any
        number of times, in one delivery or several. An empty delivery publishes the state as it was. Refused, with
        the state unchanged, if another delivery is published meanwhile; one that dies on the way is delivered again."""
        draft = self.store.draft(run_id)
        labels, anchors = self._stored(rows.schema[id_col].dataType.simpleString())
        keys = F.array(*[F.struct(F.lit(via).alias("via"), F.col(c).cast("string").alias("chave")) for via, c in key_cols.items()])
        keyed = stage(rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("node"), F.explode(keys).alias("k"))
                      .select("node", "k.via", "k.chave"), "keyed")
        links = keyed.where("trim(chave) <> ''")
        groups = stage(links.groupBy(*KEY).agg(F.min("node").alias("first")), "groups")
        known = stage(join_dim(anchors, groups, KEY).select(*KEY, "first", "ancora"), "known")

        ids = keyed.select("node").distinct()
        ends = ids.unionByName(known.select(F.col("ancora").alias("node"))).distinct()
        before = stage(join_dim(labels, stage(ends, "ends"), "node"), "before")  # labels of what the delivery touches
        fresh = stage(ids.join(before, "node", "left_anti").select("node", F.col("node").alias("component")), "fresh")

        edges = links.join(bounded(groups), KEY).select(F.col("node").alias("src"), F.col("first").alias("dst")) \
            .unionByName(known.select(F.col("first").alias("src"), F.col("ancora").alias("dst")))
        now = before.unionByName(fresh)
        for end in ("src", "dst"):
            at = now.select(F.col("node").alias(end), F.col("component").alias("label"))
            edges = join_dim(edges, at, end).drop(end).withColumnRenamed("label", end)
        merged = identity.connected_components(self.spark, edges.where("src <> dst").distinct())
        merged = stage(merged.where("node <> component").select(F.col("node").alias("component"), F.col("component").alias("into")), "merged")

        draft.add("labels", join_dim(labels.unionByName(fresh), merged, "component", "left")
                  .select("node", F.coalesce("into", "component").alias("component")))
        draft.add("anchors", anchors.unionByName(
            groups.join(known, KEY, "left_anti").select(*KEY, F.col("first").alias("ancora"))))
        draft.check_all({"label per id": lambda d: duplicates(d.read("labels"), "node"),
                         "anchor per key": lambda d: duplicates(d.read("anchors"), *KEY)})
        return self.store.publish(draft, novos=fresh.count(), fundidas=merged.count())

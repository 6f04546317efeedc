"""Forward as-of match: the next event of a key after a moment.

Moments and events are put in one order by key and time, cut into ranges
(so that a key with many rows is spread over several tasks), and each row
takes the next event of its key within its range. A range's last key may go
on in later ranges; the first event there is carried back by a table with
one row per range. No pairs of moments and events are ever made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.session import stage


def next_event(moments: DataFrame, events: DataFrame, key: list[str], at: str, event_at: str, name: str) -> DataFrame:
    """``moments`` with ``name`` = the earliest ``event_at`` of ``events`` with the same key that is later than ``at``,
    or null. Rows with a null in the key or the time match nothing; repeated rows are answered alike."""
    extra = [c for c in moments.columns if c not in key]
    none = F.lit(None)
    asked = moments.select(*key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*extra).alias("_row"))
    kind = dict(asked.dtypes)["_row"]
    # at equal times events stand first, so that what follows a moment is later
    told = events.select(*key, F.col(event_at).alias("_t"), F.lit(0).alias("_kind"), none.cast(kind).alias("_row")).dropna(subset=[*key, "_t"])
    order = [*key, "_t", "_kind"]
    rows = asked.unionByName(told).withColumn("_salt", F.rand(1)).repartitionByRange(*order, "_salt").drop("_salt")
    rows = stage(rows.withColumn("_range", F.spark_partition_id()), "asof")

    ahead = Window.partitionBy("_range", *key).orderBy("_t", "_kind").rowsBetween(1, Window.unboundedFollowing)
    event = F.when(F.col("_kind") == 0, F.col("_t"))
    near = rows.withColumn("_next", F.first(event, ignorenulls=True).over(ahead)).where("_kind = 1")

    k = F.struct(*key)
    edges = stage(rows.groupBy("_range").agg(F.min(k).alias("first"), F.max(k).alias("last")), "edges")  # a row per range
    begins = F.broadcast(edges.select("_range", F.col("first").alias("k")))
    opening = rows.where("_kind = 0").withColumn("k", k).join(begins, ["_range", "k"]).groupBy("_range", "k").agg(F.min("_t").alias("_t"))
    opening = stage(opening, "opening").select(F.col("_range").alias("_later"), "k", "_t")
    carry = edges.join(F.broadcast(opening), (F.col("last") == F.col("k")) & (F.col("_later") > F.col("_range"))).groupBy("_range", "last").agg(F.min("_t").alias("_carried"))
    out = near.withColumn("last", k).join(F.broadcast(carry), ["_range", "last"], "left")
    found = F.when(F.col("_t").isNotNull() & ~_any_null(key), F.coalesce("_next", "_carried"))
    return out.select(*key, *[F.col("_row")[c].alias(c) for c in extra], found.alias(name)).select(*moments.columns, name)


def _any_null(key: list[str]):
    cond = F.lit(False)
    for c in key:
        cond = cond | F.col(c).isNull()
    return cond

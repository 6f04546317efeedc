"""Survivorship: identical copies, versions of one key, first-seen winners.

The classifiers' rows are dealt by their key once, and "first/last row per
key" is read off each group where it lies: the rows cross the network a
single time, with the columns that are asked for, and are parsed a single
time. Rejected rows take no part; they are dealt one by one, as their keys
may be null or all alike. Where only the winners are asked for, they are
computed with a partial-aggregating ``min``/``max`` over an ordering struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.operators.joins import delivered_bytes as estimated_bytes  # a join would spoil the plain estimate

#: Of the compressed files of a delivery, which grow some fourteen times in a sort.
PARTITION_BYTES = 8 * 1024 * 1024
#: An estimate that asks for more is none.
MAX_PARTITIONS = 100_000


def mark_first(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds ``{name}`` = the smallest ``struct(order)`` of the row's key group
    and ``{name}_is_me`` = whether this row is that first row."""
    o = F.struct(*order)
    firsts = df.groupBy(*keys).agg(F.min(o).alias(name))
    return df.join(firsts, keys, "left").withColumn(f"{name}_is_me", o == F.col(name))


def partitions_for(rows: DataFrame) -> int:
    """How many partitions the rows of ``rows`` (with corrections joined to them or not) are dealt to, so that a task sorts
    about 100 MB whatever the size of the table; 0 where the session's own number is enough."""
    wanted = estimated_bytes(rows) // PARTITION_BYTES + 1
    return wanted if int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) < wanted <= MAX_PARTITIONS else 0


def dealt_by_key(df: DataFrame, keys: list[str], partitions: int = 0) -> tuple[DataFrame, list[str]]:
    """``df`` shuffled by ``keys``, to so many ``partitions`` if they are given, with ``_ok`` (accepted: ``falha`` NULL and
    no key NULL), and the columns that make up a group: an accepted row's keys; a rejected row is as good as a group of
    its own."""
    ok = F.col("falha").isNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    df = df.withColumn("_ok", ok).withColumn("_alone", F.when(~F.col("_ok"), F.xxhash64("_origem", "_linha")))
    group = [*keys, "_alone"]
    return (df.repartition(partitions, *group) if partitions else df.repartition(*group)), group


def classify_copies_and_versions(df: DataFrame, keys: list[str], copy_order: list[Column],
                                 version_order: list[Column], partitions: int = 0) -> DataFrame:
    """Among accepted rows (``falha`` NULL): an identical copy (same key and
    content hash) after the first one is a duplicate; among the remaining,
    the version winning ``version_order`` survives, a loser from the same
    file is a version conflict and a loser from another file is silently
    superseded. Rejected rows pass through untouched.

    Adds: ``copia_de`` (struct of the first copy), ``vencedor`` (struct of
    the winning version), ``e_copia``, ``superado``, ``conflito``."""
    df, group = dealt_by_key(df, keys, partitions)
    ok, c, o = F.col("_ok"), F.struct(*copy_order), F.struct(*version_order)
    df = df.withColumn("copia_de", F.min(F.when(ok, c)).over(Window.partitionBy(*group, "_hash")))
    df = df.withColumn("e_copia", F.when(ok, c != F.col("copia_de")))
    df = df.withColumn("vencedor", F.max(F.when(~F.col("e_copia"), o)).over(Window.partitionBy(*group)))
    loser = ~F.col("e_copia") & (o != F.col("vencedor"))
    return df.withColumn("superado", F.when(ok, loser & (F.col("_origem") != F.col("vencedor._origem")))) \
             .withColumn("conflito", F.when(ok, loser & (F.col("_origem") == F.col("vencedor._origem")))).drop("_ok", "_alone")


def first_by_business_key(df: DataFrame, keys: list[str], order: list[Column], partitions: int = 0) -> DataFrame:
    """Events/comments/recommendations: among accepted rows the first
    occurrence of a business key survives; a later one with the same content
    hash is a duplicate, with other content a version conflict.

    Adds ``primeiro`` (struct of the first row, including its hash),
    ``e_copia`` and ``conflito``."""
    names = df.select(*order, "_hash").columns
    df, group = dealt_by_key(df, keys, partitions)
    ranked = Window.partitionBy(*group).orderBy(*order, "_hash")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the first row's fields are read off one by one: a struct of them would be sorted with every row
    fields = {f"_first_{n}": F.first(c).over(whole) for n, c in zip(names, [*order, F.col("_hash")])}
    df = df.withColumns({"_rank": F.rank().over(ranked), **fields})
    later, same = F.when(F.col("_ok"), F.col("_rank") > 1), F.when(F.col("_ok"), F.col("_hash") == F.col("_first__hash"))
    return df.withColumn("primeiro", F.when(F.col("_ok"), F.struct(*[F.col(f"_first_{n}").alias(n) for n in names]))) \
             .withColumn("e_copia", later & same).withColumn("conflito", later & ~same).drop("_ok", "_alone", "_rank", *fields)


def canonical_spelling(df: DataFrame, key: Column, value: str, order: list[Column]) -> DataFrame:
    """First spelling per comparison key (``min_by`` over the order), joined
    back as ``{value}_canonica``; the set of keys is small relative to rows
    but is still joined without assuming a size bound."""
    k = df.withColumn("_ck", key)
    firsts = k.where(F.col("_ck").isNotNull()).groupBy("_ck").agg(
        F.min_by(F.col(value), F.struct(*order)).alias(f"{value}_canonica"))
    return k.join(firsts, "_ck", "left").drop("_ck")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The winning row per key (``max_by`` over a struct of all columns):
    a DISTINCT ON without a sort of each key group."""
    cols = [c for c in df.columns if c not in keys]
    w = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_w"))
    return w.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in cols])

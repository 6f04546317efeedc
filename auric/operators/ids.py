"""Dense numbers and stable surrogate ids without a single task for all rows.

Rows are range-partitioned and sorted side by side; a row's number is its
place in its range plus the sizes of the ranges before it (one row per range
reaches the driver). Known keys keep their ids, new keys follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.session import stage


def number_rows(rows: DataFrame, order: list[str | Column], name: str, start: int | Column = 1) -> DataFrame:
    """``rows`` with ``name`` = start, start + 1, ... in ``order``; equal rows are numbered in some order."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    cur = rows.withColumn("_salt", F.rand(1)).repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
    cur = stage(cur.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)  # the upper bits are the partition, the lower ones the place in it
    before, begin = 0, []
    for r in cur.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect():
        begin.append((r["_part"], before))
        before += r["n"]
    firsts = F.broadcast(rows.sparkSession.createDataFrame(begin, "_part long, _before long"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    start = F.lit(start) if isinstance(start, int) else start
    return cur.withColumn("_part", part).join(firsts, "_part").withColumn(name, (F.col("_before") + place + start).cast("long")).drop("_part", "_before", "_at")


def assign_ids(known: DataFrame, rows: DataFrame, key: list[str], id_col: str, highest: int) -> DataFrame:
    """(key, id) of every key of ``rows``: that of ``known`` where it has one, else the next after ``highest`` in the
    order of the keys. Rows with a null in their key have none and are left out."""
    wanted = rows.select(*key).distinct().dropna(subset=key)
    old = wanted.join(known.select(*key, id_col), key)
    new = number_rows(wanted.join(known.select(*key), key, "left_anti"), list(key), id_col, highest + 1)
    return old.unionByName(new)

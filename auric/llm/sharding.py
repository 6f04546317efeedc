"""Shards of equal bytes by histogram sort.

Rows are ordered by a hash of the text, so equal texts stand together, then by
a hash of the id, then by the row's number. Splitters of that order are found
without sorting: every pass counts the exact bytes and rows below candidate
boundaries over all partitions and puts new candidates into the interval that
holds a splitter, until it is within tolerance. Then the rows are exchanged
once, by the range they fall into.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.session import stage

#: New candidates per splitter and pass.
PROBES = 24
#: Part of a shard's bytes by which a splitter may miss its place; ranges within a shard need less care.
TOLERANCE, RANGE_TOLERANCE = 0.01, 0.2
#: A shard is exchanged in ranges of about so many bytes, at least and at most so many ranges.
RANGE_BYTES, LEAST_RANGES, MOST_RANGES = 128 << 20, 8, 512
KEY_BITS = 192
#: A shard's end within a group of equal texts moves to the group's nearer edge if the group is at most this part of a shard.
WHOLE_GROUP = 1 / 8


def key_bytes(batch) -> np.ndarray:
    """24-byte keys whose byte order is the order of (h, t, n)."""
    parts = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "t", "n")]
    flipped = [p.view(np.uint64) ^ np.uint64(1 << 63) for p in parts]
    return np.ascontiguousarray(np.stack(flipped, 1).astype(">u8")).view("S24").ravel()


def as_keys(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(24, "big") for k in keys], "S24")


def count_below(keyed: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int]]:
    """For the interval up to each probe, and last for the one above all: exact bytes and rows below its end over all
    partitions, and the least and greatest key that its rows can have."""
    edges = keyed.sparkSession.sparkContext.broadcast(as_keys(probes))
    parts = ("h", "t", "n")
    least, most = np.iinfo(np.int64).max, np.iinfo(np.int64).min

    def scan(batches):
        n = len(edges.value) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low, high = np.full((3, n), least), np.full((3, n), most)
        for batch in batches:
            at = np.searchsorted(edges.value, key_bytes(batch), "right")  # the probes at or below the key
            np.add.at(size, at, batch.column("size").to_numpy())
            rows += np.bincount(at, minlength=n)
            for k, c in enumerate(parts):
                np.minimum.at(low[k], at, batch.column(c).to_numpy())
                np.maximum.at(high[k], at, batch.column(c).to_numpy())
        some = np.flatnonzero(rows)
        cols = [some, size[some], rows[some], *low[:, some], *high[:, some]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=names)

    names = ["at", "size", "rows", *[f"low_{c}" for c in parts], *[f"high_{c}" for c in parts]]
    found = (keyed.select(*parts, "size").mapInArrow(scan, ", ".join(f"{c} long" for c in names)).groupBy("at")
             .agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"), *[F.min(f"low_{c}").alias(f"low_{c}") for c in parts],
                  *[F.max(f"high_{c}").alias(f"high_{c}") for c in parts]).collect())
    by = {r["at"]: r for r in found}
    out, size, rows = [], 0, 0
    for k in range(len(probes) + 1):
        low, high = 0, 1 << KEY_BITS
        if r := by.get(k):
            size, rows = size + r["size"], rows + r["rows"]
            low, high, bits = 0, 0, KEY_BITS
            for c in parts:  # later parts narrow the keys where earlier ones are equal
                a, b, bits = r[f"low_{c}"] + (1 << 63), r[f"high_{c}"] + (1 << 63), bits - 64
                low, high = low + (a << bits), high + (b << bits)
                if a != b:
                    break
            high += 1 << bits
        out.append((size, rows, low, high))
    return out


@dataclass
class Splitter:
    target: int
    slack: float
    low: tuple = (0, 0, 0)  # key, bytes and rows below it
    high: tuple = (0, 0, 0)

    def best(self) -> tuple:
        return min((self.low, self.high), key=lambda x: (abs(x[1] - self.target), x[0]))

    def settled(self) -> bool:
        near = abs(self.best()[1] - self.target)
        return near <= self.slack or self.high[2] - self.low[2] <= 1 or self.high[0] - self.low[0] <= 1

    def probes(self) -> list[int]:
        low, high = self.low[0], self.high[0]
        unit = next((u for u in (1 << 128, 1 << 64, 1) if high // u - low // u > 1), 1)  # between texts, ids, rows
        steps = min(PROBES, high // unit - low // unit - (0 if high % unit else 1))
        width = high // unit - low // unit
        return [low, high, *[(low // unit + max(1, width * k // (steps + 1))) * unit for k in range(1, steps + 1)]]


def find_splitters(keyed: DataFrame, shards: int, ranges: int, total: int, rows: int, tolerance: float) -> list[tuple]:
    """(key, bytes below, rows below) of the shards * ranges - 1 inner splitters."""
    share = total / shards
    top = (1 << KEY_BITS, total, rows)
    todo = [Splitter(round(share * k / ranges), share * tolerance if k % ranges == 0 else share / ranges * RANGE_TOLERANCE, high=top)
            for k in range(1, shards * ranges)]
    while True:
        probes = sorted({p for s in todo if not s.settled() for p in s.probes()} - {0, 1 << KEY_BITS})
        if not probes:
            return [s.best() for s in todo]
        known = count_below(keyed, probes)
        sums = np.array([x[0] for x in known[:-1]])
        for s in todo:
            k = int(np.searchsorted(sums, s.target, "right"))  # the interval of the splitter
            if k:
                s.low = max(s.low, (probes[k - 1], *known[k - 1][:2]), key=lambda x: x[0])
            if k < len(probes):
                s.high = min(s.high, (probes[k], *known[k][:2]), key=lambda x: x[0])
            if (known[k - 1][1] if k else 0) == s.low[2] and known[k][1] == s.high[2]:  # the same rows
                s.low = (max(s.low[0], known[k][2]), *s.low[1:])
                s.high = (min(s.high[0], known[k][3]), *s.high[1:])


def at_group_edges(keyed: DataFrame, ends: list[tuple], shards: int, ranges: int, total: int) -> list[tuple]:
    """``ends`` with shard ends moved out of groups of equal texts that are small enough to stay whole. The bytes up to
    the edges of the groups at shard ends are counted in one pass."""
    group = 1 << (KEY_BITS - 64)
    at = range(ranges - 1, len(ends), ranges)
    edges = sorted({e for k in at for e in (ends[k][0] // group * group, (ends[k][0] // group + 1) * group)} - {0, 1 << KEY_BITS})
    if not edges:
        return ends
    known = {0: (0, 0), **{e: x[:2] for e, x in zip(edges, count_below(keyed, edges))}}
    out = list(ends)
    for k in at:
        low = out[k][0] // group * group
        begin, end = known.get(low), known.get(low + group)
        if begin and end and end[0] - begin[0] <= WHOLE_GROUP * total / shards:
            target = total * (k + 1) / (shards * ranges)
            out[k] = (low, *begin) if abs(begin[0] - target) <= abs(end[0] - target) else (low + group, *end)
    bounds = [(0, 0, 0), *[out[k] for k in at], (1 << KEY_BITS, total, out[-1][2] if out else 0)]
    for k in range(len(out)):  # the ranges within a shard end where it ends
        if (k + 1) % ranges:
            s = k // ranges
            if not bounds[s][0] <= out[k][0] <= bounds[s + 1][0]:
                out[k] = min(max(out[k], bounds[s], key=lambda x: x[0]), bounds[s + 1], key=lambda x: x[0])
    return out


def shard_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
               tolerance: float = TOLERANCE, keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default ``id_col``; size, text_crc32, law, shard, slot, grown_shard) for every row.

    Size is the text's UTF-8 bytes plus 8; shards get equal sums of sizes up to ``tolerance`` of a shard, or up to
    the one row a splitter falls into. Equal texts share a shard if they have at most ``WHOLE_GROUP`` of a shard's bytes,
    half of which a shard's end may move for it; a larger group that a shard's end falls into is split there by id, rows
    repeated as a whole by their place. A null text has no
    bytes (size 8, CRC of the empty string); null ids are ordered like a value of their own. ``slot`` counts a shard's
    rows from 0. An empty table gives no rows. Other columns, whatever their names, do not matter.

    The rows with their keys are written once to the shared folder, since all passes must see the same row numbers.
    Only counts per candidate reach the driver, and their number depends on the parameters, not on the rows."""
    keep = keep or [id_col]
    names = [f"c{k}" for k in range(len(keep))]
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    keyed = stage(docs.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names)],
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.xxhash64(F.lit(7), text).alias("h"), F.xxhash64(F.lit(11), F.col(id_col).cast("string")).alias("t"),
        F.monotonically_increasing_id().alias("n")), "shards")
    sums = keyed.agg(F.sum("size").alias("size"), F.count("*").alias("rows")).first()
    total, rows = sums["size"] or 0, sums["rows"]
    ranges = max(LEAST_RANGES, min(MOST_RANGES, -(-total // (shards * RANGE_BYTES))))
    ends = at_group_edges(keyed, find_splitters(keyed, shards, ranges, total, rows, tolerance), shards, ranges, total) if rows else []
    below = [0, *[x[2] for x in ends]]
    for k in range(1, len(below)):  # an empty range begins where the one before ends
        below[k] = max(below[k], below[k - 1])
    offset = [below[k] - below[k // ranges * ranges] for k in range(len(below))]
    edges = docs.sparkSession.sparkContext.broadcast((as_keys([x[0] if x[0] < 1 << KEY_BITS else (1 << KEY_BITS) - 1 for x in ends]), np.array(offset, np.int64)))
    carried = [f.name for f in keyed.schema.fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)

    def place(batches):
        splitters, first = edges.value
        for batch in batches:
            part = np.searchsorted(splitters, key_bytes(batch), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32()), pa.array(first[part])], names=[*carried, "part", "first"])

    w = Window.partitionBy("part").orderBy("h", "t", "n")
    placed = keyed.mapInArrow(place, f"{kinds}, part int, first long")
    return placed.withColumn("slot", F.col("first") + F.row_number().over(w) - 1).select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.floor(F.col("part") / ranges).cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))

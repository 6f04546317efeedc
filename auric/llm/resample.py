"""Importance resampling towards the distribution of a target text set.

Features are runs of one and two words, counted in hashed buckets over all
documents and over the target. A batch's feature occurrences are interned in
an open-addressed numpy table under xxhash64 keys with the bytes compared;
a slot stores its feature's bucket and count, so the bucket is computed once
per distinct feature and occurrences gather their gains by slot. Documents
are drawn without replacement by the largest weight plus Gumbel noise.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import bounded_batches, flat, lower_az, shared, slices, word_spans
from auric.llm.decontaminate import word_bytes
from auric.llm.intern import intern, joined, xxhash64
from auric.session import stage

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Words interned at a time; a longer text is counted in several parts.
BLOCK_WORDS = 1 << 16
SLICE = 1 << 20


class Table:
    """The features of a block of words: slots with bucket and count, and the slot of each occurrence."""

    def __init__(self, buf, start, size, buckets):
        self.slot, holder = intern(buf, start, size, xxhash64(buf, start, size))
        self.used = np.flatnonzero(holder >= 0)
        whole = memoryview(buf)
        first = holder[self.used]
        codes = [zlib.crc32(whole[a:a + n]) % buckets for a, n in zip(start[first].tolist(), size[first].tolist())]
        self.bucket = np.zeros(len(holder), np.int64)
        self.bucket[self.used] = codes
        self.count = np.bincount(self.slot, minlength=len(holder))


def blocks(texts, buckets: int):
    """(words of each text, iterator of (table, text of each occurrence)) for a string array."""
    data, offsets = flat(texts)
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    words = np.diff(first)

    def tables():
        text = np.repeat(np.arange(len(words)), words)
        for a in range(0, len(start), BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, len(start))
            c = min(b + 1, len(start))  # the pair that begins with the last word
            buf, s, e = joined(data, start[a:c], end[a:c])
            pair = np.flatnonzero(text[a:c - 1] == text[a + 1:c])
            yield (Table(buf, np.concatenate([s[:b - a], s[pair]]), np.concatenate([(e - s)[:b - a], e[pair + 1] - s[pair]]), buckets),
                   np.concatenate([text[a:b], text[a:c - 1][pair]]))

    return words, tables()


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often features of each bucket occur in all texts; a task sends at most one row a bucket."""

    def scan(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole, "txt", SLICE):
                for table, _ in blocks(batch.column("txt"), buckets)[1]:
                    np.add.at(total, table.bucket[table.used], table.count[table.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = docs.select(F.col(text_col).alias("txt")).mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds: the floored thousandfold log ratio of smoothed shares."""
    buckets, s_all, t_all = len(all_counts), int(all_counts.sum()), int(target_counts.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
                     for s, t in zip(all_counts.tolist(), target_counts.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of each row: the floored mean gain of its features, 0 without any."""
    known = shared(docs.sparkSession, gain)

    def scan(batches):
        gain = known()
        for whole in batches:
            for batch in slices(whole, "txt", SLICE):
                words, tables = blocks(batch.column("txt"), len(gain))
                total = np.zeros(len(words), np.int64)
                for table, text in tables:
                    per_slot = gain[table.bucket]
                    np.add.at(total, text, per_slot[table.slot])
                n = words + np.maximum(words - 1, 0)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words), pa.array(n), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    cur = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    kind = cur.schema["id"].dataType.simpleString()
    return cur.mapInArrow(scan, f"id {kind}, n_words long, n_features long, weight long")


def numbered(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in ``order``, without one task for all: ranges are sorted side by side, and
    each range's numbers begin after the rows of the ranges before it. Equal rows are dealt over ranges by a salt."""
    salt = F.rand(SEED).alias("salt")
    cur = rows.select("*", salt).repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt")
    cur = stage(cur.drop("salt").withColumn("at", F.monotonically_increasing_id()), "numbered")
    place = F.shiftright("at", 33)
    sizes = cur.groupBy(place.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per partition
    begin, before = [], 0
    for r in sizes:
        begin.append((r["part"], before))
        before += r["n"]
    firsts = F.broadcast(rows.sparkSession.createDataFrame(begin, "part long, before long"))
    out = cur.withColumn("part", place.cast("long")).join(firsts, "part")
    return out.withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("part", "before", "at")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_features, weight, score, rank) of each row of ``docs``: of those with ``min_words`` words ``percent`` in
    a hundred are drawn, by descending score, ties to the smaller id; the others have a null rank.

    Null and empty texts have no features and weight 0. A null id has no noise, so its score is null and it is neither
    drawn nor counted. Repeated rows are rows of their own, with ranks next to each other. An empty table gives no
    rows, an empty target is a uniform one; other columns do not matter."""
    bounded_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    rows = stage(weigh(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise), "weights")
    able = (F.col("n_words") >= min_words) & F.col("id").isNotNull()
    drawn = rows.where(able).count() * percent // 100
    first = numbered(rows.where(able), F.col("score").desc(), F.col("id"))
    first = first.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


#: DuckDB has no crc32: its table of 256 remainders follows from the polynomial, its steps are a fold over the bytes.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS k, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE step = 8),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
worded AS (
  SELECT side, rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM texts),
occ AS (
  SELECT side, rid, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM worded),
feats AS (SELECT side, rid, f, count(*) AS n FROM occ GROUP BY ALL),
codes AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(f)) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i::INT - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM feats), crc),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM feats JOIN codes USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS g FROM sums),
weights AS (
  SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n))::BIGINT AS weight
  FROM feats JOIN codes USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (
  SELECT w.doc_id, len(w.ws) AS n_words, coalesce(x.n_features, 0) AS n_features, coalesce(x.weight, 0) AS weight,
    coalesce(x.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded w LEFT JOIN weights x USING (rid) WHERE w.side = 'd'),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 25 // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

"""Benchmark decontamination by Wu-Manber search over words.

The test strings are the ``window``-word passages of the benchmark items (an
item with fewer words is one string of its own length). Symbols are words: a
table over blocks of two words tells how far the search may jump before a
string could end, most positions are jumped over, a block that ends a string
leads to the bucket of strings with that suffix, and the words' bytes are
compared directly before an occurrence counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, flat, lower_az, mix, shared, slices, word_spans

WINDOW = 10
#: Bytes of benchmark text compiled (and broadcast) at a time; a larger benchmark is searched block after block.
BLOCK_BYTES = 32 << 20
BLOCK_MULT = np.uint64(0xD6E8FEB86659FD93)
LANE = 256


def word_bytes() -> np.ndarray:
    """Table of the bytes that words consist of: digits, letters and every byte of a non-ASCII character."""
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


class Strings:
    """The strings of one length: shift table over blocks, suffix buckets, and the strings themselves."""

    def __init__(self, length: int, hashes: np.ndarray, texts: list, items: list):
        self.length, self.block = length, min(2, length)
        self.texts, self.items = texts, items
        bits = min(22, max(10, math.ceil(math.log2(len(texts) * length + 1)) + 4))
        self.slot_shift = np.uint64(64 - bits)
        self.jump = np.full(1 << bits, length - self.block + 1, np.int16)
        for end in range(self.block - 1, length):
            slot = self.blocks(hashes, np.full(len(hashes), end), np.arange(len(hashes))) >> self.slot_shift
            np.minimum.at(self.jump, slot.astype(np.int64), length - 1 - end)
        suffix = self.blocks(hashes, np.full(len(hashes), length - 1), np.arange(len(hashes)))
        whole = self.whole(hashes, np.full(len(hashes), length - 1), np.arange(len(hashes)))
        key = self.key(suffix, whole)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def blocks(self, words: np.ndarray, end: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        at = (lambda k: words[k]) if row is None else (lambda k: words[row, k])
        return at(end) if self.block == 1 else mix(at(end - 1) * BLOCK_MULT + at(end))

    def whole(self, words: np.ndarray, end: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        at = (lambda k: words[k]) if row is None else (lambda k: words[row, k])
        out = np.zeros(len(end), np.uint64)
        for back in range(self.length - 1, -1, -1):
            out = out * BLOCK_MULT + at(end - back)
        return mix(out)

    def key(self, suffix: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Order of the strings: by suffix bucket, and by a hash of the whole string within it."""
        return (suffix >> np.uint64(40) << np.uint64(40)) | (whole >> np.uint64(24))

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Positions of words at which a block ends that also ends a string."""
        n, last = len(words), self.length - 1
        pos = np.arange(last, n, LANE)
        stop = np.minimum(pos + LANE, n)
        found = []
        while len(pos):
            step = self.jump[(self.blocks(words, pos) >> self.slot_shift).astype(np.int64)]
            found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def occurrences(self, words: np.ndarray, doc: np.ndarray, text_of) -> list:
        """(first word, last word, string number) of every confirmed occurrence within one text."""
        end = self.candidates(words)
        end = end[doc[end - self.length + 1] == doc[end]]
        if not len(end):
            return []
        key = self.key(self.blocks(words, end), self.whole(words, end))
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        out = []
        for e, a, b in zip(end[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            first = e - self.length + 1
            text = text_of(first, e)
            out += [(first, e, int(k)) for k in self.order[a:b] if self.texts[k] == text]
        return out


def compile_strings(items: list, window: int = WINDOW) -> list[Strings]:
    """``Strings`` by length for (item_id or None, text or None) pairs; equal strings of several items are one."""
    data, offsets = flat(pa.array([t or "" for _, t in items], pa.string()))
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    hasher = SpanHasher()
    words = hasher.spans(hasher.sums(data), start, end)
    raw = data.tobytes()
    own = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
    by: dict = {}
    for k, (item, _) in enumerate(items):
        a, b = int(first[k]), int(first[k + 1])
        length = min(window, b - a)
        for at in range(a, b - length + 1) if length else ():
            row = by.setdefault(length, {}).setdefault(b" ".join(own[at: at + length]), (words[at: at + length], set()))
            if item is not None:
                row[1].add(str(item))
    return [Strings(n, np.array([h for h, _ in rows.values()], np.uint64).reshape(len(rows), n), list(rows), [s for _, s in rows.values()]) for n, rows in by.items()]


def search(data: np.ndarray, offsets: np.ndarray, tables: list[Strings], hasher: SpanHasher) -> tuple[np.ndarray, list, list]:
    """Per text: number of words, hit spans as (first, last) word positions, and ids of the items found."""
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    words = hasher.spans(hasher.sums(data), start, end)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    raw = data.tobytes()

    def text_of(a, b):
        return b" ".join([raw[x:y] for x, y in zip(start[a: b + 1].tolist(), end[a: b + 1].tolist())])

    spans: list = [[] for _ in count]
    items: list = [set() for _ in count]
    for table in tables:
        for a, b, k in table.occurrences(words, doc, text_of):
            spans[doc[a]].append((a - int(first[doc[a]]), b - int(first[doc[a]])))
            items[doc[a]] |= table.items[k]
    return count, spans, items


def merged(spans: list) -> list:
    """The union of closed word spans as disjoint spans in order."""
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default ``id_col``; n_words, spans, items) for each row of ``docs``.

    ``spans`` are disjoint runs of word positions (from 0) inside occurrences of benchmark strings, ``items`` the
    sorted distinct ids of the items that have one. Words are lower-cased in A-Z and consist of ASCII letters,
    digits and all non-ASCII characters. A null or empty text has no words and no hits. Rows of ``docs`` are
    answered one by one, so repeated rows and null ids give a row each. Items without words match nothing; item
    rows with one id are one item; an item without an id marks words but is not listed. Empty tables give no hits
    or no rows. Other columns, whatever their names, do not matter.

    The strings are compiled on the driver from blocks of at most ``block_bytes`` of item text and broadcast; a
    larger benchmark takes several blocks, searched one after the other over the same rows without a shuffle.
    """
    spark = docs.sparkSession
    keep = keep or [id_col]
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("txt"))
    total = bench.agg(F.sum(F.octet_length("txt"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    schema = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"
    names = [f"c{k}" for k in range(len(keep))]
    cur = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("txt"),
                      F.lit(0).cast("long").alias("n_words"),
                      F.expr("cast(array() as array<struct<first:long,last:long>>)").alias("spans"),
                      F.expr("cast(array() as array<string>)").alias("items"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cur.schema.fields[: len(names) + 1])
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "txt"), F.lit(blocks)) == k)
        tables = shared(spark, compile_strings([(r.item, r.txt) for r in part.collect()], window))

        def scan(batches, tables=tables):
            hasher, known = SpanHasher(), tables()
            for whole in batches:
                for batch in slices(whole, "txt"):
                    data, offsets = flat(batch.column("txt"))
                    count, spans, items = search(data, offsets, known, hasher)
                    before, listed = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                    runs = [merged(s + [(x["first"], x["last"]) for x in p]) if s or p else [] for s, p in zip(spans, before)]
                    cols = [batch.column(c) for c in (*names, "txt")]
                    cols.append(pa.array(count, pa.int64()))
                    cols.append(pa.array([[{"first": a, "last": b} for a, b in r] for r in runs], batch.schema.field("spans").type))
                    cols.append(pa.array([sorted(s | set(p), key=lambda x: x.encode()) for s, p in zip(items, listed)], pa.list_(pa.string())))
                    yield pa.RecordBatch.from_arrays(cols, names=[*names, "txt", "n_words", "spans", "items"])

        cur = cur.mapInArrow(scan, f"{kinds}, {schema}")
        if k + 1 < blocks:
            cur = cur.checkpoint()
    return cur.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "n_words", "spans", "items")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report of ``find_passages``: counts of words hit and items, and a digest of the item list."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    return found.select(id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pats AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
         FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM pats),
wins AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
         FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT wins.doc_id, wins.n, wins.p, pats.item FROM wins JOIN pats ON wins.n = pats.n AND wins.s = pats.s),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

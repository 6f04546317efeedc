"""JSON arrays and CSV files read in many tasks, with exact record positions.

A file is read as text cut at a character (``}`` or a line break), so every
block of it can be read on its own. What a block does to the reader's state
(inside quotes or not, depth of nesting) is summed up once for every state
that it may begin in; the summaries, one row per block, are composed in
order, and a second pass then knows for every block in what state and with
which record it begins. Only records that lie across blocks, or over several
lines, are put together by a shuffle.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, BACKSLASH, NEWLINE = 34, 92, 10


def string_fields(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def text_pieces(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """(file, block, size, value) of the pieces between cuts, in order within a block."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", cut).text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"), "value")


def runs(batches):
    """((file, block, file size), iterator of lists of pieces) for each run of rows of one block."""

    def rows():
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("file", "block", "size", "value")]
            yield from zip(*cols)

    for key, group in itertools.groupby(rows(), key=lambda r: r[:3]):
        yield key, (r[3] for r in group)


def chunks(pieces, most: int = 1 << 20):
    """The pieces in lists of about ``most`` characters."""
    held, size = [], 0
    for p in pieces:
        held.append(p)
        size += len(p)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


# ---------------------------------------------------------------- JSON arrays
def depths(pieces: list[str], quoted: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(depth after each piece relative to the beginning, whether the brace that ends it is outside strings, whether the
    last piece ends inside a string), for pieces that a closing brace follows, from a beginning inside a string or not."""
    data = np.frombuffer(("}".join(pieces) + "}").encode(), np.uint8)
    ends = np.cumsum([len(p.encode()) + 1 for p in pieces]) - 1
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != BACKSLASH, at, -1))  # the last byte that is no backslash
    before = np.concatenate([[-1], other[:-1]])
    escaped = (at - 1 - before) % 2 == 1
    inside = (np.cumsum((data == QUOTE) & ~escaped) + quoted) % 2 == 1
    step = ((data == 123) | (data == 91)).astype(np.int64) - ((data == 125) | (data == 93))
    depth = np.cumsum(np.where(inside, 0, step))
    return depth[ends], ~inside[ends], bool(inside[-1])


def summarise_json(batches):
    for (file, block, size), pieces in runs(batches):
        state = {q: [q, 0, {}, 0] for q in (False, True)}  # inside a string, depth, elements that end by depth, last step
        length, first = 0, None
        for held in chunks(pieces):
            first = held[0] if first is None else first
            length += sum(len(p.encode()) + 1 for p in held)
            for s in state.values():
                depth, real, quoted = depths(held, s[0])
                for d, n in zip(*np.unique(depth[real] + s[1], return_counts=True)):
                    s[2][int(d)] = s[2].get(int(d), 0) + int(n)
                s[0], s[1], s[3] = quoted, s[1] + int(depth[-1]), int(real[-1])
        lead = first.lstrip("﻿ \t\r\n")[:1]
        for q, (quoted, depth, seen, last) in state.items():
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "size": size, "length": length, "lead": lead, "from_q": q, "to_q": quoted, "depth": depth,
                                               "last": last, "at": list(seen), "n": list(seen.values())}], schema=SUMMARY_ARROW)


SUMMARY = "file string, block long, size long, length long, lead string, from_q boolean, to_q boolean, depth long, last long, at array<long>, n array<long>"
SUMMARY_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("length", pa.int64()), ("lead", pa.string()), ("from_q", pa.bool_()),
                           ("to_q", pa.bool_()), ("depth", pa.int64()), ("last", pa.int64()), ("at", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])


def compose_json(rows) -> tuple[dict, list[str]]:
    """((file, block) → state that the block begins in, errors) from the summaries of all blocks."""
    starts, errors, by_file = {}, [], {}
    for r in rows:
        by_file.setdefault(r["file"], {}).setdefault(r["block"], {})[r["from_q"]] = r
    for file, found in by_file.items():
        quoted, depth, done, total, lead, last = False, 0, 0, 0, "", None
        for block in sorted(found):
            r = found[block][quoted]
            lead = lead or r["lead"]
            starts[file, block] = (quoted, depth, done)
            done += sum(n for at, n in zip(r["at"], r["n"]) if at + depth == 1)
            quoted, depth, total, last = r["to_q"], depth + r["depth"], total + r["length"], r
        if last["size"] + 1 - total in (0, 3):  # no brace ends the file (whose reader drops a byte order mark): the last one counted does not exist
            if last["last"]:
                done, depth = done - (depth == 1), depth + 1
        if lead != "[":
            errors.append(f"{file}: not an array")
        elif quoted or depth != 0:
            errors.append(f"{file}: truncated")
    return starts, errors


def split_json(starts: dict):
    """Pass two: (file, n, block, i, text, whole) of elements, those that lie across blocks in fragments."""

    def scan(batches):
        for (file, block, _), pieces in runs(batches):
            quoted, depth, done = starts[file, block]
            out, text, i, inherited = [], [], 0, depth > 1 or quoted
            for held in chunks(pieces):
                d, real, now = depths(held, quoted)
                for piece, after, ok in zip(held, (d + depth).tolist(), real.tolist()):
                    text.append(piece)
                    if ok and after == 1:
                        done += 1
                        out.append((file, done, block, i, "}".join(text) + "}", not inherited))
                        text, inherited, i = [], False, i + 1
                quoted, depth = now, depth + int(d[-1])
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file", "n", "block", "i", "text", "whole"])
                    out = []
            if text:  # goes on in the next block, or is what stands after the last element
                row = [(file, done + 1, block, i, "}".join(text) + "}", False)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*row)], names=["file", "n", "block", "i", "text", "whole"])

    return scan


def joined_fragments(found: DataFrame, sep: str) -> DataFrame:
    """(file, n, text): whole records as they are, fragments joined in order. A record has a fragment per block."""
    parts = found.where("not whole").groupBy("file", "n").agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "i", "text")))["text"], sep).alias("text"))
    return found.where("whole").select("file", "n", "text").unionByName(parts)


def read_json_array(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(_arquivo, _linha, columns as strings) of the objects of JSON-array files, ``_linha`` from 1 in each file.

    A file that is no array (an object, or nothing at all) or that ends too early is an error before any row is read; so
    is, when it is reached, an element that is no object. Files are UTF-8. Nested values come as JSON text, missing fields as null."""
    pieces = text_pieces(spark, path, "}")
    summary = pieces.mapInArrow(summarise_json, SUMMARY).collect()  # two rows a block
    starts, errors = compose_json(summary)
    if errors:
        raise ValueError("; ".join(sorted(errors)))
    found = pieces.mapInArrow(split_json(starts), "file string, n long, block long, i long, text string, whole boolean")
    whole = joined_fragments(found, "")
    body = F.regexp_replace("text", r"\A[\x{FEFF}\s]*[\[,]?\s*", "")
    rows = whole.select("file", "n", body.alias("v")).where(~F.col("v").rlike(r"\A\]\s*\}?\z"))  # not what stands after the last element
    parsed = rows.select("file", "n", F.when(F.col("v").startswith("{"), F.from_json("v", string_fields(columns), {"mode": "FAILFAST"})).otherwise(
        F.raise_error(F.concat(F.lit("not an object: "), F.left("v", F.lit(80))))).alias("r"))
    return parsed.select(F.col("file").alias("_arquivo"), F.col("n").alias("_linha"), "r.*")


# ---------------------------------------------------------------- CSV
def summarise_csv(batches):
    for (file, block, size), pieces in runs(batches):
        quotes, records, first = 0, [0, 0], None
        for p in pieces:
            first = p if first is None else first
            if p.strip():
                records[quotes % 2] += 1  # a record begins here if the block begins outside quotes, or the other way round
            quotes += p.count('"')
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "quotes": quotes % 2, "even": records[0], "odd": records[1], "first": first}])


def split_csv(starts: dict):
    def scan(batches):
        for (file, block, _), pieces in runs(batches):
            quoted, n = starts[file, block]
            held, i, inherited = [], 0, bool(quoted)
            out = []
            for p in pieces:
                if not quoted and not p.strip():
                    continue
                if not quoted:
                    n += 1
                held.append(p)
                quoted = (quoted + p.count('"')) % 2
                if not quoted:
                    out.append((file, n, block, i, "\n".join(held), not inherited))
                    held, inherited, i = [], False, i + 1
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file", "n", "block", "i", "text", "whole"])
                    out = []
            if held:
                out.append((file, n, block, i, "\n".join(held), False))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file", "n", "block", "i", "text", "whole"])

    return scan


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, text) of all records of CSV files, the header as record 1; blank lines outside quotes do not count and
    a line break inside quotes does not end a record. A quote that is never closed is an error."""
    pieces = text_pieces(spark, path, "\n")
    summary = pieces.mapInArrow(summarise_csv, "file string, block long, quotes long, even long, odd long, first string").collect()  # a row a block
    starts, quoted, n, before = {}, 0, 0, None
    for r in sorted(summary, key=lambda r: (r["file"], r["block"])):
        if r["file"] != before:
            if quoted:
                raise ValueError(f"{before}: a quote is not closed")
            quoted, n, before = 0, 0, r["file"]
        starts[r["file"], r["block"]] = (quoted, n)
        n += r["odd"] if quoted else r["even"]
        quoted = (quoted + r["quotes"]) % 2
    if quoted:
        raise ValueError(f"{before}: a quote is not closed")
    return joined_fragments(pieces.mapInArrow(split_csv(starts), "file string, n long, block long, i long, text string, whole boolean"), "\n")


CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def csv_header(text: str) -> list[str]:
    import csv
    import io

    return next(csv.reader(io.StringIO(text.lstrip("﻿").rstrip("\r"))), [])


def header_report(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(_arquivo, ausentes, a_mais, ordem) of each CSV file: expected columns that its header lacks, columns that it has
    besides, and whether those expected stand in the expected order."""
    rows = []
    for r in csv_records(spark, path).where("n = 1").collect():  # a row per file
        found = csv_header(r["text"])
        rows.append((r["file"], [c for c in columns if c not in found], [c for c in found if c not in columns], [c for c in found if c in columns] == [c for c in columns if c in found]))
    return spark.createDataFrame(rows, "_arquivo string, ausentes array<string>, a_mais array<string>, ordem boolean")


def read_csv_positions(spark: SparkSession, path: str, columns: list[str], positional: bool = False) -> DataFrame:
    """(_arquivo, _linha, columns as strings) of CSV files, ``_linha`` from 1 after the header. Columns are found by the
    header of each file, and a missing one is an error, or taken by position whatever the header says."""
    records = csv_records(spark, path)
    layouts: dict[tuple, list[str]] = {}
    for r in records.where("n = 1").collect():  # a row per file
        names = tuple(columns if positional else csv_header(r["text"]))
        if missing := [c for c in columns if c not in names]:
            raise ValueError(f"{r['file']}: the header lacks {missing}")
        layouts.setdefault(names, []).append(r["file"])
    out = None
    body = F.regexp_replace("text", r"\r\z", "")
    for names, files in layouts.items():  # files of one header at a time
        part = records.where((F.col("n") > 1) & F.col("file").isin(files)).select("file", "n", F.from_csv(body, string_fields(list(names)).simpleString()[7:-1].replace(":", " "), CSV_OPTIONS).alias("r"))
        part = part.select(F.col("file").alias("_arquivo"), (F.col("n") - 1).alias("_linha"), *[F.col("r")[c].alias(c) for c in columns])
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "_arquivo string, _linha long, " + ", ".join(f"{c} string" for c in columns))
    return out

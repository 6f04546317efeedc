"""Exact BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of the last bytes has a given value, so a
passage that stands in many texts is cut into the same chunks wherever it
stands, and a chunk is encoded once for all texts of a task that hold it. At
each join the pieces that the end of the left chunk may have changed are
encoded again together with the first pieces of the right chunk, with more of
it each time, until a piece of the joined text begins where a piece of the
right chunk began: the splitter looks only ahead, so from there on both agree
for certain.
"""

from __future__ import annotations

import json
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, flat, slices
from auric.llm.token_count import Classes, Splitter, byte_letters

#: Bytes under the rolling hash; a cut falls after one byte in CHUNK_BYTES on average.
WINDOW_BYTES, CHUNK_BYTES = 16, 512
#: Entries kept by a worker's tables, and the longest chunk kept; a table that is full is begun anew.
MAX_PIECES, MAX_CHUNKS, MAX_KEPT_BYTES = 400_000, 30_000, 4096


class Chunk:
    """Pieces of a chunk: where each begins, its place in the encoded bytes, and the first that the chunk's end may have changed."""

    __slots__ = ("data", "starts", "at", "ids", "loose")

    def __init__(self, data: bytes, starts: list, encoded: list):
        self.data, self.starts, self.ids = data, array("i", [*starts, len(data)]), b"".join(encoded)
        self.at = array("i", [0, *accumulate(map(len, encoded))])
        self.loose = first_loose(data, self.starts)


def first_loose(data: bytes, starts: list) -> int:
    """The first piece that more text after ``data`` could change: it touches the end, or is a quote (which may begin
    a contraction of three characters) too near to it."""
    k = len(starts) - 1
    while k > 0 and (starts[k] >= len(data) or starts[k - 1] + 3 > len(data)):
        k -= 1
    return k


class Encoder:
    """Encodes and decodes as the tokenizer library does with the same byte-level file."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        library = Tokenizer.from_str(definition)
        self.model, self.split = library.model, library.pre_tokenizer.pre_tokenize_str
        self.letters = {b: c for c, b in byte_letters().items()}
        back = byte_letters()
        self.special = [(t["content"].encode(), np.uint32(t["id"]).tobytes()) for t in spec["added_tokens"] if t["content"]]
        self.token = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in back for c in t)}
        self.token |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.hasher, self.classes, self.splitter = SpanHasher(), Classes(), Splitter()
        self.pieces: dict = {}
        self.chunks: dict = {}
        self.joins: dict = {}

    def piece(self, data: bytes) -> bytes:
        """The token ids of a piece as little-endian 32-bit numbers."""
        if data not in self.pieces:
            text = "".join([self.letters[b] for b in data])
            self.pieces[data] = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        return self.pieces[data]

    def split_all(self, chunks: list) -> list:
        """Piece starts of each chunk taken as a text of its own, for many at once."""
        data = np.frombuffer(b"".join(chunks), np.uint8)
        bounds = np.cumsum([0, *map(len, chunks)])
        place = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        stream = np.insert(self.classes.of(points), np.searchsorted(place, bounds[1:]), 10)
        start = place[self.splitter.begins(stream)[stream != 10]]
        first = np.searchsorted(start, bounds)
        return [(start[a:b] - z).tolist() for a, b, z in zip(first[:-1], first[1:], bounds[:-1])]

    def learn(self, chunks: set) -> None:
        """Encode the chunks that are not known yet."""
        new, known, piece = [c for c in chunks if c not in self.chunks], self.pieces, self.piece
        for data, starts in zip(new, self.split_all(new) if new else ()):
            parts = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
            self.chunks[data] = Chunk(data, starts, [known.get(p) or piece(p) for p in parts])

    def window(self, data: bytes) -> tuple[list, list]:
        """Pieces of a short stretch: starts with the length at the end, and the encoded pieces."""
        starts, out, at = [], [], 0
        for text, _ in self.split(data.decode("utf-8")):  # a letter for each byte
            starts.append(at)
            out.append(self.piece(data[at: at + len(text)]))
            at += len(text)
        return [*starts, at], out

    def join(self, tail: bytes, chunk: Chunk) -> tuple[bytes, int, bytes]:
        """(tokens before the agreement, the chunk's piece from which both agree, new tail). Without agreement in the
        whole chunk the piece number is -1 and the tail is what its end may still change."""
        pieces = len(chunk.starts) - 1
        reach = min(4, pieces)
        while True:
            head = chunk.data[: chunk.starts[reach]]
            key = (tail, head)
            found = self.joins.get(key)
            if found is None:
                text = tail + head
                starts, encoded = self.window(text)
                firm = first_loose(text, starts)
                own = {s: k for k, s in enumerate(chunk.starts[: reach])}
                found = (b"", -1)
                for k in range(firm + 1):
                    if starts[k] >= len(tail) and starts[k] - len(tail) in own and k <= firm:
                        found = (b"".join(encoded[:k]), own[starts[k] - len(tail)])
                        break
                self.joins[key] = found
            if found[1] >= 0:
                return found[0], found[1], b""
            if reach == pieces:
                text = tail + chunk.data
                starts, encoded = self.window(text)
                firm = first_loose(text, starts)
                return b"".join(encoded[:firm]), -1, text[starts[firm]:]
            reach = min(reach * 4, pieces)

    def run(self, chunks: list) -> bytes:
        """Token ids of the text that consists of the chunks."""
        out, tail = [], b""
        for k, data in enumerate(chunks):
            chunk = self.chunks[data]
            j = 0
            if k:
                done, j, rest = self.join(tail, chunk)
                out.append(done)
                if j < 0:
                    tail = rest
                    continue
            last = max(j, chunk.loose)
            if k == len(chunks) - 1:  # the text ends as the chunk does
                out.append(chunk.ids[chunk.at[j]:])
                return b"".join(out)
            out.append(chunk.ids[chunk.at[j]: chunk.at[last]])
            tail = data[chunk.starts[last]:]
        out += self.window(tail)[1]
        return b"".join(out)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Positions after which a chunk begins: by the hash of the bytes before, within a text, between characters."""
        if len(data) <= WINDOW_BYTES:
            return np.zeros(0, np.int64)
        at = np.arange(WINDOW_BYTES, len(data))
        value = self.hasher.spans(self.hasher.sums(data), at - WINDOW_BYTES, at)
        at = at[(value % np.uint64(CHUNK_BYTES) == 0) & ((data[at] & 0xC0) != 0x80)]
        return at[at - offsets[np.searchsorted(offsets, at, "right") - 1] >= WINDOW_BYTES]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Token ids of each text; special strings in a text are their token."""
        raw = data.tobytes()
        bounds = np.union1d(offsets, self.cut(data, offsets)).tolist()
        specials: dict = {}
        for text, code in self.special:
            at = raw.find(text)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(text) <= offsets[k + 1]:
                    specials[at] = (at + len(text), code)
                at = raw.find(text, at + len(text))
        for table, most in ((self.pieces, MAX_PIECES), (self.chunks, MAX_CHUNKS), (self.joins, MAX_CHUNKS)):
            if len(table) > most:
                table.clear()
        if specials:
            inside = [x for a, (b, _) in specials.items() for x in range(a + 1, b)]
            bounds = sorted((set(bounds) | set(specials) | {b for b, _ in specials.values()}) - set(inside))
        spans = list(zip(bounds[:-1], bounds[1:]))
        self.learn({raw[a:b] for a, b in spans if a not in specials})
        out, k = [], 0
        for end in offsets[1:].tolist():
            ids, run = [], []
            while k < len(spans) and spans[k][1] <= end:
                a, b = spans[k]
                k += 1
                if a in specials:
                    ids += [self.run(run) if run else b"", specials[a][1]]
                    run = []
                else:
                    run.append(raw[a:b])
            if run:
                ids.append(self.run(run))
            out.append(b"".join(ids))
        for data in [c for c in self.chunks if len(c) > MAX_KEPT_BYTES]:
            del self.chunks[data]
        return out

    def decode(self, ids: bytes) -> str:
        token = self.token
        return b"".join([token.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer_file: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default doc_id; n_tokens, token_ids, decoded) for each row of ``docs``.

    ``token_ids`` is binary, 32-bit little-endian numbers, as the tokenizer library encodes the whole text without
    added tokens; ``decoded`` is the text decoded from them. A null text counts as empty: no tokens, empty text. Each
    row is answered on its own: null or repeated ids keep their rows, an empty table gives none, and other columns do
    not matter. The tokenizer file is read on the driver and broadcast; its size does not depend on the data. Tables
    of chunks, pieces and joins live in each task and are bounded."""
    keep = keep or ["doc_id"]
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [f"c{k}" for k in range(len(keep))]

    def scan(batches):
        encoder = Encoder(definition.value)
        for whole in batches:
            for batch in slices(whole, "txt"):
                ids = encoder.encode(*flat(batch.column("txt")))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in names], pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([encoder.decode(x) for x in ids], pa.string())],
                    names=[*names, "n_tokens", "token_ids", "decoded"])

    cur = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("txt"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cur.schema.fields[:-1])
    out = cur.mapInArrow(scan, f"{kinds}n_tokens long, token_ids binary, decoded string")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "n_tokens", "token_ids", "decoded")


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report of ``encode``: digests of the ids and of the decoded text."""
    return encoded.select(id_col, "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

"""Arrow batches of texts as flat numpy arrays.

A batch of texts becomes one byte buffer plus offsets, so per-byte work is a
few numpy passes over the buffer instead of a Python loop per row. Work is
done on slices of bounded size; only a single longer text exceeds the bound.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

SLICE_BYTES = 1 << 20
#: Rows and bytes of an Arrow batch; 10 000 texts, or 1000 pairs of large sets, take tens or hundreds of MB in the JVM and
#: again in the worker.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20
MULT = np.uint64(0x9E3779B97F4A7C15 | 1)


def shared(spark, value):
    """Broadcast ``value``, classes of this package included by value; the returned function gives it inside a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def bounded_batches(spark) -> None:
    """From now on Arrow batches of this session have at most ``BATCH_ROWS`` rows, and end at ``BATCH_BYTES``."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(name).rstrip("b")) <= most:
            spark.conf.set(name, str(most))


def slices(batch, text_col: str, max_bytes: int = SLICE_BYTES):
    """Yield zero-copy slices of ``batch`` with about ``max_bytes`` of text each (a longer text stands alone)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0))
    if len(size) == 0:
        return
    part = np.cumsum(size) // max_bytes
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(size)]):
        yield batch.slice(a, b - a)


def flat(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class SpanHasher:
    """64-bit hashes of byte spans of a buffer from one prefix sum.

    With S[i] = sum of (byte + 1) * P**j for j < i, a span's value is
    (S[end] - S[start]) * P**-start, the same wherever the span stands.
    """

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.power) < n:
            step = np.full(n, MULT, np.uint64)
            step[0] = 1
            self.power = np.cumprod(step)
            step[1:] = np.uint64(pow(int(MULT), -1, 1 << 64))
            self.inverse = np.cumprod(step)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def lower_az(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the maximal runs of word bytes in each text: bytes of word i are
    data[start[i]:end[i]]; the words of text t are first[t]:first[t + 1]. ``is_word`` is a table over the 256 bytes."""
    inside = is_word[data]
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]  # a text begins anew
    start = np.flatnonzero(begins)
    after = np.ones(len(data), bool)
    after[:-1] = ~inside[1:]
    after[heads[heads > 0] - 1] = True
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(start, offsets)

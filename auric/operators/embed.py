"""Batch text encoding for pending contents.

Model inference is the one per-row Python step; it runs in Arrow batches
through ``mapInPandas`` (one encoder per task, never per row). The default
encoder is an offline signed feature-hashing vectoriser over word tokens,
L2-normalised, so it needs no model download; any callable mapping a list of
texts to an ``(n, dim)`` array can be plugged in instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class DimensionError(ValueError):
    """The encoder's vectors have another length than the model's."""


Encoder = Callable[[list[str], int], np.ndarray]


def hashing_encoder(texts: list[str], dim: int) -> np.ndarray:
    import re

    import xxhash

    out = np.zeros((len(texts), dim), dtype=np.float64)
    for i, t in enumerate(texts):
        for tok in re.findall(r"\w+", (t or "").lower()):
            h = xxhash.xxh64_intdigest(tok)
            out[i, h % dim] += 1.0 if (h >> 63) & 1 == 0 else -1.0
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def encode(df: DataFrame, key: str, text: str, dim: int, encoder: Encoder = hashing_encoder,
           batch_size: int = 256) -> DataFrame:
    """(key, embedding array<float>, falhou) for every row. When a batch
    fails, its rows are encoded one by one; a row that still fails keeps its
    key with a NULL embedding and ``falhou`` set, so nothing is lost."""

    def vectors(texts: list[str]) -> list:
        vecs = encoder(texts, dim)
        if vecs.shape[1] != dim:
            raise DimensionError(f"encoder produced {vecs.shape[1]} dimensions, expected {dim}")
        return [v.astype(np.float32) for v in vecs]

    def one(text: str):
        try:
            return vectors([text])[0]
        except DimensionError:
            raise
        except Exception:  # noqa: BLE001 — reported per row in ``falhou``
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start:start + batch_size]
                texts = part[text].tolist()
                try:
                    vecs = vectors(texts)
                except DimensionError:
                    raise
                except Exception:  # noqa: BLE001 — find the rows that fail
                    vecs = [one(t) for t in texts]
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": vecs,
                                    "falhou": [v is None for v in vecs]})

    key_type = dict(df.dtypes)[key]
    return df.select(key, text).mapInPandas(run, f"{key} {key_type}, embedding array<float>, falhou boolean")

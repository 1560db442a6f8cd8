"""Batch embedding through a pluggable callable."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv
from .text import embed_input

Embedder = Callable[[list[str]], np.ndarray]


class HashedTokens:
    """Offline default: signed token counts folded into ``dimension`` slots."""

    def __init__(self, dimension: int = fv.EMBED_DIMENSION):
        self.dimension = dimension

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for i, text in enumerate(texts):
            codes = [zlib.crc32(t.encode()) for t in re.findall(r"\w+", text.lower())]
            codes = np.array(codes, dtype=np.int64)
            np.add.at(out[i], (codes >> 1) % self.dimension, np.where(codes & 1, 1.0, -1.0))
        return out


def embed(
    df: DataFrame, embedder: Embedder | None = None, batch: int = fv.EMBED_BATCH,
    text: str = "text", out: str = "role_vec",
) -> DataFrame:
    """``text`` becomes a unit vector, ``batch`` texts per call of the embedder.

    The embedder is pickled to the tasks; a call that returns another number of
    vectors than it got texts fails the task.  A zero vector stays zero.
    """
    call = embedder or HashedTokens()
    keep = [f for f in df.schema if f.name != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    names = [f.name for f in keep]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start:start + batch]
                vectors = np.asarray(call(part[text].tolist()), dtype=np.float64)
                if vectors.shape[:1] != (len(part),):
                    raise RuntimeError(f"the embedder must give one vector per text, not {vectors.shape}")
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = (vectors / np.where(norm > 0, norm, 1.0)).astype(np.float32)
                yield part[names].assign(**{out: list(vectors)})

    prepared = df.withColumn(text, embed_input(F.col(text)))
    return prepared.mapInPandas(run, f"{fields}, `{out}` array<float>")

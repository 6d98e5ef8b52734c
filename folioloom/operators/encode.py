"""Encoding of texts to vectors through a slot: each distinct text once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]


def hash_encoder(dim: int) -> Encoder:
    """A deterministic stand-in for a model: signed hashes of words, brought to unit length."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                out[i, h % dim] += 1 if h >> 63 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length > 0, length, 1)

    return encode


def encode(df: DataFrame, column: str, out: str, encoder: Encoder | None = None, dim: int = 64) -> DataFrame:
    """Adds the vector of each text; null for null and blank texts. Duplicates are encoded once and joined back."""
    model = encoder or hash_encoder(dim)
    texts = df.select(F.col(column).alias("_text")).where(F.col(column).rlike(r"(?U)\S")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_text": batch["_text"], "_vector": list(model(batch["_text"].tolist()))})

    vectors = texts.mapInPandas(run, "_text string, _vector array<float>")
    return df.join(vectors, df[column] == vectors["_text"], "left").withColumn(out, F.col("_vector")).drop("_text", "_vector")

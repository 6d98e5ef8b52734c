"""Top-k retrieval by cosine similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine


def top_k(df: DataFrame, vector: str, query: Column, k: int = 10, absolute: bool = False, tie: list[str] = ()) -> DataFrame:
    """The k rows most similar to the query vector, with the signed similarity; null vectors are passed over.

    One stage: every task keeps its own k best (TakeOrderedAndProject), nothing is shuffled whole.
    """
    scored = df.where(F.col(vector).isNotNull()).withColumn("similarity", cosine(F.col(vector), query))
    rank = F.abs("similarity") if absolute else F.col("similarity")
    return scored.orderBy(F.desc(rank), *tie).limit(k)


def pairwise(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(a, b, cosine) of all pairs a < b. For bounded sets (an analysis of named rows), not for a corpus."""
    left, right = df.select(F.col(key).alias("a"), F.col(vector).alias("va")), df.select(F.col(key).alias("b"), F.col(vector).alias("vb"))
    return left.join(right, F.col("a") < F.col("b")).select("a", "b", cosine(F.col("va"), F.col("vb")).alias("cosine"))

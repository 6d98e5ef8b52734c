"""All queries of the engine by name."""

from __future__ import annotations

from . import analyse, curate, hierarchies, ingest, more, repair, validities  # noqa: F401
from .base import ORACLE_SQL, QUERIES  # noqa: F401


def flagship(spark, sf_dir):
    """Pooled vectors of each label ranked by similarity to a pooled query of two reverse-keyed items, with counts."""
    from pyspark.sql import functions as F

    from ..functions.vectors import literal_vector
    from ..operators import pooling, search
    from .base import table

    items = table(spark, sf_dir, "embeddings")
    reverse = F.col("vec_id") % 5 == 0
    query = pooling.keyed_centroid(items.where("vec_id in (0, 1)"), [], "embedding", reverse).first()["centroid"]
    counts = items.groupBy("label").agg(F.count("*").alias("n_items"))
    pooled = pooling.keyed_centroid(items, ["label"], "embedding", reverse).join(counts, "label")
    return search.top_k(pooled, "centroid", literal_vector(query), 10, True, ["label"]).select("label", "n_items", "similarity")

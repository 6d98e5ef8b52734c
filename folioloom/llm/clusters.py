"""Centroid clustering in whole numbers with partial-distance search.

Components become floor(64 * x). Every round reads the vectors once: each task assigns its vectors and returns one row
of sums a cluster, so what is shuffled and what the driver reads (``k`` rows) depend on the number of clusters only.
Centroids travel in the tasks' code; there is no lineage from round to round, and a lost task is worked out again from
the table. Sums are exact, so any order of tasks gives the same centroids.

Search: dimensions are taken in order of their variance over all vectors, the largest first. Every vector's distance to
a first centroid is finished; each other centroid then accumulates squared differences ``STEP`` dimensions at a time
and is abandoned for a vector once its partial sum is strictly above the vector's best. Whole sums replace the best if
they are smaller, or equal with a smaller number; so the result is that of the full search.

Defined results: vectors with another number of components, a null, a NaN or an infinity are left out, as are null
vectors; repeated rows count as often as they stand there; the first centroids come from rows with an id, ties of their
hash go by the components; with fewer vectors than ``k`` there are fewer centroids, with none the result is empty;
equal distances go to the smaller number; a cluster that gets no vector keeps its centroid; components beyond +-2^27
after scaling count as that bound (their distances would not fit a long); a vector of any other column's value is
carried as its id only, extra columns are not read; an id column that is named like an output makes that output's name
begin with an underscore.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import beside, map_slices, table

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
STEP = 8  # dimensions that are added up between two looks at the best distance
SLICE = 4096  # vectors handled at once
LARGEST = 1 << 27


def usable(vector: Column, size: int = DIMENSIONS) -> Column:
    """Whether a vector has exactly ``size`` components, each a finite number."""
    # With abs(x) < infinity nulls, NaN (larger than any number here) and infinities fail.
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def whole(column: pa.Array, size: int = DIMENSIONS) -> np.ndarray:
    """floor(SCALE * x) of usable vectors, one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(SCALE * flat), -LARGEST, LARGEST).astype(np.int64).reshape(-1, size)


@dataclass(frozen=True)
class Search:
    """Nearest centroids; ``order``: the dimensions, those of the largest variance first."""

    centroids: np.ndarray
    order: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the number of the nearest centroid and the squared distance."""
        v, c = vectors[:, self.order], self.centroids[:, self.order]
        best = ((v - c[0]) ** 2).sum(axis=1)
        cluster = np.zeros(len(v), np.int32)
        for k in range(1, len(c)):
            left, sums = np.arange(len(v)), np.zeros(len(v), np.int64)
            for at in range(0, v.shape[1], STEP):
                sums = sums + ((v[left, at : at + STEP] - c[k, at : at + STEP]) ** 2).sum(axis=1)
                going = sums <= best[left]
                left, sums = left[going], sums[going]
                if not len(left):
                    break
            closer = sums < best[left]  # an equal one has the larger number
            cluster[left[closer]], best[left[closer]] = k, sums[closer]
        return cluster, best


def vectors_of(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector of the usable rows."""
    return df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(usable(F.col("vector")))


def spread(kept: DataFrame) -> np.ndarray:
    """The dimensions by falling variance over all vectors, from one row of sums a dimension and slice."""

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            v = whole(part.column(0)).astype(np.float64)
            columns = [pa.array(np.arange(DIMENSIONS)), pa.array([float(len(v))] * DIMENSIONS), pa.array(v.sum(axis=0)), pa.array((v * v).sum(axis=0))]
            return pa.RecordBatch.from_arrays(columns, names=["dim", "n", "one", "two"])

        return handle

    rows = map_slices(kept.select("vector"), make, "dim long, n double, one double, two double", SLICE)
    found = rows.groupBy("dim").agg(F.sum("n"), F.sum("one"), F.sum("two")).collect()  # one row a dimension
    if not found:
        return np.arange(DIMENSIONS)
    _, n, one, two = np.array(sorted(map(tuple, found))).T
    return np.argsort(-(two / n - (one / n) ** 2), kind="stable")


def first_centroids(kept: DataFrame, k: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of the hashes."""
    named = kept.where(F.col("key").isNotNull()).withColumn("hash", F.sha2(F.concat(F.lit("1:"), F.col("key").cast("string")), 256))
    rows = named.orderBy("hash", "vector").limit(k).select("vector").toArrow()
    return whole(rows.column(0).combine_chunks()) if rows.num_rows else np.zeros((0, DIMENSIONS), np.int64)


def totals(kept: DataFrame, search: Search) -> dict[int, tuple[int, int, list[int]]]:
    """By cluster: number of vectors, sum of the distances, sums of the components. A slice gives one row of each; the
    driver reads ``k`` rows of each."""
    k = len(search.centroids)

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            v = whole(part.column(0))
            cluster, distance = search.nearest(v)
            # Columns of sums: number, the distances in two halves (no sum of a slice leaves a long), components.
            sums = np.zeros((k, 3 + DIMENSIONS), np.int64)
            np.add.at(sums, cluster, np.column_stack([np.ones_like(distance), distance >> 31, distance & 0x7FFFFFFF, v]))
            have = np.flatnonzero(sums[:, 0])
            what = np.tile(np.arange(sums.shape[1]), len(have))
            columns = [np.repeat(have, sums.shape[1]), what, sums[have].ravel()]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["cluster", "what", "value"])

        return handle

    rows = map_slices(kept.select("vector"), make, "cluster long, what long, value long", SLICE)
    out: dict[int, dict[int, int]] = {}
    for cluster, what, value in rows.groupBy("cluster", "what").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect():
        out.setdefault(cluster, {})[what] = int(value)
    return {c: (x[0], (x[1] << 31) + x[2], [x[3 + i] for i in range(DIMENSIONS)]) for c, x in out.items()}


def assign(kept: DataFrame, search: Search) -> DataFrame:
    """key, cluster and distance of every vector."""

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            cluster, distance = search.nearest(whole(part.column(1)))
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster), pa.array(distance)], names=["key", "cluster", "distance"])

        return handle

    schema = StructType([kept.schema["key"]]).add("cluster", "integer").add("distance", "long")
    return map_slices(kept, make, schema, SLICE)


def fit(kept: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> Search:
    """``rounds`` rounds from the first centroids."""
    search = Search(first_centroids(kept, k), spread(kept))
    for _ in range(rounds if len(search.centroids) else 0):
        centroids = search.centroids.copy()
        for cluster, (n, _, sums) in totals(kept, search).items():
            centroids[cluster] = [x // n for x in sums]
        search = Search(centroids, search.order)
    return search


def cluster_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kept = vectors_of(df, key, vector)
    search = fit(kept, k, rounds)
    if not len(search.centroids):  # no vectors that could be assigned
        kept, search = kept.limit(0), Search(np.zeros((1, DIMENSIONS), np.int64), search.order)
    found = totals(kept, search)
    limit = (1 << 63) - 1
    inertia = min(sum(x[1] for x in found.values()), limit)
    known = [(i, min(found[i][1], limit), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(search.centroids) if i in found]
    facts = df.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, centroid_sha256 string")
    out = assign(kept, search).join(F.broadcast(facts), "cluster")  # k rows
    names = beside(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    values = [F.col("cluster"), F.col("distance"), F.col("cluster_inertia"), F.lit(inertia).cast("long"), F.col("centroid_sha256")]
    return out.select(F.col("key").alias(key), *(v.alias(n) for v, n in zip(values, names, strict=True)))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector of ``embeddings``."""
    return cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _sql() -> str:
    """The same in SQL, one step a round."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster, v AS c FROM kept WHERE vec_id IS NOT NULL
  ORDER BY sha256('1:' || vec_id), v LIMIT {CLUSTERS})""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT row_id, vec_id, v, (m).d AS distance, (m).k AS cluster FROM (SELECT row_id, any_value(vec_id) AS vec_id, any_value(v) AS v,
    min({{'d': list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'k': cluster}}) AS m FROM kept, c{i} GROUP BY row_id))""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (SELECT cluster, d, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i}) GROUP BY ALL),
m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""


ORACLE = _sql()

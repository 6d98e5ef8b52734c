"""Pooling of item vectors over groups and hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import keyed, unit

GROUPS = 10_000  # groups whose sums are broadcast at most


def elementwise_mean(df: DataFrame, keys: list[str], vector: str, out: str = "centroid") -> DataFrame:
    """Mean by position within groups: positions are averaged with partial sums, then put in order again.
    Null vectors are passed over."""
    exploded = df.where(F.col(vector).isNotNull()).select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("_pos", "_x"))
    means = exploded.groupBy(*keys, "_pos").agg(F.avg("_x").alias("_x"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_x"))), lambda s: s["_x"]).alias(out))


def keyed_centroid(df: DataFrame, keys: list[str], vector: str, reverse: Column, out: str = "centroid") -> DataFrame:
    """Mean of signed unit vectors of each group, not brought to unit length again."""
    return elementwise_mean(df.withColumn("_k", keyed(F.col(vector), reverse)), keys, "_k", out)


def renormalised_centroid(df: DataFrame, keys: list[str], vector: str, reverse: Column, out: str = "centroid") -> DataFrame:
    return keyed_centroid(df, keys, vector, reverse, out).withColumn(out, unit(F.col(out)))


def keying_disagreement(df: DataFrame, keys: list[str], vector: str, reverse: Column) -> DataFrame:
    """keys, n_items, n_disagree: rows whose signed vector points away from the mean of the others.

    With the group's sum S, k.(S - k) = k.S - k.k decides; groups of one row disagree with nothing. Sums are
    aggregated by position with partial sums and put together as one vector a group; the rows meet them where they lie,
    with a broadcast of at most GROUPS groups, and beyond that by a join on the keys. No row is shuffled by position.
    """
    rows = df.where(F.col(vector).isNotNull()).withColumn("_k", keyed(F.col(vector), reverse))
    flat = rows.select(*keys, F.posexplode("_k").alias("_pos", "_x")).groupBy(*keys, "_pos").agg(F.sum("_x").alias("_x"))
    sums = flat.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_x"))), lambda s: s["_x"]).alias("_s"))
    few = sums.limit(GROUPS + 1).count() <= GROUPS
    sums = sums.select(*[F.col(k).alias(f"_sum_{k}") for k in keys], "_s")
    same = [F.col(k).eqNullSafe(F.col(f"_sum_{k}")) for k in keys]
    met = rows.join(F.broadcast(sums) if few else sums, same).select(*keys, "_k", "_s")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
    away = ((dot(F.col("_k"), F.col("_s")) - dot(F.col("_k"), F.col("_k"))) < 0).cast("long")
    counted = met.groupBy(*keys).agg(F.count("*").alias("n_items"), F.sum(away).alias("_away"))
    return counted.select(*keys, "n_items", F.when(F.col("n_items") >= 2, F.col("_away")).otherwise(F.lit(0).cast("long")).alias("n_disagree"))


def closure(df: DataFrame, doc: str, path: str) -> DataFrame:
    """Every row once for each node on its path: adds node, depth and below (the path from the node on)."""
    exploded = df.select("*", F.posexplode(path).alias("_at", "node"))
    below = F.slice(F.col(path), F.col("_at") + 1, F.size(path))
    return exploded.withColumn("depth", (F.col("_at") + 1).cast("long")).withColumn("below", below).drop("_at")


def once_per_item(df: DataFrame, keys: list[str], item: str, order: list[str]) -> DataFrame:
    """The first row of each item in a group; rows without an item id count one by one."""
    tag = F.when(F.col(item).isNotNull(), F.struct(F.lit(1).alias("t"), F.col(item).cast("string").alias("v"))).otherwise(F.struct(F.lit(0).alias("t"), F.to_json(F.struct(*order)).alias("v")))
    first = Window.partitionBy(*keys, "_tag").orderBy(*order)
    return df.withColumn("_tag", tag).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_tag")


def pooled(df: DataFrame, doc: str, path: str, item: str, order: list[str], flags: list[str] = ()) -> DataFrame:
    """Nodes and whole documents: (doc, node, is_instrument, depth, n_items, n_scales, flags).

    Items count once a node; a document's own row has a null node and counts the items of all its rows, those
    without a path too. Flags are or-ed as three-valued logic: true wins, null only where all are null.
    """
    scaled = closure(df.where(F.col(path).isNotNull()), doc, path)
    nodes = scaled.groupBy(doc, "node").agg(F.min("depth").alias("depth"), F.size(F.array_distinct(F.flatten(F.collect_set("below")))).cast("long").alias("n_scales"))
    items = once_per_item(scaled, [doc, "node"], item, order).groupBy(doc, "node").agg(F.count("*").alias("n_items"), *[F.bool_or(f).alias(f) for f in flags])
    by_node = nodes.join(items, [doc, "node"], "left").withColumn("is_instrument", F.lit(False))
    whole = once_per_item(df, [doc], item, order).groupBy(doc).agg(F.count("*").alias("n_items"), *[F.bool_or(f).alias(f) for f in flags])
    scales = df.groupBy(doc).agg(F.size(F.array_distinct(F.flatten(F.collect_set(path)))).cast("long").alias("n_scales"))
    by_doc = whole.join(scales, whole[doc].eqNullSafe(scales[doc])).drop(scales[doc]).withColumn("is_instrument", F.lit(True))
    return by_node.unionByName(by_doc, allowMissingColumns=True)


def first_values(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The values of each group's first row, nulls included."""
    by = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(c, by).alias(c) for c in columns])

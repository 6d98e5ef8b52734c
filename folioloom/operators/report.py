"""Counts, distributions and coverage for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .curation import spread_by

QUANTILES = (0.25, 0.5, 0.75, 0.95)


def document_key(path: Column, source: Column, title: Column) -> Column:
    """The path, or a key made of source and title."""
    return F.coalesce(path, F.concat(F.lit("doc::"), F.coalesce(source, F.lit("?")), F.lit("::"), F.coalesce(title, F.lit("?"))))


def structure_counts(df: DataFrame, source: str | None, doc: str, item: str, scale: str, path: str) -> DataFrame:
    """Documents, rows, placements, items, scale nodes and item-bearing scales, by source and in total.

    Rows are dealt by document once, over as many tasks as their number needs. There each becomes its entries (document,
    item, bearing scale, nodes of the path), an entry counts once for each source and once for the total, and only
    counts leave the task.
    """
    total = F.lit("(all)")
    kept = df.select(F.col(source).alias("source") if source else F.lit(None).cast("string").alias("source"), F.col(doc).alias("d"), F.col(item).alias("i"), F.col(scale).alias("s"), F.col(path).alias("p"))
    none = {c: F.lit(None).cast(kept.schema[c].dataType) for c in ("i", "s")} | {"n": F.lit(None).cast(kept.schema["p"].dataType.elementType)}
    entry = lambda kind, **of: F.struct(F.lit(kind).alias("kind"), *(of.get(c, none[c]).alias(c) for c in none))
    some = lambda wanted, x: F.when(wanted, F.array(x)).otherwise(F.array().cast(kept.select(F.array(entry("d")).alias("x")).schema["x"].dataType))
    i, s, named = F.col("i"), F.col("s"), F.col("d").isNotNull()
    nodes = F.transform(F.filter(F.when(named, F.col("p")), lambda n: n.isNotNull()), lambda n: entry("n", n=n))
    empty = some(F.lit(False), entry("d"))
    entries = F.concat(some(named, entry("d")), some(i.isNotNull(), entry("i", i=i)), some(s.isNotNull(), entry("s", s=s)), F.coalesce(nodes, empty))
    each = spread_by(kept, "d").select("source", "d", F.explode(entries).alias("e")).select("source", "d", "e.*").distinct()
    first = F.row_number().over(Window.partitionBy("d", "kind", "i", "s", "n").orderBy("source")) == 1
    counts = each.withColumn("first", first).groupBy("source", "kind").agg(F.count("*").alias("n"), F.count_if("first").alias("once"))
    rows = kept.groupBy("source").agg(F.count("*").alias("rows"), F.count("i").alias("placements"))
    if source:
        # A source that is named like the total is in the total already.
        one = lambda name, n: F.struct(name.alias("source"), F.col("kind"), n.alias("n"))
        own = F.when(F.col("source").eqNullSafe(total), 0).otherwise(F.col("n"))
        counts = counts.select(F.inline(F.array(one(F.col("source"), own), one(total, F.col("once")))))
        rows = rows.unionByName(rows.withColumn("source", total))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    both = rows.select("source", "rows", "placements", F.lit(None).alias("kind"), F.lit(None).cast("long").alias("n")).unionByName(counts.select("source", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("placements"), "kind", "n"))
    return both.groupBy("source").agg(
        of("d").alias("documents"), F.sum("rows").alias("rows"), F.sum("placements").alias("placements"),
        of("i").alias("items"), of("s").alias("bearing_scales"), of("n").alias("nodes"),
    )


def per_unit(universe: DataFrame, rows: DataFrame, unit: list[str], counted: Column) -> DataFrame:
    """(unit..., n): distinct counts within units, 0 for units of the universe without rows."""
    counts = rows.groupBy(*unit).agg(F.countDistinct(counted).alias("n"))
    return universe.join(counts, unit, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def distribution(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """n, mean, sd, least, quartiles, 95th percentile and largest of a column; exact quantiles.

    A quantile between two values a and b is a + (b - a) * share: a (1 - share) + b share, as ``percentile`` has it, can
    round to the other side. The values are counted first, so that a group's window holds its distinct values only.
    """
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).cast("double").alias("least"), F.max(value).cast("double").alias("largest"))
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*by)
    placed = counts.withColumn("_end", F.sum("_c").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(group))

    def quantile(q: float) -> Column:
        at = (F.col("_n") - 1) * q
        low, high = (F.min(F.when(F.col("_end") > edge, F.col("_v"))) for edge in (F.floor(at), F.ceil(at)))
        share = F.max(at - F.floor(at))
        return F.when(low == high, low).otherwise(low + (high - low) * share)

    names = ("q1", "median", "q3", "p95")
    found = placed.groupBy(*by).agg(*(quantile(q).alias(name) for q, name in zip(QUANTILES, names, strict=True)))
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    met = out.join(found.toDF(*(f"_by{i}" for i in range(len(by))), *names), same or F.lit(True), "left")
    return met.select(*by, "n", "mean", "sd", "least", *names, "largest")


def summary_text(mean: Column, sd: Column, median: Column, q1: Column, q3: Column) -> Column:
    """``M (SD) · Mdn [Q1–Q3]``"""
    two = lambda x: F.format_number(x, 2)
    return F.concat(two(mean), F.lit(" ("), F.coalesce(two(sd), F.lit("n/a")), F.lit(") · "), two(median), F.lit(" ["), two(q1), F.lit("–"), two(q3), F.lit("]"))


def levels(df: DataFrame, value: str) -> DataFrame:
    """(level, n, share, cumulative) from the least to the largest level, gaps as 0."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("long").alias("level")).agg(F.count("*").alias("n"))
    spine = counts.agg(F.sequence(F.min("level"), F.max("level")).alias("l")).select(F.explode("l").alias("level"))
    filled = spine.join(counts, "level", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # A histogram has as many rows as levels, so one ordered window over it stays small.
    total, running = F.sum("n").over(Window.partitionBy()), F.sum("n").over(Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0))
    return filled.select("level", "n", (F.col("n") / total).alias("share"), (running / total).alias("cumulative"))


def node_depths(df: DataFrame, doc: str, path: str, order: str) -> DataFrame:
    """(doc, node, depth): the first place of each node on its paths."""
    flat = df.select(doc, order, F.posexplode(path).alias("pos", "node"))
    return flat.groupBy(doc, "node").agg((F.min_by("pos", order) + 1).cast("long").alias("depth"))


def value_counts(df: DataFrame, value: str, k: int = 10) -> DataFrame:
    """(value, n, share) of the k most frequent values; ties by value."""
    counts = df.groupBy(F.coalesce(F.col(value).cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("_total")))  # one row
    return counts.orderBy(F.desc("n"), "value").limit(k).join(total).select("value", "n", (F.col("n") / F.col("_total")).alias("share"))


def bands(similarity: Column) -> Column:
    return F.when(similarity >= 1, "100").when(similarity >= 0.95, "95-100").when(similarity >= 0.8, "80-95").when(similarity >= 0.5, "50-80").when(similarity.isNotNull(), "<50")


def coverage(universe: DataFrame, key: str, usage: str, tiers: list[tuple[str, DataFrame]]) -> DataFrame:
    """(tier, overlapping, incremental, usage_share): what each tier covers, alone and beyond those before it.

    A record's first tier is the least rank over all tiers that have it: one aggregate, no chain of anti joins.
    """
    members = None
    for rank, (name, df) in enumerate(tiers):
        one = df.select(key).distinct().select(key, F.lit(rank).alias("rank"), F.lit(name).alias("tier"))
        members = one if members is None else members.unionByName(one)
    inside = members.join(universe.select(key, usage), key)
    first = inside.withColumn("lead", F.min("rank").over(Window.partitionBy(key)) == F.col("rank"))
    total = universe.agg(F.sum(usage)).first()[0]
    return first.groupBy("tier").agg(F.count("*").alias("overlapping"), F.count_if("lead").alias("incremental"), (F.sum(F.when(F.col("lead"), F.col(usage))) / F.lit(total)).alias("usage_share"))


def top_missing(records: DataFrame, covered: DataFrame, key: str, usage: str, k: int = 20) -> DataFrame:
    """The ``k`` records of the largest usage that no row of ``covered`` (key) covers; ties by key, unknown usage last."""
    left = records.join(covered.select(key).distinct(), key, "left_anti")
    return left.orderBy(F.col(usage).desc_nulls_last(), key).limit(k)


def manifest(df: DataFrame) -> DataFrame:
    """(column, type, nulls, dim, trues): one wide aggregate over the schema, turned to rows."""
    from pyspark.sql.types import ArrayType, BooleanType

    cols = []
    for f in df.schema:
        dim = F.max(F.size(f.name)).cast("long") if isinstance(f.dataType, ArrayType) else F.lit(None).cast("long")
        trues = F.count_if(f.name) if isinstance(f.dataType, BooleanType) else F.lit(None).cast("long")
        cols.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count_if(F.col(f.name).isNull()).alias("nulls"), dim.alias("dim"), trues.alias("trues")))
    return df.agg(F.array(*cols).alias("a")).select(F.inline("a"))

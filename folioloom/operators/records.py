"""Records, their lookups and their reports: joins on keys of one row each, numbering, retention and small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import core_name


def overridden(df: DataFrame, found: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """``column`` takes the value worked out from the row of ``found`` with the key, where that is not null."""
    return df.join(found, key, "left").withColumn(column, F.coalesce(value, F.col(column)))


def filled(df: DataFrame, verdicts: DataFrame, key: str, column: str, value: str, accepted: str) -> DataFrame:
    """Null cells of ``column`` from accepted verdicts; rejected ones fill nothing."""
    known = verdicts.where(F.col(accepted)).groupBy(key).agg(F.min(value).alias("_found"))
    return df.join(known, key, "left").withColumn(column, F.coalesce(column, "_found")).drop("_found")


def covered_through_aliases(records: DataFrame, aliases: DataFrame, covered: DataFrame, key: str, kept: str) -> DataFrame:
    """(key, covered): a dropped record counts as covered where its kept sibling is. ``aliases`` are (key, kept)."""
    seen = covered.select(F.col(key).alias("_seen")).distinct()
    named = records.select(key).join(aliases.select(key, F.col(kept).alias("_kept")), key, "left").withColumn("_own", F.coalesce("_kept", key))
    return named.join(seen, F.col("_own") == F.col("_seen"), "left").select(key, F.col("_seen").isNotNull().alias("covered"))


def numbered_items(items: DataFrame, gate: DataFrame, record: str, order: str, item: str) -> DataFrame:
    """(record, item_id, item): the items of the records that pass the gate, numbered 1, 2, ... within each."""
    number = F.row_number().over(Window.partitionBy(record).orderBy(order)).cast("long")
    return items.join(gate.select(record), record, "left_semi").select(F.col(record).alias("record"), number.alias("item_id"), F.col(item).alias("item"))


def vector_or_name(nodes: DataFrame, own: DataFrame, names: DataFrame, node: str, name: str, vector: str) -> DataFrame:
    """Nodes with a vector and its origin: 'direct', their own, else 'sidecar', that of their name, else null."""
    direct = own.select(F.col(node), F.col(vector).alias("_own"))
    side = names.groupBy(name).agg(F.first(vector).alias("_side"))
    joined = nodes.join(direct, node, "left").join(side, name, "left")
    origin = F.when(F.col("_own").isNotNull(), "direct").when(F.col("_side").isNotNull(), "sidecar")
    return joined.withColumn(vector, F.coalesce("_own", "_side")).withColumn("origin", origin).drop("_own", "_side")


def name_tiers(records: DataFrame, known: DataFrame, record: str, name: str, identifier: str, generic: tuple[str, ...]) -> DataFrame:
    """(record, matched, tier): the least identifier of the same name ('exact'), else of the same name without generic
    words ('core'), else none. Names are match keys."""
    exact = known.groupBy(F.col(name).alias("_k")).agg(F.min(identifier).alias("_m"))
    core = exact.groupBy(core_name(F.col("_k"), generic).alias("_c")).agg(F.min("_m").alias("_n"))
    asked = records.select(record, F.col(name).alias("_q"), core_name(F.col(name), generic).alias("_d"))
    joined = asked.join(exact, F.col("_q") == F.col("_k"), "left").join(core, F.col("_d") == F.col("_c"), "left")
    tier = F.when(F.col("_m").isNotNull(), "exact").when(F.col("_n").isNotNull(), "core").otherwise("none")
    return joined.select(record, F.coalesce("_m", "_n").alias("matched"), tier.alias("tier"))


def fidelity(items: DataFrame, doc: str, similarity: str, least: float, digits: int = 9) -> DataFrame:
    """One row: items and documents, how many of each lie below ``least`` (documents by mean and by their worst item), and
    the 5th percentile of the items."""
    low = lambda c: F.count_if(F.round(c, digits) < least)
    by_item = items.agg(F.count("*").alias("items"), low(similarity).alias("items_below"), F.percentile(similarity, 0.05).alias("p05"))
    docs = items.groupBy(doc).agg(F.avg(similarity).alias("_mean"), F.min(similarity).alias("_worst"))
    return by_item.crossJoin(docs.agg(F.count("*").alias("docs"), low("_mean").alias("docs_below_mean"), low("_worst").alias("docs_below_min")))  # two single rows


def coverage_by(records: DataFrame, covered: DataFrame, key: str, by: str, usage: str) -> DataFrame:
    """(by, covered, n, usage_share): records and their share of the group's usage."""
    seen = covered.select(key).distinct().withColumn("_hit", F.lit(True))
    counted = records.join(seen, key, "left").groupBy(by, F.col("_hit").isNotNull().alias("covered")).agg(F.count("*").alias("n"), F.sum(usage).alias("_u"))
    return counted.select(by, "covered", "n", (F.col("_u") / F.sum("_u").over(Window.partitionBy(by))).alias("usage_share"))


def descriptives_by(df: DataFrame, by: str, value: str, short: int) -> DataFrame:
    """(by, n, mean, q10, q90, single, short) by group and over all ('(all)'): shares of ones and of ``short`` or fewer."""
    share = lambda c: F.avg(c.cast("int"))
    q = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9)))
    out = df.rollup(by).agg(F.grouping(by).alias("_all"), F.count("*").alias("n"), F.avg(value).alias("mean"), q.alias("q"), share(F.col(value) == 1).alias("single"), share(F.col(value) <= short).alias("short"))
    return out.select(F.when(F.col("_all") == 1, "(all)").otherwise(F.col(by)).alias(by), "n", "mean", F.col("q")[0].alias("q10"), F.col("q")[1].alias("q90"), "single", "short")


def worst_first(df: DataFrame, kind: str, first: str, similarity: str, identifier: str, k: int) -> DataFrame:
    """The ``k`` worst: rows of the kind ``first`` before others, least similarity first."""
    return df.orderBy(F.col(kind) != first, similarity, identifier).limit(k)


def beyond_newest(df: DataFrame, key: str, time: str, identifier: str, k: int) -> DataFrame:
    """What a retention of the ``k`` newest rows of a key lets go."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(time), identifier))
    return df.withColumn("_place", place).where(F.col("_place") > k).drop("_place")


def seeded(df: DataFrame, identifier: str, seed: int, k: int) -> DataFrame:
    """The first ``k`` rows in an order drawn by a seed, with their place; the same in any engine."""
    drawn = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(identifier).cast("string")))).orderBy("_h", identifier).limit(k)
    return drawn.withColumn("place", F.row_number().over(Window.orderBy("_h", identifier)).cast("long")).drop("_h")


def multiset_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(side, *columns): rows that only the old or only the new frame has, as often as it has them more."""
    return old.exceptAll(new).select(F.lit("old").alias("side"), "*").unionByName(new.exceptAll(old).select(F.lit("new").alias("side"), "*"))


def any_flag(df: DataFrame, by: str, flag: Column, checked: str) -> DataFrame:
    """(by, flagged, checked): three-valued or: true wins, null only where nothing could be checked."""
    return df.groupBy(by).agg(F.bool_or(flag).alias("flagged"), F.count(checked).alias("checked"))


def keyed_means(df: DataFrame, key: str, response: Column, reverse: Column, top: float) -> DataFrame:
    """(key, mean) of responses with reversed ones turned round at ``top``; missing responses are passed over."""
    return df.groupBy(key).agg(F.avg(F.when(reverse, top - response).otherwise(response)).alias("mean")).where("mean is not null")


def inferred_keys(df: DataFrame, vector: str) -> DataFrame:
    """(item, reversed) for the items 2, 3, ... of response vectors: those that correlate negatively with the first one."""
    flat = df.select(F.col(vector)[0].cast("double").alias("_first"), F.posexplode(vector).alias("_at", "_x")).where("_at > 0")
    return flat.groupBy((F.col("_at") + 1).cast("long").alias("item")).agg((F.corr("_first", F.col("_x").cast("double")) < 0).alias("reversed"))


def grid(df: DataFrame, unit: str, run: str, runs: list[str], value: str) -> DataFrame:
    """(unit, a column a run, deviates): the runs' values side by side, and whether they differ."""
    wide = df.groupBy(unit).pivot(run, runs).agg(F.max(value))
    return wide.withColumn("deviates", F.size(F.array_distinct(F.array_compact(F.array(*runs)))) > 1)


def remaining_by(df: DataFrame, by: str, dropped: Column) -> DataFrame:
    """(by, before, after): rows of a group, and those that the mask leaves; a null mask drops nothing."""
    return df.groupBy(by).agg(F.count("*").alias("before"), F.count_if(~F.coalesce(dropped, F.lit(False))).alias("after"))


def throughput(nanoseconds: Column, tokens: Column) -> Column:
    """struct(seconds, rate): null rates for no time."""
    seconds = nanoseconds / 1e9
    return F.struct(seconds.alias("seconds"), (tokens / F.nullif(seconds, F.lit(0.0))).alias("rate"))


def with_default(column: Column, value: Column) -> Column:
    """A default where there is none."""
    return F.coalesce(column, value)

"""How well displayed values follow true correlations: draws of the truth, read-down cutoffs, and keys left unmarked.

Draws come from hashes of what is drawn for, so that any engine, and any run, draws the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, keyed, unit
from .hierarchy import vector_sums
from .statistics import draw


def uniform(*parts: Column) -> Column:
    """A number within (0, 1), never at its ends."""
    return (draw(*parts) + F.lit(0.5)) / F.lit(float(1 << 32))


def normal(*parts: Column) -> Column:
    """A standard normal number from two uniform ones."""
    return F.sqrt(-2 * F.log(uniform(*parts, F.lit("r")))) * F.cos(F.lit(2 * math.pi) * uniform(*parts, F.lit("a")))


def shown_shares(pairs: DataFrame, key: list[str], observed: str, error: str, displayed: str, cutoffs: list[float], related: list[float], draws: int) -> DataFrame:
    """(t, draw, n, shares): for each draw of the true correlations (observed + error x a normal number), of the n pairs
    related by at least ``t``, the share shown at each cutoff: displayed with the truth's sign and at least that value.

    Pairs meet no cutoffs: each is counted once under the number of cutoffs that it passes, and sums from above give
    the shares. Draws in which no pair is related are left out.
    """
    each = pairs.select(*key, observed, error, displayed, F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    truth = F.col(observed) + F.col(error) * normal(F.col("draw"), *(F.col(k) for k in key))
    passed = F.size(F.filter(F.array(*map(F.lit, sorted(cutoffs))), lambda c: c <= F.col(displayed) * F.signum(F.col("truth"))))
    rows = each.withColumn("truth", truth).select("draw", passed.alias("k"), F.explode(F.filter(F.array(*map(F.lit, related)), lambda t: t <= F.abs("truth"))).alias("t"))
    counts = rows.groupBy("t", "draw", "k").agg(F.count("*").alias("c"))
    by = counts.groupBy("t", "draw").agg(F.sum("c").alias("n"), F.collect_list(F.struct("k", "c")).alias("ks"))
    above = lambda i: F.aggregate("ks", F.lit(0).cast("long"), lambda s, x: s + F.when(x["k"] > i, x["c"]).otherwise(0)) / F.col("n")
    return by.select("t", "draw", "n", F.array(*(above(i) for i in range(len(cutoffs)))).alias("shares"))


def sensitivity(shares: DataFrame, cutoffs: list[float]) -> DataFrame:
    """(t, cutoff, share, lower, upper, related): medians and 95 % intervals over the draws."""
    named = F.map_from_arrays(F.array(*map(F.lit, sorted(cutoffs))), "shares")
    rows = shares.select("t", "n", F.explode(named).alias("cutoff", "share"))
    quantile = lambda p: F.percentile("share", p)
    return rows.groupBy("t", "cutoff").agg(quantile(0.5).alias("share"), quantile(0.025).alias("lower"), quantile(0.975).alias("upper"), F.percentile("n", 0.5).alias("related"))


def read_down(shares: DataFrame, cutoffs: list[float], targets: list[float]) -> DataFrame:
    """(t, target, cutoff, lower, upper): how far down one has to read: the largest cutoff at which each draw still shows
    the target share, as median and 95 % interval; null where no draw does."""
    ordered = F.array(*map(F.lit, sorted(cutoffs)))
    rows = shares.select("t", "shares", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    reached = F.array_max(F.filter(F.zip_with(ordered, "shares", lambda c, s: F.when(s >= F.col("target"), c)), lambda c: c.isNotNull()))
    quantile = lambda p: F.percentile("reached", p)
    return rows.withColumn("reached", reached).groupBy("t", "target").agg(quantile(0.5).alias("cutoff"), quantile(0.025).alias("lower"), quantile(0.975).alias("upper"))


def unmarked(items: DataFrame, pairs: DataFrame, scale: str, item: str, vector: str, reverse: Column, a: str, b: str, observed: str, shares: list[float], draws: int) -> DataFrame:
    """(share, draw, condition, accuracy, n_dropped): how accuracy falls where reverse keys are not marked.

    In each draw a reverse-keyed item loses its key with the probability ``share`` (one draw is enough for 0 and 1), and
    its scale is pooled anew: with S the sum of the keyed unit vectors and D that of the unit vectors which lost their
    key, the new direction is that of S + 2 D, so only dropped items are added up for a draw. query: the perturbed
    scale is searched against documented ones, either scale of a pair as the query; both: both are perturbed.
    Accuracy is the correlation of the displayed values (cosines) with the observed ones.
    """
    rows = items.where(F.col(vector).isNotNull()).select(F.col(scale).alias("s"), F.col(item).alias("i"), F.col(vector).alias("v"), F.coalesce(reverse, F.lit(False)).alias("rev"))
    documented = vector_sums(rows.withColumn("k", keyed(F.col("v"), F.col("rev"))), ["s"], "k").select("s", F.col("sums").alias("doc"))
    grid = [(float(p), d) for p in shares for d in range(1 if p in (0, 1) else draws)]
    cells = F.explode(F.array(*(F.struct(F.lit(p).alias("share"), F.lit(d).alias("draw")) for p, d in grid))).alias("c")
    lost = rows.where("rev").select("s", "i", "v", cells).select("s", "i", "v", "c.share", "c.draw").where(uniform(F.col("draw"), F.col("s"), F.col("i")) < F.col("share"))
    moved = vector_sums(lost.withColumn("u", unit(F.col("v"))), ["share", "draw", "s"], "u").withColumnRenamed("n", "dropped")
    known = documented.select("s", "doc", cells).select("s", "doc", "c.share", "c.draw").join(moved, ["share", "draw", "s"], "left")
    new = F.coalesce(F.zip_with("doc", "sums", lambda x, y: x + 2 * y), F.col("doc"))
    scales = known.select("share", "draw", "s", unit(F.col("doc")).alias("old"), unit(new).alias("new"), F.coalesce("dropped", F.lit(0)).alias("dropped"))
    side = lambda name, at: scales.select("share", "draw", F.col("s").alias(name), F.col("old").alias(f"doc_{at}"), F.col("new").alias(f"new_{at}"))
    met = pairs.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(observed).alias("r")).join(side("a", "a"), "a").join(side("b", "b"), ["share", "draw", "b"])
    value = lambda x, y: dot(F.col(x), F.col(y))
    shown = F.array(*(F.struct(F.lit(c).alias("condition"), x.alias("x")) for c, x in (("query", value("new_a", "doc_b")), ("query", value("doc_a", "new_b")), ("both", value("new_a", "new_b")))))
    each = met.select("share", "draw", "r", F.explode(shown).alias("e")).select("share", "draw", "r", "e.*")
    accuracy = each.groupBy("share", "draw", "condition").agg(F.corr("x", "r").alias("accuracy"))
    counts = scales.groupBy("share", "draw").agg(F.sum("dropped").alias("n_dropped"))
    return accuracy.join(counts, ["share", "draw"])


@dataclass(frozen=True)
class Predicate:
    """A condition under one name that serves as a filter, as a mask and in reports; what is unknown counts as ``unknown``."""

    name: str
    condition: Column
    unknown: bool = False

    def mask(self) -> Column:
        return F.coalesce(self.condition, F.lit(self.unknown)).alias(self.name)

    def keep(self, df: DataFrame) -> DataFrame:
        return df.where(self.mask())

    def drop(self, df: DataFrame) -> DataFrame:
        return df.where(~self.mask())

    def __and__(self, other: Predicate) -> Predicate:
        return Predicate(f"{self.name} and {other.name}", self.mask() & other.mask())

    def inverted(self, name: str) -> Predicate:
        return Predicate(name, ~self.mask())


def searchable(dropped: list[Predicate], name: str = "searchable") -> Predicate:
    """What none of the filters drops."""
    out = F.lit(True)
    for p in dropped:
        out = out & ~p.mask()
    return Predicate(name, out)


def cross_check(outcomes: DataFrame, rows: DataFrame, key: str, genuine: Predicate, flags: list[Predicate], corpus: Predicate | None = None) -> DataFrame:
    """(flag, audited, in_corpus, flagged, genuine, precision, caught, genuine_total): how flags on the rows of documents
    meet what an audit of the documents found. A document is flagged if any of its rows in the corpus is; documents
    without such rows are audited but not in the corpus, and count for no flag. any_flag: the union of the flags.
    """
    kept = corpus.keep(rows) if corpus else rows
    per = kept.groupBy(F.col(key).alias("_key")).agg(*(F.bool_or(p.mask()).alias(p.name) for p in flags))
    audited = outcomes.select(F.col(key).alias("_audited"), genuine.mask().alias("_genuine"))
    both = audited.join(per, F.col("_audited") == F.col("_key"), "left")
    names = [p.name for p in flags]
    any_ = F.greatest(*(F.col(n) for n in names)) if len(names) > 1 else F.col(names[0])
    one = F.explode(F.array(*(F.struct(F.lit(n).alias("flag"), x.alias("on")) for n, x in [*((n, F.col(n)) for n in names), ("any_flag", any_)])))
    here, on, bad = F.col("_key").isNotNull(), F.col("e.on"), F.col("_genuine")
    out = both.select("_key", "_genuine", one.alias("e")).groupBy(F.col("e.flag").alias("flag")).agg(
        F.count("*").alias("audited"), F.count_if(here).alias("in_corpus"), F.count_if(here & on).alias("flagged"), F.count_if(here & on & bad).alias("caught"), F.count_if(here & bad).alias("genuine_total"),
    )
    return out.withColumn("precision", F.col("caught") / F.nullif(F.col("flagged"), F.lit(0)))

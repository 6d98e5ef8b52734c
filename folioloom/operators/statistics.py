"""Agreement, intervals and resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair_agreement(df: DataFrame, unit: str, run: str, value: str) -> DataFrame:
    """(run_a, run_b, agreement): share of units on which two runs agree; nulls agree with nulls."""
    left, right = df.select(unit, F.col(run).alias("run_a"), F.col(value).alias("a")), df.select(unit, F.col(run).alias("run_b"), F.col(value).alias("b"))
    both = left.join(right, unit).where("run_a < run_b")
    return both.groupBy("run_a", "run_b").agg(F.avg(F.col("a").eqNullSafe(F.col("b")).cast("double")).alias("agreement"), F.count("*").alias("n"))


def alpha_nominal(df: DataFrame, unit: str, value: str) -> DataFrame:
    """Krippendorff's alpha for nominal values, one row; 1 where only one value occurs."""
    counts = df.where(F.col(value).isNotNull()).groupBy(unit, value).agg(F.count("*").alias("c"))
    units = counts.groupBy(unit).agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s2")).where("m > 1")
    # Sum over unlike pairs of a unit is m^2 - sum of squares.
    observed = units.agg(F.sum((F.col("m") * F.col("m") - F.col("s2")) / (F.col("m") - 1)).alias("obs"), F.sum("m").alias("n"))
    totals = counts.join(units.select(unit), unit, "left_semi").groupBy(value).agg(F.sum("c").alias("t"))
    expected = totals.agg(F.sum(F.col("t") * F.col("t")).alias("t2"), F.count("*").alias("labels"))
    return observed.crossJoin(expected).select(
        F.when(F.col("labels") <= 1, F.lit(1.0)).otherwise(1 - F.col("obs") * (F.col("n") - 1) / (F.col("n") * F.col("n") - F.col("t2"))).alias("alpha"), F.col("n").cast("long").alias("n_ratings")
    )


def alpha_text(df: DataFrame, by: str, run: str, position: str, text: str) -> DataFrame:
    """(by, alpha, n_runs, n_positions): for each document, alpha of its runs with squared normalised Levenshtein distance.

    Only the positions 0, 1, ... that all runs of the document have are compared. Pairs within a position are what was
    observed, pairs over all values of the document what was to be expected; a pair of distinct texts is compared once
    and counts as often as its texts occur, and pairs are made within a document only. Null texts are empty; alpha is 1
    where nothing differs or no position is shared, and null for a single run.
    """
    from .matching import spread_of, text_edits

    # As a struct the key is never null. Texts are dealt by number, as few bytes stand for much work here.
    spread = spread_of(df)
    rows = df.select(F.struct(F.col(by).alias("v")).alias("doc"), F.col(run).alias("run"), F.col(position).alias("p"), F.coalesce(text, F.lit("")).alias("t"))
    sizes = rows.groupBy("doc", "run").agg(F.count("*").alias("k"))
    least = sizes.groupBy("doc").agg(F.min("k").alias("k"), F.count("*").alias("r"))
    kept = rows.join(least, "doc").where(F.col("p") < F.col("k"))
    places = kept.groupBy("doc", "t", "p").agg(F.count("*").alias("c"))
    texts = places.groupBy("doc", "t").agg(F.sum("c").alias("c"), F.map_from_entries(F.collect_list(F.struct("p", "c"))).alias("at")).repartition(spread, "doc")
    one, two = (texts.select("doc", *(F.col(x).alias(f"{x}{side}") for x in ("t", "c", "at"))) for side in "ab")
    pairs = one.join(two, "doc").where(F.col("ta") < F.col("tb"))
    together = F.aggregate(F.map_keys("ata"), F.lit(0).cast("long"), lambda s, p: s + F.col("ata")[p] * F.coalesce(F.try_element_at("atb", p), F.lit(0)))
    pairs = pairs.withColumn("edits", text_edits(F.lower("ta"), F.lower("tb")))
    d = 2 * F.pow(F.col("edits") / F.greatest(F.length("ta"), F.length("tb")), 2.0)  # either way round; one of the two is longer than 0
    sums = pairs.select("doc", d.alias("d"), together.alias("both"), (F.col("ca") * F.col("cb")).alias("all"))
    sums = sums.groupBy("doc").agg(F.sum(F.col("d") * F.col("both")).alias("obs"), F.sum(F.col("d") * F.col("all")).alias("every"))
    n = F.col("k") * F.col("r")
    alpha = F.when(F.coalesce("every", F.lit(0.0)) == 0, F.lit(1.0)).otherwise(1 - F.col("obs") / F.nullif(F.col("r") - 1, F.lit(0)) * (n - 1) / F.col("every"))
    return least.join(sums, "doc", "left").select(F.col("doc.v").alias(by), F.when(F.col("r") > 1, alpha).alias("alpha"), F.col("r").alias("n_runs"), F.col("k").alias("n_positions"))


def reverse_agreement(df: DataFrame, pair: list[str], reverse: str) -> DataFrame:
    """(agreement, n_agree, n_pairs): pairs seen in any run of which the keying never differs."""
    same = (F.countDistinct(F.coalesce(reverse, F.lit(False))) <= 1).cast("long")
    pairs = df.groupBy(*pair).agg(same.alias("same"))
    return pairs.agg(F.avg("same").alias("agreement"), F.sum("same").alias("n_agree"), F.count("*").alias("n_pairs"))


def icc21(df: DataFrame, subject: str, rater: str, value: str) -> DataFrame:
    """ICC(2,1) of a complete table, from the mean squares of rows, columns and error."""
    grand = df.agg(F.avg(value).alias("g"), F.countDistinct(subject).alias("n"), F.countDistinct(rater).alias("k"))
    rows = df.groupBy(subject).agg(F.avg(value).alias("m"))
    cols = df.groupBy(rater).agg(F.avg(value).alias("m"))
    g = grand.first()  # three numbers
    ss_rows = rows.agg(F.sum(F.pow(F.col("m") - F.lit(g["g"]), 2.0)).alias("r"))
    ss_cols = cols.agg(F.sum(F.pow(F.col("m") - F.lit(g["g"]), 2.0)).alias("c"))
    ss_all = df.agg(F.sum(F.pow(F.col(value) - F.lit(g["g"]), 2.0)).alias("t"))
    n, k = float(g["n"]), float(g["k"])
    r, c, t = F.col("r") * k, F.col("c") * n, F.col("t")
    msr, msc, mse = r / (n - 1), c / (k - 1), (t - r - c) / ((n - 1) * (k - 1))
    return ss_rows.crossJoin(ss_cols).crossJoin(ss_all).select(((msr - mse) / (msr + (k - 1) * mse + k * (msc - mse) / n)).alias("icc"))


def run_spread(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, n_runs, mean, sd, least, largest, text) of a value over the runs of each document: SD over all runs (not n - 1),
    and ``M ± SD [least, largest]`` with two digits."""
    out = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n_runs"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.min(value).alias("least"), F.max(value).alias("largest"))
    two = lambda c: F.format_number(c, 2)
    return out.withColumn("text", F.concat(two("mean"), F.lit(" ± "), two("sd"), F.lit(" ["), two("least"), F.lit(", "), two("largest"), F.lit("]")))


def wilson(k: Column, n: Column, z: float = 1.959964) -> Column:
    """struct(low, high); null for n = 0."""
    p = k / F.nullif(n, F.lit(0))
    centre, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.struct(((centre - spread) / (1 + z * z / n)).alias("low"), ((centre + spread) / (1 + z * z / n)).alias("high"))


def fit_of(x: Column, y: Column) -> list[Column]:
    """r, rmse, mae and largest absolute difference of pairs."""
    return [F.corr(x, y).alias("r"), F.sqrt(F.avg(F.pow(x - y, 2.0))).alias("rmse"), F.avg(F.abs(x - y)).alias("mae"), F.max(F.abs(x - y)).alias("largest")]


def draw(*parts: Column) -> Column:
    """A number from 0 to 2**32 - 1 that depends on the parts only: the same draw in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def cluster_weights(clusters: DataFrame, key: str, reps: int) -> DataFrame:
    """(rep, key, w): how often each cluster is drawn, with replacement, in each of ``reps`` resamples.

    Draws pick places; places are dealt to clusters by row number over the (bounded) list of clusters.
    """
    numbered = clusters.select(key).distinct().withColumn("place", (F.row_number().over(Window.orderBy(key)) - 1).cast("long"))
    n = numbered.count()
    draws = numbered.select(F.col("place").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
    picked = draws.select("rep", (draw(F.col("rep"), F.col("slot")) % max(n, 1)).alias("place")).groupBy("rep", "place").agg(F.count("*").alias("w"))
    return picked.join(F.broadcast(numbered), "place").select(F.col("rep").cast("long").alias("rep"), key, "w")


def weighted_correlation(w: Column, x: Column, y: Column) -> Column:
    """Pearson's r with weights, from weighted sums."""
    sw, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * y)
    cov = F.sum(w * x * y) - sx * sy / sw
    return cov / F.sqrt((F.sum(w * x * x) - sx * sx / sw) * (F.sum(w * y * y) - sy * sy / sw))


def bootstrap_correlation(pairs: DataFrame, clusters: DataFrame, key: str, a: str, b: str, x: str, y: str, reps: int) -> DataFrame:
    """(rep, r): correlations over pairs of units whose clusters are resampled; a pair weighs the product of its
    clusters' draws, and pairs within one cluster count only where that cluster itself is a pair's both ends once."""
    weights = cluster_weights(clusters, key, reps)
    left, right = weights.select("rep", F.col(key).alias(a), F.col("w").alias("wa")), weights.select("rep", F.col(key).alias(b), F.col("w").alias("wb"))
    joined = pairs.join(left, a).join(right, ["rep", b])
    return joined.groupBy("rep").agg(weighted_correlation((F.col("wa") * F.col("wb")).cast("double"), F.col(x), F.col(y)).alias("r"))


def compression(observed: Column, predicted: Column, error: Column) -> list[Column]:
    """SD of the observed corrected for their error, SD of the predicted, and the slope of one on the other."""
    return [F.sqrt(F.greatest(F.var_samp(observed) - F.avg(F.pow(error, 2.0)), F.lit(0.0))).alias("sd_true"), F.stddev_samp(predicted).alias("sd_predicted"), F.regr_slope(observed, predicted).alias("slope")]


def shown_at(df: DataFrame, truth: str, value: str, strong: float, cutoffs: list[float]) -> DataFrame:
    """(cutoff, share, n): of the rows whose truth is at least ``strong``, the share shown at each cutoff."""
    rows = df.where(F.abs(truth) >= strong).select(F.abs(value).alias("v"), F.explode(F.array(*map(F.lit, cutoffs))).alias("cutoff"))
    return rows.groupBy("cutoff").agg(F.avg((F.col("v") >= F.col("cutoff")).cast("double")).alias("share"), F.count("*").alias("n"))


def hashed_subsets(df: DataFrame, group: str, item: str, size: int, draws: int) -> DataFrame:
    """(group, draw, items): subsets of ``size`` items of each group, in an order drawn by hash."""
    rows = df.select(group, item, F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(group, "draw").orderBy(draw(F.col("draw"), F.col(group), F.col(item)), item))).where(F.col("_n") <= size)
    return ranked.groupBy(group, F.col("draw").cast("long").alias("draw")).agg(F.sort_array(F.collect_list(item)).alias("items"))

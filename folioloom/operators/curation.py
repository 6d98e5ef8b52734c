"""Filters with attrition, three-valued flags, and repairs that look at whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trimmed

ITEM_CHARS = 250  # longest item text that is kept
TEXT_DEVIATION = 0.05  # largest near-verbatim distance
LAYER_CHARS, LAYER_CHARS_A_PAGE = 200, 500  # a text layer with fewer can't be checked
MAIN_SOURCE = "apa-psyctests"  # fixed value: the source whose empty fields drop a row


def attrition_counts(filters: dict[str, Column]) -> list[Column]:
    """Aggregates i0, n0, i1, ...: what each filter alone hits, and what it adds to those before it. Null masks don't hit."""
    masks = [F.coalesce(mask, F.lit(False)) for mask in filters.values()]
    hit = F.coalesce(*[F.when(m, i) for i, m in enumerate(masks)])
    return [c for i, m in enumerate(masks) for c in (F.count_if(m).alias(f"i{i}"), F.count_if(hit.eqNullSafe(F.lit(i))).alias(f"n{i}"))]


def attrition(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(step, name, isolated, new, cumulative): what each filter alone hits, adds to those before it, and all so far.

    One pass: all masks are counted in one aggregate; null masks don't hit.
    """
    counts = df.agg(*attrition_counts(filters))
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("step"), F.lit(name).alias("name"), F.col(f"i{i}").alias("isolated"), F.col(f"n{i}").alias("new"), sum((F.col(f"n{j}") for j in range(i + 1)), F.lit(0).cast("long")).alias("cumulative")) for i, name in enumerate(filters)])
    return counts.select(F.inline(rows))


def surviving(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Rows that no filter hits."""
    keep = F.lit(True)
    for mask in filters.values():
        keep = keep & ~F.coalesce(mask, F.lit(False))
    return df.where(keep)


def source_filters(columns: list[str]) -> dict[str, Column]:
    """The registry of placement filters, in order; filters whose columns are absent are left out."""
    c = F.col
    main = c("corpus_source").eqNullSafe(MAIN_SOURCE) if "corpus_source" in columns else F.lit(True)
    text = trimmed(c("item_item_text"))
    registry = {
        "extraction_error": ("has_errors", F.coalesce(c("has_errors"), F.lit(False))),
        "null_bucket": ("bucket", c("bucket").isNull()),
        "non_rating_scale": ("item_item_type", c("item_item_type").isNotNull() & (c("item_item_type") != "rating_scale")),
        "empty_item_text": ("item_item_text", F.coalesce(text, F.lit("")) == ""),
        "long_item_text": ("item_item_text", F.length(text) > ITEM_CHARS),
        "has_image": ("item_has_image", F.coalesce(c("item_has_image"), F.lit(False))),
        "sample_version": ("is_sample_version", F.coalesce(c("is_sample_version"), F.lit(False))),
        "unscaled_bucket": ("bucket", c("bucket").eqNullSafe("unscaled")),
        "intake_form": ("meta_intake_form", F.coalesce(c("meta_intake_form"), main)),
        "objective_measure": ("meta_objective_measure", F.coalesce(c("meta_objective_measure"), F.lit(False))),
    }
    return {name: mask for name, (needs, mask) in registry.items() if needs in columns}


def with_observed(df: DataFrame, key: str, counted: dict[str, str]) -> DataFrame:
    """Adds the distinct counts of columns within ``key`` ({new: counted}); null where the key is."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.countDistinct(c).alias(n) for n, c in counted.items()])
    return df.join(counts, key, "left")


def deviates(observed: Column, reference: Column, applies: Column, zero_is_missing: bool = False) -> Column:
    """Three-valued: true or false where the flag applies and both sides are there, else null."""
    return F.when(applies, observed != (F.nullif(reference, F.lit(0)) if zero_is_missing else reference))


def text_deviates(distance: Column, checkable: Column) -> Column:
    """Null where the text can't be checked; a NaN distance is no distance."""
    known = F.when(~F.isnan(distance), distance)
    return F.when(F.coalesce(checkable, F.lit(True)), known > TEXT_DEVIATION)


def translated(lang: Column) -> Column:
    return F.nullif(F.lower(trimmed(lang)), F.lit("")) != "en"


def checkable(chars: Column, pages: Column, images: Column) -> Column:
    """Whether a text layer can show the items: long enough, and not a set of page images. Null without a layer."""
    body = pages - 1
    image_only = (body > 0) & (images - pages >= body) & (chars / F.nullif(body, F.lit(0)) < LAYER_CHARS_A_PAGE)
    return F.when(chars.isNotNull(), (chars >= LAYER_CHARS) & ~F.coalesce(image_only, F.lit(False)))


def without_copies(df: DataFrame, path: str) -> DataFrame:
    """Drops ``name (2).ext`` where ``name.ext`` is there too. Rows that are no copy by their name, nearly all, join nothing."""
    stem, ending = F.regexp_extract(path, r"^(.+) \([0-9]+\)(\.[A-Za-z0-9]+)\z", 1), F.regexp_extract(path, r"^(.+) \([0-9]+\)(\.[A-Za-z0-9]+)\z", 2)
    original = F.when(ending != "", F.concat(stem, ending))
    marked = df.withColumn("_original", original)
    wanted = marked.select("_original").where("_original is not null").distinct()
    known = df.join(wanted, df[path] == wanted["_original"], "left_semi").select(F.col(path).alias("_path")).distinct()
    copies = marked.where("_original is not null").join(known, F.col("_original") == F.col("_path"), "left_anti")
    return marked.where("_original is null").unionByName(copies).drop("_original")


def propagate(df: DataFrame, key: str, column: str) -> DataFrame:
    """Fills nulls of a column with its group's one value; groups with none or several stay."""
    values = df.groupBy(key).agg(F.min(column).alias("_v"), F.countDistinct(column).alias("_n")).where("_n = 1").select(key, "_v")
    return df.join(values, key, "left").withColumn(column, F.coalesce(column, "_v")).drop("_v")


def null_constants(df: DataFrame, source: str, constants: list[tuple[str, str, object]]) -> DataFrame:
    """Nulls (source, column, constant) fills, but only where the source's column holds that constant alone. All are
    looked at in one aggregate."""
    known = [(n, c, v) for n, c, v in constants if c in df.columns]
    if not known:
        return df
    own = [F.when(F.col(source).eqNullSafe(n), F.col(c)) for n, c, _ in known]
    seen = df.agg(*[F.coalesce((F.min(x) == F.lit(v)) & (F.max(x) == F.lit(v)), F.lit(False)).alias(f"c{i}") for i, (x, (_, _, v)) in enumerate(zip(own, known, strict=True))]).first()
    for i, (name, column, _) in enumerate(known):
        if seen[f"c{i}"]:
            df = df.withColumn(column, F.when(~F.col(source).eqNullSafe(name), F.col(column)))
    return df


def empty_to_null(x: Column) -> Column:
    """An empty list as null."""
    return F.when(F.size(x) > 0, x)


ROWS_A_TASK = 500_000


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by keys over so many tasks that each has ROWS_A_TASK rows or so, however few the session's partitions."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks, *keys)


def renumbered(df: DataFrame, doc: str, item: str, cluster: str, order: str, out: str = "new_id") -> DataFrame:
    """New ids 1, 2, ... by first appearance of (id, cluster) in documents where an id has several clusters. Rows are dealt
    by document once, over as many tasks as their number needs; all else happens within a task."""
    several = F.min(cluster).over(Window.partitionBy(doc, item)) < F.max(cluster).over(Window.partitionBy(doc, item))
    first = F.min(order).over(Window.partitionBy(doc, item, cluster))
    marked = spread_by(df, doc).withColumn("_first", first).withColumn("_several", F.col(item).isNotNull() & several)
    ranked = marked.withColumn("_affected", F.bool_or("_several").over(Window.partitionBy(doc)))
    ranked = ranked.withColumn("_rank", F.dense_rank().over(Window.partitionBy(doc).orderBy("_first")).cast("long"))
    named = F.col("_rank")
    for c in (item, cluster):
        named = F.when(F.col(c).isNotNull(), named)
    return ranked.withColumn(out, F.when(F.col("_affected") & F.col(doc).isNotNull(), named).otherwise(F.col(item))).drop("_first", "_several", "_affected", "_rank")


def changed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, changed): rows of ``after`` in which any value differs from ``before``; new columns count where not null."""
    shared = [c for c in after.columns if c in before.columns and c != key]
    fresh = [c for c in after.columns if c not in before.columns]
    old = before.select(key, *[F.col(c).alias(f"_old_{c}") for c in shared])
    differs = F.lit(False)
    for c in shared:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    for c in fresh:
        differs = differs | F.col(c).isNotNull()
    return after.join(old, key, "left").select(key, differs.alias("changed"))

"""The descriptive report: a list of sections, each of queries and text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import render, report

Section = Callable[[DataFrame], list[str]]


def structure(df: DataFrame) -> list[str]:
    """Counts by source and in total."""
    counts = report.structure_counts(df, "corpus_source", "path", "item_item_id", "scale_id", "scale_id_path").orderBy("source")
    return ["## Structure", *render.frame_table(counts)]


def items_per_document(df: DataFrame) -> list[str]:
    n = report.per_unit(df.select("path").distinct(), df, ["path"], F.col("item_item_id"))
    return ["## Items per document", *render.frame_table(report.distribution(n, "n"))]


def nesting(df: DataFrame) -> list[str]:
    depth = df.groupBy("path").agg(F.max(F.greatest(F.coalesce(F.size("scale_id_path"), F.lit(0)), F.lit(0))).alias("depth"))
    return ["## Nesting", *render.frame_table(report.levels(depth, "depth").orderBy("level"))]


def buckets(df: DataFrame) -> list[str]:
    """Rows by source and bucket, empty combinations as 0."""
    wide = df.where("corpus_source is not null").groupBy("corpus_source").pivot("bucket", ["scaled", "orphan", "unscaled", None]).count().na.fill(0)
    return ["## Buckets", *render.frame_table(wide.withColumnRenamed("null", "(null)").orderBy("corpus_source"))]


def languages(df: DataFrame) -> list[str]:
    return ["## Languages", *render.frame_table(report.value_counts(df.select("path", "item_language").distinct(), "item_language"))]


SECTIONS: list[tuple[str, set[str], Section]] = [
    ("structure", {"corpus_source", "path", "item_item_id", "scale_id", "scale_id_path"}, structure),
    ("items_per_document", {"path", "item_item_id"}, items_per_document),
    ("nesting", {"path", "scale_id_path"}, nesting),
    ("buckets", {"corpus_source", "bucket"}, buckets),
    ("languages", {"path", "item_language"}, languages),
]


def describe(df: DataFrame, stats: dict | None = None) -> list[str]:
    """All sections whose columns the corpus has; counters of the run at the end."""
    out = []
    for _, needs, section in SECTIONS:
        if needs <= set(df.columns):
            out += [*section(df), ""]
    if stats:
        out += ["## Counters", *render.markdown_table(["counter", "value"], render.flattened(stats))]
    return out

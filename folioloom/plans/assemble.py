"""The build of a corpus: named steps in a fixed order, with counters.

A step turns a frame of placements into another and leaves out what it has no columns for. Counters are observed
while the result is worked out (``DataFrame.observe``), so counting costs no run of its own; they are there once an
action on the result has ended. (Write the result before it is sorted: sampling for a sort reads the rows, and counts
them, once more.) What lies outside (page texts, record files, verdicts on lookups, a detector of languages,
reference records) comes in as tables or functions of the context, and a step without its table does nothing.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, NullType, StringType

from ..functions import biblio, language, text
from ..operators import curation, matching, versions
from ..session import ensure_checkpoint_dir
from .base import table

#: Endings of telemetry columns, and other columns that a release has no use for.
TELEMETRY = (
    "timestamp", "error", "total_duration", "prompt_eval_count", "eval_count", "image_tokens", "system_tokens", "user_text_tokens",
    "ttft", "prefill_ms", "predicted_ms", "prompt_per_second", "predicted_per_second", "cached_tokens", "draft_acceptance", "thinking_chars",
    "attempts",
)
INTERNAL = ("has_errors", "total_duration", "meta_doi_raw", "meta_char_count_excl_first_page", "source_grade", "extraction_confidence", "verify_verdict", "verbatim_claimed", "retrieval_notes")
SHAPE = ("meta_page_count", "meta_image_count")
#: Columns of whole numbers, of sentinels and of names.
WHOLE = ("item_item_id", "meta_publication_year_raw", "scale_id", "scale_depth", "meta_page_count", "meta_image_count", "meta_char_count_excl_first_page")
SENTINEL = ("item_item_text", "item_admin_note", "item_language", "meta_title_raw", "scale_name", "scale_construct_name", "meta_permissions_raw")
VERSIONED, TITLED = ("scale_name", "meta_title_raw"), ("scale_name", "scale_construct_name", "meta_title_raw")
#: Constants that scrapers filled in, and the sources whose items are rating scales by default.
CONSTANTS = [
    ("semanticnet", "source_grade", "semanticnet"),
    ("semanticnet", "version", "semanticnet (version/form not recorded)"),
    ("aligns", "extraction_confidence", "medium"),
    ("semanticnet", "extraction_confidence", "medium"),
    ("aligns", "verbatim_claimed", True),
    ("semanticnet", "verbatim_claimed", True),
]
RATING_SOURCES = ("aligns", "semanticnet")
BROKEN_SOURCE, PLACEHOLDER_SOURCE = "semanticnet", "(replace with real citation)"
DETECTED_TEXTS, DETECTED_CHARS, DETECTED_LEAST = 30, 2000, 40  # of a document's texts: what a detector sees


@dataclass
class Context:
    """Lines, counters and outside tables of a run."""

    lines: list[str] = field(default_factory=list)
    known: dict[str, object] = field(default_factory=dict)
    write: bool = True
    pages: DataFrame | None = None  # (path, first_page, body)
    record_files: DataFrame | None = None  # (file, doi)
    verdicts: DataFrame | None = None  # (doc, doi, authors, year, venue): accepted lookups by document
    probes: DataFrame | None = None  # (stem, doi): accepted proposals by file stem
    records: DataFrame | None = None  # (doi, record_item_count, record_scale_count)
    detect: Callable[[pd.Series], pd.Series] | None = None  # texts -> two-letter codes or None
    order: str | None = None  # the column of the rows' order, where first appearance counts
    observed: list[tuple[Observation, Callable[[dict], None]]] = field(default_factory=list)

    def log(self, line: str) -> None:
        self.lines.append(line)

    def stat(self, key: str, value) -> None:
        self.known[key] = value

    def count(self, df: DataFrame, step: str, **counters: Column) -> DataFrame:
        """``df``, whose rows are counted while it is worked out: counters ``step.name``."""
        return self.watch(df, [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()], lambda got: [self.stat(f"{step}.{n}", v) for n, v in got.items()])

    def watch(self, df: DataFrame, aggregates: list[Column], tell: Callable[[dict], object]) -> DataFrame:
        if not self.write or not aggregates:
            return df
        seen = Observation()
        self.observed.append((seen, tell))
        return df.observe(seen, *aggregates)

    @property
    def stats(self) -> dict[str, object]:
        """The counters of all that has been worked out so far."""
        ended = [seen._jo.future().isCompleted() for seen, _ in self.observed]  # asking for one that has not would wait for it
        for (seen, tell), done in zip(self.observed, ended, strict=True):
            if done:
                tell(seen.get)
        self.observed = [x for x, done in zip(self.observed, ended, strict=True) if not done]
        return self.known


Step = Callable[[DataFrame, Context], DataFrame]


def main(df: DataFrame) -> Column:
    """Rows of the main source; all of an untagged frame."""
    return F.col("corpus_source").eqNullSafe(curation.MAIN_SOURCE) if "corpus_source" in df.columns else F.lit(True)


def partial(df: DataFrame) -> Column:
    """Rows of the other sources; all of an untagged frame."""
    return F.col("corpus_source").isNotNull() & ~main(df) if "corpus_source" in df.columns else F.lit(True)


def document(df: DataFrame) -> Column:
    """What names a row's document: its path, else its source and title."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")) if c in df.columns else F.lit("?")
    other = F.concat(F.lit("doc::"), given("corpus_source"), F.lit("::"), given("meta_title_raw"))
    return F.coalesce(F.col("path"), other) if "path" in df.columns else other


def _changed(df: DataFrame, column: str, value: Column, where: Column | None = None) -> DataFrame:
    return df.withColumn(column, value if where is None else F.when(where, value).otherwise(F.col(column)))


def _has(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


# Repair
# ------


def duplicate_files(df: DataFrame, ctx: Context) -> DataFrame:
    """Copies that a system made of a file go where the file is there too."""
    return curation.without_copies(df, "path") if _has(df, "path") else df


def schema(df: DataFrame, ctx: Context) -> DataFrame:
    """Blank cells of all text columns become null; numbers that are whole all through become integers; identifiers are text."""
    if not _has(df, "meta_source_doi"):
        df = df.withColumn("meta_source_doi", F.lit(None).cast("string"))
    kinds = {f.name: f.dataType for f in df.schema}
    floats = [c for c in WHOLE if isinstance(kinds.get(c), DoubleType | FloatType)]
    whole = df.agg(*[F.coalesce(F.bool_and(F.col(c) % 1 == 0), F.lit(True)).alias(c) for c in floats]).first().asDict() if floats else {}

    def cell(name: str) -> Column:
        c = F.col(name)
        if isinstance(kinds[name], StringType):
            return text.blank_to_null(c).alias(name)
        if whole.get(name):
            return c.cast("long").alias(name)
        if name in ("meta_doi_raw", "meta_source_doi") and isinstance(kinds[name], DoubleType | FloatType | NullType):
            return c.cast("string").alias(name)
        return c

    blank = sum((F.when(F.col(f.name).isNotNull() & text.blank_to_null(F.col(f.name)).isNull(), 1).otherwise(0) for f in df.schema if isinstance(f.dataType, StringType)), F.lit(0))
    df = ctx.watch(df, [F.sum(blank).alias("n")], lambda got: ctx.stat("schema.blank_cells", got["n"] or 0))
    return df.select(*map(cell, df.columns))


def text_repair(df: DataFrame, ctx: Context) -> DataFrame:
    """Sentinels, broken characters, source remarks, escapes and placeholders."""
    for c in SENTINEL:
        if _has(df, c):
            df = _changed(df, c, text.sentinel_to_null(F.col(c)))
    if _has(df, "scale_name_path"):
        df = _changed(df, "scale_name_path", F.transform(text.sentinels_in_array(F.col("scale_name_path")), text.blank_to_null))
    if _has(df, "version_attached"):
        df = _changed(df, "version_attached", F.nullif("version_attached", F.lit("none")))
    if _has(df, "meta_source_raw"):
        for c in ("meta_source_raw", "source_url"):
            if _has(df, c, "corpus_source"):
                df = _changed(df, c, text.trimmed(text.unbroken_hyphens(F.col(c))), F.col("corpus_source").eqNullSafe(BROKEN_SOURCE))
        df = _changed(df, "meta_source_raw", text.source_remark(F.col("meta_source_raw")), main(df))
        df = _changed(df, "meta_source_raw", F.nullif("meta_source_raw", F.lit(PLACEHOLDER_SOURCE)))
    if _has(df, "retrieval_notes"):
        noted = df.withColumn("_note", F.when(partial(df), F.col("retrieval_notes")))
        df = text.all_entities(noted, "_note").withColumn("retrieval_notes", F.coalesce("_note", "retrieval_notes")).drop("_note")
    if _has(df, "item_admin_note"):
        df = _changed(df, "item_admin_note", text.newlines(F.col("item_admin_note")))
    if _has(df, "item_item_text"):
        df = _changed(df, "item_item_text", text.placeholder_to_null(text.trimmed(F.col("item_item_text"))), partial(df) & text.placeholder_to_null(text.trimmed(F.col("item_item_text"))).isNull())
    return df


def _paged(df: DataFrame, ctx: Context, column: str) -> DataFrame:
    """Adds _page, the page text of the main source's rows."""
    found = ctx.pages.select(F.col("path").alias("_path"), F.col(column).alias("_page"))
    return df.join(found, main(df) & (F.col("path") == F.col("_path")), "left").drop("_path")


def meta_dois(df: DataFrame, ctx: Context) -> DataFrame:
    """What page 1 says wins: the record's identifier and the source's."""
    if ctx.pages is None or not _has(df, "path"):
        return df
    df = _paged(df, ctx, "first_page")
    for c, value in (("meta_doi_raw", biblio.record_doi_on_page(F.col("_page"))), ("meta_source_doi", biblio.doi_in_text(F.col("_page")))):
        df = df.withColumn(c, F.coalesce(value, F.col(c)) if c in df.columns else value)
    return df.drop("_page")


def full_text(df: DataFrame, ctx: Context) -> DataFrame:
    """The body text of the main source's documents, for pdf_match."""
    if ctx.pages is None or not _has(df, "path"):
        return df
    return _paged(df.drop("pdf_full_text"), ctx, "body").withColumnRenamed("_page", "pdf_full_text")


def record_doi(df: DataFrame, ctx: Context) -> DataFrame:
    """The record's identifier: of the main source what stem, record files and page agree on, of others the stem's."""
    if not _has(df, "path"):
        return df
    none = F.lit(None).cast("string")
    file = F.regexp_replace("path", "^.*/", "")
    if ctx.record_files is not None:
        known = ctx.record_files.groupBy(F.col("file").alias("_file")).agg(F.min(F.lower("doi")).alias("_listed"))
        df = df.withColumn("_name", file).join(known, F.col("_name") == F.col("_file"), "left").drop("_name", "_file")
    else:
        df = df.withColumn("_listed", none)
    stem, own = biblio.doi_of_stem(F.col("path")), F.col("meta_doi_raw") if _has(df, "meta_doi_raw") else none
    df = df.withColumn("doi_psyctests", F.when(main(df), biblio.corroborated(stem, F.col("_listed"), own)).when(partial(df), stem))
    df = ctx.count(df, "doi_psyctests", resolved=F.col("doi_psyctests").isNotNull())
    return df.drop("_listed", "doi")


def source_fields(df: DataFrame, ctx: Context) -> DataFrame:
    """A source that is a web address moves to source_url, junk goes, a citation stays; only where the two don't differ."""
    if not _has(df, "meta_source_raw"):
        return df
    for c in ("source_url", "retrieval_notes"):
        if not _has(df, c):
            df = df.withColumn(c, F.lit(None).cast("string"))
    raw, url = F.col("meta_source_raw"), F.col("source_url")
    mine = partial(df) & raw.isNotNull() & (url.isNull() | (url == raw))
    clean = text.split_cell_repair(raw)
    df = df.withColumn("_kind", F.when(mine, biblio.source_kind(clean))).withColumn("_value", biblio.source_value(clean)).withColumn("_clean", clean)
    df = ctx.count(df, "source_fields", **{k: F.col("_kind") == k for k in ("citation", "url", "domain", "junk")})
    note = F.concat(F.lit("source_url normalized from '"), "_clean", F.lit("' [patch]"))
    notes = F.when(F.col("retrieval_notes").isNull(), note).when(F.contains("retrieval_notes", note), F.col("retrieval_notes")).otherwise(F.concat_ws("; ", "retrieval_notes", note))
    kind = F.col("_kind")
    return (
        df.withColumn("retrieval_notes", F.when(kind == "domain", notes).otherwise(F.col("retrieval_notes")))
        .withColumn("source_url", F.when(kind.isin("url", "domain"), F.col("_value")).when(kind.isNull(), url))
        .withColumn("meta_source_raw", F.when(kind == "citation", F.col("_value")).when(kind.isNull(), raw))
        .drop("_kind", "_value", "_clean")
    )


def source_doi(df: DataFrame, ctx: Context) -> DataFrame:
    """Null source identifiers from the citation's text, then from the address."""
    if not _has(df, "meta_source_doi"):
        df = df.withColumn("meta_source_doi", F.lit(None).cast("string"))
    found = [biblio.doi_in_text(F.col("meta_source_raw"))] if _has(df, "meta_source_raw") else []
    found += [biblio.doi_in_url(F.col("source_url"))] if _has(df, "source_url") else []
    return df.withColumn("meta_source_doi", F.coalesce("meta_source_doi", *found))


def _fill_documents(df: DataFrame, found: DataFrame, fills: dict[str, str], wanted: Column) -> DataFrame:
    """Fills null cells of the rows of ``wanted`` documents; ``found`` is (_doc, values by column); ``fills`` maps its
    columns to the frame's, which must be of partial rows but for the first."""
    joined = df.join(found, (F.col("_doc") == F.col("_key")) & wanted, "left").drop("_key")
    for n, (value, column) in enumerate(fills.items()):
        if column in df.columns:
            fit = F.lit(True) if n == 0 else partial(df)
            joined = joined.withColumn(column, F.coalesce(column, F.when(fit, F.col(value).cast(df.schema[column].dataType))))
    return joined.drop(*fills)


def lookups(df: DataFrame, ctx: Context) -> DataFrame:
    """A document's one source identifier for all its rows; accepted verdicts for documents that have none at all."""
    if not _has(df, "meta_source_doi"):
        return df
    df = curation.spread_by(df.withColumn("_doc", document(df)), "_doc")
    seen = df.groupBy("_doc").agg(F.min("meta_source_doi").alias("_one"), (F.min("meta_source_doi") == F.max("meta_source_doi")).alias("_same"))
    df = df.join(seen, "_doc").withColumn("meta_source_doi", F.coalesce("meta_source_doi", F.when(F.col("_same"), F.col("_one"))))
    if ctx.verdicts is not None:
        names = {"doi": "meta_source_doi", "authors": "meta_authors_raw", "year": "meta_publication_year_raw", "venue": "meta_journal_venue_raw"}
        found = ctx.verdicts.where("doi is not null").groupBy(F.col("doc").alias("_key")).agg(*[F.first(c).alias(f"_v_{c}") for c in names if c in ctx.verdicts.columns])
        df = _fill_documents(df, found, {f"_v_{c}": n for c, n in names.items() if c in ctx.verdicts.columns}, F.col("_one").isNull())
    return df.drop("_doc", "_one", "_same")


def proposals(df: DataFrame, ctx: Context) -> DataFrame:
    """Accepted proposals for partial documents without a source identifier, by the file's stem."""
    if ctx.probes is None or not _has(df, "path", "meta_source_doi"):
        return df
    stem = F.regexp_replace(F.regexp_replace("path", "^.*/", ""), r"\.[^.]*$", "")
    df = df.withColumn("_doc", stem)
    empty = df.groupBy("_doc").agg(F.max("meta_source_doi").alias("_one"))
    df = df.join(empty, df["_doc"].eqNullSafe(empty["_doc"]), "left").drop(empty["_doc"])
    found = ctx.probes.where("doi is not null").groupBy(F.col("stem").alias("_key")).agg(F.first("doi").alias("_v_doi"))
    return _fill_documents(df, found, {"_v_doi": "meta_source_doi"}, partial(df) & F.col("_one").isNull()).drop("_doc", "_one")


def languages(df: DataFrame, ctx: Context) -> DataFrame:
    """Codes of languages: copied fills go, names become codes, titles tell, a detector fills what is left of documents that
    it doesn't contradict, and partial documents are English by default."""
    for c in ("meta_language", "meta_language_raw", "item_language"):
        if not _has(df, c):
            df = df.withColumn(c, F.lit(None).cast("string"))
    pm = partial(df)
    df = _changed(df, "meta_language_raw", F.lit(None).cast("string"), pm & (F.col("meta_language_raw") == F.col("meta_language")))
    for c in ("meta_language", "item_language"):
        df = _changed(df, c, language.language_code(F.col(c)), ~F.coalesce(F.col(c).rlike(r"^[a-z]{2}\z"), F.lit(False)))
    if _has(df, "meta_title_raw"):
        told = pm & language.language_in_title(F.col("meta_title_raw")).isNotNull()
        raw, code = language.version_in_title(F.col("meta_title_raw")), language.language_in_title(F.col("meta_title_raw"))
        df = df.withColumn("meta_language_raw", F.when(told, raw).otherwise(F.col("meta_language_raw"))).withColumn("meta_language", F.when(told, code).otherwise(F.col("meta_language")))
    if ctx.detect is not None and _has(df, "item_item_text"):
        df = _detected(df, ctx)
    return _changed(df, "meta_language", F.coalesce("meta_language", F.lit("en")), pm)


def _detected(df: DataFrame, ctx: Context) -> DataFrame:
    detect = ctx.detect
    df = df.withColumn("_doc", document(df))
    place = F.struct(*[F.col(c) for c in (ctx.order, "item_item_id", "item_item_text") if c and c in df.columns])
    texts = F.slice(F.array_sort(F.collect_list(F.when(F.col("item_item_text").isNotNull(), place))), 1, DETECTED_TEXTS)
    said = F.array_union(F.collect_set("meta_language"), F.collect_set("item_language"))
    lacks = F.bool_or(F.col("item_language").isNull() | F.col("meta_language").isNull())
    docs = df.groupBy("_doc").agg(F.substring(F.array_join(F.transform(texts, lambda t: t["item_item_text"]), " "), 1, DETECTED_CHARS).alias("_text"), said.alias("_said"), lacks.alias("_lacks"))
    asked = docs.where(F.col("_lacks") & (F.length("_text") >= DETECTED_LEAST))

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_doc"], "_code": detect(batch["_text"]), "_said": batch["_said"]})

    found = asked.select("_doc", "_text", "_said").mapInPandas(run, "_key string, _code string, _said array<string>")
    kept = found.where((F.size("_said") == 0) | F.array_contains("_said", F.col("_code"))).select("_key", "_code")
    joined = df.join(kept, F.col("_doc") == F.col("_key"), "left")
    return joined.withColumn("item_language", F.coalesce("item_language", "_code")).withColumn("meta_language", F.coalesce("meta_language", "_code")).drop("_doc", "_key", "_code")


def permissions(df: DataFrame, ctx: Context) -> DataFrame:
    if not _has(df, "meta_permissions_raw"):
        return df
    df = _changed(df, "meta_permissions_raw", language.with_full_stop(F.col("meta_permissions_raw")), partial(df))
    return df.withColumn("permissions_category", language.permission_category(F.col("meta_permissions_raw")))


def fabricated(df: DataFrame, ctx: Context) -> DataFrame:
    """Constants that a source filled in all through go."""
    return curation.null_constants(df, "corpus_source", CONSTANTS) if _has(df, "corpus_source") else df


def item_type(df: DataFrame, ctx: Context) -> DataFrame:
    if not _has(df, "corpus_source", "item_item_type"):
        return df
    return _changed(df, "item_item_type", F.coalesce("item_item_type", F.lit("rating_scale")), F.coalesce(F.col("corpus_source").isin(*RATING_SOURCES), F.lit(False)))


def items(df: DataFrame, ctx: Context) -> DataFrame:
    """Empty lists go; of partial documents numbering goes from the texts, ids that start at 0 move up by one, and ids
    that several items of a document share are numbered anew. Rows without a document number stay as they are."""
    if _has(df, "item_options") and isinstance(df.schema["item_options"].dataType, ArrayType):
        df = _changed(df, "item_options", curation.empty_to_null(F.col("item_options")))
    if _has(df, "item_item_text"):
        df = _changed(df, "item_item_text", text.without_number(F.col("item_item_text")), partial(df))
    if not _has(df, "item_item_id"):
        return df
    df = curation.spread_by(df.withColumn("_doc", document(df)).withColumn("_mine", partial(df) & F.col("item_item_id").isNotNull()), "_doc")
    own = F.when(F.col("_mine"), F.col("item_item_id"))
    least = df.groupBy("_doc").agg(F.min(own).alias("_least"))
    df = df.join(least, "_doc", "left").withColumn("item_item_id", F.col("item_item_id") + F.when(F.col("_mine") & (F.col("_least") == 0), 1).otherwise(0)).drop("_least")
    return (renumbered(df, ctx) if _has(df, "item_item_text") else df).drop("_doc", "_mine")


def renumbered(df: DataFrame, ctx: Context) -> DataFrame:
    """New ids in partial documents (_doc, _mine) in which an id stands for several items: texts that are alike by nine in
    ten are one item. Documents without such an id, nearly all, pass through."""
    key = text.match_key(F.col("item_item_text"))
    several = written(df.where("_mine").groupBy("_doc", "item_item_id").agg(F.countDistinct(F.nullif(key, F.lit(""))).alias("_n")).where("_n > 1").select("_doc").distinct())
    if several.isEmpty():
        return df
    marked = df.join(several.withColumn("_hit", F.lit(True)), "_doc", "left")
    rest = marked.where("_hit is null or not _mine").drop("_hit")
    hit = written(marked.where("_hit and _mine").drop("_hit").withColumn("_key", F.nullif(key, F.lit(""))))
    order = ctx.order if ctx.order in df.columns else "_order"
    if order == "_order":  # no order of rows is given: ids, then texts
        by = [F.col(c) for c in ("scale_id", "item_item_id", "item_item_text") if c in df.columns]
        hit = hit.withColumn("_order", F.row_number().over(Window.partitionBy("_doc").orderBy(*by)))
    alike = matching.clustered(hit, ["_doc", "item_item_id"], "_key", order)
    told = alike.withColumn("cluster", F.greatest("cluster", F.lit(1)))  # a row without text keeps the id's first item
    numbered = curation.renumbered(told, "_doc", "item_item_id", "cluster", order, "_new")
    out = numbered.withColumn("item_item_id", F.col("_new").cast(df.schema["item_item_id"].dataType)).select(*rest.columns)
    return rest.unionByName(out)


def reverse_coded(df: DataFrame, ctx: Context) -> DataFrame:
    if not _has(df, "item_reverse_coded", "item_item_id"):
        return df
    return _changed(df, "item_reverse_coded", F.coalesce("item_reverse_coded", F.lit(False)), F.col("item_item_id").isNotNull())


def authors(df: DataFrame, ctx: Context) -> DataFrame:
    if not _has(df, "meta_authors_raw"):
        return df
    raw = F.col("meta_authors_raw")
    return _changed(df, "meta_authors_raw", F.coalesce(biblio.pipe_authors(raw), raw), partial(df) & raw.contains("|"))


def version_split(df: DataFrame, ctx: Context) -> DataFrame:
    names = [c for c in VERSIONED if _has(df, c)]
    if not names:
        return df
    if not _has(df, "version"):
        df = df.withColumn("version", F.lit(None).cast("string"))
    df = versions.relocate(df, names, "version")
    if not _has(df, "scale_name_path"):
        return df
    if not _has(df, "scale_id_path", "scale_id", "scale_name"):
        return _changed(df, "scale_name_path", F.transform("scale_name_path", lambda n: versions.split_version(n)["name"]))
    return versions.node_names(df.withColumn("_doc", document(df)), "_doc", "scale_id", "scale_name", "scale_id_path", "scale_name_path", "version").drop("_doc")


def title_case(df: DataFrame, ctx: Context) -> DataFrame:
    for c in TITLED:
        if _has(df, c):
            df = _changed(df, c, text.title_case(F.col(c)))
    return _changed(df, "scale_name_path", F.transform("scale_name_path", text.title_case)) if _has(df, "scale_name_path") else df


def anomalies(df: DataFrame, ctx: Context) -> DataFrame:
    """Counts what is odd and changes nothing."""
    odd = {
        "failed_shells": (("has_errors",), lambda: F.col("has_errors")),
        "null_paths": (("path",), lambda: F.col("path").isNull()),
        "options_without_text": (("item_item_text", "item_options"), lambda: F.col("item_item_text").isNull() & F.col("item_options").isNotNull()),
        "choices_without_options": (("item_item_type", "item_options"), lambda: (F.col("item_item_type") == "choice") & F.col("item_options").isNull()),
        "short_texts": (("item_item_text",), lambda: F.length(text.trimmed(F.col("item_item_text"))) <= 3),
        "leaked_paths": (("saved_files",), lambda: F.col("saved_files").rlike("^/(?:Users|home)/")),
    }
    return ctx.count(df, "anomalies", **{k: make() for k, (needs, make) in odd.items() if _has(df, *needs)})


# After the repair
# ----------------


def filter_rows(df: DataFrame, ctx: Context) -> DataFrame:
    """Counts are observed before rows go: flags are judged on what the document had."""
    if _has(df, "path"):
        df = curation.with_observed(curation.spread_by(df, "path"), "path", {n: c for n, c in (("observed_item_count", "item_item_id"), ("observed_scale_count", "scale_id")) if _has(df, c)})
    filters = curation.source_filters(df.columns)

    def tell(got: dict) -> None:
        so_far = 0
        for i, name in enumerate(filters):
            so_far += got[f"n{i}"]
            ctx.log(f"{name}: {got[f'i{i}']} alone, {got[f'n{i}']} new, {so_far} so far")
            ctx.stat(f"filter.{name}.new", got[f"n{i}"])

    return curation.surviving(ctx.watch(df, curation.attrition_counts(filters), tell), filters)


def without_telemetry(df: DataFrame, ctx: Context | None = None) -> DataFrame:
    ends = re.compile(rf"_extractor_(?:{'|'.join(TELEMETRY)})$")
    return df.drop(*[c for c in df.columns if ends.search(c) or c in INTERNAL])


def derive(df: DataFrame, ctx: Context) -> DataFrame:
    """Lengths of items, and what is published of identifiers, sources and years: of the main source the record's, of
    others the publication's where there is one."""
    if _has(df, "item_item_text"):
        df = df.withColumn("item_text_chars", F.length(text.trimmed(F.col("item_item_text"))).cast("long"))
    if not _has(df, "doi_psyctests"):
        return df
    field_ = lambda c: F.col(c).cast("string") if _has(df, c) else F.lit(None).cast("string")
    record, source = F.col("doi_psyctests"), F.nullif(field_("meta_source_doi"), F.lit(""))
    own = main(df)
    authors_, year, title, venue = map(field_, ("meta_authors_raw", "meta_publication_year_raw", "meta_title_raw", "meta_journal_venue_raw"))
    raw = F.nullif(text.trimmed(field_("meta_source_raw")), F.lit(""))
    linked = F.when(source.isNotNull() & biblio.doi_in_text(raw).isNull(), F.concat(raw, F.lit(" https://doi.org/"), source)).otherwise(raw)
    cited = F.coalesce(linked, biblio.source_citation(authors_, year, title, venue, source), biblio.record_citation(authors_, year, title, record))
    df = df.withColumn("public_doi", F.when(own, record).otherwise(F.coalesce(source, record)))
    df = df.withColumn("public_source", F.when(own, biblio.record_citation(authors_, year, title, record)).otherwise(cited))
    return df.withColumn("public_year", biblio.public_year(F.col("public_source")))


def pdf_match(df: DataFrame, ctx: Context) -> DataFrame:
    """The distance of every item from its document's text, the text's length and whether it can be checked; the text goes."""
    none = F.lit(None)
    if not _has(df, "pdf_full_text", "item_item_text"):
        df = df.withColumn("pdf_match_edit_distance", none.cast("long")).withColumn("pdf_match_edit_distance_norm", none.cast("double"))
        return df.withColumn("pdf_text_chars", none.cast("long")).withColumn("pdf_text_checkable", none.cast("boolean")).drop("pdf_full_text", *SHAPE)
    df = matching.text_distances(df, "item_item_text", "pdf_full_text", "pdf_match_edit_distance", "pdf_match_edit_distance_norm")
    df = df.withColumn("pdf_text_chars", F.length("pdf_full_text").cast("long")).drop("pdf_full_text")
    pages, images = (F.col(c).cast("double") if _has(df, c) else none.cast("double") for c in SHAPE)
    df = df.withColumn("pdf_text_checkable", curation.checkable(F.col("pdf_text_chars"), pages, images))
    return ctx.count(df, "pdf_match", measured=F.col("pdf_match_edit_distance").isNotNull(), not_checkable=~F.col("pdf_text_checkable")).drop(*SHAPE)


def _reference(df: DataFrame, ctx: Context) -> DataFrame:
    counts = ("record_item_count", "record_scale_count")
    df = df.drop(*counts)
    if ctx.records is None or not _has(df, "doi_psyctests"):
        return df.select("*", *[F.lit(None).cast("long").alias(c) for c in counts])
    known = ctx.records.groupBy(F.lower(F.trim("doi")).alias("_doi")).agg(*[F.first(c).cast("long").alias(c) for c in counts])
    return df.join(known, F.lower(F.trim("doi_psyctests")) == F.col("_doi"), "left").drop("_doi")


#: name -> what it is made of: true is a warning, null can't be checked.
FLAGS: dict[str, Callable[[DataFrame], Column | None]] = {
    "item_count_deviation": lambda df: curation.deviates(F.col("observed_item_count"), F.col("record_item_count"), main(df)) if _has(df, "observed_item_count") else None,
    "scale_count_deviation": lambda df: curation.deviates(F.col("observed_scale_count"), F.col("record_scale_count"), main(df), zero_is_missing=True) if _has(df, "observed_scale_count") else None,
    "item_text_deviation": lambda df: curation.text_deviates(F.col("pdf_match_edit_distance_norm"), F.col("pdf_text_checkable")) if _has(df, "pdf_match_edit_distance_norm", "pdf_text_checkable") else None,
    "item_translated": lambda df: curation.translated(F.col("item_language")) if _has(df, "item_language") else None,
}


def flags(df: DataFrame, ctx: Context) -> DataFrame:
    df = _reference(df, ctx)
    made = {f"flag_{name}": make(df) for name, make in FLAGS.items()}
    df = df.select("*", *[(F.lit(None).cast("boolean") if v is None else v).alias(n) for n, v in made.items()])
    return ctx.count(df, "flags", **{n: F.col(n) for n in made})


PATCH: dict[str, Step] = {
    "duplicate_files": duplicate_files, "schema": schema, "text_repair": text_repair, "meta_dois": meta_dois, "pdf_full_text": full_text,
    "doi_psyctests": record_doi, "source_fields": source_fields, "source_doi": source_doi, "crossref": lookups, "doi_probe": proposals,
    "language": languages, "permissions": permissions, "fabricated": fabricated, "item_type": item_type, "items": items,
    "reverse_coded": reverse_coded, "authors": authors, "version_split": version_split, "title_case": title_case, "anomalies": anomalies,
}
POSTPROCESS: dict[str, Step] = {"filter_rows": filter_rows, "drop_columns": without_telemetry, "derive": derive, "pdf_match": pdf_match, "flags": flags}


def selected(steps: dict[str, Step], names: list[str] | None) -> list[str]:
    """The named steps in the registry's order, whatever order they are named in."""
    unknown = set(names or ()) - set(steps)
    if unknown:
        raise ValueError(f"no such step: {sorted(unknown)}")
    return [n for n in steps if names is None or n in names]


#: Steps that join the frame with what they worked out of it: each would have all that precedes it twice in its plan.
JOINING = ("duplicate_files", "crossref", "doi_probe", "items", "filter_rows")


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: what made it runs once and leaves the plan."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/steps-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def run_steps(df: DataFrame, steps: dict[str, Step], ctx: Context, names: list[str] | None = None) -> DataFrame:
    for number, name in enumerate(selected(steps, names)):
        if name in JOINING and (number or steps is POSTPROCESS):
            df = written(df)
        df = steps[name](df, ctx)
    return df


def patch(df: DataFrame, ctx: Context, names: list[str] | None = None) -> DataFrame:
    """The repair, with is_patched: whether any value of the row changed now or in an earlier run. A changed type is
    no changed value, and source text is no repair."""
    prior = F.coalesce("is_patched", F.lit(False)) if _has(df, "is_patched") else F.lit(False)
    old = [c for c in df.columns if c != "is_patched"]
    # A hash a column stands for the values as they were; it travels through the steps in their place.
    kept = df.withColumn("_prior", prior).withColumn("_before", F.struct(*(F.xxhash64(c).alias(c) for c in old))).drop("is_patched")
    out = run_steps(kept, PATCH, ctx, names)

    def differs(c: str) -> Column:
        before = "doi" if c == "doi_psyctests" and c not in old and "doi" in old else c
        if before not in old:
            return F.col(c).isNotNull()
        return F.xxhash64(F.col(c).cast(df.schema[before].dataType)) != F.col(f"_before.{before}")

    new = [c for c in out.columns if c not in ("_prior", "_before", "pdf_full_text")]
    changed = F.col("_prior")
    for c in new:
        changed = changed | differs(c)
    out = out.withColumn("is_patched", changed).drop("_prior", "_before")
    return ctx.count(out, "is_patched", rows=F.col("is_patched"))


def build(placements: DataFrame, names: list[str] | None = None, report_only: bool = False, ctx: Context | None = None) -> tuple[DataFrame, Context]:
    """Patch, then postprocess; with ``report_only`` nothing is counted."""
    ctx = ctx or Context(write=not report_only)
    pick = lambda steps: None if names is None else [n for n in names if n in steps]
    return run_steps(patch(placements, ctx, pick(PATCH)), POSTPROCESS, ctx, pick(POSTPROCESS)), ctx


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements made of the documents' lines, with the columns that the steps look for."""
    lines = table(spark, sf_dir, "documents").select(F.concat(F.lit("/d/"), F.col("doc_id").cast("string")).alias("path"), F.col("source").alias("corpus_source"), F.col("lang").alias("item_language"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("path", "corpus_source", "item_language", F.col("pos").cast("long").alias("item_item_id"), F.col("line").alias("item_item_text"), F.lit("scaled").alias("bucket"))


def stats_path(artifact: str) -> Path:
    return Path(f"{artifact}.stats.json")


def write_stats(artifact: str, stage: str, ctx: Context) -> Path:
    """Counters and lines beside the artifact."""
    target = stats_path(artifact)
    target.write_text(json.dumps({"stage": stage, "written": time.strftime("%Y-%m-%dT%H:%M:%S"), "stats": ctx.stats, "report": ctx.lines}, indent=1))
    return target


def read_stats(artifact: str) -> dict | None:
    """The counters, or None where they can't be read."""
    try:
        return json.loads(stats_path(artifact).read_text())
    except (OSError, ValueError):
        return None


def stats_stale(artifact: str) -> bool:
    """Whether the artifact is newer than its counters."""
    try:
        return Path(artifact).stat().st_mtime > stats_path(artifact).stat().st_mtime
    except OSError:
        return True

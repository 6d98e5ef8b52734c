"""Texts that stand word for word in others: an index of stated items by their rarest words, and the check of extractions
against their sources. All of it in column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_words, probe_forms

ITEMS = 20_000  # of a block of stated items that is broadcast at once
GRAM = 3  # words
MIN_PROBE = 12  # characters; shorter probes can't be located
OK_SHARE = 0.9


def _inner(text: Column) -> Column:
    """The words that are whole wherever the text stands within another: all but the first and the last."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))


def _hash(words: Column, at: Column | int, size: int) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(size)))


def anchors(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, text, gram): for each item the run of GRAM inner words, or the one inner word where it has fewer, that the
    fewest items share; null where it has no inner word."""
    words = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).where("text <> ''").withColumn("words", _inner(F.col("text")))
    n = F.size("words")
    runs = F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: _hash(F.col("words"), i, GRAM))
    grams = words.withColumn("gram", F.explode_outer(F.when(n >= GRAM, F.array_distinct(runs)).when(n > 0, F.array(_hash(F.col("words"), 0, 1)))))
    shared = grams.where("gram IS NOT NULL").groupBy("gram").agg(F.count("*").alias("shared"))
    # The item's whole text stands for its row: repeated rows of an item have the same anchor.
    least = F.min_by("gram", F.struct(F.coalesce("shared", F.lit(0)), "gram")).alias("gram")
    return grams.join(shared, "gram", "left").groupBy("item", "text").agg(least)


def contained(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, item_text: str, block: int = ITEMS) -> DataFrame:
    """(key, item) for every row and item that stands in its text character for character, wherever it begins.

    Inner words of an item are whole words of a text that holds it, so a text holds the item only if it has the item's
    anchor among its words or runs of words. Those meet a broadcast index of anchors, in blocks of ``block`` items, and
    whole texts decide; a text is never shuffled. Items without an inner word, and so short ones, are looked for in
    every text of their block. Items are a stated set; repeated items count once, repeated rows one by one; null and
    empty items stand nowhere.
    """
    known = anchors(items, item, item_text)
    blocks = max(1, -(-known.count() // block))
    words = F.filter(F.split(F.col("_text"), r"\s+"), lambda w: w != "")
    picked = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    spread = picked.withColumn("_words", words).select("_key", "_text", "_words", F.size("_words").alias("_n"))
    runs = F.when(F.col("_n") >= GRAM, F.transform(F.sequence(F.lit(0), F.col("_n") - GRAM), lambda i: _hash(F.col("_words"), i, GRAM))).otherwise(F.array().cast("array<bigint>"))
    grams = F.array_distinct(F.concat(runs, F.transform("_words", lambda w: F.xxhash64(w))))
    each = spread.select("_key", "_text", F.explode(grams).alias("gram"))
    out = None
    for part in range(blocks):
        own = known.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == part)
        index = own.where("gram IS NOT NULL").groupBy("gram").agg(F.collect_list(F.struct("item", "text")).alias("held"))
        found = each.join(F.broadcast(index), "gram").select("_key", "_text", F.explode("held").alias("held"))
        short = F.broadcast(own.where("gram IS NULL").agg(F.collect_list(F.struct("item", "text")).alias("held")))  # one row
        direct = picked.join(short).select("_key", "_text", F.explode(F.filter("held", lambda h: F.contains(F.col("_text"), h["text"]))).alias("held"))
        hits = found.where(F.contains("_text", F.col("held.text"))).unionByName(direct).select(F.col("_key").alias(key), F.col("held.item").alias(item))
        out = hits if out is None else out.unionByName(hits)
    return out


def check_extractions(records: DataFrame, items: DataFrame, sources: DataFrame, record: str = "record", text: str = "text", options: str = "options", note: str = "note", source: str = "source_text") -> DataFrame:
    """(record, n_items, checkable, matched, status) of extracted records against the texts they were taken from.

    An item is checkable if it has a probe (its text, options or note) of more than MIN_PROBE plain characters, and
    matched if each of its probes stands, in one of its forms, in the record's sources. status: no_source_text,
    no_checkable_items, ok where OK_SHARE of the checkable items match, else REVIEW. ``sources`` (record, source text)
    may have several rows a record.
    """
    corpus = sources.select(F.col(record).alias("r"), plain_words(F.col(source)).alias("plain")).where("plain <> ''")
    # A form never reaches over the end of a source: each of them is looked through on its own.
    of_item = F.concat(F.array(F.col(text)), F.coalesce(F.col(options), F.array().cast("array<string>")), F.array(F.substring(F.col(note), 1, 120)))
    probes = F.filter(of_item, lambda p: p.isNotNull() & (F.length(plain_words(p)) > MIN_PROBE))
    numbered = items.select(F.col(record).alias("r"), F.monotonically_increasing_id().alias("i"), F.transform(probes, probe_forms).alias("probes"))
    rows = numbered.groupBy("r").agg(F.count("*").alias("n_items"), F.count_if(F.size("probes") > 0).alias("checkable"), F.collect_list(F.when(F.size("probes") > 0, F.col("probes"))).alias("items"))
    # Per source the probes that stand in it; per record the union over its sources, by place.
    places = F.transform("items", lambda ps: F.transform(ps, lambda forms: F.exists(forms, lambda f: F.contains(F.col("plain"), f))))
    seen = rows.join(corpus, "r").select("r", F.posexplode(places).alias("i", "hits")).select("r", "i", F.posexplode("hits").alias("p", "hit"))
    matched = seen.groupBy("r", "i", "p").agg(F.bool_or("hit").alias("hit")).groupBy("r", "i").agg(F.bool_and("hit").alias("all")).groupBy("r").agg(F.count_if("all").alias("matched")).withColumnRenamed("r", "m")
    having = corpus.select(F.col("r").alias("h")).distinct()
    named = records.select(F.col(record).alias(record)).distinct()
    out = named.join(rows.drop("items"), F.col(record) == F.col("r"), "left").join(having, F.col(record) == F.col("h"), "left").join(matched, F.col(record) == F.col("m"), "left")
    n, checked, found = (F.coalesce(x, F.lit(0)) for x in ("n_items", "checkable", "matched"))
    status = F.when(F.col("h").isNull(), "no_source_text").when(checked == 0, "no_checkable_items").when(found >= OK_SHARE * checked, "ok").otherwise("REVIEW")
    none = F.col("h").isNull()
    return out.select(record, n.alias("n_items"), F.when(~none, checked).alias("checkable"), F.when(~none, found).alias("matched"), status.alias("status"))

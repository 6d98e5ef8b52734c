"""Readers and writers of corpora."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType
from pyspark.sql.utils import AnalysisException

SOURCE = "corpus_source"


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns that the file has; the scan reads no others."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in columns if c in df.columns])


def read_documents(spark: SparkSession, path: str, key: str, wanted: list[str], columns: list[str]) -> DataFrame:
    """Rows of the wanted keys; the filter reaches the scan."""
    return read_columns(spark, path, columns).where(F.col(key).isin(wanted))


def source_of(path: str) -> str:
    """The source's name from a file name: without folders, ending and leading parts such as ``exploded_``."""
    return re.sub(r"^(?:exploded|partial|combined)[_-]", "", re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1]))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All frames by name, each tagged with its source in the first column; missing columns are null."""
    tagged = [df.select(F.lit(name).alias(SOURCE), *df.columns) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def canonical(df: DataFrame) -> DataFrame:
    """32-bit integers, alone or in arrays, as 64-bit ones: one schema on every write."""

    def wide(kind):
        if isinstance(kind, IntegerType):
            return LongType()
        if isinstance(kind, ArrayType):
            return ArrayType(wide(kind.elementType), kind.containsNull)
        return kind

    return df.select(*[F.col(f.name).cast(wide(f.dataType)) if wide(f.dataType) != f.dataType else F.col(f.name) for f in df.schema])


def write_corpus(df: DataFrame, path: str) -> None:
    """Canonical types; the commit protocol makes the folder appear whole or not at all."""
    canonical(df).write.mode("overwrite").parquet(path)


def open_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The document store, or an empty one; columns it lacks are null."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    for field in schema:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


def upsert(store: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The store with the rows of ``updates`` in place of those of the same key; fields that an update lacks stay."""
    kept = [c for c in store.columns if c not in updates.columns]
    filled = updates.join(store.select(key, *kept), key, "left") if kept else updates
    return store.join(updates.select(key), key, "left_anti").unionByName(filled, allowMissingColumns=True)


def cell_states(store: DataFrame, key: str, extractors: list[str], max_attempts: int = 3) -> DataFrame:
    """(key, extractor, state, run): done, failed or pending, and whether the cell runs again."""
    cells = F.array(*[F.struct(F.lit(e).alias("extractor"), F.col(f"{e}_content").alias("content"), F.col(f"{e}_error").alias("error"), F.col(f"{e}_attempts").alias("attempts")) for e in extractors])
    rows = store.select(key, F.inline(cells))
    state = F.when(F.col("error").isNotNull(), "failed").when(F.col("content").isNotNull(), "done").otherwise("pending")
    run = (state == "pending") | ((state == "failed") & (F.coalesce("attempts", F.lit(0)) < max_attempts))
    return rows.select(key, "extractor", state.alias("state"), run.alias("run"))


def read_reference(spark: SparkSession, path: str, key: str, numbers: list[str]) -> DataFrame:
    """A JSON array of records: keys in lower case, numbers null where they are none, the first record of a key."""
    raw = spark.read.option("multiLine", True).json(path)
    cols = [(F.col(c).try_cast("long") if c in raw.columns else F.lit(None).cast("long")).alias(c) for c in numbers]
    rows = raw.select(F.lower(F.trim(key)).alias(key), *cols, F.struct("_metadata.file_path", F.monotonically_increasing_id()).alias("_ord")).where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(*[F.min_by(c, "_ord").alias(c) for c in numbers])


def file_identifiers(spark: SparkSession, path: str, key: str, files: str) -> DataFrame:
    """(file, key) from JSON records with file lists nested to any depth: PDF names, the last record wins."""
    raw = spark.read.schema(f"`{key}` string, `{files}` variant").option("multiLine", True).json(path).withColumn("_ord", F.struct("_metadata.file_path", F.monotonically_increasing_id()))
    # Strings of the JSON text, those that name a field with their colon, and then what the others stand for.
    names = F.regexp_extract_all(F.to_json(F.col(files)), F.lit(r'"(?:[^"\\]|\\.)*+"(?:\s*:)?'), F.lit(0))
    plain = F.from_json(F.concat(F.lit("["), F.array_join(F.filter(names, lambda x: ~x.endswith(":")), ","), F.lit("]")), "array<string>")
    flat = raw.select(F.col(key).alias(key), "_ord", F.explode(plain).alias("_name")).where(F.col("_name").endswith(".pdf")).select(key, "_ord", F.regexp_replace("_name", "(?s)^.*/", "").alias("file"))
    return flat.groupBy("file").agg(F.max_by(key, "_ord").alias(key))


#: What the bytes 80 to 9F stand for in this encoding, in their order; undefined ones stay as they are.
CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line) of text files in an 8-bit encoding, cut at line ends and read in splits.

    ``block`` is where the split begins and ``at`` grows within it, so (file, block, at) is the order of the lines. As
    single bytes they survive the CSV reader, which is told of no quotes and of a separator that no line holds.
    """
    raw = spark.read.schema("line string").options(sep="\x01", quote="", escape="", encoding="ISO-8859-1", lineSep="\n", maxCharsPerColumn=-1, mode="PERMISSIVE").csv(path)
    text = F.translate("line", "".join(map(chr, range(0x80, 0xA0))), CP1252)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), text.alias("line"))


def logical_records(lines: DataFrame) -> DataFrame:
    """(file, number, record) of a broken CSV's lines: doubled line ends are one, a record goes on until its quotes pair up,
    trailing semicolons go.

    Whether a line lies inside a record follows from the quotes before it. Each split's quotes are counted, the few sums
    of a file's splits are added up, and a running sum within the split does the rest: a file is never one task, and a
    record may begin in one split and end in another.
    """
    tidy = F.regexp_replace(F.regexp_replace("line", r"(?U);+\s*$", ""), r"(?U)^\s+|\s+$", "")
    rows = lines.select("file", "block", "at", tidy.alias("line")).where("line <> ''").withColumn("quotes", F.length("line") - F.length(F.translate("line", '"', "")))
    inside = Window.partitionBy("file", "block").orderBy("at")
    before = lambda w, x: F.coalesce(F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = Window.partitionBy("file").orderBy("block")  # as many rows as the file has splits
    sums = rows.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")).select("file", "block", before(splits, "quotes").alias("earlier"))
    known = rows.join(sums, ["file", "block"]).withColumn("begins", ((F.col("earlier") + before(inside, "quotes")) % 2 == 0).cast("long"))
    starts = known.groupBy("file", "block").agg(F.sum("begins").alias("begins")).select("file", "block", before(splits, "begins").alias("numbered"))
    numbered = known.join(starts, ["file", "block"]).withColumn("number", F.col("numbered") + F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "line"))), lambda x: x["line"])
    return numbered.groupBy("file", "number").agg(F.array_join(parts, " ").alias("record"))


def split_record(record: Column) -> Column:
    """struct(name, item, source): cut at a citation (year in brackets or web address) where there is one, else from the right."""
    squished = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), r'^"+|"+$', ""), r"(?U)\s+", " "))
    whole = record.startswith('"') & record.endswith('"') & ~record.contains('","')
    body = F.when(whole, F.replace(F.substring(record, F.lit(2), F.length(record) - 2), F.lit('""'), F.lit('"'))).otherwise(record)
    # The last comma before "Family, I. ... (year)" or before a web address.
    cited = r"(?dU)^(.*),\s*\"?((?:[A-Z][\w'’ -]*,\s*[A-Z]\.[^()]*\((?:18|19|20)\d{2}[a-z]?\)|https?://).*)$"
    head = F.regexp_extract(body, cited, 1)
    three, two = r"(?s)^(.*),([^,]*),([^,]*)$", r"(?s)^([^,]*),([^,]*)$"
    group = lambda pattern, *at: F.array(*(F.regexp_extract(body, pattern, i) for i in at))
    fields = (
        F.when(body.rlike(cited), F.array(F.substring_index(head, ",", 1), F.regexp_replace(head, r"(?s)^[^,]*,?", ""), F.regexp_extract(body, cited, 2)))
        .when(body.rlike(three), group(three, 1, 2, 3)).when(body.rlike(two), F.concat(group(two, 1, 2), F.array(F.lit("")))).otherwise(F.array(body, F.lit(""), F.lit("")))
    )
    return F.struct(*(squished(fields[i]).alias(name) for i, name in enumerate(("name", "item", "source"))))


def read_broken_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, item, source) of the files of a folder, each triple once, with the first file that has it."""
    records = logical_records(_lines(spark, path))
    rows = records.select("file", split_record(F.col("record")).alias("r")).select("file", "r.*")
    return rows.groupBy("name", "item", "source").agg(F.min("file").alias("file")).select("file", "name", "item", "source")


def discover(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path) of all files below a folder, without copies that the system made of a file that is there too."""
    from ..operators.curation import without_copies

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return without_copies(files.select("path").distinct(), "path")

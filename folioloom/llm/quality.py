"""Quality rules with host-level verdicts.

Whole texts are measured (words, symbols, repeated lines, repeated three-word windows). Rule failures are summed by
host with map-side partial sums, host rates are shrunk towards the corpus by a beta prior fitted to the hosts
themselves (method of moments), and the hosts' verdicts are joined back to the documents. A bad host never rejects
a clean document: it only takes away the benefit of the doubt from documents that fail a soft rule. A host is the
domain of a URL (lower case, without user, port and ``www.``), or else the value as it stands.

Defined results: null text counts as empty; a null host is the host ``''``; a text of any length is measured whole, in
memory of its own size; an empty table gives an empty result; repeated rows are measured one by one and all count for
their host; a rate that equals a bound does not exceed it; null ids are carried; extra columns are not read by
``verdicts`` and stay in ``keep_good``; output columns that would be named like the key get a leading underscore.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir
from .common import beside, map_slices, table, utf8

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
NOT_COUNTED = SPACES + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes

MIN_WORDS = 50  # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50  # base rule: a larger share of repeated words fails
SOFT_SYMBOLS_PER_WORD = 0.5  # soft rules below
HEAVY_SYMBOLS_PER_WORD = 1.5  # counts as a second soft rule
SOFT_DUP_LINE_SHARE = 0.3
SOFT_REPEAT_SHARE = 0.3
SOFT_CASE_SHARE = 0.7
SOFT_WORD_CHARS = (2.0, 15.0)
BAD_HOST_RATE = 0.5  # shrunk failure rate above which a host is bad
HOST_BROADCAST_ROWS = 50_000  # at most this many host rows are broadcast, otherwise the join is salted
HOST_SALTS = 32

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_letters long"
UPPER = bytes(range(65, 91))
NOT_UPPER = bytes(sorted(set(range(256)) - set(UPPER)))
NOT_LETTER = bytes(sorted(set(range(256)) - set(UPPER) - set(range(97, 123))))


def host_of(value: Column) -> Column:
    """The domain of a URL, any other value as it stands, '' for null."""
    plain = F.coalesce(value.cast("string"), F.lit(""))
    domain = F.regexp_replace(F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), r"^www\.", "")
    return F.when(domain != "", domain).otherwise(plain)


def measure(text: bytes) -> tuple[int, int, int, int, int, int, int, int]:
    """The counts of FEATURES for one whole text given as UTF-8."""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, NOT_COUNTED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            end = 0  # words before it are counted
            for at, window in enumerate(windows):
                if times[window] > 1:
                    repeated += at + 3 - max(at, end)
                    end = at + 3
    return n, chars, symbols, dup, repeated, len(lines), len(text.translate(None, NOT_UPPER)), len(text.translate(None, NOT_LETTER))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, host and FEATURES."""
    kind = docs.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in FEATURES.split(", ")]

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [measure(x) for x in utf8(part.column(2))]
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(names))]
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["key", "host", *names])

        return handle

    picked = docs.select(F.col(key).alias("key"), host_of(F.col(host)).alias("host"), F.col(text).cast("string").alias("text"))
    return map_slices(picked, make, f"key {kind}, host string, {FEATURES}")


def measured_rows(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` as columns c0, c1, ..., then host and FEATURES: no name of theirs can clash."""
    names = [x.split()[0] for x in FEATURES.split(", ")]
    renamed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = docs.columns.index(text)
    named = renamed.withColumn("host", host_of(F.col(f"c{docs.columns.index(host)}")))

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [measure(x) for x in utf8(part.column(at))]
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(names))]
            return pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *names])

        return handle

    schema = StructType(list(named.schema.fields))
    for name in names:
        schema = schema.add(name, "long")
    return map_slices(named, make, schema)


def with_rules(measured: DataFrame) -> DataFrame:
    """Adds base_failed and n_soft, the number of soft rules that the document fails."""
    n, c = F.col("n_words"), F.col
    per_word = F.when(n > 0, c("word_chars") / n)
    soft = [
        c("n_symbols") > SOFT_SYMBOLS_PER_WORD * n,
        c("n_symbols") > HEAVY_SYMBOLS_PER_WORD * n,
        c("n_dup_lines") > SOFT_DUP_LINE_SHARE * c("n_lines"),
        c("n_repeat_words") > SOFT_REPEAT_SHARE * n,
        c("n_upper") > SOFT_CASE_SHARE * c("n_letters"),
        ~per_word.between(*SOFT_WORD_CHARS),
    ]
    base = (n < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return measured.withColumn("base_failed", base).withColumn("n_soft", sum((F.coalesce(x, F.lit(False)).cast("int") for x in soft), F.lit(0)))


def host_rates(ruled: DataFrame) -> DataFrame:
    """host, host_docs, host_failed, host_rate: failure rates shrunk by a beta prior fitted to all hosts; written
    once to the shared folder, so ``ruled`` is worked out once for them.

    Moments: with host rates p_i over n_i documents, mean m and variance v of p_i, the sampling part
    m(1-m) * mean(1/n_i) is taken off v; the prior's weight is m(1-m)/v' - 1, kept within [1, 1e6].
    """
    failed = (F.col("base_failed") | (F.col("n_soft") > 0)).cast("long")
    ensure_checkpoint_dir(ruled.sparkSession)
    hosts = ruled.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(failed).alias("host_failed")).checkpoint()
    rate = F.col("host_failed") / F.col("host_docs")
    moments = hosts.agg(
        (F.sum("host_failed") / F.sum("host_docs")).alias("m"),
        F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v"),
        F.avg(1.0 / F.col("host_docs")).alias("inv"),
    )
    m, spread = F.col("m"), F.col("m") * (1 - F.col("m"))
    between = F.greatest(F.col("v") - spread * F.col("inv"), F.lit(1e-9))
    prior = moments.select(m, F.least(F.greatest(spread / between - 1, F.lit(1.0)), F.lit(1e6)).alias("weight"))
    # The prior is two numbers; the driver reads them.
    row = prior.first()
    m, weight = (row["m"], row["weight"]) if row["m"] is not None else (0.0, 1.0)
    rate = (F.col("host_failed") + F.lit(m * weight)) / (F.col("host_docs") + F.lit(weight))
    return hosts.select("host", "host_docs", "host_failed", rate.alias("host_rate"))


def judged(ruled: DataFrame, hosts: DataFrame, spread: str) -> DataFrame:
    """``ruled`` with the hosts' figures, host_bad and kept; ``spread`` deals a large host's rows."""
    if hosts.limit(HOST_BROADCAST_ROWS + 1).count() <= HOST_BROADCAST_ROWS:
        joined = ruled.join(F.broadcast(hosts), "host", "left")
    else:  # a host may hold a third of all documents: deal its rows and its verdict over salts
        salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1))))
        joined = ruled.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(HOST_SALTS)).cast("int")).join(salted, ["host", "salt"], "left").drop("salt")
    bad = F.coalesce(F.col("host_rate") > BAD_HOST_RATE, F.lit(False))
    kept = ~F.col("base_failed") & ~((F.col("n_soft") >= 2) | ((F.col("n_soft") >= 1) & bad))
    return joined.withColumn("host_bad", bad).withColumn("kept", kept)


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, the counts, base_failed, n_soft, host figures and ``kept``.

    Rejected: what fails the base rules, what fails two soft rules or more, and what fails one soft rule
    on a bad host.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # Written once to the shared folder: both branches below read it, the texts are measured once.
    ruled = with_rules(features(docs, key, text, host)).checkpoint()
    out = judged(ruled, host_rates(ruled), "key")
    names = [c for c in out.columns if c != "key"]
    return out.select(F.col("key").alias(key), *(F.col(a).alias(b) for a, b in zip(names, beside(key, *names), strict=True)))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` without the rows that the rules reject; all columns stay. Texts are measured twice (for the
    hosts' rates, then for each verdict) instead of being shuffled."""
    hosts = host_rates(with_rules(features(docs, key, text, host)))
    out = judged(with_rules(measured_rows(docs, text, host)), hosts, f"c{docs.columns.index(text)}").where("kept")
    return out.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality verdict of every document."""
    out = verdicts(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_soft", "host_rate", "host_bad")

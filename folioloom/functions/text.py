"""Text repair and normalisation as column builders. All stay in whole-stage codegen or higher-order functions."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that stand for "no value".
SENTINELS = ("None", "N/A", "UNKNOWN", "Unknown", "nan", "-")
#: Spellings of a source remark and the form that all take.
SOURCE_REMARKS = {
    "supplied by author": "Supplied by author.",
    "supplied by authors": "Supplied by author.",
    "supplied by the author": "Supplied by author.",
    "supplied author": "Supplied by author.",
    "author supplied": "Supplied by author.",
    "author provided": "Supplied by author.",
    "provided by author": "Supplied by author.",
    "submitted by author": "Supplied by author.",
    "supplied by publisher": "Supplied by publisher.",
}
#: Words that title case leaves small inside a title.
SMALL_WORDS = (
    "a", "an", "the", "and", "but", "or", "nor", "for", "so", "yet", "as", "at", "by", "in", "of", "off", "on", "per", "to", "up", "via", "vs",
    "de", "del", "der", "des", "di", "du", "la", "le", "van", "von", "und", "et", "y",
)
REMARK_CHARS = 40
NUMBER_REST = 3  # characters that must remain behind an item number


def trimmed(x: Column) -> Column:
    """Without white space (Unicode) at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def collapsed(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(trimmed(x), r"(?U)\s+", " ")


def blank_to_null(x: Column) -> Column:
    return F.when(~x.rlike(r"(?U)^\s*\z"), x)


def folded(x: Column) -> Column:
    """Lower case for caseless comparison (sharp s as ss)."""
    return F.replace(F.lower(x), F.lit("ß"), F.lit("ss"))


def sentinel_to_null(x: Column) -> Column:
    return F.when(~trimmed(x).isin(*SENTINELS), x)


def sentinels_in_array(x: Column) -> Column:
    """The same on every element."""
    return F.transform(x, lambda v: F.when(~trimmed(v).isin(*SENTINELS), v))


def source_remark(x: Column) -> Column:
    """A short source remark in its one form; other text stays."""
    key = folded(F.regexp_replace(trimmed(x), r"\.+$", ""))
    known = F.create_map(*(F.lit(v) for pair in SOURCE_REMARKS.items() for v in pair))
    return F.when(F.length(x) < REMARK_CHARS, F.coalesce(F.try_element_at(known, key), x)).otherwise(x)


def unbroken_hyphens(x: Column) -> Column:
    """A question mark between letters was a hyphen, a pilcrow a space."""
    return F.replace(F.regexp_replace(x, r"(?<=[A-Za-z])\?(?=[A-Za-z])", "-"), F.lit("¶"), F.lit(" "))


def newlines(x: Column) -> Column:
    """A literal backslash-n as a line break."""
    return F.replace(x, F.lit("\\n"), F.lit("\n"))


def core_entities(x: Column, rounds: int = 4) -> Column:
    """The five core HTML entities and the two numeric apostrophes, to a fixpoint of at most ``rounds``."""
    for _ in range(rounds):
        for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            x = F.replace(x, F.lit(name), F.lit(char))
    return x


def all_entities(df: DataFrame, column: str, rounds: int = 4) -> DataFrame:
    """All named and numeric entities, over the distinct texts that have any (see ``map_distinct``)."""
    from ..operators.distinct import map_distinct

    def unescape(values):
        for _ in range(rounds):
            values = values.map(lambda v: html.unescape(v) if isinstance(v, str) else v)
        return values

    return map_distinct(df, column, unescape, "string", only=F.col(column).contains("&"))


def placeholder_to_null(x: Column) -> Column:
    return F.when(~x.rlike(r"^Item [0-9]+ statement group\z"), x)


def without_number(x: Column) -> Column:
    """A leading ``1. ``, ``(2) ``, ``a. `` goes where enough text remains."""
    rest = trimmed(F.regexp_extract(x, r"(?Us)^\s*(?:\(?[0-9]{1,3}[.)]|[A-Za-z][.)])\s+(.*)\z", 1))
    return F.when(F.length(rest) >= NUMBER_REST, rest).otherwise(x)


def split_cell_repair(x: Column) -> Column:
    """Traces of a cell that was split at a comma: leading ``,"``, doubled quotes, one quote without a partner."""
    t = trimmed(x)
    t = F.when(t.startswith(","), F.regexp_replace(trimmed(F.regexp_replace(t, "^,+", "")), '^"+', "")).otherwise(t)
    t = F.replace(t, F.lit('""'), F.lit('"'))
    single = F.length(t) - F.length(F.replace(t, F.lit('"'), F.lit(""))) == 1
    t = F.when(single & (t.startswith('"') | t.endswith('"')), F.replace(t, F.lit('"'), F.lit(""))).otherwise(t)
    return collapsed(t)


def match_key(x: Column) -> Column:
    """Lower-case letters and digits with single spaces: what two spellings of an item share."""
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def core_name(x: Column, generic: tuple[str, ...]) -> Column:
    """The distinct words of a name that aren't generic, in order of appearance."""
    return F.array_join(F.array_except(F.split(match_key(x), " "), F.array(*map(F.lit, generic))), " ")


def braces(x: Column) -> Column:
    """From the first opening to the last closing brace; all of the text where there are none."""
    inside = F.regexp_extract(x, r"(?s)(\{.*\})", 1)
    return F.when(inside != "", inside).otherwise(x)


def plain_words(x: Column) -> Column:
    """Lower-case ASCII letters and digits with single blanks between; marks in angle brackets are left out."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(x, "<[^>]+>", " ")), "[^a-z0-9 ]", " "), " +", " "))


def probe_forms(x: Column) -> Column:
    """The forms under which a text is looked for, in plain words: as it is, without a score behind or a label before it,
    and its first eight words where it has so many."""
    bare = F.regexp_replace(x, r"\s*\(\d+\)\s*$", "")
    bare = F.regexp_replace(bare, r"^\s*Item \d+\s*(\([A-Z]\d+\))?[:.]\s*", "")
    bare = plain_words(F.regexp_replace(bare, "[:.]+$", ""))
    words = F.split(bare, " ")
    first = F.when(F.size(words) >= 8, F.array_join(F.slice(words, 1, 8), " "))
    return F.array_distinct(F.array_compact(F.array(plain_words(x), bare, first)))


def segment(x: Column) -> Column:
    """A name as part of a column name: lower case, other characters as single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _capital(part: Column, first: Column) -> Column:
    """The part with its first letter capital, unless it has capitals already or is a small word inside a compound."""
    raised = F.concat(F.regexp_extract(part, r"(?U)^([^\p{L}]*)", 1), F.upper(F.regexp_extract(part, r"(?U)^[^\p{L}]*(\p{L})", 1)), F.regexp_extract(part, r"(?Us)^[^\p{L}]*\p{L}(.*)\z", 1))
    keep = (part != F.lower(part)) | (~first & part.isin(*SMALL_WORDS)) | ~part.rlike(r"\p{L}")
    return F.when(keep, part).otherwise(raised)


def title_case(x: Column) -> Column:
    """Title case that lowers no capitals: small words stay small inside, the first word, the last word and the
    word after a colon or semicolon are capital, parts of compounds count one by one. A fold over the words."""
    words = F.split(x, " ")
    last = F.size(words) - 1

    def step(state: Column, word: Column) -> Column:
        core = F.regexp_replace(word, r"""^[()\[\]{}"'.,;:!?]+|[()\[\]{}"'.,;:!?]+$""", "")
        small = F.lower(core).isin(*SMALL_WORDS) & ~state["force"] & (state["at"] < last)
        capitalised = (core != F.lower(core)) & (core == F.concat(F.upper(F.substring(core, 1, 1)), F.lower(core.substr(F.lit(2), F.length(core)))))
        lowered = F.when(capitalised, F.replace(word, core, F.lower(core))).otherwise(word)
        # Parts and separators alternate: a separator is turned into itself between marks.
        parts = F.split(F.regexp_replace(word, "([-/]+)", "\u0001$1\u0001"), "\u0001")
        raised = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, _capital(p, i == 0)).otherwise(p)), "")
        out = F.when(small, lowered).otherwise(raised)
        force = F.when(word == "", state["force"]).otherwise(word.rlike("[:;]$"))
        return F.struct(F.concat(state["out"], F.when(state["at"] == 0, "").otherwise(" "), out).alias("out"), force.alias("force"), (state["at"] + 1).alias("at"))

    return F.aggregate(words, F.struct(F.lit("").alias("out"), F.lit(True).alias("force"), F.lit(0).alias("at")), step, lambda s: s["out"])

"""Identifiers, citations and authors as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapsed, trimmed

#: Patterns of identifiers and sources.
ANY_DOI = r"\b(10\.[0-9]{4,9}/[!#-&(-;=?-~]+)"
RECORD_DOI = r"^10\.1037/t[0-9]{4,6}-[0-9]{3}"
RECORD_ON_PAGE = r"(?i)doi:\s*https?://(?:dx\.)?doi\.org/(10\.1037/t[0-9]{4,6}-[0-9]{3})"
LANDING_TAIL = r"(?i)/(?:full|abstract|pdf|epdf|pdfdirect|fulltext|html|summary)$"
YEAR_IN_BRACKETS = r"\(\s*((?:18|19|20)[0-9]{2})"
WEB_ADDRESS = r"(?i)^https?://\S+\z"
DOMAIN = r"^((?:www\.)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?:/\S*)?)(?:\s+\(.*\))?\z"
FILE_ENDINGS = ("htm", "html", "pdf", "doc", "docx", "csv", "xls", "xlsx")
CITATION_CHARS = 30
#: Words of an affiliation.
AFFILIATION = r"(?i)@|univ|depart|school|institute|college|hospital|center|centre|faculty|laborator|clinic"


def plain_hyphens(x: Column) -> Column:
    """Typographic hyphens as '-', soft hyphens gone."""
    return F.translate(x, "‐‑‒−­", "----")


def clean_doi(x: Column, rounds: int = 4) -> Column:
    """Without trailing punctuation, unbalanced closing brackets and landing-page tails; lower case.

    A fold over rounds and brackets, so the expression stays small.
    """
    brackets = F.array(*[F.struct(F.lit(a).alias("open"), F.lit(b).alias("shut")) for a, b in ("()", "[]", "{}")])

    def balance(s: Column, pair: Column) -> Column:
        count = lambda c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
        return F.when(F.endswith(s, pair["shut"]) & (count(pair["shut"]) > count(pair["open"])), F.left(s, F.length(s) - 1)).otherwise(s)

    def step(s: Column, _: Column) -> Column:
        bare = F.aggregate(brackets, F.regexp_replace(s, "[.,;:]+$", ""), balance)
        return F.regexp_replace(bare, LANDING_TAIL, "")

    return F.lower(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step))


def doi_in_text(x: Column) -> Column:
    """The first DOI of a text that isn't a record's own."""
    found = F.transform(F.regexp_extract_all(plain_hyphens(x), F.lit(ANY_DOI), F.lit(1)), clean_doi)
    return F.get(F.filter(found, lambda d: ~d.rlike(RECORD_DOI)), F.lit(0))


def doi_in_url(x: Column) -> Column:
    return doi_in_text(F.try_url_decode(x))


def record_doi_on_page(x: Column) -> Column:
    found = F.lower(F.regexp_extract(plain_hyphens(x), RECORD_ON_PAGE, 1))
    return F.when(found != "", found)


def doi_of_stem(path: Column) -> Column:
    """``9999NNNNN...`` in a file's name -> the record's DOI."""
    digits = F.regexp_extract(F.regexp_replace(path, "^.*/", ""), "^9999([0-9]{5})", 1)
    return F.when(digits != "", F.concat(F.lit("10.1037/t"), digits, F.lit("-000")))


def corroborated(*candidates: Column) -> Column:
    """The one value that all candidates that have one agree on, else null."""
    seen = F.array_distinct(F.array_compact(F.array(*candidates)))
    return F.when(F.size(seen) == 1, F.try_element_at(seen, F.lit(1)))


def source_kind(x: Column) -> Column:
    """url, domain, citation or junk; null stays null."""
    t = collapsed(x)
    ending = F.lower(F.regexp_extract(F.regexp_extract(t, DOMAIN, 1), r"\.([^.]*)$", 1))
    ending = F.regexp_replace(ending, "/.*$", "")
    return (
        F.when(x.isNull(), None)
        .when(t == "", "junk")
        .when(t.rlike(WEB_ADDRESS), "url")
        .when(t.rlike(DOMAIN) & ~ending.isin(*FILE_ENDINGS), "domain")
        .when(t.rlike(YEAR_IN_BRACKETS) & (F.length(t) >= CITATION_CHARS), "citation")
        .otherwise("junk")
    )


def source_value(x: Column) -> Column:
    """The normalised source: a domain gets a scheme, junk becomes null."""
    t, kind = collapsed(x), source_kind(x)
    return F.when(kind == "domain", F.concat(F.lit("https://"), F.regexp_extract(t, DOMAIN, 1))).when(kind.isin("url", "citation"), t)


def citation_parts(x: Column) -> Column:
    """struct(family, year, title) of a citation; all null without a year in brackets."""
    year = F.regexp_extract(x, YEAR_IN_BRACKETS, 1)
    family = trimmed(F.split_part(F.regexp_extract(x, r"(?s)^(.*?)" + YEAR_IN_BRACKETS, 1), F.lit(","), F.lit(1)))
    title = collapsed(F.regexp_extract(x, r"(?s)" + YEAR_IN_BRACKETS + r".*?\)\s*\.\s*(.{5,300}?)[.?!](?:\s|$)", 2))
    none = year == ""
    pick = lambda v: F.when(~none & (v != ""), v)
    return F.struct(pick(family).alias("family"), F.when(~none, year.try_cast("int")).alias("year"), pick(title).alias("title"))


def initials(given: Column) -> Column:
    """``Mary jane`` -> ``M. J.``"""
    parts = F.filter(F.split(trimmed(given), r"[\s.]+"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lit("."))), " ")


def authors_apa(authors: Column) -> Column:
    """array<struct<family, given>> -> ``Family, F. M., & Other, G.``; null without a family name."""
    named = F.filter(authors, lambda a: trimmed(F.coalesce(a["family"], F.lit(""))) != "")

    def one(a: Column) -> Column:
        short = initials(F.coalesce(a["given"], F.lit("")))
        return F.concat(trimmed(a["family"]), F.when(short != "", F.concat(F.lit(", "), short)).otherwise(""))

    names = F.transform(named, one)
    many = F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(F.size(names) - 1, F.lit(0))), ", "), F.lit(", & "), F.try_element_at(names, F.lit(-1)))
    return F.when(F.size(names) == 1, F.try_element_at(names, F.lit(1))).when(F.size(names) > 1, many)


def pipe_authors(x: Column) -> Column:
    """A list parted by '|' as APA authors: affiliations go, initials pair with the family name before them."""
    tokens = F.filter(F.transform(F.split(x, r"\|"), trimmed), lambda t: (t != "") & ~t.rlike(AFFILIATION) & (F.length(t) <= 40))
    none = F.lit(None).cast("string")
    pair = lambda family, given: F.struct(family.alias("family"), given.alias("given"))
    direct = F.transform(tokens, lambda t: pair(trimmed(F.split_part(t, F.lit(","), F.lit(1))), trimmed(F.regexp_extract(t, "^[^,]*,(.*)$", 1))))
    start = F.struct(none.alias("pending"), F.array().cast("array<struct<family:string,given:string>>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        short, name = t.rlike(r"^(?:[A-Z]\.?\s*)+\z"), t.rlike(r"^[A-Za-z][A-Za-z' -]*\z")
        grown = lambda given: F.concat(s["out"], F.array(pair(s["pending"], given)))
        out = F.when(short & s["pending"].isNotNull(), grown(t)).when(~short & name & s["pending"].isNotNull(), grown(none)).otherwise(s["out"])
        pending = F.when(short & s["pending"].isNotNull(), none).when(short, s["pending"]).when(name, t)
        return F.struct(pending.alias("pending"), out.alias("out"))

    folded = F.aggregate(tokens, start, step, lambda s: F.when(s["pending"].isNotNull(), F.concat(s["out"], F.array(pair(s["pending"], none)))).otherwise(s["out"]))
    return F.when(F.size(tokens) > 0, authors_apa(F.when(F.forall(tokens, lambda t: t.contains(",")), direct).otherwise(folded)))


def part(x: Column) -> Column:
    """A citation's part: trimmed, without its final full stops; null when nothing is left."""
    return F.nullif(trimmed(F.regexp_replace(trimmed(x), r"\.+$", "")), F.lit(""))


def year_text(x: Column) -> Column:
    """A year as text: whole numbers without decimals, other text as it is, ``n.d.`` for none."""
    return F.coalesce(x.try_cast("double").cast("long").cast("string"), F.nullif(trimmed(x), F.lit("")), F.lit("n.d."))


def _address(doi: Column) -> Column:
    return F.when(F.coalesce(doi, F.lit("")) != "", F.concat(F.lit("https://doi.org/"), doi))


def record_citation(authors: Column, year: Column, title: Column, doi: Column) -> Column:
    """The citation of a database record, as complete as its fields are."""
    head = F.concat(part(title), F.lit(" [Database record]."))
    who, when = F.nullif(trimmed(authors), F.lit("")), F.concat(F.lit("("), year_text(year), F.lit(")."))
    base = F.lit("APA PsycTests.")
    return (
        F.when(part(title).isNull(), F.concat_ws(" ", F.lit("APA PsycTests database record."), _address(doi)))
        .when(who.isNotNull(), F.concat_ws(" ", F.concat(who, F.lit(" "), when), head, base, _address(doi)))
        .otherwise(F.concat_ws(" ", head, when, base, _address(doi)))
    )


def source_citation(authors: Column, year: Column, title: Column, journal: Column, doi: Column) -> Column:
    """The citation of a publication; null unless there is a title and authors or a DOI."""
    who, when = F.nullif(trimmed(authors), F.lit("")), F.concat(F.lit("("), year_text(year), F.lit(")."))
    what, where = F.concat(part(title), F.lit(".")), F.concat(part(journal), F.lit("."))
    full = F.when(who.isNotNull(), F.concat_ws(" ", F.concat(who, F.lit(" "), when), what, where, _address(doi))).otherwise(F.concat_ws(" ", what, when, where, _address(doi)))
    return F.when(part(title).isNotNull() & (who.isNotNull() | _address(doi).isNotNull()), full)


def public_year(citation: Column) -> Column:
    """The first four digits in brackets."""
    return F.nullif(F.regexp_extract(citation, r"\(([0-9]{4})\)", 1), F.lit("")).try_cast("long")


def lookup_mode(citation: Column, title: Column, authors: Column, year: Column) -> Column:
    """citation, structured or insufficient: what a bibliographic lookup could start from."""
    structured = title.isNotNull() & authors.isNotNull() & year.isNotNull()
    return F.when(source_kind(citation) == "citation", "citation").when(structured, "structured").otherwise("insufficient")


def candidate_fits(title: Column, family: Column, year: Column, work: Column, threshold: float = 0.9, tolerance: int = 1) -> Column:
    """Whether a candidate work (struct title, families, year) verifies: title contained or close, year near, family listed."""
    a, b = F.lower(title), F.lower(work["title"])
    close = F.when(b.contains(a) | a.contains(b), True).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)) >= threshold)
    return F.coalesce(close & (F.abs(work["year"] - year) <= tolerance) & F.exists(work["families"], lambda f: F.lower(f) == F.lower(family)), F.lit(False))

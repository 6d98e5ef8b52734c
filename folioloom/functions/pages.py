"""Fields of a record's first page, found by their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .biblio import record_doi_on_page
from .text import collapsed

#: Labels of the page's fields, in the order in which they stand.
LABELS = {
    "instrument_type": r"Instrument Type:",
    "year": r"(?:Publication Year|Year of Publication):",
    "authors": r"Author\(s\):|Authors?:",
    "test_format": r"Test Format:",
    "source": r"Source:",
    "permissions": r"Permissions:",
    "journal": r"Journal(?: Title)?:",
    "language": r"Language(?:\(s\))?:",
}
_NEXT = "|".join(LABELS.values()) + r"|DOI:|Doi:"


def page_fields(page: Column) -> Column:
    """struct of title, doi and the labelled fields; null for labels that the page lacks. A value ends at the next label."""
    field = lambda pattern: F.nullif(collapsed(F.regexp_extract(page, rf"(?s)(?:^|\n)\s*(?:{pattern})\s*(.*?)\s*(?=\n\s*(?:{_NEXT})|\z)", 1)), F.lit(""))
    title = F.nullif(collapsed(F.regexp_extract(page, rf"(?s)^(.*?)\s*(?=\n\s*(?:{_NEXT})|\z)", 1)), F.lit(""))
    return F.struct(title.alias("title"), record_doi_on_page(page).alias("doi"), *[field(p).alias(n) for n, p in LABELS.items()])

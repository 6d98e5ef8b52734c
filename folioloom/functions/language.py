"""Languages and permissions of a document's fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapsed, trimmed

#: Language names and their ISO 639-1 codes.
LANGUAGE_CODES = {
    "arabic": "ar", "bengali": "bn", "bulgarian": "bg", "catalan": "ca", "chinese": "zh", "croatian": "hr", "czech": "cs",
    "danish": "da", "dutch": "nl", "english": "en", "estonian": "et", "farsi": "fa", "filipino": "tl", "finnish": "fi",
    "french": "fr", "german": "de", "greek": "el", "hebrew": "he", "hindi": "hi", "hungarian": "hu", "icelandic": "is",
    "indonesian": "id", "italian": "it", "japanese": "ja", "kannada": "kn", "korean": "ko", "kurdish": "ku", "lithuanian": "lt",
    "malay": "ms", "malayalam": "ml", "norwegian": "no", "persian": "fa", "polish": "pl", "portuguese": "pt", "romanian": "ro",
    "russian": "ru", "serbian": "sr", "sinhala": "si", "slovak": "sk", "slovenian": "sl", "spanish": "es", "swahili": "sw",
    "swedish": "sv", "tagalog": "tl", "thai": "th", "turkish": "tr", "ukrainian": "uk", "urdu": "ur", "vietnamese": "vi",
}
#: Openings of a permission text and their categories, in order of test.
PERMISSION_CATEGORIES = (
    ("contact publisher and corresponding author", "contact_publisher_and_author"),
    ("contact publisher", "contact_publisher"),
    ("contact corresponding author", "contact_author"),
    ("not specified", "not_specified"),
    ("may use for research/teaching", "research_teaching"),
)
REPRODUCTION = "test content may be reproduced"


def _code(name: Column) -> Column:
    known = F.create_map(*(F.lit(v) for pair in LANGUAGE_CODES.items() for v in pair))
    return F.try_element_at(known, F.lower(name))


def language_code(x: Column) -> Column:
    """A code, locale, leaked field or name as a two-letter code; null if it is none."""
    v = trimmed(x)
    locale = F.lower(F.regexp_extract(v, "^([A-Za-z]{2})[-_',’]", 1))
    return F.when(v.rlike(r"^[A-Za-z]{2}\z"), F.lower(v)).when(locale != "", locale).otherwise(_code(F.regexp_extract(v, "^([A-Za-z]+)", 1)))


def language_in_title(x: Column) -> Column:
    """The code of ``... - Kurdish Version``; null for English, unknown names or none."""
    code = _code(F.regexp_extract(x, r"[-–—(]+\s*([A-Za-z]+) [Vv]ersion\b", 1))
    return F.when(code != "en", code)


def version_in_title(x: Column) -> Column:
    """``Kurdish Version`` of such a title; null where ``language_in_title`` is."""
    name = F.lower(F.regexp_extract(x, r"[-–—(]+\s*([A-Za-z]+) [Vv]ersion\b", 1))
    return F.when(language_in_title(x).isNotNull(), F.concat(F.initcap(name), F.lit(" Version")))


#: The permission texts that may lack their full stop.
PERMISSIONS = ("Contact Corresponding Author.", "Contact Publisher.", "Contact Publisher and Corresponding Author.", "Not Specified.", "May use for Research/Teaching.")


def with_full_stop(x: Column) -> Column:
    """A known permission text with its full stop; others stay."""
    stopped = F.concat(trimmed(x), F.lit("."))
    return F.when(stopped.isin(*PERMISSIONS), stopped).otherwise(x)


def permission_category(x: Column) -> Column:
    low = F.lower(collapsed(x))
    out = F.when(low.startswith(REPRODUCTION), F.when(low.contains("public domain"), "public_domain").otherwise("free_reproduction"))
    for opening, category in PERMISSION_CATEGORIES:
        out = out.when(low.startswith(opening), category)
    return out

"""Names of instruments: kinds, translations, and gates for candidate matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that make a name an instrument's.
INSTRUMENT = (r"(?i)scale", r"(?i)questionnaire", r"(?i)inventory", r"(?i)Test(?!im)", r"(?i)index", r"(?i)survey", r"(?i)checklist")
#: Languages and nationalities of a translated record's name.
LANGUAGE_WORDS = (
    "chinese", "mandarin", "cantonese", "taiwanese",
    "german", "austrian", "french", "italian", "spanish", "castilian", "catalan",
    "basque", "galician", "portuguese", "brazilian", "mexican", "argentine",
    "argentinian", "chilean", "colombian", "peruvian",
    "dutch", "flemish", "danish", "norwegian", "swedish", "finnish", "icelandic",
    "japanese", "korean", "vietnamese", "thai", "khmer", "burmese", "myanmar",
    "lao", "filipino", "tagalog", "indonesian", "malay", "malaysian",
    "turkish", "persian", "farsi", "iranian", "arabic", "arab", "hebrew",
    "israeli", "egyptian", "moroccan", "tunisian", "lebanese", "jordanian",
    "saudi", "pakistani", "bangladeshi", "sri lankan",
    "urdu", "hindi", "punjabi", "tamil", "telugu", "marathi", "gujarati",
    "kannada", "bengali", "sinhala", "nepali",
    "polish", "czech", "slovak", "slovenian", "slovene", "hungarian", "romanian",
    "bulgarian", "greek", "albanian", "macedonian", "serbian", "croatian",
    "bosnian", "russian", "ukrainian", "estonian", "latvian", "lithuanian",
    "georgian", "armenian", "azerbaijani", "kazakh", "uzbek", "mongolian",
    "amharic", "ethiopian", "swahili", "yoruba", "igbo", "hausa", "zulu",
    "xhosa", "afrikaans", "maltese", "welsh", "irish",
    "bangla", "kirundi", "kurdish", "isixhosa", "twi", "malayalam", "chichewa",
    "creole", "kreyol", "kriol", "haitian", "kinyarwanda", "kinyarwandan", "kiswahili",
    "sinhalese", "luganda", "malagasy", "melayu", "samoan", "setswana", "somali",
    "venda", "faroese", "fijian", "miskito", "oromo", "runyankole", "shona", "sidama",
    "sindhi", "tigrigna", "tigrignan", "tongan", "dusun", "mirpuri", "myaamia",
    "deutsche", "portugese", "catalonian", "slovakian", "swiss", "scandinavian",
    "sign language", "argentinean", "ghanaian", "nepalese", "ugandan", "nigerian",
    "cuban", "dominican", "ecuadorian", "emirati", "gambian", "iraqi", "kenyan",
    "laotian", "malawian", "rwandan", "salvadoran", "venezuelan", "zambian",
    "zimbabwean", "singaporean", "puerto rican", "costa rican", "hispanic", "latino",
    "taiwan", "nepal", "india", "indonesia", "malaysia", "singapore", "chile",
    "china", "japan", "mexico", "israel", "kenya", "zimbabwe", "hong kong",
    "sierra leone",
)
#: Words that may stand between a language and the word for a version, and those words.
FILLER_WORDS = (
    "language", "speaking", "canadian", "portuguese", "short", "long", "brief", "revised",
    "modified", "abridged", "adapted", "validated", "paper", "electronic", r"[0-9]+(?:[ -]item)?",
)
VERSION_WORDS = ("version", "translation", "translated", "adaptation", "adaption", "edition", "revision")
COUNT_TOLERANCE = 0.25
CORE_WORDS, CORE_CHARS = 2, 8


def is_instrument(name: Column) -> Column:
    out = F.lit(False)
    for pattern in INSTRUMENT:
        out = out | name.rlike(pattern)
    return out


def is_translation(name: Column) -> Column:
    """Whether a name is a translated record's: a language before a word for a version, alone in closing brackets, in front,
    behind a double hyphen, or behind ``for``. False for null."""
    lang = "(?:" + "|".join(LANGUAGE_WORDS) + ")"
    forms = (
        rf"\b{lang}(?:[ -](?:{'|'.join(FILLER_WORDS)}))*[ -](?:{'|'.join(VERSION_WORDS)})s?\b",
        rf"\({lang}\)\s*$",
        rf"^{lang}\b",
        rf"--[^-]*\b{lang}\b",
        rf"\bfor {lang}\b",
    )
    return F.coalesce(F.lower(name).rlike("|".join(forms)), F.lit(False))


def count_fits(found: Column, expected: Column) -> Column:
    """Within a quarter of the expected count; an unknown expectation fits."""
    return expected.isNull() | (F.abs(found - expected) / F.greatest(expected, F.lit(1)) <= COUNT_TOLERANCE)


def core_is_safe(core: Column) -> Column:
    """A core name long enough to mean one thing."""
    return (F.size(F.split(core, " ")) >= CORE_WORDS) & (F.length(core) >= CORE_CHARS)


def passes(score: Column, threshold: Column) -> Column:
    """A missing or NaN score fails."""
    return F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))


def shard(order: Column, shards: int) -> Column:
    """The shard of a place in a sorted worklist: strides of ``shards``."""
    return F.pmod(order, F.lit(shards))

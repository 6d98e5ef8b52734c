"""Surrogates for personal data, with DataFrame functions only.

Entities (e-mail and IP addresses, telephone, card, social-security and bank-account numbers, and names of persons) are
found in whole texts by one pattern. Names stand behind a title, behind a label (``Author: ``) or before an e-mail
address in angle brackets; where such a name stands again in the same text without any of these, whole or as the family
name, it is found as well.

Each entity gets a surrogate that is a keyed hash of its normalised form, the same everywhere (coreference): digits by
digits, letters by letters of the same case, separators kept; card and bank-account numbers with valid check digits
where the original had them, the latter with their country. Names are replaced word by word, family and given
names apart, so ``Dr. Schmidt`` stays the ``Frau Maria Schmidt`` of another place; script, capitals and hyphens are
kept, and a given name's gender is that of the title, or else of the titles that the whole name has elsewhere (more of
one kind; of a tie, or without any, the ending decides).

Collisions are checked over the whole corpus: distinct entities are collected by a partial aggregate, and where
two share a surrogate, or a surrogate is a real entity, all but the smallest move on to their next candidate, in
rounds, until all differ; each attempt has more room (names get another syllable). Without exceptions the texts are
rewritten where they lie; up to MAP_ROWS exceptions (moved entities, and genders that are known from elsewhere) travel
as a map. More are joined by text: entities that are HOT or more of all mentions are few and stay in the map, and the
texts are dealt over salts, so that no frequent address or text makes a large task.

The key of the hash is the session's setting KEY_SETTING; where there is none, one is drawn and kept for the session.

Defined results: null text stays null with no entity; empty text stays empty; a text of any length is rewritten whole;
of overlapping entities the one that begins first counts, of two that begin together the kind listed first; repeated rows
are rewritten alike; other columns stay as they are whatever their names; null ids are carried; an empty table gives
an empty result.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import beside, table

KEY_SETTING = "spark.folioloom.pii.key"
MAP_ROWS = 1000  # exceptions that travel in the plan
HOT = 1000  # an entity of one mention in so many is hot: there are at most that many
SALTS = 16
MAX_ROUNDS = 60

EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,254}[A-Za-z0-9])?@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})++"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9A-Za-z+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
#: Titles by the gender that they tell, and labels that a name stands behind; fixed lists.
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Mme", "Mlle", "Frau", "Señora", "Señorita", "Sra", "Signora", "Г-жа", "Госпожа", "Κα")
MALE = ("Mr", "Mister", "Sir", "Monsieur", "Herr", "Señor", "Sr", "Signor", "Г-н", "Господин", "Κος")
EITHER = ("Dr", "Prof", "Professor", "Doctor")
LABELS = ("Name", "Author", "Contact", "From", "To", "Cc", "Attn", "Signed", "By")
GAP = r"[ \x{a0}]"


def _either_case(words: tuple[str, ...]) -> str:
    return "|".join(sorted({*words, *(w.upper() for w in words)}, key=lambda w: (-len(w), w)))


_TITLE = rf"(?:{_either_case((*FEMALE, *MALE, *EITHER))})\.?{GAP}"
CASED = r"\p{Lu}[\p{L}\p{M}'’-]+"
#: A word of a name: capitalised, or in a script without capitals.
WORD = rf"(?:{CASED}|\p{{IsHan}}{{2,4}}|\p{{IsHangul}}{{2,4}}|[\p{{IsKatakana}}\p{{IsHiragana}}ー]{{2,12}}|[\p{{IsArabic}}]{{2,24}}|[\p{{IsHebrew}}]{{2,24}}|[\p{{IsDevanagari}}]{{2,24}})"
NAME = (
    rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_TITLE}){{1,3}}(?:\p{{Lu}}\.{GAP}?){{0,2}}{WORD}(?:{GAP}{CASED}){{0,2}}"
    rf"|(?<=(?<!\p{{L}})(?:{'|'.join(LABELS)}): ){CASED}(?: {CASED}){{1,2}}"
    rf"|{CASED}(?: {CASED}){{1,2}}(?= <[A-Za-z0-9._%+-]{{1,64}}@))"
)
KINDS = {"email": EMAIL, "iban": IBAN, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE, "name": NAME}
ANY = "|".join(KINDS.values())
#: What a text must have to hold a name, or any entity; spares the others the long patterns.
NAME_HINT = rf"(?=\p{{Lu}})(?:{_TITLE}[\p{{Lu}}\p{{Lo}}]|(?:{'|'.join(LABELS)}): \p{{Lu}})| <[A-Za-z0-9._%+-]{{1,64}}@"
HINT = rf"(?=[@0-9\p{{Lu}}])(?:@|[0-9][0-9 .()-]{{6}}|[A-Z][0-9]{{2}}|{_TITLE}[\p{{Lu}}\p{{Lo}}]|(?:{'|'.join(LABELS)}): \p{{Lu}})"

#: Syllables and endings of surrogate names by script: the script's class, syllables, endings of women's and men's given names.
SCRIPTS = {
    "latin": (r"\p{IsLatin}", "ba do fe gi ka lo me ni pa ro se ti va wo za lu".split(), "a ina ella ia".split(), "o us ert an".split()),
    "cyrillic": (r"\p{IsCyrillic}", "ба до фе ги ка ло ме ни па ро се ти ва ву за лу".split(), "а ина елла ия".split(), "о ус ер ан".split()),
    "greek": (r"\p{IsGreek}", "βα δο φε γι κα λο με νι πα ρο σε τι βο ζα λι θε".split(), "α ίνα έλλα ία".split(), "ος ης ων ας".split()),
    "arabic": (r"\p{IsArabic}", "با دو في جي كا لو مي ني را رو سي تي وا زا لا ها".split(), "ة ية اء ى".split(), "د ن ر م".split()),
    "hebrew": (r"\p{IsHebrew}", "בא דו פי גי קא לו מי ני רא רו סי טי וא זא לא הא".split(), "ה ית את לה".split(), "ד ן ר ם".split()),
    "devanagari": (r"\p{IsDevanagari}", "बा दो फे गि का लो मे नि पा रो से ति वा जा ला हा".split(), "ा ी िका िता".split(), "न श र म".split()),
}
#: Scripts whose surrogate names are drawn letter by letter: the script's class, first code point, number of code points.
LETTERS = {"han": (r"\p{IsHan}", 0x4E00, 20_900), "hangul": (r"\p{IsHangul}", 0xAC00, 11_172), "kana": (r"[\p{IsKatakana}\p{IsHiragana}ー]", 0x30AB, 0x38)}
FEMALE_ENDING = r"[aаяαηήةה]$"  # of a given name that no title tells the gender of
F_GENDER, M_GENDER = 1, 2


def session_key(spark: SparkSession) -> str:
    """The secret of the keyed hash."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def kind_of(entity: Column) -> Column:
    out = F.lit("name")
    for kind in reversed([k for k in KINDS if k != "name"]):
        out = F.when(entity.rlike(rf"^(?:{KINDS[kind]})\z"), kind).otherwise(out)
    return out


def normal_of(kind: Column, entity: Column) -> Column:
    """What makes two mentions one entity: digits and letters of a number, an address or a word in lower case."""
    number = F.regexp_replace(F.upper(entity), r"[^0-9A-Z]", "")
    return F.when(kind.isin("iban", "ssn", "card", "phone"), number).otherwise(F.lower(entity))


def let(fn, **values: Column) -> Column:
    """``fn`` of the values' struct, each worked out once however often ``fn`` reads it."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), fn), 1)


# The text's entities
# -------------------


def pattern_of(text: Column) -> Column:
    """The pattern of a text: ANY, and the names that it introduces, as wholes and by the family name."""

    def with_names(x: Column) -> Column:
        bare = F.transform(x["names"], lambda e: F.regexp_replace(e, rf"^(?:{_TITLE})+(?:\p{{Lu}}\.{GAP}?)*", ""))
        cased = F.filter(bare, lambda w: w.rlike(rf"^{CASED}"))
        known = F.array_distinct(F.flatten(F.transform(cased, lambda w: F.array(w, F.regexp_extract(w, rf"({CASED})$", 1)))))
        quoted = F.transform(F.filter(known, lambda w: F.length(w) >= 3), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E")))
        longest = F.array_sort(quoted, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
        own = F.concat(F.lit(rf"{ANY}|(?<!\p{{L}})(?:"), F.array_join(longest, "|"), F.lit(r")(?!\p{L})"))
        return F.when(F.size(longest) > 0, own).otherwise(F.lit(ANY))

    return F.when(text.rlike(NAME_HINT), let(with_names, names=F.regexp_extract_all(text, F.lit(NAME), F.lit(0)))).otherwise(F.lit(ANY))


def mentions_of(text: Column, pattern: Column) -> Column:
    """array<struct(entity, kind, title, gender, words, full)> of the entities of a text with a HINT, in order; each step is
    a transform of its own, so that what a step works out is read from a field afterwards and never computed twice."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kinds = F.transform(found, lambda e: F.struct(e.alias("entity"), kind_of(e).alias("kind")))
    title = lambda x: F.when(x["kind"] == "name", F.regexp_extract(x["entity"], rf"^((?:{_TITLE})+)", 1)).otherwise("")
    titled = F.transform(kinds, lambda x: F.struct(x["entity"].alias("entity"), x["kind"].alias("kind"), title(x).alias("title")))

    def split(x: Column) -> Column:
        words = F.split(x["entity"].substr(F.length(x["title"]) + 1, F.length(x["entity"])), rf"{GAP}|(?<=\.)(?=\p{{L}})")
        gender = F.when(x["title"].rlike(rf"(?<!\p{{L}})(?:{_either_case(FEMALE)})(?!\p{{L}})"), F_GENDER).when(x["title"].rlike(rf"(?<!\p{{L}})(?:{_either_case(MALE)})(?!\p{{L}})"), M_GENDER).otherwise(0)
        return F.struct(x["entity"].alias("entity"), x["kind"].alias("kind"), x["title"].alias("title"), gender.alias("gender"), F.when(x["kind"] == "name", words).alias("words"))

    worded = F.transform(titled, split)
    whole = lambda x: F.lower(F.array_join(F.filter(x["words"], lambda w: ~w.endswith(".")), " "))
    full = lambda x: F.when((x["kind"] == "name") & whole(x).contains(" "), whole(x)).otherwise("")
    return F.transform(worded, lambda x: F.struct(*(x[c].alias(c) for c in ("entity", "kind", "title", "gender", "words")), full(x).alias("full")))


def _part_kind(word: Column, place: Column, size: Column, gender: Column) -> Column:
    return F.when(place == size - 1, "family").when(word.endswith("."), "initial").when(gender == F_GENDER, "given_f").otherwise("given_m")


def ending_gender(full: Column) -> Column:
    return F.when(F.substring_index(full, " ", 1).rlike(FEMALE_ENDING), F_GENDER).otherwise(M_GENDER)


def parts_of(mentions: Column, lookup) -> Column:
    """array<struct(title, parts)> of mentions; ``lookup`` gives the exception of (kind, normal), 0 where there is none.
    Parts are array<struct(kind, normal, text, attempt)>: the words of a name, any other entity as one."""

    def gendered(x: Column) -> Column:
        known = F.when(x["gender"] > 0, x["gender"]).when(x["full"] == "", 0).otherwise(lookup(F.lit("gender"), x["full"]))
        return F.struct(*(x[c].alias(c) for c in ("entity", "kind", "title", "words", "full")), known.alias("known"))

    def parted(x: Column) -> Column:
        gender = F.when(x["known"] > 0, x["known"]).otherwise(ending_gender(x["full"]))
        words = F.transform(x["words"], lambda w, i: F.struct(_part_kind(w, i, F.size(x["words"]), gender).alias("kind"), F.lower(w).alias("normal"), w.alias("text")))
        own = F.array(F.struct(x["kind"].alias("kind"), normal_of(x["kind"], x["entity"]).alias("normal"), x["entity"].alias("text")))
        return F.struct(x["title"].alias("title"), F.when(x["kind"] == "name", words).otherwise(own).alias("parts"))

    def tried(x: Column) -> Column:
        parts = F.transform(x["parts"], lambda p: F.struct(p["kind"].alias("kind"), p["normal"].alias("normal"), p["text"].alias("text"), lookup(p["kind"], p["normal"]).alias("attempt")))
        return F.struct(x["title"].alias("title"), parts.alias("parts"))

    return F.transform(F.transform(F.transform(mentions, gendered), parted), tried)


def entities_of(mentions: Column) -> Column:
    """array<struct(kind, normal, gender)>: what the mentions need to look up. A given name of unknown gender is there
    as a woman's and as a man's; a whole name is there with what its title tells."""

    def rows(x: Column) -> Column:
        row = lambda kind, normal, gender: F.struct(kind.alias("kind"), normal.alias("normal"), gender.alias("gender"))
        none = F.lit(0)

        def word(w: Column, i: Column) -> Column:
            last = i == F.size(x["words"]) - 1
            low = F.lower(w)
            both = F.filter(F.array(row(F.lit("given_f"), low, none), row(F.lit("given_m"), low, none)), lambda g: (x["gender"] == 0) | (g["kind"] == F.when(x["gender"] == F_GENDER, "given_f").otherwise("given_m")))
            return F.when(last, F.array(row(F.lit("family"), low, none))).when(w.endswith("."), F.array().cast("array<struct<kind:string,normal:string,gender:int>>")).otherwise(both)

        name = F.concat(F.flatten(F.transform(x["words"], word)), F.filter(F.array(row(F.lit("gender"), x["full"], x["gender"])), lambda g: g["normal"] != ""))
        return F.when(x["kind"] == "name", name).otherwise(F.array(row(x["kind"], normal_of(x["kind"], x["entity"]), none)))

    return F.flatten(F.transform(mentions, rows))


# Surrogates
# ----------


def _stream(kind: Column, normal: Column, attempt: Column, key: str) -> Column:
    """64 hexadecimal characters that depend on the key, the entity and the attempt."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, normal, attempt.cast("string")), 256)


def _at(stream: Column, place: Column, digits: int = 3) -> Column:
    return F.conv(stream.substr(F.pmod(place * 3, F.lit(65 - digits)).cast("int") + 1, F.lit(digits)), 16, 10).cast("int")


def _characters(entity: Column, stream: Column, places: bool = False) -> Column:
    """Every digit by a digit, every ASCII letter by a letter of its case; the rest stays. What is drawn goes by the
    number of digits and letters so far (separators don't count), or by the place."""

    def swap(x: Column, c: Column, i: Column) -> Column:
        rank = i + 1 if places else F.length(F.regexp_replace(x["e"].substr(F.lit(1), (i + 1).cast("int")), "[^0-9A-Za-z]", ""))

        def pick(y: Column) -> Column:
            letter = F.lit("bcdfghjklmnpqrstvwxz").substr(F.pmod(y["draw"], F.lit(20)) + 1, F.lit(1))
            return F.when(y["c"].rlike("[0-9]"), F.pmod(y["draw"], F.lit(10)).cast("string")).when(y["c"].rlike("[a-z]"), letter).otherwise(F.upper(letter))

        return F.when(c.rlike("[0-9A-Za-z]"), let(pick, draw=_at(x["s"], rank), c=c)).otherwise(c)

    def all_of(x: Column) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(x["e"], F.lit("(?s)."), F.lit(0)), lambda c, i: swap(x, c, i)), "")

    return let(all_of, e=entity, s=stream)


def _luhn(digits: Column) -> Column:
    """The digit that makes ``digits`` followed by it pass the Luhn test."""

    def weight(x: Column, i: Column) -> Column:
        d = x["d"].substr(i.cast("int"), F.lit(1)).cast("int")
        double = F.pmod(F.length(x["d"]) - i, F.lit(2)) == 0
        return F.when(double & (d > 4), 2 * d - 9).when(double, 2 * d).otherwise(d)

    def check(x: Column) -> Column:
        total = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x["d"]), F.lit(1))), lambda i: weight(x, i)), F.lit(0), lambda a, v: a + v)
        return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")

    return let(check, d=digits)


def _card(entity: Column, stream: Column) -> Column:
    def one(x: Column) -> Column:
        body = x["d"].substr(F.lit(1), F.length(x["d"]) - 1)
        head = F.regexp_replace(x["new"], "[0-9]$", "")
        return F.when(_luhn(body) == F.substring(x["d"], -1, 1), F.concat(head, _luhn(F.regexp_replace(head, "[^0-9]", "")))).otherwise(x["new"])

    return let(one, d=F.regexp_replace(entity, "[^0-9]", ""), new=_characters(entity, stream))


def _mod97(number: Column) -> Column:
    """The remainder of an account number: digits as they are, letters as 10 to 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.transform(F.regexp_extract_all(number, F.lit("."), F.lit(0)), value), F.lit(0), lambda a, v: F.pmod(F.when(v > 9, a * 100 + v).otherwise(a * 10 + v), F.lit(97)))


def _iban(entity: Column, stream: Column) -> Column:
    """Country kept; check digits that are right where they were."""

    def one(x: Column) -> Column:
        country = F.substring(x["e"], 1, 2)
        right = _mod97(F.concat(x["bare"].substr(F.lit(5), F.length(x["bare"])), F.substring(x["bare"], 1, 4))) == 1
        rest = x["new"].substr(F.lit(5), F.length(x["new"]))
        zero = F.concat(F.regexp_replace(rest, " ", ""), country, F.lit("00"))
        check = F.when(right, F.lpad((F.lit(98) - _mod97(zero)).cast("string"), 2, "0")).otherwise(F.substring(x["new"], 3, 2))
        return F.concat(country, check, rest)

    return let(one, e=entity, bare=F.regexp_replace(entity, " ", ""), new=_characters(entity, stream))


def _letters(text: Column, attempt: Column, stream: Column, first: Column, count: Column) -> Column:
    """As many letters of a script; more from the fourth attempt on."""
    code = lambda i: first + F.pmod(_at(stream, i, 6), count)
    letter = lambda i: F.decode(F.unhex(F.lpad(F.hex(code(i)), 4, "0")), "UTF-16BE")
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text) + F.greatest(attempt - 3, F.lit(0))), letter), "")


def _syllables(x: Column) -> Column:
    """Four syllables for a family name, two and an ending for a given name, one more an attempt."""

    def made(y: Column) -> Column:
        family = F.when(y["hyphen"], F.concat(F.initcap(y["head"]), F.lit("-"), F.initcap(y["tail"]))).otherwise(F.initcap(F.concat(y["head"], y["tail"])))
        given = F.when(y["hyphen"], F.concat(F.initcap(y["head"]), F.lit("-"), F.initcap(F.concat(y["tail"], y["ending"])))).otherwise(F.initcap(F.concat(y["head"], y["more"], y["ending"])))
        return F.when(y["k"] == "family", family).otherwise(given)

    pick = lambda values, place: F.element_at(values, F.pmod(_at(x["s"], place), F.size(values)).cast("int") + 1)
    some = lambda a, b: F.array_join(F.transform(F.sequence(F.lit(a), b), lambda i: pick(x["syllables"], i)), "")
    out = let(
        made, k=x["k"], head=some(2, F.lit(3)), tail=some(4, x["a"] + 5), more=F.when(x["a"] > 0, some(4, F.greatest(x["a"], F.lit(1)) + 3)).otherwise(""),
        ending=pick(F.when(x["k"] == "given_f", x["female"]).otherwise(x["male"]), F.lit(1)), hyphen=x["w"].contains("-"),
    )
    return let(lambda y: F.when((F.length(y["w"]) > 1) & (y["w"] == F.upper(y["w"])) & (y["w"] != F.lower(y["w"])), F.upper(y["o"])).otherwise(y["o"]), w=x["w"], o=out)


def _name(kind: Column, text: Column, attempt: Column, stream: Column) -> Column:
    of_script = lambda values: F.array(*map(F.lit, values))

    def one(x: Column) -> Column:
        letter = F.upper(F.lit("abcdefghijklmnopqrstuvwxyz").substr(F.pmod(_at(x["s"], F.lit(1)), F.lit(26)) + 1, F.lit(1)))
        drawn = _letters(x["w"], x["a"], x["s"], x["first"], x["count"])
        return F.when(x["k"] == "initial", F.concat(letter, F.lit("."))).when(x["count"] > 0, drawn).otherwise(_syllables(x))

    def scripted(x: Column) -> Column:
        values = [of_script(v) for v in SCRIPTS["latin"][1:]]
        for name, (script, *own) in SCRIPTS.items():
            if name != "latin":
                values = [F.when(x["w"].rlike(rf"^{script}"), of_script(v)).otherwise(old) for v, old in zip(own, values, strict=True)]
        first = count = F.lit(0)
        for script, a, n in LETTERS.values():
            first, count = F.when(x["w"].rlike(rf"^{script}"), a).otherwise(first), F.when(x["w"].rlike(rf"^{script}"), n).otherwise(count)
        return let(one, k=x["k"], w=x["w"], a=x["a"], s=x["s"], syllables=values[0], female=values[1], male=values[2], first=first, count=count)

    return let(scripted, k=kind, w=text, a=attempt, s=stream)


def surrogate(kind: Column, text: Column, attempt: Column, s: Column) -> Column:
    """The surrogate of an entity or a word of a name, from its stream."""
    octet = lambda p: (F.pmod(_at(s, F.lit(p)), F.lit(254)) + 1).cast("string")
    local, domain = F.regexp_extract(text, "^(.*)@", 1), F.regexp_extract(text, r"\.([A-Za-z0-9-]+)$", 1)
    host = F.regexp_replace(F.regexp_extract(text, r"@(.*)\.[A-Za-z0-9-]+$", 1), "-", "0")
    wider = F.substring(F.sha2(s, 256), 1, F.greatest(attempt - 3, F.lit(0)))  # short addresses run out of letters
    email = F.concat(_characters(local, s, True), wider, F.lit("@"), _characters(host, F.sha2(s, 256), True), F.lit("."), domain)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *map(octet, (1, 5, 9, 13))))
        .when(kind == "card", _card(text, s))
        .when(kind == "iban", _iban(text, s))
        .when(kind.isin("ssn", "phone"), _characters(text, s))
        .otherwise(_name(kind, text, attempt, s))
    )


def surrogates(told: Column, key: str) -> Column:
    """array<string>: the surrogates of mentions as parts_of gives them."""

    def one(x: Column) -> Column:
        streams = F.transform(x["parts"], lambda p: F.struct(*(p[c].alias(c) for c in ("kind", "text", "attempt")), _stream(p["kind"], p["normal"], p["attempt"], key).alias("stream")))
        return F.concat(x["title"], F.array_join(F.transform(streams, lambda p: surrogate(p["kind"], p["text"], p["attempt"], p["stream"])), " "))

    return F.transform(told, one)


# The corpus
# ----------


def _found(text: Column) -> Column:
    """The text's mentions."""
    return let(lambda x: mentions_of(x["t"], x["p"]), t=text, p=pattern_of(text))


def exceptions(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(exceptions, entities), both written to the shared folder. Exceptions are (kind, normal, attempt): entities
    that can't take their first surrogate, and whole names (kind gender) whose gender is known from elsewhere.
    Entities are (kind, normal, n), n the mentions."""
    ensure_checkpoint_dir(docs.sparkSession)
    # Few bytes but much work a row: a set number of partitions isn't merged.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.where(F.col(text).rlike(HINT)).select(F.inline(entities_of(_found(F.col(text)))))
    tells = lambda value, name: F.count_if(F.col("gender") == value).alias(name)
    entities = rows.groupBy("kind", "normal").agg(F.count("*").alias("n"), tells(0, "u"), tells(F_GENDER, "f"), tells(M_GENDER, "m")).repartition(tasks, "kind", "normal").checkpoint()
    names = entities.where("kind = 'gender' and u > 0 and f <> m").select("kind", "normal", F.when(F.col("f") > F.col("m"), F_GENDER).otherwise(M_GENDER).alias("attempt"))
    genders = names.where(F.col("attempt") != ending_gender(F.col("normal")))
    distinct = entities.where("kind <> 'gender'").select("kind", "normal")

    def made(attempt: Column) -> Column:
        out = let(lambda x: surrogate(x["k"], x["n"], x["a"], x["s"]), k=F.col("kind"), n=F.col("normal"), a=attempt, s=_stream(F.col("kind"), F.col("normal"), attempt, key))
        return let(lambda x: normal_of(x["k"], x["o"]), k=F.col("kind"), o=out)

    def losers(rows: DataFrame, taken: DataFrame | None) -> DataFrame:
        """Of rows (kind, normal, attempt), those whose surrogate is real, taken, or won by a smaller entity."""
        rows = rows.withColumn("made", made(F.col("attempt")))
        first = rows.groupBy("kind", "made").agg(F.min("normal").alias("winner"), F.count("*").alias("n"))
        out = rows.join(first.where("n > 1"), ["kind", "made"], "left").withColumn("lost", F.coalesce(F.col("winner") != F.col("normal"), F.lit(False)))
        real = distinct.select("kind", F.col("normal").alias("made"), F.lit(True).alias("real"))
        out = out.join(real, ["kind", "made"], "left")
        out = out.join(taken.withColumn("held", F.lit(True)), ["kind", "made"], "left") if taken is not None else out.withColumn("held", F.lit(False))
        return out.where(F.col("lost") | F.coalesce("real", F.lit(False)) | F.coalesce("held", F.lit(False))).select("kind", "normal", "attempt")

    lost = losers(distinct.withColumn("attempt", F.lit(0)), None).checkpoint()
    settled = None
    for attempt in range(1, MAX_ROUNDS):
        if lost.isEmpty():
            break
        open_ = lost.select("kind", "normal", F.lit(attempt).alias("attempt"))
        # Surrogates of all that keep theirs: first attempts that were not lost, and those settled since.
        moved = open_ if settled is None else open_.select("kind", "normal").unionByName(settled.select("kind", "normal"))
        taken = distinct.join(moved.select("kind", "normal"), ["kind", "normal"], "left_anti").withColumn("attempt", F.lit(0))
        taken = taken if settled is None else taken.unionByName(settled)
        again = losers(open_, taken.withColumn("made", made(F.col("attempt"))).select("kind", "made").distinct()).checkpoint()
        won = open_.join(again.select("kind", "normal"), ["kind", "normal"], "left_anti")
        settled = (won if settled is None else settled.unionByName(won)).checkpoint()
        lost = again
    else:
        raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")
    out = genders if settled is None else genders.unionByName(settled)
    return out.checkpoint(), entities.select("kind", "normal", "n")


def with_surrogates(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and n_entities added as the last column."""
    key = key or session_key(docs.sparkSession)
    moved, entities = exceptions(docs, text, key)
    named = F.concat_ws("\x1f", "kind", "normal")
    few = moved.select(named.alias("name"), "attempt").limit(MAP_ROWS + 1).collect()
    # No name of these can clash with a column: all columns' names are part of it.
    own = lambda name: f"_{name}_{'_'.join(docs.columns)}"

    def mapped(rows: list) -> Column | None:
        return F.create_map(*(F.lit(x) for r in rows for x in (r["name"], r["attempt"]))) if rows else None

    def lookup(*maps: Column | None):
        known = [m for m in maps if m is not None]
        return lambda k, n: F.coalesce(*(F.try_element_at(m, F.concat_ws("\x1f", k, n)) for m in known), F.lit(0)) if known else F.lit(0)

    def finished(df: DataFrame, exception) -> DataFrame:
        """The columns of ``docs`` with the new text, and n_entities; entities and text are worked out once a row."""

        def one(x: Column) -> Column:
            joined = F.array_join(F.zip_with(F.split(x["t"], x["p"], -1), x["e"], lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), "")
            return F.struct(F.when(F.size(x["e"]) > 0, joined).otherwise(x["t"]).alias("text"), F.size(x["e"]).cast("long").alias("n"))

        def told(x: Column) -> Column:
            made = surrogates(parts_of(mentions_of(x["t"], x["p"]), exception), key)
            return let(one, t=x["t"], p=x["p"], e=made)

        # A text without a hint, most are, costs that one look.
        bare = F.struct(F.col(text).alias("text"), F.lit(0).cast("long").alias("n"))
        out = df.withColumn(own("made"), F.when(F.col(text).rlike(HINT), let(told, t=F.col(text), p=pattern_of(F.col(text)))).otherwise(bare))
        made = F.col(own("made"))
        count = beside("", *[c for c in docs.columns], "n_entities")[-1]
        return out.select(*[made["text"].alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns], made["n"].alias(count))

    if len(few) <= MAP_ROWS:
        return finished(docs, lookup(mapped(few)))

    # Many exceptions: those of a text are joined to it as a map.
    total = entities.agg(F.sum("n")).first()[0]
    hot = entities.where(F.col("n") * HOT >= total).join(moved, ["kind", "normal"], "left").select(named.alias("name"), F.coalesce("attempt", F.lit(0)).alias("attempt")).collect()
    h1, h2, salt, found = (own(x) for x in ("h1", "h2", "salt", "found"))
    ids = [F.xxhash64(F.col(text)).alias(h1), F.xxhash64(F.lit(1), F.col(text)).alias(h2)]
    needs = docs.where(F.col(text).rlike(HINT)).select(*ids, F.inline(entities_of(_found(F.col(text))))).select(h1, h2, named.alias("name")).distinct()
    rest = needs.where(~F.col("name").isin([r["name"] for r in hot])) if hot else needs
    joined = rest.join(moved.select(named.alias("name"), "attempt"), "name").groupBy(h1, h2).agg(F.map_from_entries(F.collect_list(F.struct("name", "attempt"))).alias(found))
    salted = joined.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = docs.select("*", *ids).withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return finished(dealt.join(salted, [h1, h2, salt], "left"), lookup(F.col(found), mapped(hot)))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return with_surrogates(table(spark, sf_dir, "documents", "doc_id", "text"))

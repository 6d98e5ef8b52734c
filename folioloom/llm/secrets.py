"""Secret scans by assignment-aware lexing.

Base spans come from three patterns (an assignment to a sensitive name, access key ids, long hexadecimal
strings). The method adds spans. Source and configuration syntax is read into name-literal pairs: targets are bare,
dotted, quoted or subscripted names (``a.b``, ``"db_pwd":``, ``cfg["db_pwd"] =``), with or without a type
(``db_pwd: str =``), and XML elements; values are quoted literals (escapes, prefixes, triple quotes, back ticks), several
of them added or put side by side, indented blocks, bare literals and other names, on the operator's line or, where
quoted, on a later one. Sensitive names also take every quoted literal of a list, set, tuple, nested object or call
(``os.environ.get("DB_PWD", "...")``; there, what is letters and underscores only is a name), the entries of an indented
list, their place of a tuple (``db_pwd, n = "...", 1``), and the ``value`` of a tag that names them
(``<add key="db_pwd" value="..."/>``). Constants are propagated (``a = "..."`` then ``password = a``; a name stands for all
literals it was given, through any number of names; lists are not followed through names), and a literal is reported
where its target's name is sensitive and its own form (length, alphabet, entropy) scores high enough. Literals and names
may have any length, and pairs inside a literal are read too. No assignments, and so not read: comparisons, arguments
of calls whose name is sensitive, credentials within addresses, and literals with blanks.

Spans are kind:start:end in code points, end exclusive; a literal in several pieces has a span a piece. Defined results:
null text counts as empty and has no spans; a very long text is read once from end to end; of spans that start
together the kind listed first comes first; repeated rows are scanned one by one; null ids are carried; an empty table
gives no rows; extra columns are not read by ``scan_documents`` and stay in ``redact``; output columns that would be
named like the key get a leading underscore.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import beside, map_slices, table

KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16


def _either(word: str) -> str:
    """The word with its ASCII letters in either case, and no other character that folds to them."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# The runs of these two are maximal, so asking for the least length finds what dropping short runs leaves.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

_WORD = r"[A-Za-z_$][A-Za-z0-9_.$-]*+"
#: A target with its operator; no run of characters is tried twice. An operator belongs to no comparison or scope mark.
TARGET = re.compile(
    rf"""(?<![A-Za-z0-9_.$-])-*+(?:"({_WORD})"|'({_WORD})'|({_WORD}))\]?[ \t]*+(:=|=>|<-|\+=|\?=|=(?![=~])|:(?!:))[ \t]*+"""
    rf"""|<({_WORD})(?=(?:\s[^<>]*+)?>)"""
)
ANNOTATION = re.compile(r"[A-Za-z_][A-Za-z0-9_.|\[\], ]*+=(?!=)[ \t]*+")  # the type behind a name's colon, and its operator
OPENING = re.compile(r"\(?\s*")
PREFIX = re.compile(r"""[rRbBuUfF@$]{0,2}(?=["'`])""")
QUOTED = {
    '"': re.compile(r'"((?:[^"\\\n]|\\.)*+)"', re.DOTALL),
    "'": re.compile(r"'((?:[^'\\\n]|\\.)*+)'", re.DOTALL),
    "`": re.compile(r"`((?:[^`\\]|\\.)*+)`", re.DOTALL),
}
NEXT_PIECE = re.compile(r"""(?:[ \t]*+(?:\\\n[ \t]*+)?|\s*+(?:\+|\.\.?|&|<>)\s*+)(?=[rRbBuUfF]{0,2}["'`])""")
NEXT_LINE = re.compile(r"""\s*+(?:(?:\+|\.\.?|&|<>)\s*+)?(?=[rRbBuUfF]{0,2}["'`])""")  # within brackets
PLUS = re.compile(r"\s*+\+\s*+")
BARE = re.compile(r"""[^\s"',;(){}\[\]<>&]++(?:&(?![A-Za-z_][A-Za-z0-9_.-]*+=)[^\s"',;(){}\[\]<>&]*+)*+""")
SUBSCRIPT = re.compile(r"""\[\s*(?:"([^"\n]++)"|'([^'\n]++)')\s*\]""")
BLOCK_MARK = re.compile(r"[|>][+-]?[ \t]*+\n(?=([ \t]++)\S)")
NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$-]*+")
PLAIN = re.compile(r"[A-Za-z_.]+")  # a name, even where no pair of the text defines it
ESCAPE = re.compile(r"\\(.)", re.DOTALL)
LATER_LINE = re.compile(r"""(?:\\)?\n\s*+(?=[rRbBuUfF]{0,2}["'`])""")
ENTRY = re.compile(r"\n[ \t]*+-[ \t]++")
CALL = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*+(?=\()")
IS_KEY = re.compile(r"\s*+(?::(?!:)|=(?!=))")
INSIDE = re.compile(r"""[^\[\](){}"'`]++""")
SEVERAL = re.compile(rf"((?<![A-Za-z0-9_.$-]){_WORD}(?:[ \t]*+,[ \t]*+{_WORD})++)[ \t]*+(=(?!=)[ \t]*+)?")
COMMA = re.compile(r"[ \t]*+,[ \t]*+")
TAG = re.compile(r"<[A-Za-z][^<>]*+>")
ATTRIBUTE = re.compile(r"""([A-Za-z_:][A-Za-z0-9_.:-]*+)\s*+=\s*+(?:"([^"<>]*+)"|'([^'<>]*+)')""")
COUNTED = 4096  # longer literals are counted by numpy
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "accesskey", "privatekey", "credential", "authkey", "clientkey", "signingkey", "encryptionkey")
SENSITIVE_BYTES = [x.encode() for x in SENSITIVE]
NOT_LOWER = bytes(sorted(set(range(256)) - set(range(97, 123))))
BENIGN = ("public", "count", "length", "size", "type", "name", "file", "path", "url", "limit", "max", "min")
MIN_LITERAL, MIN_SCORE = 8, 0.5


def name_weight(name: str) -> float:
    """How sensitive a target's name is, 0 to 1."""
    flat = re.sub(r"[^a-z]", "", name.lower())
    if not any(x in flat for x in SENSITIVE):
        return 0.0
    return 0.4 if any(flat.endswith(x) or flat.startswith(x) for x in BENIGN) else 1.0


def literal_weight(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: entropy per character, length and mixed alphabets."""
    n = len(value)
    if n < MIN_LITERAL or any(map(str.isspace, value)) or re.fullmatch(r"(?:\$\{.*\}|<.*>|\*+|x+|X+|\.+)", value):
        return 0.0
    if n > COUNTED:
        counts = np.bincount(np.unique(np.frombuffer(value.encode("utf-32-le", "replace"), dtype=np.uint32), return_inverse=True)[1])
    else:
        counts = Counter(value).values()
    entropy = -sum(k / n * math.log2(k / n) for k in counts)
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4) * min(1.0, n / 12) * (0.5 + 0.25 * min(classes, 3) if classes > 1 else 0.4)


class Lexer:
    """Reads a text's name-literal pairs from left to right."""

    def __init__(self, text: str):
        self.text = text
        self.open: dict[str, int] = {}  # quote -> the end of the line on which it is known not to be closed
        self.bare = (0, 0)  # the last bare run
        self.block_end = 0  # of the last block; what stands in it is none
        self.taken = 0  # end of the last bracket whose literals a sensitive name took

    def quoted(self, at: int) -> tuple[int, int, int] | None:
        """(start, end, stop) of the content of a quoted literal that begins at ``at`` (its prefix included)."""
        text = self.text
        at = PREFIX.match(text, at).end() if PREFIX.match(text, at) else -1
        if at < 0:
            return None
        quote = text[at]
        if text.startswith(quote * 3, at) and quote != "`":
            end = text.find(quote * 3, at + 3) if self.open.get(quote * 3, -1) < at else -1
            if end >= 0:
                return at + 3, end, end + 3
            self.open[quote * 3] = len(text)
        if at < self.open.get(quote, -1):
            return None
        if m := QUOTED[quote].match(text, at):
            return *m.span(1), m.end()
        line = text.find("\n", at) if quote != "`" else -1
        self.open[quote] = line if line >= 0 else len(text)
        return None

    def run(self, at: int) -> int:
        """The end of the bare literal at ``at``."""
        start, end = self.bare
        if not start <= at < end:
            m = BARE.match(self.text, at)
            if m is None:
                return at
            self.bare = (at, m.end())
            end = m.end()
        return end

    def value(self, at: int) -> tuple[list[tuple[int, int]], list[tuple[str, int, int]]]:
        """(pieces of the literal, (name, start, end) of names) of the value at ``at``: operands that are added or stand
        side by side."""
        text, pieces, names = self.text, [], []
        if m := BLOCK_MARK.match(text, at):
            return ([self.block(m.end(), m.group(1))] if at >= self.block_end else []), []
        inside = text.startswith("(", at)
        at = OPENING.match(text, at).end() if inside else at
        while True:
            if found := self.quoted(at):
                pieces.append(found[:2])
                at = found[2]
                if m := (NEXT_LINE if inside else NEXT_PIECE).match(text, at):
                    at = m.end()
                    continue
            else:
                m = NAME.match(text, at)
                end = self.run(at)
                added = m is not None and end == m.end() + 1 and text[m.end()] == "+"  # a+"b"
                if m is None or (m.end() < end and not added):
                    return (pieces or ([(at, end)] if end > at else [])), names
                names.append((m.group().lstrip("$"), *m.span()))
                at = m.end()
                if part := SUBSCRIPT.match(text, at):
                    names[-1] = (part.group(1) or part.group(2), *names[-1][1:])
                    at = part.end()
            if not (m := PLUS.match(text, at)):
                return pieces, names
            at = m.end()

    def block(self, at: int, indent: str) -> tuple[int, int]:
        """The lines from ``at`` on that begin with ``indent``."""
        start, end = at + len(indent), at
        while self.text.startswith(indent, end):
            line = self.text.find("\n", end)
            end = len(self.text) if line < 0 else line + 1
            if line < 0:
                break
        self.block_end = end
        return start, max(start, end - self.text.endswith("\n", at, end))

    def bracket(self, at: int) -> Iterator[tuple[int, int]]:
        """The quoted literals up to the end of the bracket that opens at ``at``, nested ones too, keys left out. What a
        name has taken is not read again for a name within."""
        text = self.text
        if at < self.taken or at >= len(text) or text[at] not in "[({":
            return
        depth, call = 0, text[at] == "(" and at and (text[at - 1].isalnum() or text[at - 1] == "_")
        while at < len(text):
            if text[at] in "[({":
                depth += 1
            elif text[at] in "])}":
                depth -= 1
                if not depth:
                    break
            elif text[at] in "\"'`":
                if found := self.quoted(at):
                    start, end, at = found
                    if not IS_KEY.match(text, at) and not (call and PLAIN.fullmatch(text, start, end)):
                        yield start, end
                    continue
            elif m := INSIDE.match(text, at):
                at = m.end()
                continue
            at += 1
        self.taken = at

    def more(self, at: int) -> Iterator[tuple[int, int]]:
        """Literals of a value at ``at`` that is no single one: on a later line, in brackets or a call, in a list of entries."""
        text = self.text
        call = CALL.match(text, at)
        yield from self.bracket(call.end() if call else at)
        if m := LATER_LINE.match(text, at):
            if (found := self.quoted(m.end())) and not IS_KEY.match(text, found[2]):
                yield found[:2]
        while m := ENTRY.match(text, at):
            if found := self.quoted(m.end()):
                at = found[2]
                if IS_KEY.match(text, at):
                    return
                yield found[:2]
            elif (at := self.run(m.end())) > m.end():
                if text.endswith(":", m.end(), at):
                    return
                yield m.end(), at
            else:
                return

    def others(self) -> Iterator[tuple[str, tuple[int, int]]]:
        """(name, literal) of tuples and of tags that name what they hold."""
        text = self.text
        for m in SEVERAL.finditer(text) if "," in text else ():
            at = m.end()
            for name in re.findall(_WORD, m.group(1)) if m.group(2) else ():
                if found := self.quoted(at):
                    yield name, found[:2]
                    at = found[2]
                else:
                    end = self.run(at)
                    if end > at and name_weight(name) and not NAME.fullmatch(text, at, end):
                        yield name, (at, end)
                    at = end
                after = COMMA.match(text, at)
                if not after:
                    break
                at = after.end()
        for tag in TAG.finditer(text) if "<" in text else ():
            held = {m.group(1).lower(): (m.span(2) if m.group(2) is not None else m.span(3)) for m in ATTRIBUTE.finditer(text, *tag.span())}
            named = next((held[k] for k in ("name", "key", "id") if k in held), None)
            if named and "value" in held:
                yield text[slice(*named)], held["value"]

    def pairs(self) -> Iterator[tuple[str, list[tuple[int, int]], list[tuple[str, int, int]]]]:
        """(name, pieces of its literal, names it was given), in order."""
        text, typed = self.text, 0  # up to ``typed`` there is a type, no target
        for m in TARGET.finditer(text):
            if m.start() < typed:
                continue
            if element := m.group(5):
                start = text.index(">", m.end()) + 1
                end = text.find("<", start)
                if end > start and text.startswith(f"</{element}", end):
                    yield element, [(start, end)], []
                continue
            name = (m.group(1) or m.group(2) or m.group(3)).lstrip("$")
            yield name, *self.value(m.end())
            if name_weight(name):
                for piece in self.more(m.end()):
                    yield name, [piece], []
            if m.group(4) == ":" and (kind := ANNOTATION.match(text, m.end())):
                typed = kind.end()
                yield name, *self.value(typed)
                if name_weight(name):
                    for piece in self.more(typed):
                        yield name, [piece], []
        for name, piece in self.others():
            yield name, [piece], []


def lexed(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through other names.

    A value that could be a name is one where some pair of the text defines it, or where it is letters only; else it
    is a bare literal. A name stands for all literals that it was given, and for those of all names that it was given.
    """
    pairs = list(Lexer(text).pairs())
    weights = {name: name_weight(name) for name, _, _ in pairs}
    literals: dict[str, list[tuple[tuple[int, int], ...]]] = {}
    others: dict[str, set[str]] = {}
    found: set[tuple[int, int]] = set()
    passed: set[tuple] = set()
    reach = 0  # end of the reported pieces: a pair inside a reported literal reports nothing new

    def judge(pieces: tuple[tuple[int, int], ...], weight: float) -> None:
        if not weight or (pieces, weight) in passed:
            return
        passed.add((pieces, weight))
        value = "".join(ESCAPE.sub(r"\1", text[a:b]) for a, b in pieces)
        if "\n" in value:  # a block, or a literal over several lines
            value = "".join(value.split())
        if weight * literal_weight(value) >= MIN_SCORE:
            found.update((a, b) for a, b in pieces if b > a)

    for name, pieces, names in pairs:
        known = [other for other, _, _ in names if other in weights or PLAIN.fullmatch(other)]
        if known:
            others.setdefault(name, set()).update(known)
        elif names and not pieces:
            pieces = [names[0][1:]]
        if pieces:
            given = tuple(pieces)
            literals.setdefault(name, []).append(given)
            if given[-1][1] > reach:
                judge(given, weights[name])
                if given[-1] in found:
                    reach = given[-1][1]
    for weight in set(weights.values()) - {0.0}:
        front = [name for name in others if weights[name] == weight]
        seen = set(front)
        while front:
            name = front.pop()
            for pieces in literals.get(name, ()):
                judge(pieces, weight)
            new = others.get(name, set()) - seen
            seen |= new
            front += new
    return sorted(found)


def may_name(low: str) -> bool:
    """Whether a lower-cased text can hold a sensitive name; names are judged by their letters alone."""
    letters = low.encode("utf-8", "replace").translate(None, NOT_LOWER)
    return any(x in letters for x in SENSITIVE_BYTES)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span, in order; kind indexes KINDS."""
    spans = []
    if "=" in text or ":" in text or "<" in text:
        low = text.lower()
        if any(x in low for x in ("password", "passwd", "secret", "token", "key")):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
        if may_name(low):
            spans += [(s, 3, e) for s, e in lexed(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_assign, n_access, n_hex, base_sha256, spans, n_literal."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, *beside(key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for value in part.column(1).to_pylist():
                spans = scan(value or "")
                n = Counter(k for _, k, _ in spans)
                base = joined([x for x in spans if x[1] < 3])
                out.append((n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), joined(spans), n[3]))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

        return handle

    picked = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, (kind, "long", "long", "long", "string", "string", "long"), strict=True))
    return map_slices(picked, make, schema)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", count: str | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping spans by one mark); other columns
    stay, but for ``count``, which gets the new number of characters where the text changed."""
    names = docs.columns
    at = names.index(text)

    def clean(value: str | None) -> str | None:
        spans = scan(value) if value else ()
        out, end = [], 0
        for start, _, stop in spans:
            if start >= end:
                out += [value[end:start], mark]
            end = max(end, stop)
        return "".join(out) + value[end:] if out else value

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            old = part.column(at).to_pylist()
            new = [clean(x) for x in old]
            columns = list(part.columns)
            columns[at] = pa.array(new, part.schema.field(at).type)
            if count is not None:
                k = names.index(count)
                sizes = [n if a is b else len(b) for a, b, n in zip(old, new, columns[k].to_pylist(), strict=True)]
                columns[k] = pa.array(sizes, part.schema.field(k).type)
            return pa.RecordBatch.from_arrays(columns, names=names)

        return handle

    return map_slices(docs, make, docs.schema)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    return scan_documents(table(spark, sf_dir, "documents", "doc_id", "text"))

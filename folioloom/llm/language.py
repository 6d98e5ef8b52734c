"""Language identification of mixed-language text.

A word's script range narrows the candidate languages; its character trigrams score those that remain; a
Viterbi pass over the words with a penalty for switching labels spans. The document's language is the one
that labels most letters, or else one that opens and closes the text and labels FRAME_SHARE of it: what
stands inside is then a quotation.

The model (letter trigrams by language, of all letters and all languages that the sample holds) is fitted on a bounded
sample of labelled rows (SAMPLE_DOCS a language in expectation, drawn by a hash of the id, MAX_SAMPLE at most); every
document is labelled over its whole text. A trigram that the sample lacks is scored by its context and its bigram.

Everything runs on arrays over blocks of about BLOCK_CHARS characters (fewer where there are many languages): the
Viterbi pass walks chunks of CHUNK words side by side (each chunk as a matrix from entry to exit language), joins the
chunks of a document, and walks back. It is exact, however long the text.

Defined results: null text and text without a letter are ``und`` with score 0 and no spans; a text of any length is
labelled whole; repeated rows are labelled one by one; ties go to the language that sorts first; an empty training
sample makes every text ``und``; an empty table gives no rows; null ids are carried; extra columns are not read, and
output columns that would be named like the key get a leading underscore.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import beside, keyed_share, remainder, slices, table

SAMPLE_DOCS = 400  # labelled rows a language, in expectation
MAX_SAMPLE = 2 * SAMPLE_DOCS  # labelled rows a language at most
MANY_LANGS = 16  # with more languages than that, blocks are smaller by the square: a chunk's matrix is
SWITCH = 6.0  # log-odds that a change of language costs
FLOOR = -8.0  # log-probability that no letter falls below
SCRIPT_SHARE = 0.01  # a language uses a script that holds this share of its letters
WRONG_SCRIPT = -30.0
BLOCK_CHARS = 1 << 20
CHUNK = 64
FRAME_SHARE = 0.25  # of the letters, for a language that opens and closes the text

#: Script ranges (first code point, last code point), most used first; index 0 stands for any other.
SCRIPTS = (
    (0x0000, 0x024F), (0x0370, 0x03FF), (0x0400, 0x052F), (0x0530, 0x058F), (0x0590, 0x05FF), (0x0600, 0x077F), (0x0900, 0x097F),
    (0x0980, 0x09FF), (0x0B80, 0x0BFF), (0x0E00, 0x0E7F), (0x10A0, 0x10FF), (0x1100, 0x11FF), (0x1E00, 0x1EFF), (0x1F00, 0x1FFF),
    (0x3040, 0x309F), (0x30A0, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF),
)


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """code point -> whether it is a letter, and code point -> script."""
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
    scripts = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for i, (a, b) in enumerate(SCRIPTS, 1):
        scripts[a : b + 1] = i
    scripts[0x1E00:0x1F00] = 1  # Latin additions
    return letters, scripts


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


@dataclass
class Table:
    """Log-probabilities by key: a sorted array of keys and a row of languages for each."""

    keys: np.ndarray
    rows: np.ndarray  # (keys, langs) float32

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of every key."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)


@dataclass
class Model:
    langs: list[str]
    trigrams: Table  # P(c | two letters before)
    contexts: Table  # what is left for letters that were not seen behind these two
    bigrams: Table
    befores: Table
    letters: Table
    scripts: np.ndarray  # (scripts, langs) float32: 0, or WRONG_SCRIPT

    def score(self, two: np.ndarray, one: np.ndarray, c: np.ndarray) -> np.ndarray:
        """(positions, langs) log-probabilities of ``c`` behind ``one`` and, before that, ``two``."""
        at, known = self.trigrams.find((two << 42) | (one << 21) | c)
        out = self.trigrams.rows[at] if len(self.trigrams.keys) else np.zeros((len(c), len(self.langs)), np.float32)
        if known.all():
            return out
        rest = np.flatnonzero(~known)
        value = self._back(self.contexts, (two[rest] << 21) | one[rest])
        at, known = self.bigrams.find((one[rest] << 21) | c[rest])
        value[known] += self.bigrams.rows[at[known]]
        rest, value = rest, value
        lost = np.flatnonzero(~known)
        if len(lost):
            value[lost] += self._back(self.befores, one[rest[lost]])
            at, known = self.letters.find(c[rest[lost]])
            value[lost[known]] += self.letters.rows[at[known]]
            value[lost[~known]] = FLOOR
        out[rest] = np.maximum(value, FLOOR)
        return out

    def _back(self, table: Table, keys: np.ndarray) -> np.ndarray:
        at, known = table.find(keys)
        return np.where(known[:, None], table.rows[at], np.float32(0)) if len(table.keys) else np.zeros((len(keys), len(self.langs)), np.float32)


def ngrams(points_: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, two before, one before, letter) of letters and of what follows a word; 0 is a word's edge."""
    c = np.where(letter, points_, 0).astype(np.int64)
    one = np.concatenate([[0], c[:-1]])
    two = np.where(one == 0, 0, np.concatenate([[0, 0], c[:-2]])[: len(c)])
    at = np.flatnonzero((c > 0) | (one > 0))
    return at, two[at], one[at], c[at]


def _counted(keys: list[np.ndarray], n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, counts by language) of a key array a language."""
    every = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]))
    counts = np.zeros((len(every), n_langs))
    for i, k in enumerate(keys):
        counts[:, i] = np.bincount(np.searchsorted(every, k), minlength=len(every))
    return every, counts


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model from (text, language) rows."""
    langs = sorted({lang for _, lang in rows})
    place = {lang: i for i, lang in enumerate(langs)}
    letters, scripts = letter_tables()
    found: list[list] = [[] for _ in langs]
    used = np.zeros((len(SCRIPTS) + 1, len(langs)))
    for text, lang in rows:
        p = points(lowered(text) + " ")
        found[place[lang]].append(np.column_stack(ngrams(p, letters[p])[1:]))
        used[:, place[lang]] += np.bincount(scripts[p[letters[p]]], minlength=len(SCRIPTS) + 1)
    grams = [np.concatenate([np.zeros((0, 3), np.int64), *x]) for x in found]
    n = len(langs)
    tri, n3 = _counted([(g[:, 0] << 42) | (g[:, 1] << 21) | g[:, 2] for g in grams], n)
    context, n_context = _counted([(g[:, 0] << 21) | g[:, 1] for g in grams], n)
    bi, n2 = _counted([(g[:, 1] << 21) | g[:, 2] for g in grams], n)
    before, n_before = _counted([g[:, 1] for g in grams], n)
    uni, n1 = _counted([g[:, 2] for g in grams], n)
    p1 = (n1 + 1) / (n1.sum(axis=0) + len(uni) + 1)
    left2 = 5 / (n_before + 5)
    at = np.searchsorted(before, bi >> 21)
    p2 = n2 / (n_before[at] + 5) + left2[at] * p1[np.searchsorted(uni, bi & 0x1FFFFF)]
    left3 = 2 / (n_context + 2)
    at = np.searchsorted(context, tri >> 21)
    p3 = n3 / (n_context[at] + 2) + left3[at] * p2[np.searchsorted(bi, tri & ((1 << 42) - 1))]
    log = lambda x: np.maximum(np.log(x), FLOOR).astype(np.float32)
    share = used / np.maximum(1, used.sum(axis=0, keepdims=True))
    allowed = np.where(share >= SCRIPT_SHARE, 0, WRONG_SCRIPT).astype(np.float32)
    allowed[allowed.max(axis=1, initial=WRONG_SCRIPT) < 0] = 0  # a script of no language narrows nothing
    return Model(langs, Table(tri, log(p3)), Table(context, log(left3)), Table(bi, log(p2)), Table(before, log(left2)), Table(uni, log(p1)), allowed)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of every word. scores: (words, langs); first: the first word of each document, ascending.

    Every document has a word. A change of label between neighbours of a document costs ``penalty``.
    """
    n_words, n_langs = scores.shape
    sizes = np.diff(np.append(first, n_words))
    n_chunks = -(-sizes // CHUNK)
    chunk0 = np.concatenate([[0], np.cumsum(n_chunks)[:-1]])
    total = int(n_chunks.sum())
    inside = np.arange(n_words) - np.repeat(first, sizes)
    chunk = np.repeat(chunk0, sizes) + inside // CHUNK
    emit = np.zeros((CHUNK, total, n_langs), dtype=np.float32)  # words that pad the last chunk change nothing
    emit[inside % CHUNK, chunk] = scores
    # From the language before a chunk to the one at its end.
    move = np.where(np.eye(n_langs, dtype=bool), 0, -np.inf).astype(np.float32)[None].repeat(total, axis=0)
    for t in range(CHUNK):
        move = np.maximum(move, move.max(axis=2, keepdims=True) - penalty) + emit[t][:, None, :]
    # Chunks of a document in turn, documents side by side (longest first).
    order = np.argsort(-n_chunks, kind="stable")
    counts, start = n_chunks[order], chunk0[order]
    value = np.zeros((len(order), n_langs), dtype=np.float64)
    came = np.zeros((total, n_langs), dtype=np.int16)
    alive = len(order)
    for c in range(int(counts[0]) if len(counts) else 0):
        while counts[alive - 1] <= c:
            alive -= 1
        at = start[:alive] + c
        paths = value[:alive, :, None] + move[at]
        came[at] = paths.argmax(axis=1)
        value[:alive] = paths.max(axis=1)
    ends, entry = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    state = value.argmax(axis=1)
    for c in range(int(counts[0]) - 1 if len(counts) else -1, -1, -1):
        alive = int(np.searchsorted(-counts, -c, side="left"))  # documents with more than c chunks
        at = start[:alive] + c
        ends[at] = state[:alive]
        entry[at] = came[at, state[:alive]]
        state[:alive] = entry[at]
    # Inside the chunks: forward from the known entry, then back from the known end.
    rows = np.arange(total)
    best = np.full((total, n_langs), -np.inf, dtype=np.float32)
    best[rows, entry] = 0
    back = np.zeros((CHUNK, total, n_langs), dtype=np.int16)
    stay = np.arange(n_langs, dtype=np.int16)[None]
    for t in range(CHUNK):
        top = best.max(axis=1, keepdims=True) - penalty
        back[t] = np.where(best >= top, stay, best.argmax(axis=1)[:, None])
        best = np.maximum(best, top) + emit[t]
    labels = np.zeros((CHUNK, total), dtype=np.int16)
    now = ends
    for t in range(CHUNK - 1, -1, -1):
        labels[t] = now
        now = back[t, rows, now]
    return labels[inside % CHUNK, chunk]


def word_scores(model: Model, tables: tuple[np.ndarray, np.ndarray], text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, first character, letters) of every word (run of letters) of the text."""
    letters, script_of = tables
    p = points(text)
    letter = letters[p]
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    if not len(starts):
        return np.zeros((0, len(model.langs)), np.float32), starts, starts
    at, two, one, c = ngrams(np.append(p, np.uint32(32)), np.append(letter, False))
    scores = np.add.reduceat(model.score(two, one, c), np.searchsorted(at, starts), axis=0)
    stops = np.flatnonzero(letter & ~np.append(letter[1:], False)) + 1
    return scores + model.scripts[script_of[p[starts]]], starts, stops - starts


def lowered(text: str) -> str:
    """Lower case with the same number of code points (a few capitals grow when lowered: they stay)."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """The text in pieces of about BLOCK_CHARS, cut behind white space, with their first character."""
    at = 0
    while at < len(text):
        end = at + BLOCK_CHARS
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield at, text[at:end]
        at = end


def label_block(model: Model, tables: tuple[np.ndarray, np.ndarray], texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, share of its letters, spans) of every text."""
    parts, doc_of, first, at = [], [], [], 0
    for i, text in enumerate(texts):
        found = [(s, a + base, n) for base, piece in pieces(lowered(text)) for s, a, n in [word_scores(model, tables, piece)] if len(a)]
        if found:
            parts += found
            doc_of.append(i)
            first.append(at)
            at += sum(len(x[1]) for x in found)
    out: list = [("und", 0.0, [])] * len(texts)
    if not parts or not model.langs:
        return out
    scores, starts, letters = (np.concatenate([x[k] for x in parts]) for k in range(3))
    first = np.array(first)
    labels = viterbi(scores, first)
    docs = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(labels))))
    votes = np.zeros((len(first), len(model.langs)))
    np.add.at(votes, (docs, labels), letters)
    change = np.flatnonzero((np.diff(labels, prepend=-1) != 0) | (np.diff(docs, prepend=-1) != 0))
    stop = np.append(change[1:], len(labels)) - 1
    spans: list[list] = [[] for _ in first]
    for d, a, b, k in zip(docs[change].tolist(), starts[change].tolist(), (starts[stop] + letters[stop]).tolist(), labels[change].tolist(), strict=True):
        spans[d].append((a, b, model.langs[k]))
    for d, i in enumerate(doc_of):
        k = int(votes[d].argmax())
        if len(spans[d]) > 2 and spans[d][0][2] == spans[d][-1][2]:
            frame = model.langs.index(spans[d][0][2])
            k = frame if votes[d, frame] >= FRAME_SHARE * votes[d].sum() else k
        out[i] = (model.langs[k], float(votes[d, k] / votes[d].sum()), spans[d])
    return out


def block_chars(langs: int) -> int:
    """Characters of a block: a chunk's matrix grows with the square of the languages."""
    return max(1 << 14, int(BLOCK_CHARS * min(1.0, (MANY_LANGS / max(1, langs)) ** 2)))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fits on a bounded sample of the rows of every language."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))  # a row a language
    drawn = known.join(F.broadcast(counts), "lang").where(keyed_share("key", "language") < F.lit(SAMPLE_DOCS) / F.col("n"))
    # Ids that repeat are drawn together: the sample's size is held to MAX_SAMPLE a language by an order of its own.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key", "text"), "key", "text"))
    rows = drawn.withColumn("place", place).where(F.col("place") <= MAX_SAMPLE).collect()
    rows.sort(key=lambda r: (r["lang"], str(r["key"]), r["text"]))
    return fit([(r["text"], r["lang"]) for r in rows])


def label_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, spans) of every row; spans are runs of words of one language in code points."""
    kind = docs.schema[key].dataType.simpleString()
    output = [key, *beside(key, "lang_pred", "score", "spans")]
    # The model's size is bounded by its sample.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    block = block_chars(len(model.langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tables = shared.value, letter_tables()

        def emit(names: list, texts: list[str], key_type) -> pa.RecordBatch:
            found = label_block(model, tables, texts)
            spans = [[{"start": a, "end": b, "lang": k} for a, b, k in x[2]] for x in found]
            columns = [pa.array(names, key_type), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(spans, span)]
            return pa.RecordBatch.from_arrays(columns, names=output)

        for batch in slices(batches):
            names, texts, size = [], [], 0
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names.append(name)
                texts.append(value or "")
                size += len(texts[-1])
                if size >= block:
                    yield emit(names, texts, batch.column(0).type)
                    names, texts, size = [], [], 0
            if names:
                yield emit(names, texts, batch.column(0).type)

    picked = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    kinds = (kind, "string", "double", "array<struct<start: long, end: long, lang: string>>")
    return picked.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(output, kinds, strict=True)))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out quarter; spans are start:end:language, comma-joined."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.where(remainder("doc_id", 4) != 2))
    out = label_documents(docs, model)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"], s["lang"])), ",")
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", spans.alias("spans"))

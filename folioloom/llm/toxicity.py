"""Toxicity by compression distance.

Two zstandard dictionaries, one of ordinary and one of toxic text, compress every window of a text (WINDOW words,
a new one every STRIDE words); the difference of the two compressed lengths is the
window's distance. What a document's distances say is calibrated on labelled documents: each of FOLDS folds is measured
with parts that were trained on the others, and all folds train the parts that score documents. The calibration is a
logistic curve, in which a toxic document weighs TOXIC_WEIGHT ordinary ones, over the three largest distances, the number of windows (more windows, larger chance
maxima) and the sum of all distances.

*Dictionaries.* Toxic documents are mostly ordinary text, so two dictionaries of whole texts differ by chance
more than by toxicity. Both therefore begin with the same base, trained by zstandard on windows of ordinary
documents, and end with a part of their own, trained by zstandard in the same way on excerpts of their class:
words, and forms of word stems, that stand in many different contexts of one class and hardly in the other (copies
repeat a context, so they support nothing). Training keeps what is frequent and drops some excerpts; it is repeated on
those until the part holds all or is full. A fixed lead and tail around each window, which both dictionaries hold,
keep the compressor from storing short windows as they are.

The classifier is fitted on a bounded sample of labelled rows (ORDINARY_SAMPLE, TOXIC_SAMPLE rows in
expectation, drawn by a hash of the id, MAX_ROWS at most); every document is scored over its whole text.

Defined results: null or empty text has no window and gets the curve's value without distances; a text of any
length is scored in memory of its own size, window by window; without labels of both kinds every score is the
share of toxic labels (0 without any); repeated rows are scored one by one; an id with both labels counts as toxic;
of equal distances each counts; null ids are carried and never train; an empty table gives no rows.
Extra columns are not read, and output columns that would be named like the key get a leading underscore.
"""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import beside, keyed_share, map_slices, remainder, table, utf8

ORDINARY_SAMPLE, TOXIC_SAMPLE = 3000, 1500  # labelled rows, in expectation
MAX_ROWS = 2 * (ORDINARY_SAMPLE + TOXIC_SAMPLE)  # labelled rows at most, should ids have several texts
FOLDS = 3
TOXIC_WEIGHT = 2.0
WINDOW, STRIDE = 3, 3  # words
BASE_BYTES, OWN_BYTES = 8192, 3072  # of a dictionary: the base, and the part of its class
BASE_WINDOWS, OWN_SAMPLES = 60_000, 3000  # samples that train the base; samples that train a part, repeated to so many
SEGMENT, DMER = 24, 6  # zstandard's training: bytes of a segment, bytes that are counted
MIN_LIFT, MIN_CONTEXTS, CONTEXT_SHARE = 20.0, 4, 0.03  # stems: ratio of rates, contexts, contexts a document
STEM = (3, 10)  # characters
LEAD, TAIL = b"~0A~", b"!?=|{}[]^#"
#: Lazy matching from three bytes on finds short stems; the tables fit the small dictionaries.
MATCHING = {"window_log": 15, "chain_log": 14, "hash_log": 14, "search_log": 7, "min_match": 3, "target_length": 64}
EDGE = ".,;:!?|*#$%&<>()[]{}\"'-_/=+~"


def windows(text: bytes, stride: int = STRIDE) -> list[bytes]:
    """WINDOW words in lower case each, a window every ``stride`` words; one window for a shorter text, none without words."""
    words = text.decode("utf-8", "replace").lower().encode().split()
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, max(1, len(words) - WINDOW + stride), stride)] if words else []


def bare_words(text: bytes) -> list[str]:
    return [w for x in text.decode("utf-8", "replace").lower().split() if (w := x.strip(EDGE))]


def stems_of(word: str) -> list[str]:
    """The word's openings of STEM characters: inflected forms share one."""
    return [word[:n] for n in range(STEM[0], min(len(word), STEM[1]) + 1)]


@dataclass
class Model:
    ordinary: bytes  # contents of the two dictionaries
    toxic: bytes
    weights: tuple[float, ...]  # of FEATURES, and the constant

    #: the three largest distances, the logarithm of the number of windows, the sum of distances over its root
    FEATURES = 5

    def distances(self):
        """text -> the distances of its windows."""
        import zstandard as zstd

        params = zstd.ZstdCompressionParameters(strategy=zstd.STRATEGY_LAZY2, **MATCHING, write_checksum=False, write_content_size=False, write_dict_id=False)

        def packed(content: bytes):
            known = zstd.ZstdCompressionDict(content + LEAD + TAIL, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=params)
            return zstd.ZstdCompressor(dict_data=known, compression_params=params).compress

        ordinary, toxic = packed(self.ordinary), packed(self.toxic)

        def measure(text: bytes) -> list[int]:
            return [len(ordinary(x)) - len(toxic(x)) for w in windows(text) for x in (LEAD + w + TAIL,)]

        return measure

    @staticmethod
    def features(found: list[int]) -> list[float]:
        top = sorted(found, reverse=True)[:3]
        return [*top, *[0] * (3 - len(top)), float(np.log1p(len(found))), sum(found) / max(1, len(found)) ** 0.5]

    def score(self, features) -> np.ndarray:
        """Scores of rows of features, 0 to 1."""
        x = np.asarray(features, float).reshape(-1, self.FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[:-1]) + self.weights[-1], -500, 500)))


def excerpts(texts: list[bytes], others: list[bytes]) -> list[str]:
    """Words of ``texts``, best supported first: words, and forms of stems, that stand in many contexts of them
    and hardly in ``others``."""
    common = Counter(p for x in others for p in {p for w in set(bare_words(x)) for p in (w + " ", *stems_of(w))})
    contexts: dict[str, set] = defaultdict(set)
    usual = len(others) // 200  # a stem of more of the others is no candidate
    for x in texts:
        words = ["", *bare_words(x), ""]
        for before, word, after in zip(words, words[1:], words[2:], strict=False):
            for p in (word + " ", *stems_of(word)):
                if common[p] <= usual:
                    contexts[p].add((before, after))
    scale = (len(others) + 1) / (len(texts) + 1)
    support = {p: n for p, c in contexts.items() if (n := len(c)) >= MIN_CONTEXTS and (n + 0.5) / (common[p] + 0.5) * scale >= MIN_LIFT}
    stems = {p for p, n in support.items() if p[-1] != " " and n >= CONTEXT_SHARE * len(texts)}
    forms = {p: len(contexts[p]) for p in contexts if p[-1] == " " and not common[p] and (p in support or stems.intersection(stems_of(p[:-1])))}
    forms.update({p: n for p, n in support.items() if p[-1] == " "})
    return sorted(forms, key=lambda p: (-forms[p], p))


def dictionary(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on the samples; the samples themselves where they are too few to train."""
    import zstandard as zstd

    if not samples:
        return b""
    try:
        raw = zstd.train_dictionary(size, samples, k=SEGMENT, d=DMER).as_bytes()
    except zstd.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]
    marks = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"  # the three start offsets end a trained dictionary's head
    return raw[raw.find(marks) + len(marks) :] if marks in raw else raw


def own_part(forms: list[str]) -> bytes:
    """The part of a class: trained on its excerpts, repeated to OWN_SAMPLES and mixed, and again on those that the
    training left out, until all are there or the part is full; what was trained first stands nearest to the text."""
    left, part = [b" " + p.encode() for p in forms], b""
    while left and len(part) < OWN_BYTES:
        samples = left[: OWN_BYTES // 8]
        samples = samples * max(1, OWN_SAMPLES // len(samples))
        random.Random(1).shuffle(samples)
        trained = dictionary(samples, OWN_BYTES)
        if not any(x in trained for x in left):
            trained = b"".join(reversed(left))[-OWN_BYTES:]
        part, left = trained + part, [x for x in left if x not in trained]
    return part[-OWN_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights (constant last) by Newton steps with a small ridge; rows of label 1 weigh TOXIC_WEIGHT."""
    weight = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * (p * (1 - p) + 1e-9))[:, None]) + keep, x.T @ (weight * (y - p)) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(rows: list[tuple[bytes, int, int]]) -> Model:
    """A model from (text, label, fold) rows."""
    seen = list(dict.fromkeys(rows))  # copies teach nothing new
    share = sum(y for _, y, _ in rows) / len(rows) if rows else 0.0
    constant = float(np.log(share / (1 - share))) if 0 < share < 1 else (500.0 if share else -500.0)
    flat = (0.0,) * Model.FEATURES + (constant,)
    usual = [w for t, y, _ in seen if not y for w in windows(t, WINDOW)]
    base = dictionary(usual[:: max(1, len(usual) // BASE_WINDOWS)], BASE_BYTES) or b" "

    def trained(some: list[tuple[bytes, int, int]]) -> Model | None:
        toxic, ordinary = [t for t, y, _ in some if y], [t for t, y, _ in some if not y]
        if toxic and ordinary:
            return Model(base + own_part(excerpts(ordinary, toxic)), base + own_part(excerpts(toxic, ordinary)), flat)
        return None

    model = trained(seen)
    if model is None:
        return Model(b"", b"", flat)
    x, y = [], []
    for fold in sorted({f for _, _, f in seen}):
        own = trained([r for r in seen if r[2] != fold]) or model  # the only fold measures itself
        measure = own.distances()
        x += [model.features(measure(t)) for t, _, f in seen if f == fold]
        y += [v for _, v, f in seen if f == fold]
    model.weights = tuple(logistic(np.array(x, float), np.array(y, float)).tolist())
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits on a bounded sample of the labelled rows of ``labels`` (key, label)."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect() if r["label"] in (0, 1)}
    draw = F.lit(False)
    for value, bound in ((0, ORDINARY_SAMPLE), (1, TOXIC_SAMPLE)):
        if counts.get(value):
            draw = draw | ((F.col("label") == value) & (keyed_share("key", "toxicity") < bound / counts[value]))
    sample = known.where(draw)
    # The sample is bounded by its parameters, so broadcasting it is too; MAX_ROWS bounds ids with many texts.
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "key").select("key", "text", "label")
    rows = picked.dropDuplicates(["key", "text"]).orderBy(F.xxhash64("key", "text"), "key", "text").limit(MAX_ROWS).collect()
    rows.sort(key=lambda r: (r["key"], r["text"] or ""))
    texts = [((r["text"] or "").encode("utf-8", "replace"), r["label"]) for r in rows]
    return fit([(t, y, crc32(t) % FOLDS) for t, y in texts])  # by text: copies share a fold


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, distance, distance_2, n_windows) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, *beside(key, "score", "distance", "distance_2", "n_windows")]

    def make():
        measure = model.distances() if model.toxic else lambda _: []

        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [measure(x) for x in utf8(part.column(1))]
            rows = np.array([model.features(x) for x in found], dtype=float).reshape(-1, model.FEATURES)
            columns = [pa.array(model.score(rows)), pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy()), pa.array([len(x) for x in found], pa.int64())]
            return pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

        return handle

    picked = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    return map_slices(picked, make, f"`{key}` {kind}, " + ", ".join(f"`{n}` {k}" for n, k in zip(names[1:], ("double", "double", "double", "long"), strict=True)))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(remainder("doc_id", 5) != 0)
    scored = score_documents(docs, train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "distance", "distance_2", "n_windows")

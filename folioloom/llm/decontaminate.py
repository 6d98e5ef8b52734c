"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet in shared runs of TILE words, the shortest tile there is. For every pair that could
reach the threshold at all, the longest common runs of words that overlap no run already marked are marked again and
again (running Karp-Rabin: hashes of all windows of a search length that falls from long to TILE words); an item
leaks where the marked words cover THRESHOLD of it, in whatever order its passages stand.

No pair is lost before the tiling: tiles consist of shared TILE-word runs only, so an item whose positions under such
runs are fewer than THRESHOLD of it can't be covered, and a document's words outside of them can't be marked.

The benchmark is a stated query set: it is taken in blocks of at most ITEMS items and WORDS words, each small
enough to broadcast, and every block is compared with all documents where they lie; a benchmark of one block reads
them once. Nothing is shuffled. A worker builds a block's index once. Between blocks what is found so far is
written to the shared folder, so that no worker holds two.

Words are runs of letters, digits and underscores in lower case. Defined results: null or empty texts have no
words and leak nothing; items without words are passed over; items of fewer than TILE words leak where they stand whole
(a caller who doesn't want that leaves them out of the benchmark); of equally long matches the one first in
the document and then in the item is marked first; repeated documents and repeated items are compared one by one;
null ids are carried; a text of any length is compared whole; an empty table gives no rows; extra columns are not read
by ``contaminated_pairs`` and stay in ``drop_contaminated``; output columns that would be named like the key or the
item get a leading underscore.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ensure_checkpoint_dir
from .common import beside, slices, table

TILE = 3  # shortest run that is marked, in words
THRESHOLD = 0.8  # share of an item's words
ITEMS, WORDS = 20_000, 2_000_000  # of a block; so a run of TILE words has a number below 2**63
LONGEST_SEARCH = 20  # words, at first
SLICE_ROWS = 256
_WORD = re.compile(r"\w+")
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _windows(x: list[int], used: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, hash) of the windows that hold no marked word."""
    top = pow(_BASE, size - 1, _MOD)
    value = run = 0
    for i, v in enumerate(x):
        if used[i]:
            value = run = 0
            continue
        if run == size:
            value = (value - x[i - size] * top) % _MOD
            run -= 1
        value = (value * _BASE + v) % _MOD
        run += 1
        if run == size:
            yield i - size + 1, value


def greedy_tiles(a: list[int], b: list[int], least: int = TILE) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of greedy tiles, in the order of marking. A 0 in ``a`` ends every match."""
    used_a, used_b = [x == 0 for x in a], [False] * len(b)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(b), LONGEST_SEARCH))
    while True:
        known = defaultdict(list)
        for j, h in _windows(b, used_b, size):
            known[h].append(j)
        found, longest = [], 0
        for i, h in _windows(a, used_a, size) if known else ():
            for j in known.get(h, ()):
                if i and j and not used_a[i - 1] and not used_b[j - 1] and a[i - 1] == b[j - 1]:
                    continue  # goes on to the left: found from there
                k = 0
                while i + k < len(a) and j + k < len(b) and not used_a[i + k] and not used_b[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k >= size:
                    found.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * size:
            size = longest
            continue
        heapq.heapify(found)
        while found:
            k, i, j = heapq.heappop(found)
            k = -k
            free = [not used_a[i + t] and not used_b[j + t] for t in range(k)]
            if all(free):
                used_a[i : i + k] = used_b[j : j + k] = [True] * k
                out.append((i, j, k))
                continue
            at = 0  # what marked words leave of the match may still be a tile
            for t in [t for t, x in enumerate(free) if not x] + [k]:
                if t - at >= size:
                    heapq.heappush(found, (at - t, i + at, j + at))
                at = t + 1
        if size == least:
            return out
        size = max(least, size // 2) if size > 2 * least else least


def tiles(doc: list[str], item: list[str], least: int = TILE) -> list[tuple[int, int, int]]:
    """(start in doc, start in item, length) of greedy tiles, in the order of marking."""
    number = {w: k for k, w in enumerate(set(item), 1)}
    return greedy_tiles([number.get(w, 0) for w in doc], [number[w] for w in item], least)


class Index:
    """A block of the benchmark by the runs of TILE words of its items, and by its short items as wholes."""

    def __init__(self, items: list[tuple[object, list[str]]]):
        self.names = [name for name, _ in items]
        vocabulary: dict[str, int] = {}
        for _, words in items:
            for w in words:
                vocabulary.setdefault(w, len(vocabulary) + 1)
        self.number = vocabulary.get
        self.base = len(vocabulary) + 1
        self.ids = [np.array([vocabulary[w] for w in words], dtype=np.int64) for _, words in items]
        self.runs = [self.codes(x, TILE) for x in self.ids]  # of fewer words: none
        self.seeds, seed = np.unique(np.concatenate([np.zeros(0, np.int64), *self.runs]), return_inverse=True)
        owner = np.repeat(np.arange(len(items)), [len(x) for x in self.runs])
        order = np.lexsort((owner, seed))
        self.owner = owner[order]  # of the seeds in order, an entry for each time that an item has one
        self.first = np.searchsorted(seed[order], np.arange(len(self.seeds) + 1))
        self.short = {n: self._wholes(n) for n in range(1, TILE) if any(len(x) == n for x in self.ids)}

    def codes(self, ids: np.ndarray, n: int) -> np.ndarray:
        """The number of every run of ``n`` words; a run with an unknown word (0) gets -1."""
        size = max(0, len(ids) - n + 1)
        out, known = np.zeros(size, dtype=np.int64), np.ones(size, dtype=bool)
        for k in range(n):
            part = ids[k : k + size]
            out = out * self.base + part
            known &= part > 0
        return np.where(known, out, -1)

    def _wholes(self, n: int) -> dict[int, list[int]]:
        out = defaultdict(list)
        for k, ids in enumerate(self.ids):
            if len(ids) == n:
                out[int(self.codes(ids, n)[0])].append(k)
        return dict(out)

    def leaks(self, texts: list[str | None], threshold: float = THRESHOLD) -> Iterator[tuple[int, object, float, int, int]]:
        """(text's place, item, coverage, tiles, longest tile) of the items that the texts leak."""
        number = self.number
        ids, sizes = [], []
        for text in texts:
            found = [number(w, 0) for w in words_of(text)]
            found.append(0)  # no run goes from one text into the next
            ids += found
            sizes.append(len(found))
        ids = np.array(ids, dtype=np.int64)
        doc_of = np.repeat(np.arange(len(texts)), sizes)
        for n, wholes in self.short.items():
            codes = self.codes(ids, n)
            at = np.flatnonzero(np.isin(codes, np.fromiter(wholes, np.int64, len(wholes))))
            for d, code in np.unique(np.column_stack([doc_of[at], codes[at]]), axis=0).tolist():
                for k in wholes[code]:
                    yield d, self.names[k], 1.0, 1, n
        codes = self.codes(ids, TILE)
        at = np.flatnonzero(codes >= 0)
        if not len(at) or not len(self.seeds):
            return
        seed = np.searchsorted(self.seeds, codes[at])
        seed[seed == len(self.seeds)] = 0
        hit = self.seeds[seed] == codes[at]
        at, seed = at[hit], seed[hit]
        if not len(at):
            return
        # Every text with each of its seeds once, then with each item that has the seed, as often as it has it.
        pair = np.unique(doc_of[at] * np.int64(len(self.seeds)) + seed)
        d, s = pair // len(self.seeds), pair % len(self.seeds)
        many = self.first[s + 1] - self.first[s]
        place = np.repeat(self.first[s] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        both, shared = np.unique(np.repeat(d, many) * np.int64(len(self.ids)) + self.owner[place], return_counts=True)
        length = np.array([len(x) for x in self.ids])[both % len(self.ids)]
        # c words covered by tiles of TILE words or more need c / TILE shared runs at least.
        for x in both[shared * TILE >= threshold * length - 1e-9].tolist():
            d, k = divmod(x, len(self.ids))
            low, high = np.searchsorted(doc_of[at], (d, d + 1))
            found = self._judge(ids, at[low:high], codes, k, threshold)
            if found is not None:
                yield d, self.names[k], *found

    def _judge(self, ids: np.ndarray, at: np.ndarray, codes: np.ndarray, k: int, threshold: float) -> tuple[float, int, int] | None:
        """(coverage, tiles, longest) where the runs at ``at`` cover enough of item ``k``."""
        item = self.ids[k]

        def under(starts: np.ndarray, size: int) -> np.ndarray:
            out = np.zeros(size + TILE, dtype=bool)
            for t in range(TILE):
                out[starts + t] = True
            return out[:size]

        if under(np.flatnonzero(np.isin(self.runs[k], codes[at])), len(item)).sum() < threshold * len(item) - 1e-9:
            return None
        starts = at[np.isin(codes[at], self.runs[k])]
        base = int(starts[0])
        a = np.where(under(starts - base, int(starts[-1]) - base + TILE), ids[base : int(starts[-1]) + TILE], 0)
        keep = (a != 0) | (np.concatenate([[1], a[:-1]]) != 0)  # one 0 between two runs
        marked = greedy_tiles(a[keep].tolist(), item.tolist())
        covered = sum(x[2] for x in marked) / len(item)
        return (covered, len(marked), max(x[2] for x in marked)) if covered >= threshold - 1e-9 else None


class Block:
    """Items with their words, as they are broadcast; the index is built where it is first asked for, once a worker."""

    def __init__(self, items: list[tuple[object, list[str]]]):
        self.items, self._index = items, None

    def __getstate__(self):
        return {"items": self.items, "_index": None}

    def index(self) -> Index:
        if self._index is None:
            self._index = Index(self.items)
        return self._index


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[tuple[Block, bool]]:
    """(block, whether it is the last) of the benchmark, read row by row."""
    picked = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    held, size = [], 0
    for row in picked.toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        if held and (len(held) >= ITEMS or size + len(words) > WORDS):
            yield Block(held), False
            held, size = [], 0
        held.append((row["item"], words))
        size += len(words)
    if held:
        yield Block(held), True


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", threshold: float = THRESHOLD, item_text: str = "text") -> DataFrame:
    """(key, item, coverage, n_tiles, longest) of every document and item that it leaks."""
    names = [key, *beside(key, item, "coverage", "n_tiles", "longest")]
    kinds = [docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString(), "double", "long", "long"]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    arrow = [to_arrow_type(benchmark.schema[item].dataType), pa.float64(), pa.int64(), pa.int64()]
    picked = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text"))
    out = docs.sparkSession.createDataFrame([], schema)
    ensure_checkpoint_dir(docs.sparkSession)
    for block, last in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value.index()
            for batch in slices(batches, SLICE_ROWS):
                rows = list(index.leaks(batch.column(1).to_pylist(), threshold))
                if rows:
                    at, *columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(c, k) for c, k in zip(columns, arrow, strict=True))], names=names)

        found = picked.mapInArrow(run, schema)
        out = out.unionByName(found if last else found.checkpoint())
        if not last:
            shared.unpersist()
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", threshold: float = THRESHOLD, item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item; all columns stay."""
    at = docs.columns.index(text)
    ensure_checkpoint_dir(docs.sparkSession)
    for block, last in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value.index()
            for batch in slices(batches, SLICE_ROWS):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[x[0] for x in index.leaks(batch.column(at).to_pylist(), threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = docs.checkpoint()
            shared.unpersist()
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that leak benchmark items, with the items."""
    return contaminated_pairs(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))

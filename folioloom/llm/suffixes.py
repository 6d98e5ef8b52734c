"""Exact removal of repeated passages by a sampled suffix array.

A byte goes if a SPAN-byte string (100) that covers it also starts earlier: in a smaller doc_id, or earlier in
the same document. Texts are UTF-8 bytes; matches never cross documents; strings are judged on the input.

1. *Sampling.* Every SPAN-byte window has an anchor: its least K-byte gram by a hash, the leftmost of equals.
   Equal windows have equal anchors at equal offsets, so only anchor suffixes (about 3 in 100 positions) need
   sorting. An anchor serves a run of neighbouring windows, all inside the context of CONTEXT bytes around it.
2. *Candidates.* Copies are collapsed before the shuffle: a task sends a whole context once, by its first document, and
   marks the later ones itself. What is sent is dealt by the gram; there, too, whole contexts that repeat are marked. A
   gram with one context needs nothing more. Grams with several contexts are the edges of repeats: their suffixes
   are sorted. A task that has sent two contexts of a gram knows as much and sends all further ones straight to
   the sort, so no gram, however common, costs the shuffle more than a few rows a task.
3. *Suffix array.* The suffixes at these anchors (SPAN bytes, then what stands before them) are range-partitioned by
   all of their bytes, with splitters that Spark samples; a splitter may cut a run of suffixes with equal openings
   anywhere, so a common gram fills as many buckets as it needs. A bucket sorts suffixes (and reversed left
   contexts) by multikey quicksort, eight bytes a key; the common-prefix lengths of neighbours give, for every offset,
   the classes of equal windows, of which the first in order stays.
4. *Boundaries.* A class that the bucket's first or last suffix belongs to may go on in the neighbour. The windows that
   stay of such classes are compared across buckets by 128-bit digests; a bucket sends each of them once.
5. *Removal.* Marked windows are joined to the documents by key and cut out.

Defined results: null text is empty (no bytes, nothing removed); rows that agree in doc_id and text are one
document, and each gets its result; rows of one doc_id with different texts are documents in the order of a
64-bit hash of the text; null ids come first and are null in the result; texts have up to 2**31 bytes and are read in
blocks; an empty table gives no rows; extra columns are not read, and the key's name is the result's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import beside, slices, table, utf8

SPAN = 100
K = 32
WIDTH = SPAN - K + 1  # grams in a window
BEFORE = WIDTH - 1  # context before an anchor; SPAN bytes follow from it
CONTEXT = BEFORE + SPAN
BLOCK = 1 << 20  # bytes handled at a time
AT_BITS, RUN_BITS = 31, 7
STATE = 500_000  # contexts that a task remembers to have sent; beyond, it begins anew
GROUP_ROWS = 20_000  # contexts that a bucket sorts at a time, by whole grams
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64)
U = np.uint64


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of all substrings of a block in constant time each."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.up) <= len(data):
            self.up, self.down = powers(_MULT, len(data) + 1), powers(_INVERSE, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self.up[: len(data)], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k]

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


@dataclass
class Segment:
    """Bytes of a document from ``base`` on; its windows start in [first, last) of the document."""

    key: int
    tie: int
    base: int
    first: int
    last: int
    data: bytes
    size: int  # of the document


def segments(key: int, tie: int, text: bytes) -> Iterator[Segment]:
    """The document in overlapping segments of about BLOCK windows (short documents: one)."""
    last = len(text) - SPAN + 1
    start = 0
    while start < last:
        stop = min(last, start + BLOCK)
        base = max(0, start - BEFORE)
        yield Segment(key, tie, base, start, stop, text[base : stop + SPAN + BEFORE], len(text))
        # Every run that the cut may have shortened is begun again by the next segment.
        start = stop if stop == last else stop - WIDTH


def anchors(hasher: Hasher, block: list[Segment]) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, segment, anchor, first window, last window) of the block's runs; positions in documents."""
    data = np.frombuffer(b"".join(s.data for s in block), dtype=np.uint8)
    sizes = np.array([len(s.data) for s in block])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    hasher.load(data)
    grams = hasher.grams(K)
    order = ((grams * U(0xD6E8FEB86659FD93)) ^ (grams >> U(29))) * U(0xA24BAED4963EE407)
    least = (order & ~U(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while 2 * have <= WIDTH:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if WIDTH > have:
        least = np.minimum(least[: len(least) - (WIDTH - have)], least[WIDTH - have :])
    chosen = (least & U(0xFFFFFF)).astype(np.int64)
    first = at + np.array([s.first - s.base for s in block])
    count = np.array([s.last - s.first for s in block])
    # The windows of all segments, one after the other.
    windows = np.arange(count.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    anchor = chosen[windows]
    starts = np.flatnonzero(np.diff(anchor, prepend=-1))
    ends = np.append(starts[1:], len(anchor)) - 1
    a, lo, hi = anchor[starts], windows[starts], windows[ends]
    seg = np.searchsorted(at, lo, side="right") - 1
    shift = np.array([s.base for s in block]) - at
    # A run at a cut of a long document is whole in one of the two segments only: where it starts inside
    # the segment and does not touch the segment's end (or the document's ends).
    last = np.array([s.last for s in block])[seg] - 1
    final = np.array([s.last == s.size - SPAN + 1 for s in block])[seg]
    begin = np.array([s.first for s in block])[seg]
    whole = (final | (hi + shift[seg] < last)) & ((begin == 0) | (lo + shift[seg] > begin))
    a, lo, hi, seg = a[whole], lo[whole], hi[whole], seg[whole]
    left = np.maximum(a - BEFORE, at[seg])
    right = np.minimum(a + SPAN, at[seg] + sizes[seg])
    context = hasher.between(left, right) + (a - left).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F) + (right - a).astype(np.uint64) * U(0x165667B19E3779F9)
    return grams[a], context, seg, a + shift[seg], lo + shift[seg], hi + shift[seg]


def _pack(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (a << (2 * RUN_BITS)) | ((a - lo) << RUN_BITS) | (a - hi)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window)."""
    a = packed >> (2 * RUN_BITS)
    return a, a - ((packed >> RUN_BITS) & ((1 << RUN_BITS) - 1)), a - (packed & ((1 << RUN_BITS) - 1))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching intervals [start, end)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, top = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(start[1:] > top[:-1]) + 1
    return start[np.concatenate([[0], cut])], top[np.concatenate([cut - 1, [len(top) - 1]])]


class Sent:
    """What a task has sent: contexts with their first row, and the grams of one or more contexts."""

    def __init__(self) -> None:
        self.place: dict[int, int] = {}  # context's number -> its row below
        self.rows = np.zeros((STATE, 4), dtype=np.int64)  # gram, key, tie, packed
        self.grams: dict[int, bool] = {}  # gram -> whether it has several contexts

    def judge(self, gram: np.ndarray, context: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(late, again, direct) for distinct contexts with their first rows (key, tie, packed): whether an earlier row
        of the context was sent, whether the very row was, and whether it can go straight to the sort."""
        if len(self.place) + len(gram) > STATE:
            self.__init__()
            if len(gram) > STATE:  # more than is remembered: all are sent and nothing is known of them
                return np.zeros((3, len(gram)), dtype=bool)
        numbers, grams = (context ^ (gram * _MULT)).tolist(), gram.tolist()
        at = np.fromiter(map(self.place.get, numbers, repeat(-1)), np.int64, len(numbers))
        mixed = np.fromiter(map(self.grams.get, grams, repeat(False)), bool, len(grams))
        full = np.column_stack([gram.view(np.int64), row])
        old = self.rows[at]
        known = (at >= 0) & (old[:, 0] == full[:, 0])
        again, late = known, np.zeros(len(full), dtype=bool)
        for k in range(1, 4):
            late |= again & (old[:, k] < full[:, k])
            again = again & (old[:, k] == full[:, k])
        first = known & ~late
        self.rows[at[first]] = full[first]
        fresh = np.flatnonzero(at < 0)
        self.rows[len(self.place) : len(self.place) + len(fresh)] = full[fresh]
        self.place.update(zip([numbers[k] for k in fresh.tolist()], range(len(self.place), len(self.place) + len(fresh)), strict=True))
        # A gram becomes mixed where a second context of it comes, here or in an earlier block.
        for k in np.flatnonzero(~known).tolist():
            self.grams[grams[k]] = grams[k] in self.grams
        return late, again, ~late & ~again & mixed


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, g, f, key, tie, packed): kind 0 is an anchor to judge by its gram, kind 1 an interval g..f marked here,
    kind 2 an anchor for the sort."""
    hasher, sent = Hasher(), Sent()

    def emit(block: list[Segment]) -> pa.RecordBatch:
        block.sort(key=lambda s: (s.key, s.tie, s.first))
        gram, context, seg, a, lo, hi = anchors(hasher, block)
        key, tie = np.array([s.key for s in block], dtype=np.int64)[seg], np.array([s.tie for s in block], dtype=np.int64)[seg]
        packed = _pack(a, lo, hi)
        # Rows are in order of (key, tie, anchor); equal contexts behind the first are repeats.
        order = np.lexsort((context, gram))
        g, f = gram[order], context[order]
        same = np.concatenate([[False], (g[1:] == g[:-1]) & (f[1:] == f[:-1])])
        leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        clone = (key[leader] == key[order]) & (tie[leader] == tie[order]) & (packed[leader] == packed[order])  # the same row twice
        keep = order[~same]
        behind, again, direct = sent.judge(gram[keep], context[keep], np.column_stack([key[keep], tie[keep], packed[keep]]))
        late = np.concatenate([order[same & ~clone], keep[behind]])
        marks = []
        if len(late):
            late = np.sort(late)
            for part in np.split(late, np.flatnonzero(np.diff(seg[late])) + 1):
                s = block[seg[part[0]]]
                x, y = merged(lo[part], hi[part] + SPAN)
                marks.append((x, y, np.full(len(x), s.key), np.full(len(x), s.tie)))
        stay = ~behind & ~again
        kept = keep[stay]
        kind = np.where(direct[stay], 2, 0).astype(np.int8)
        columns = [kind, gram[kept].view(np.int64), context[kept].view(np.int64), key[kept], tie[kept], packed[kept]]
        if marks:
            x, y, k, t = (np.concatenate(c) for c in zip(*marks, strict=True))
            columns = [np.concatenate(c) for c in zip(columns, [np.ones(len(x), np.int8), x, y, k, t, np.zeros(len(x), np.int64)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "g", "f", "key", "tie", "packed"])

    block, size = [], 0
    for batch in slices(batches):
        for key, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
            for s in segments(key, tie, text):
                if block and size + len(s.data) > BLOCK:
                    yield emit(block)
                    block, size = [], 0
                block.append(s)
                size += len(s.data)
    if block:
        yield emit(block)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words: multikey quicksort, one word at a time within runs of equals."""
    n, width = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    run = np.concatenate([[0], np.cumsum(np.diff(words[order, 0].astype(np.int64)) != 0)]) if n else np.zeros(0, int)
    for w in range(1, width):
        alike = np.zeros(n, dtype=bool)
        same = run[1:] == run[:-1]
        alike[1:] |= same
        alike[:-1] |= same
        at = np.flatnonzero(alike)
        if not len(at):
            break
        value = words[order[at], w]
        inner = np.lexsort((value, run[at]))
        order[at] = order[at][inner]
        value, old = value[inner], run[at]
        fresh = np.zeros(n, dtype=np.int64)
        fresh[at[1:]] = (old[1:] == old[:-1]) & (value[1:] != value[:-1])
        run = run + np.cumsum(fresh)
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row of the order shares with the one before it (0 for the first)."""
    differ = rows[order[1:]] != rows[order[:-1]]
    out = np.zeros(len(order), dtype=np.int64)
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def repeated_windows(contexts: np.ndarray, gram: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of windows that an earlier row of the same gram has too.

    contexts: (rows, CONTEXT) bytes, the anchor at BEFORE; rows in order of their documents; first and last:
    the offsets (0..BEFORE) at which a row's windows start.
    """
    n = len(contexts)
    pad = lambda x: np.ascontiguousarray(np.pad(x, ((0, 0), (0, -x.shape[1] % 8))))
    suffix, prefix = contexts[:, BEFORE:], contexts[:, :BEFORE][:, ::-1]
    by_suffix = multikey_order(pad(suffix).view(">u8").astype(np.uint64))
    by_prefix = multikey_order(pad(prefix).view(">u8").astype(np.uint64))
    right, left = common_prefixes(suffix, by_suffix), common_prefixes(prefix, by_prefix)
    group = np.unique(gram, return_inverse=True)[1]
    rows, offsets = [], []
    a, b = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for offset in range(BEFORE + 1):
        here = np.flatnonzero((first <= offset) & (offset <= last))
        if len(here) < 2:
            continue
        before = BEFORE - offset  # bytes of the window before the anchor
        a[by_suffix] = np.cumsum(right < SPAN - before)
        b[by_prefix] = np.cumsum(left < before) if before else 0
        value = (a[here] * (n + 1) + b[here]).astype(np.int64)
        order = np.lexsort((value, group[here]))
        v, g = value[order], group[here][order]
        again = np.concatenate([[False], (v[1:] == v[:-1]) & (g[1:] == g[:-1])])
        hit = here[order[again]]
        rows.append(hit)
        offsets.append(np.full(len(hit), offset))
    return (np.concatenate(rows), np.concatenate(offsets)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (suffix, before, key, tie, packed) in order of suffix and before -> (key, tie, start, end, h1, h2): an interval
    that is repeated within the bucket, or, with a digest, a window that a neighbour may hold too."""
    names = ["key", "tie", "start", "end", "h1", "h2"]

    def solve(rows: list[pa.RecordBatch], edges: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """``edges``: the bucket's first and last suffix, where the rows hold one."""
        part = pa.Table.from_batches(rows).combine_chunks()
        n = part.num_rows
        suffix = np.frombuffer(b"".join(part.column("suffix").to_pylist()), dtype=np.uint8).reshape(n, SPAN)
        before = np.frombuffer(b"".join(part.column("before").to_pylist()), dtype=np.uint8).reshape(n, BEFORE)
        key, tie, packed = (part.column(c).to_numpy() for c in ("key", "tie", "packed"))
        gram = np.cumsum(np.concatenate([[0], (suffix[1:, :K] != suffix[:-1, :K]).any(axis=1)]))
        # Rows in order of their documents within a gram; a repeated row is the same document and is compared once.
        order = np.lexsort((packed, tie, key, gram))
        gram, key, tie, packed = gram[order], key[order], tie[order], packed[order]
        fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1]) | (tie[1:] != tie[:-1]) | (packed[1:] != packed[:-1])])
        order, gram, key, tie, packed = order[fresh], gram[fresh], key[fresh], tie[fresh], packed[fresh]
        contexts = np.concatenate([before[order][:, ::-1], suffix[order]], axis=1)
        a, lo, hi = _unpack(packed)
        first, last = lo - a + BEFORE, hi - a + BEFORE
        row, offset = repeated_windows(contexts, gram, first, last)
        if len(row):
            start = a[row] - BEFORE + offset
            by = np.lexsort((start, row))
            x, starts = row[by], start[by]
            cut = np.flatnonzero((x[1:] != x[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
            i, j = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(x) - 1]])
            none = pa.nulls(len(i), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key[x[i]]), pa.array(tie[x[i]]), pa.array(starts[i]), pa.array(starts[j] + SPAN), none, none], names=names)
        if not edges:
            return
        # Bytes that a suffix shares with the bucket's first or last one.
        reach = np.max([np.where((d := contexts[:, BEFORE:] != e).any(axis=1), d.argmax(axis=1), SPAN) for e in edges], axis=0)
        repeated = np.zeros((len(contexts), BEFORE + 1), dtype=bool)
        repeated[row, offset] = True
        at = np.arange(BEFORE + 1)
        touching = ~repeated & (at >= first[:, None]) & (at <= last[:, None]) & (reach[:, None] >= SPAN - BEFORE + at)
        i, o = np.nonzero(touching)
        for k in range(0, len(i), GROUP_ROWS):
            r, s = i[k : k + GROUP_ROWS], o[k : k + GROUP_ROWS]
            digests = np.frombuffer(b"".join(hashlib.blake2b(contexts[x, y : y + SPAN].tobytes(), digest_size=16).digest() for x, y in zip(r.tolist(), s.tolist(), strict=True)), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(key[r]), pa.array(tie[r]), pa.array(a[r] - BEFORE + s), pa.nulls(len(r), pa.int64()), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())], names=names)

    opening = None  # the bucket's first suffix
    held: list[pa.RecordBatch] = []  # whole grams, but for the last one
    count, starts = 0, True
    for batch in slices(batches, GROUP_ROWS):
        if not batch.num_rows:
            continue
        column = batch.column(0).to_pylist()
        opening = column[0] if opening is None else opening
        cut = next((i for i in range(len(column) - 1, 0, -1) if column[i][:K] != column[i - 1][:K]), 0)
        if not cut and held and held[-1].column(0)[-1].as_py()[:K] != column[0][:K]:
            cut = -1  # the gram in hand has ended with the batch before
        if cut and count + max(cut, 0) >= GROUP_ROWS:
            yield from solve(held + ([batch.slice(0, cut)] if cut > 0 else []), [np.frombuffer(opening, dtype=np.uint8)] if starts else [])
            held, count, starts = [], 0, False
            batch = batch.slice(max(cut, 0))
        held.append(batch)
        count += batch.num_rows
    if held:
        closing = held[-1].column(0)[-1].as_py()
        yield from solve(held, [np.frombuffer(x, dtype=np.uint8) for x in ([opening] if starts else []) + [closing]])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, tie, text, wanted) -> a row (suffix, before, key, tie, packed) for every wanted anchor; ``before`` goes backwards."""
    for batch in slices(batches, 64):
        out: list[list] = [[], [], [], [], []]
        for key, tie, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            packed = np.array(wanted, dtype=np.int64)
            framed = b"\0" * BEFORE + text + b"\0" * SPAN  # filler is never part of a window
            for at in _unpack(packed)[0].tolist():
                out[0].append(framed[at + BEFORE : at + CONTEXT])
                out[1].append(framed[at : at + BEFORE][::-1])
            out[2].append(np.full(len(packed), key))
            out[3].append(np.full(len(packed), tie))
            out[4].append(packed)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), *(pa.array(np.concatenate(c)) for c in out[2:])], names=["suffix", "before", "key", "tie", "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, starts, ends) -> counts, digest and what is left."""
    for batch in slices(batches, 256):
        rows = []
        for text, marks in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            removed = spans = 0
            kept = text
            if marks:
                x, y = merged(np.array([m["start"] for m in marks]), np.array([m["end"] for m in marks]))
                removed, spans = int((y - x).sum()), len(x)
                edges = [0, *np.column_stack([x, y]).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; key must be integral."""
    whole = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = whole.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = keyed.select("key", "tie", "text").mapInArrow(_anchor_rows, "kind byte, g long, f long, key long, tie long, packed long")

    # A gram has a few rows a task here, see Sent; what is late or of several contexts is told in one pass over them.
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    deal = F.when(F.col("kind") == 0, F.col("g")).otherwise(F.xxhash64("key", "tie", "g", "packed"))  # the others need no company
    by_gram = Window.partitionBy("deal", "kind").orderBy("f", "key", "tie", "packed").rowsBetween(*everything)
    by_context = Window.partitionBy("deal", "kind", "f").orderBy("key", "tie", "packed").rowsBetween(*everything)
    leader = F.first(F.struct("key", "tie", "packed")).over(by_context)
    judged = (
        rows.withColumn("deal", deal)
        .repartition("deal")
        .withColumn("mixed", (F.col("kind") == 0) & (F.first("f").over(by_gram) != F.last("f").over(by_gram)))
        .withColumn("late", (F.col("kind") == 0) & (leader != F.struct("key", "tie", "packed")))
    )
    at = F.shiftrightunsigned("packed", 2 * RUN_BITS)
    run = lambda bits: F.shiftrightunsigned("packed", bits).bitwiseAND(F.lit((1 << RUN_BITS) - 1))
    marked, sorted_ = F.col("kind") == 1, (F.col("kind") == 2) | F.col("mixed")
    # One list a document: marked intervals (start, end), and anchors for the sort (packed, -1).
    mark = F.struct(
        F.when(marked, F.col("g")).when(F.col("late"), at - run(RUN_BITS)).otherwise(F.col("packed")).alias("start"),
        F.when(marked, F.col("f")).when(F.col("late"), at - run(0) + SPAN).otherwise(F.lit(-1)).alias("end"),
    )
    marks = judged.where(marked | F.col("late") | sorted_).select("key", "tie", mark.alias("m")).groupBy("key", "tie").agg(F.collect_list("m").alias("marks"))

    # The documents are dealt by key once; both joins read that exchange, so both take all its columns.
    dealt = keyed.repartition("key", "tie")
    wanted = F.transform(F.filter("marks", lambda m: m["end"] < 0), lambda m: m["start"])
    edges = marks.select("key", "tie", wanted.alias("wanted")).where(F.size("wanted") > 0)
    once = dealt.join(edges, ["key", "tie"])
    contexts = once.select("key", "tie", "text", "wanted", "doc_id").mapInArrow(_contexts, "suffix binary, before binary, key long, tie long, packed long")
    buckets = contexts.repartitionByRange("suffix", "before").sortWithinPartitions("suffix", "before")
    found = buckets.mapInArrow(_bucket, "key long, tie long, start long, end long, h1 long, h2 long")
    # Windows that several buckets hold: all but the first are repeats. What a bucket has decided goes by itself.
    alone = F.coalesce("h1", F.xxhash64("key", "tie", "start"))
    place = Window.partitionBy(alone, "h2").orderBy("key", "tie", "start").rowsBetween(*everything)
    first = F.first(F.struct("key", "tie", "start")).over(place)
    across = found.withColumn("again", F.col("h2").isNotNull() & (first != F.struct("key", "tie", "start")))
    repeated = across.where(F.col("h2").isNull() | F.col("again")).select("key", "tie", F.struct("start", F.coalesce("end", F.col("start") + SPAN).alias("end")).alias("m"))
    more = repeated.groupBy("key", "tie").agg(F.collect_list("m").alias("more"))
    own = F.filter(F.coalesce("marks", F.expr("array()")), lambda m: m["end"] >= 0)
    joined = dealt.join(marks, ["key", "tie"], "left").join(more, ["key", "tie"], "left")
    spans = F.concat(own, F.coalesce("more", F.filter(own, lambda _: F.lit(False))))
    out = joined.select("doc_id", "text", spans.alias("spans")).mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.toDF(key, *beside(key, *out.columns[1:]))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte passages removed from every document."""
    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")

"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints of 64 bits link at 3 or fewer differing bits. Cut into two segments of 32 bits, one of the two
differs by at most one bit, so every fingerprint is indexed under each segment with each single bit wildcarded
(2 x 32 signatures) and linked fingerprints meet under an equal signature. Only distinct fingerprints are
indexed: copies collapse before any join, by a partial aggregate.

A signature's bucket may hold a large group of near copies. Its pairs are never emitted: the bucket's
fingerprints are verified and reduced to a spanning forest, and buckets beyond BLOCK members are first dealt
over sub-buckets by the same argument applied to the other segment (see ``_split``), again without loss.

Defined results: null, empty and blank texts have the fingerprint zero, which links like any other; texts
of one or two words have one shingle; a text of any length is read whole, its bits summed in pieces; repeated rows and
rows of one doc_id with several texts belong to the smallest doc_id reachable; null ids never become a component's
id unless nothing else is in it; an empty table gives no rows; extra columns are not read by ``near_duplicates`` and
stay in ``drop_near_duplicates``; output columns that would be named like the key get a leading underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import beside, map_slices, slices, table, utf8
from .components import components

SHINGLE = 3
BITS = 3
SEED = 42
BLOCK = 2048  # members of a bucket compared in one go
HOT = 1000  # a fingerprint of one row in so many is hot: there are at most that many


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words, repeats included; none for a text without words."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    whole = b" ".join(words)
    if len(words) <= shingle:
        return np.array([digest(whole, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.array([digest(whole[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole UTF-8 text."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(octets), 1 << 16):  # in pieces: the bits of a very long text need not be held at once
        counts += np.unpackbits(octets[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            values = np.array([fingerprint(x, shingle) for x in utf8(part.column(1))], dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], names=["key", "fp"])

        return handle

    return map_slices(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), make, f"key {kind}, fp long")


def _signatures(fps: DataFrame) -> DataFrame:
    """(sig, fp): 64 rows a fingerprint. A signature is the segment with one bit cleared, the place of that
    bit and the segment's number, packed in a long without loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(32, dtype=np.uint64)
        clear = ~(np.uint64(1) << place) & np.uint64(0xFFFFFFFF)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                out = []
                for segment in (0, 1):
                    part = (fp >> np.uint64(32 * segment)) & np.uint64(0xFFFFFFFF)
                    out.append(((part[:, None] & clear) | (place << np.uint64(32)) | np.uint64(segment << 40)).ravel())
                sig = np.concatenate(out).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(np.tile(np.repeat(fp.view(np.int64), 32), 2))], names=["sig", "fp"])

    return fps.mapInArrow(run, "sig long, fp long")


def forest(values: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the distinct fingerprints (uint64), linked at ``bits`` or fewer bits.

    Breadth first from each unvisited member against all that are still unvisited: every comparison either
    retires a member or is repeated for a later front, and only the forest's edges are kept.
    """
    rest = np.unique(values)
    edges: list[tuple[int, int]] = []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            at, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ at) <= bits
            if near.any():
                hit = rest[near]
                edges += [(int(at), int(x)) for x in hit]
                front, rest = np.concatenate([front, hit]), rest[~near]
    return edges


def _split(bucket: np.ndarray, segment: int) -> Iterator[np.ndarray]:
    """A large bucket as sub-buckets in which all links of the bucket meet.

    Members agree in ``segment`` but for one bit, so links differ by at most 3 bits in the other segment.
    Cut in four parts of 8 bits, one part is then equal: a sub-bucket for every part and value.
    """
    other = (bucket >> np.uint64(32 * (1 - segment))) & np.uint64(0xFFFFFFFF)
    for part in range(4):
        value = (other >> np.uint64(8 * part)) & np.uint64(0xFF)
        order = np.argsort(value, kind="stable")
        for piece in np.split(bucket[order], np.flatnonzero(np.diff(value[order])) + 1):
            if len(piece) > 1:
                yield piece


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v): edges that connect the same fingerprints as all pairs at ``bits`` or fewer differing bits do."""
    assert bits <= 3, "two segments with one wildcard each cover up to three differing bits"
    # A signature of one fingerprint links nothing. Sorted runs are read in order: a task holds one bucket.
    dealt = _signatures(fps).repartition("sig").sortWithinPartitions("sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reduce(sig: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            cut = np.flatnonzero(np.diff(sig)) + 1
            if not len(sig):
                return None
            starts, stops = np.concatenate([[0], cut]), np.concatenate([cut, [len(sig)]])
            edges = []
            size = stops - starts
            two = starts[size == 2]  # most buckets hold two: compared at once
            near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits
            edges += zip(fp[two][near].tolist(), fp[two + 1][near].tolist(), strict=True)
            for a, b in zip(starts[size > 2].tolist(), stops[size > 2].tolist(), strict=True):
                bucket = fp[a:b]
                for piece in [bucket] if b - a <= BLOCK else _split(bucket, int(sig[a]) >> 40):
                    edges += forest(piece, bits)
            if not edges:
                return None
            pairs = np.unique(np.array(edges, dtype=np.uint64).view(np.int64).reshape(-1, 2), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"])

        # The last bucket of a batch may go on in the next ones: its parts are joined once, when it ends.
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def joined() -> pa.RecordBatch | None:
            sig, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return reduce(sig, fp)

        for batch in batches:
            sig, fp = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(sig):
                continue
            last = int(np.searchsorted(sig, sig[-1]))
            if last or (held and held[-1][0][-1] != sig[0]):
                held.append((sig[:last], fp[:last]))
                if (out := joined()) is not None:
                    yield out
            held.append((sig[last:].copy(), fp[last:].copy()))
        if held and (out := joined()) is not None:
            yield out

    return dealt.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp, component): the smallest key reachable over links, itself included."""
    ensure_checkpoint_dir(docs.sparkSession)
    marked = fingerprints(docs, key, text, shingle).checkpoint()  # read three times below
    classes = marked.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    found = components(links(classes.select("fp")))
    # Least key of every component: from the classes' least keys, not from the fingerprints' order.
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("fp", "root", "n").join(best, "root").select("fp", "component", "n")
    # A fingerprint may be a third of all rows: HOT rows or more are few fingerprints, and those are broadcast.
    hot = F.broadcast(named.where(F.col("n") * HOT >= marked.count()).select("fp", F.col("component").alias("hot")))
    told = marked.join(hot, "fp", "left")
    many = told.where("hot is not null").select("key", "fp", F.col("hot").alias("component"))
    few = told.where("hot is null").select("key", "fp").join(named.select("fp", "component"), "fp")
    output = beside(key, "fp", "component")
    return many.unionByName(few.select("key", "fp", "component")).toDF(key, *output)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


# Near copies by Jaccard similarity
# ---------------------------------
# Two texts of which 80 % of the five-word shingles agree differ in about 10 of 64 SimHash bits, so a radius of
# three bits misses most of them, and a wider one needs segments too short to tell texts apart. The stage below
# keeps the deletion-variant index but cuts signatures of min-hash symbols, which agree as often as shingles do.

STAGE_SHINGLE, SIMILARITY = 5, 0.8
SEGMENTS, SYMBOLS, SKETCH = 8, 7, 128  # segments of symbols that are indexed; symbols compared to verify
BROADCAST_ROWS = 50_000  # names of documents (three numbers each) that are broadcast at most
BROADCAST_BYTES = 8 << 20  # of sets of shingles that are broadcast at most
FIRST_SHARE = 4  # one bucket in so many is read in the first round, which only spares the second one work
REST_BLOCK = 512  # classes of a block, on average, that meet under one shingle
BUCKETS = 1 << 16  # of shingles, whose counts order them
CLOSE = 0.12  # over three standard errors of a sketch's similarity
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, size=(SKETCH, 2), dtype=np.uint64) | np.uint64(1)


def sketch(text: bytes, shingle: int = STAGE_SHINGLE) -> np.ndarray:
    """SKETCH min-hash symbols (uint32) of the text's set of shingles."""
    hashes = shingle_hashes(text, shingle)
    least = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):  # in pieces: very long texts take no more memory
        part = hashes[at : at + 2048, None]
        mixed = part * _MULTIPLIERS[:, 0] + _MULTIPLIERS[:, 1]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(axis=0))
    return (least ^ (least >> np.uint64(32))).astype(np.uint32)


def _variants(sketches: np.ndarray) -> np.ndarray:
    """(rows, SEGMENTS * SYMBOLS) keys: every segment with each of its symbols left out."""
    rows = len(sketches)
    part = sketches[:, : SEGMENTS * SYMBOLS].astype(np.uint64).reshape(rows, SEGMENTS, SYMBOLS)
    odd = np.random.default_rng(11).integers(1, 1 << 63, size=(SEGMENTS, SYMBOLS), dtype=np.uint64) | np.uint64(1)
    terms = (part + np.uint64(1)) * odd[None]
    terms ^= terms >> np.uint64(29)
    terms *= np.uint64(0xBF58476D1CE4E5B9)
    keys = terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms  # all symbols but one
    label = np.arange(SEGMENTS * SYMBOLS, dtype=np.uint64).reshape(1, SEGMENTS, SYMBOLS) * np.uint64(0x9E3779B97F4A7C15)
    return ((keys ^ (keys >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + label).reshape(rows, -1)


def cell_pairs(batches: Iterator[pa.RecordBatch], similarity: float, every: bool) -> Iterator[pa.RecordBatch]:
    """Candidates (u, v) of rows (cell, second, class, root, n, place) in order of cells: pairs of different roots whose
    sets can still reach the similarity, as this is the first shingle that both hold at their places. ``second`` parts
    the two sides of a cell of two blocks. Without ``every``, one candidate a row.
    """
    least = similarity / (1 + similarity)

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        cell, second, name, root, n, place = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in rows]) for k in range(6))
        sided = np.isin(cell, cell[second])  # cells of two blocks: only pairs between them
        found: list[np.ndarray] = []
        open_ = np.ones(len(cell), dtype=bool)
        step = 1
        while step < len(cell):
            i = np.flatnonzero(cell[step:] == cell[:-step])
            if not len(i):
                break
            j = i + step
            left = np.minimum(n[i] - place[i], n[j] - place[j]) + 1
            fits = (root[i] != root[j]) & (left >= least * (n[i] + n[j]) - 1e-9) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
            fits &= ~sided[i] | (second[i] != second[j])
            if not every:
                fits &= open_[j]
                open_[j[fits]] = False
            found.append(np.column_stack([name[i[fits]], name[j[fits]]]))
            step += 1
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *found])
        if not len(pairs):
            return None
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
        if last or (held and held[-1].column(0)[-1].as_py() != cell[0]):
            held.append(batch.slice(0, last))
            if (out := solve(held)) is not None:
                yield out
            held = []
        held.append(batch.slice(last))
    if held and (out := solve(held)) is not None:
        yield out


def standing_for(docs: DataFrame, key: str, text: str, similarity: float = SIMILARITY, shingle: int = STAGE_SHINGLE) -> DataFrame:
    """(r1, r2): identities of the documents that stand for their groups of near copies, the smallest key of each.
    A document's identity is made of two hashes of its key and text.

    Texts with the same sketch are one class; a bucket holds the classes of one variant. A first round compares the
    classes of some buckets with the one that meets most others in all buckets (of an original with many copies
    that is the original): sketches settle the clear cases, and where they agree within CLOSE of the threshold the
    texts' whole sets of shingles are compared.

    The rest is decided without loss among all classes that share a bucket with another group. In an order of all
    shingles, rare ones first, two sets of the similarity share one of their first ones (prefixes), and from the first
    that they share on enough must be left of both. So classes meet under the shingles of their prefixes, pairs that
    can't reach the similarity any more are passed over where they meet, and the others are compared on whole sets.
    Copies of a common template meet under nothing, as what makes them differ comes first. A shingle that more than
    REST_BLOCK classes meet under is dealt over cells of two blocks each. One candidate a class and shingle is compared
    first; that joins most groups, and all pairs of groups that are left follow.
    """
    ensure_checkpoint_dir(docs.sparkSession)

    def make():
        def handle(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [sketch(x, shingle).tobytes() for x in utf8(part.column(2))]
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(found, pa.binary())], names=["r1", "r2", "key", "sketch"])

        return handle

    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(*identity(key, text), F.col(text).cast("string").alias("text"), F.col(key).alias("key"))
    marked = map_slices(picked, make, f"r1 long, r2 long, key {kind}, sketch binary").withColumn("class", F.xxhash64("sketch")).checkpoint()
    classes = marked.groupBy("class").agg(F.first("sketch").alias("sketch"), F.min(F.struct("key", "r1", "r2")).alias("least")).checkpoint()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint32).reshape(-1, SKETCH)
                variants = _variants(found)
                names = np.repeat(part.column(0).to_numpy(zero_copy_only=False), variants.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(variants.ravel().view(np.int64)), pa.array(names)], names=["v", "class"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows (v, class) in order: a bucket's first class with each other one."""
        bucket = head = None  # of the bucket that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            v, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            first = np.maximum.accumulate(np.where(np.concatenate([[True], v[1:] != v[:-1]]), np.arange(len(v)), 0))
            heads = c[first]
            if v[0] == bucket:
                heads[v == bucket] = head
            bucket, head = v[-1], heads[-1]
            both = np.unique(np.sort(np.column_stack([heads, c])[heads != c], axis=1), axis=0)
            if len(both):
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["u", "v"])

    variants = classes.select("class", "sketch").mapInArrow(explode, "v long, class long")
    counted = lambda rows: rows.withColumn("n", F.count("*").over(Window.partitionBy("v"))).where("n > 1")

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, SKETCH) for i in (2, 3))
            share = (a == b).mean(axis=1)
            clear = pa.array(share >= similarity + CLOSE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], clear], names=["u", "v", "clear"]).filter(pa.array(share > similarity - CLOSE))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(shingle_hashes(x, shingle).astype(np.uint32)).tobytes() for x in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["class", "set"])

    def paired(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
        left = pairs.join(values.select(F.col("class").alias("u"), F.col(name).alias("a")), "u")
        return left.join(values.select(F.col("class").alias("v"), F.col(name).alias("b")), "v").select("u", "v", "a", "b")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(class, set) of the classes of ``wanted``."""
        needed = wanted.join(classes.select("class", "least"), "class").select("class", "least.r1", "least.r2").checkpoint()
        if needed.count() <= BROADCAST_ROWS:
            needed = F.broadcast(needed)
        texts = docs.select(*identity(key, text), F.col(text).cast("string").alias("text")).join(needed, ["r1", "r2"]).select("class", "text")
        return texts.mapInArrow(whole_sets, "class long, set binary").dropDuplicates(["class"])

    def linked(shared: DataFrame) -> DataFrame:
        """Links of the classes of ``shared`` (v, class, n) with the first of each bucket."""
        facts = shared.groupBy("class").agg(F.sum(F.col("n") - 1).alias("degree"))
        ordered = shared.select("v", "class").join(facts, "class").repartition("v").sortWithinPartitions("v", F.desc("degree"), "class")
        candidates = ordered.select("v", "class").mapInArrow(pairs, "u long, v long").distinct()
        judged = paired(candidates, classes, "sketch").mapInArrow(estimate, "u long, v long, clear boolean").checkpoint()
        unclear = judged.where("not clear").select("u", "v")
        ends = [unclear.select(F.col(c).alias("class")).distinct() for c in ("u", "v")]
        sets = sets_of(ends[0].union(ends[1]).distinct())
        return judged.where("clear").select("u", "v").unionByName(paired(unclear, sets, "set").mapInArrow(exact, "u long, v long")).checkpoint()

    def rooted_by(edges: DataFrame) -> DataFrame:
        """(class, root) of all classes."""
        nodes = components(edges).withColumnRenamed("node", "class")
        return classes.select("class").join(nodes, "class", "left").select("class", F.coalesce("root", "class").alias("root")).checkpoint()

    def counted_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, n): how many of a task's shingles fall into every one of BUCKETS buckets."""
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in slices(batches):
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint32)
            counts += np.bincount(held % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])

    def prefixes(batches: Iterator[pa.RecordBatch], often: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(token, class, n, place) of the first n - ceil(t n) + 1 shingles of every set, those of rare buckets first."""
        for batch in slices(batches):
            sets = [np.frombuffer(x, dtype=np.uint32) for x in batch.column(1).to_pylist()]
            first = [x[np.lexsort((x, often[x % BUCKETS]))[: len(x) - int(np.ceil(similarity * len(x) - 1e-9)) + 1]] for x in sets]
            many = [len(x) for x in first]
            names = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), many)
            sizes = np.repeat(np.array([len(x) for x in sets], dtype=np.int32), many)
            place = np.concatenate([np.zeros(0, np.int32), *(np.arange(1, k + 1, dtype=np.int32) for k in many)])
            tokens = np.concatenate([np.zeros(0, np.uint32), *first]).view(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(names), pa.array(sizes), pa.array(place)], names=["token", "class", "n", "place"])

    def rest(shared: DataFrame, edges: DataFrame) -> DataFrame:
        """``edges`` and what joins the groups that are left."""
        labels = rooted_by(edges)
        rows = shared.select("v", "class").join(labels, "class")
        open_ = rows.groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("v")
        wanted = rows.join(open_, "v", "left_semi").select("class").distinct().checkpoint()
        if wanted.isEmpty():
            return edges
        sets = sets_of(wanted).checkpoint()
        small = (sets.agg(F.sum(F.length("set"))).first()[0] or 0) <= BROADCAST_BYTES
        # Any one order of all shingles loses nothing; counts of buckets suffice to put the frequent ones last.
        found = sets.select("set").mapInArrow(counted_shingles, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
        often = np.zeros(BUCKETS, dtype=np.int64)
        for row in found:  # BUCKETS numbers at most, whatever the input
            often[row["bucket"]] = row["n"]
        prefix = sets.mapInArrow(lambda x: prefixes(x, often), "token int, class long, n int, place int").checkpoint()
        for all_pairs in (False, True):
            named = prefix.join(labels, "class")
            several = named.groupBy("token").agg(F.count("*").alias("f"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
            met = named.join(several.select("token", F.ceil(F.col("f") / REST_BLOCK).cast("int").alias("blocks")), "token").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "class"), "blocks").cast("int"))
            other = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            low, high = F.least("block", "other"), F.greatest("block", "other")
            cells = other.select(F.xxhash64("token", low, high).alias("cell"), (F.col("block") != low).alias("second"), "class", "root", "n", "place")
            dealt = cells.repartition("cell").sortWithinPartitions("cell", "class")
            candidates = dealt.mapInArrow(lambda x, y=all_pairs: cell_pairs(x, similarity, y), "u long, v long").distinct()
            joined = paired(candidates, F.broadcast(sets) if small else sets, "set").mapInArrow(exact, "u long, v long").checkpoint()
            if not joined.isEmpty():
                edges = edges.unionByName(joined)
                labels = rooted_by(edges)
        return edges

    shared = counted(variants).checkpoint()
    links = rest(shared, linked(shared.where(F.pmod(F.xxhash64("v"), F.lit(FIRST_SHARE)) == 0)))
    found = components(links)
    rooted = classes.select("class", "least").join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    best = rooted.groupBy("root").agg(F.min("least").alias("best"))
    return best.select("best.r1", "best.r2")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every group of near copies: that of the smallest key. All columns stay.

    Rows that agree in key and text are copies of each other too, so one of them stays.
    """
    kept = standing_for(docs, key, text, similarity)
    names = [f"{n}_{'_'.join(docs.columns)}" for n in ("_r1", "_r2", "_n")]  # clash with no column
    marked = docs.select("*", *[c.alias(n) for c, n in zip(identity(key, text), names, strict=False)])
    found = marked.join(kept.toDF(*names[:2]), names[:2], "left_semi")
    # The window reads the join's own partitioning; what it holds together are equal rows.
    first = F.row_number().over(Window.partitionBy(*names[:2]).orderBy(F.lit(0)))
    return found.withColumn(names[2], first).where(F.col(names[2]) == 1).select(*docs.columns)


def identity(key: str, text: str) -> list:
    """Two hashes of key and text, null-safe: 128 bits that name a document."""
    return [F.xxhash64(F.col(key), F.col(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(text), F.col(key)).alias("r2")]

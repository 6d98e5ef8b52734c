"""Hierarchical multi-length packing of token sequences.

Documents are tokenised and packed inside the task that reads them, so nothing is shuffled and memory is
bounded by the pool of one task (POOL_TOKENS, plus the document in hand):

1. a document of 1024 tokens or more gives full 1024-token windows; what is left is routed, like any short
   document, to the smallest context-size tier (128, 256, 512, 1024) that holds it;
2. each tier is packed from its longest piece; the gap of a window is filled from this and the shorter
   tiers, best fit first, and where nothing fits the shortest piece is cut to fill the gap exactly;
3. when a task ends, its last unfilled windows are split into sequences whose lengths are powers of two,
   which need no padding either;
4. finished sequences are dealt to step groups of one tier: a group is full when the next sequence would bring it
   over GROUP_TOKENS, so full groups of any tier cost the same but for less than a window. A task's last group of each
   tier holds what is left.

Sequence and group ids carry the partition's number in their high bits. They follow from the input's
partitioning alone, so a recomputed task gives the same rows.

Defined results: null or empty text is a document of one token, the end-of-document id 0; a text of any length is
encoded whole; of pieces of one length the one of the earlier document is packed first; a repeated row is packed
again; an empty table gives no rows; null ids are carried as they are; extra columns are not read, and output columns
that would be named like the key get a leading underscore.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import beside, slices, table, utf8

WINDOW = 1024
TIERS = (128, 256, 512, 1024)
GROUP_TOKENS = 16 * WINDOW
END_ID = 0
POOL_TOKENS = 1 << 21  # a task packs once its pool holds as many tokens
KEPT_SHARE = 8  # the last 1/8 of a pool waits for the next one: its gaps fill better then
LONG_PIECE = 4000  # characters
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")  # the tokenizer, and its vocabulary as ranks
COLUMNS = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length int, tier int, step_group long"

#: The pre-tokeniser's split of the byte-level vocabulary, as public_tokenizers documents it.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_encoder(path: str, ranks_path: str) -> Callable[[str], bytes]:
    """text -> ids (4 bytes each) as the tokenizer of ``path`` gives them, without added special tokens.

    ``ranks_path`` holds the same vocabulary as ranks, whose encoder gives the same ids several times
    faster. Texts that it does not suit go to the tokenizer itself: those with a special token's string,
    and those with a piece of over LONG_PIECE characters, on which its merging takes quadratic time.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    long_space = re.compile(r"\s{%d}" % LONG_PIECE)

    def encode(text: str) -> bytes:
        if any(x in text for x in special) or (len(text) > LONG_PIECE and (max(map(len, text.split()), default=0) > LONG_PIECE or long_space.search(text))):
            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return fast.encode_to_numpy(text, disallowed_special=()).tobytes()

    return encode


def tier_of(length: int) -> int:
    return next(t for t in TIERS if length <= t)


class Packer:
    """Packs pieces (doc number, start, length) into sequences of at most WINDOW tokens."""

    def __init__(self) -> None:
        self.pool: list[tuple[int, int, int]] = []  # (length, doc, start), shortest first
        self.tokens = 0

    def add(self, doc: int, start: int, length: int) -> None:
        insort(self.pool, (length, doc, start))
        self.tokens += length

    def route(self, doc: int, length: int) -> Iterator[list[tuple[int, int, int]]]:
        """The full windows of a document; its rest goes to the pool."""
        full = length - length % WINDOW
        for start in range(0, full, WINDOW):
            yield [(doc, start, WINDOW)]
        if length > full:
            self.add(doc, full, length - full)

    def pack(self, down_to: int = 0) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(tier, pieces) of finished sequences until the pool holds ``down_to`` tokens or fewer."""
        while self.pool and self.tokens > down_to:
            length, doc, start = self.pool.pop()
            tier = tier_of(length)
            pieces, gap = [(doc, start, length)], tier - length
            while gap and self.pool:
                at = bisect_right(self.pool, (gap, float("inf"), 0)) - 1
                if at >= 0:
                    length, doc, start = self.pool.pop(at)
                    pieces.append((doc, start, length))
                    gap -= length
                else:  # the shortest piece is longer than the gap: cut it
                    length, doc, start = self.pool.pop(0)
                    pieces.append((doc, start, gap))
                    insort(self.pool, (length - gap, doc, start + gap))
                    gap = 0
            self.tokens -= tier - gap
            yield from [(tier, pieces)] if not gap else in_powers(pieces)


def in_powers(pieces: list[tuple[int, int, int]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Cuts the pieces of an unfilled window into sequences whose lengths are powers of two, longest first."""
    rest = list(reversed(pieces))
    left = sum(x[2] for x in pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        out, need = [], size
        while need:
            doc, start, length = rest.pop()
            out.append((doc, start, min(length, need)))
            if length > need:
                rest.append((doc, start + need, length - need))
            need -= min(length, need)
        left -= size
        yield tier_of(size), out


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece of a document, with the sequence that holds it (COLUMNS)."""
    kind = docs.schema[key].dataType.simpleString()
    plain = [x.split() for x in COLUMNS.split(", ")[1:]]
    names = [key, *beside(key, *(n for n, _ in plain))]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, [kind, *(k for _, k in plain)], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = token_encoder(*(paths or map(public_tokenizers.path, VOCABULARY)))
        end = array("I", [END_ID]).tobytes()
        part = TaskContext.get().partitionId() << 40
        packer, held = Packer(), {}  # held: doc number -> (id, token bytes)
        open_groups: dict[int, list[int]] = {t: [0, 0] for t in TIERS}  # tier -> [group, tokens]
        count = {"doc": 0, "sequence": 0, "group": 0}
        key_type = None

        def rows(sequences) -> pa.RecordBatch | None:
            out = []
            for tier, pieces in sequences:
                size = sum(x[2] for x in pieces)
                group = open_groups[tier]
                if group[1] == 0 or group[1] + size > GROUP_TOKENS:
                    count["group"] += 1
                    group[0], group[1] = part | count["group"], 0
                group[1] += size
                sequence = part | count["sequence"]
                count["sequence"] += 1
                offset = 0
                for doc, start, length in pieces:
                    name, ids = held[doc]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    out.append((name, start, length, crc, len(ids) // 4, sequence, offset, size, tier, group[0]))
                    offset += length
            if not out:
                return None
            columns = list(zip(*out, strict=True))
            kinds = [key_type, *[pa.int64()] * 6, pa.int32(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def forget() -> None:
            alive = {x[1] for x in packer.pool}
            for doc in [d for d in held if d not in alive]:
                del held[doc]

        for batch in slices(batches, 128):
            key_type = batch.column(0).type
            full = []
            for name, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = encode(raw.decode("utf-8", "replace")) + end
                doc = count["doc"]
                count["doc"] += 1
                held[doc] = (name, ids)
                full += ((WINDOW, x) for x in packer.route(doc, len(ids) // 4))
            if packer.tokens > POOL_TOKENS:
                full += packer.pack(POOL_TOKENS // KEPT_SHARE)
            out = rows(full)
            forget()
            if out is not None:
                yield out
        if key_type is not None:
            out = rows(packer.pack())
            if out is not None:
                yield out

    return docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))

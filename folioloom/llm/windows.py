"""Rolling window features by square-root decomposition.

For every time of a group and every window length W, the features of the group's rows in [time - W, time): how many
rows, the sum of their values, how many different labels, and values by rank. Rows of one group, time, value and label
are counted first (partial sums before the shuffle), so copies cost one row. Time is cut into tiles; a group's tile
holds its own rows and those of the longest window before it, so a group that holds a third of all rows is spread over
all its tiles, and what a task holds depends on a tile's rows, not on the length of the history.

Within a tile (rows in order of time): values are numbered by size; about sqrt(values) neighbours form a coarse bucket.
At every sqrt(rows) rows a checkpoint holds the cumulative weights of the coarse buckets, of the values and of the
labels. A window's histogram is the difference of the two checkpoints inside it, patched with the rows between them
and its edges; a rank is found by a scan over the coarse buckets and one over the values of the bucket it falls into.
Checkpoints lie further apart where there are so many values that their tables would exceed ``CELLS`` cells.

The features of a time then meet the rows of that time in an equality join; many rows of one time are split by the
skew join of adaptive execution.

Defined results: a null group is a group; a null time belongs to no window, and its own windows are empty; null values
count as rows but not for sums and ranks; null labels are not counted; an empty window has zeros and null ranks; a
window without values has the sum 0; repeated rows count as often as they stand there and each gets its own result;
rows of the same time are not in each other's windows; equal values keep their number; an empty table gives an empty
result; the length of a text is that of the whole text; an id whose time would not fit a long has none; extra columns
are not read, and a key that is named like an output makes that output's name begin with an underscore.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import beside, table

WINDOWS = (600, 43_200)
TILE = 10_800  # seconds; a row is sent to its own tile and to those that the longest window reaches
PERCENT = (50, 90)
CELLS = 4_000_000  # of a table of checkpoints, and of what is scanned for a block of windows
#: One element a window; ``ranked`` has all percentages of the first window, then those of the next.
FEATURES = ("n_events", "sum_values", "n_labels", "ranked")


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and the number of the range that each is from."""
    sizes = np.maximum(ends - starts, 0)
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes), of


class Checkpoints:
    """Cumulative weights of ``code`` (0 .. size - 1) at every ``step`` rows."""

    def __init__(self, code: np.ndarray, weight: np.ndarray, size: int, step: int, width: int = 1):
        self.code, self.weight, self.step, self.width = code, weight, step, width
        blocks, columns = len(code) // step + 1, -(-max(size, 1) // width) * width
        self.fine = np.zeros((blocks + 1, columns), np.int64)
        np.add.at(self.fine, (np.arange(len(code)) // step + 1, code), weight)
        np.cumsum(self.fine, axis=0, out=self.fine)
        self.coarse = self.fine.reshape(blocks + 1, -1, width).sum(axis=2)

    def inside(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last checkpoint within each range of rows (equal ones where there is none), rows at the edges, and whose they are."""
        first, last = -(-start // self.step), end // self.step
        none = first > last
        first, last = np.where(none, 0, first), np.where(none, 0, last)
        left, of_left = ranges(start, np.where(none, end, first * self.step))
        right, of_right = ranges(np.where(none, end, last * self.step), end)
        return first, last, np.concatenate([left, right]), np.concatenate([of_left, of_right])

    def histograms(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The weights of the coarse buckets for each range."""
        first, last, edge, of = self.inside(start, end)
        out = self.coarse[last] - self.coarse[first]
        np.add.at(out, (of, self.code[edge] // self.width), self.weight[edge])
        return out

    def ranked(self, start: np.ndarray, end: np.ndarray, histograms: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The code with the given rank (from 1) in each range; ranges without weight give any."""
        each = np.arange(len(start))
        reached = np.cumsum(histograms, axis=1)
        bucket = np.minimum((reached < rank[:, None]).sum(axis=1), reached.shape[1] - 1)
        before = reached[each, bucket] - histograms[each, bucket]
        first, last, edge, of = self.inside(start, end)
        columns = bucket[:, None] * self.width + np.arange(self.width)
        fine = self.fine[last[:, None], columns] - self.fine[first[:, None], columns]
        here = self.code[edge] // self.width == bucket[of]
        np.add.at(fine, (of[here], self.code[edge[here]] % self.width), self.weight[edge[here]])
        place = ((np.cumsum(fine, axis=1) + before[:, None]) < rank[:, None]).sum(axis=1)
        return bucket * self.width + np.minimum(place, self.width - 1)


def features(time: np.ndarray, value: np.ma.MaskedArray, label: np.ndarray, weight: np.ndarray, at: np.ndarray, windows=WINDOWS, percent=PERCENT, cells=CELLS) -> dict[str, np.ndarray]:
    """The features of the windows before the times ``at`` (one row a time, one column a window, or a window and
    percentage). The rows are in order of time; labels are codes, below 0 for none."""
    known = ~np.ma.getmaskarray(value)
    values, code = np.unique(value.data[known], return_inverse=True)
    codes = np.zeros(len(time), np.int64)
    codes[known] = code
    n, width = len(time), max(1, int(np.ceil(np.sqrt(len(values)))))
    step = lambda size: max(1, int(np.sqrt(n)), -(-n * size // cells))
    sizes = Checkpoints(codes, np.where(known, weight, 0), len(values), step(len(values)), width)
    n_labels = int(label.max(initial=-1)) + 1
    labels = Checkpoints(np.maximum(label, 0), np.where(label >= 0, weight, 0), n_labels, step(n_labels))
    rows = np.concatenate([[0], np.cumsum(weight)])
    sums = np.concatenate([[0], np.cumsum(np.where(known, value.data, 0) * weight)])
    out = {name: np.zeros((len(at), len(windows)), np.int64) for name in ("n_events", "sum_values", "n_labels")}
    out["ranked"] = np.ma.zeros((len(at), len(windows), len(percent)), np.int64)
    # So many windows at once that their histograms and the rows at their edges stay within the bound.
    block = max(1, cells // max(sizes.coarse.shape[1], width, n_labels, 2 * sizes.step, 2 * labels.step))
    for j, w in enumerate(windows):
        for i in range(0, len(at), block):
            here = slice(i, i + block)
            start, end = np.searchsorted(time, at[here] - w), np.searchsorted(time, at[here])
            out["n_events"][here, j] = rows[end] - rows[start]
            out["sum_values"][here, j] = sums[end] - sums[start]
            out["n_labels"][here, j] = (labels.histograms(start, end) > 0).sum(axis=1)
            found = sizes.histograms(start, end)
            m = found.sum(axis=1)
            for k, p in enumerate(percent):
                picked = values[sizes.ranked(start, end, found, -(-p * m // 100))] if len(values) else 0
                out["ranked"][here, j, k] = np.ma.masked_array(np.broadcast_to(picked, m.shape), m == 0)
    return out


def tile_features(rows: pa.Table, tile_s: int, windows=WINDOWS, percent=PERCENT) -> pa.Table:
    """A tile's rows (grp, tile, time, value, label, n) to one row for each time of its own."""
    rows = rows.sort_by("time").combine_chunks()
    time = rows["time"].to_numpy()
    value = np.ma.masked_array(rows["value"].fill_null(0).to_numpy(), rows["value"].is_null().to_numpy())
    label = rows["label"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.unique(time[time // tile_s == rows["tile"][0].as_py()])
    seen = slice(None if len(at) else 0)  # nothing is looked up in a tile that only holds the rows before it
    found = features(time[seen], value[seen], label[seen], rows["n"].to_numpy()[seen], at, windows, percent)
    columns = [pa.array([rows["grp"][0].as_py()] * len(at), rows.schema.field("grp").type), pa.array(at, pa.int64())]
    for x in found.values():
        flat = np.ma.asarray(x).reshape(len(at), int(np.prod(x.shape[1:])))
        ends = pa.array(np.arange(len(at) + 1) * flat.shape[1], pa.int32())
        columns.append(pa.ListArray.from_arrays(ends, pa.array(flat.data.ravel(), pa.int64(), mask=np.ma.getmaskarray(flat).ravel())))
    return pa.table(columns, names=["grp", "time", *found])


def rolling(rows: DataFrame, windows: tuple[int, ...] = WINDOWS, percent: tuple[int, ...] = PERCENT, tile: int = TILE) -> DataFrame:
    """grp, time and FEATURES, one row per group and time; ``rows`` has grp, time, value and label."""
    counted = rows.where("time IS NOT NULL").groupBy("grp", "time", "value", "label").agg(F.count("*").alias("n"))
    own = F.expr(f"time div {tile} - if(time % {tile} < 0, 1, 0)")
    reached = F.expr(f"(pmod(time, {tile}) + {max(windows)}) div {tile}")
    tiles = counted.withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), reached), lambda i: own + i)))
    schema = StructType([rows.schema["grp"], rows.schema["time"], *(StructField(name, ArrayType(LongType())) for name in FEATURES)])

    def tile_rows(table: pa.Table) -> pa.Table:
        return tile_features(table, tile, windows, percent)

    return tiles.groupBy("grp", "tile").applyInArrow(tile_rows, schema)


def window_features(
    df: DataFrame, time: Column, group: Column, value: Column, label: Column, key: str = "doc_id", windows: tuple[int, ...] = WINDOWS,
    percent: tuple[int, ...] = PERCENT, tile: int = TILE,
) -> DataFrame:
    """For each row of ``df`` and each window one row: key, time, window_s, n_events, sum_values, n_labels and ranked
    (one element a percentage: number ceil(percent * m / 100) of the window's m values in ascending order)."""
    time = time.cast("long")
    found = rolling(df.select(group.alias("grp"), time.alias("time"), value.cast("long").alias("value"), label.cast("string").alias("label")), windows, percent, tile)
    keys = df.select(F.col(key).alias("key"), group.alias("g"), time.alias("t"))
    joined = keys.join(found, keys["g"].eqNullSafe(found["grp"]) & (keys["t"] == found["time"]), "left")
    each = joined.select("key", "t", *FEATURES, F.posexplode(F.array(*map(F.lit, windows))).alias("i", "w"))
    counts = [F.coalesce(F.col(x)[F.col("i")], F.lit(0)) for x in FEATURES[:3]]
    ranked = F.array(*(F.col("ranked")[F.col("i") * len(percent) + k] for k in range(len(percent))))
    names = beside(key, "time", "window_s", *FEATURES)
    return each.select(F.col("key").alias(key), *(c.alias(n) for c, n in zip([F.col("t"), F.col("w").cast("long"), *counts, ranked], names, strict=True)))


def event_second(key: str = "doc_id") -> Column:
    """60 * floor((id + (crc32 of the id's decimal text mod 10000)) / 6); null where that does not fit a long."""
    shifted = f"try_add(`{key}`, crc32(cast(cast(`{key}` AS string) AS binary)) % 10000)"
    return F.expr(f"try_multiply(60L, {shifted} div 6 - if({shifted} % 6 < 0, 1, 0))")


def op11_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and languages of the documents of the same source in the ten minutes and the twelve hours before each."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    out = window_features(docs, event_second(), F.col("source"), F.length("text"), F.col("lang"))
    return out.select(
        "doc_id", "window_s", F.col("time").alias("event_s"), "n_events", F.col("sum_values").alias("sum_chars"), F.col("n_labels").alias("n_langs"),
        F.col("ranked")[0].alias("median_chars"), F.col("ranked")[1].alias("high_chars"),
    )


#: The checksum of an id, from the characters of its decimal text, bit by bit.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, c: list_reduce(list_prepend(xor(a, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""
_FRAME = "OVER (PARTITION BY source ORDER BY event_s RANGE BETWEEN {w} PRECEDING AND 1 PRECEDING)"
_ONE = f"""SELECT doc_id, CAST({{w}} AS BIGINT) AS window_s, event_s, count(*) {_FRAME} AS n_events, CAST(coalesce(sum(size) {_FRAME}, 0) AS BIGINT) AS sum_chars,
  len(list_distinct(list(lang) FILTER (lang IS NOT NULL) {_FRAME})) AS n_langs, list_sort(list(size) FILTER (size IS NOT NULL) {_FRAME}) AS sizes FROM timed"""
ORACLE = f"""WITH summed AS (SELECT doc_id, source, lang, length(text) AS size, xor({_CRC}, 4294967295) % 10000 + doc_id AS x FROM documents),
timed AS (SELECT *, 60 * ((x - ((x % 6) + 6) % 6) // 6) AS event_s FROM summed),
found AS ({" UNION ALL ".join(_ONE.replace("{w}", str(w)) for w in WINDOWS)})
SELECT doc_id, window_s, event_s, n_events, sum_chars, CAST(coalesce(n_langs, 0) AS BIGINT) AS n_langs,
  CAST(sizes[(len(sizes) + 1) // 2] AS BIGINT) AS median_chars, CAST(sizes[(90 * len(sizes) + 99) // 100] AS BIGINT) AS high_chars FROM found"""

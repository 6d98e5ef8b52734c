"""What the operators of this subpackage share: reading a table and mapping over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to Python objects at a time; bounds memory however large Arrow's batches are.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the input folder, with the named columns only (all when none is named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows (views, no copies)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch] | None]],
    schema: str,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """mapInArrow in small slices; ``make`` runs once a task and returns what handles a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = make()
        for part in slices(batches, rows):
            out = handle(part)
            if out is None:
                continue
            yield from out if isinstance(out, list) else [out]

    return df.mapInArrow(run, schema)


def beside(key: str, *names: str) -> list[str]:
    """Names of output columns; one that is the key's gets leading underscores until it differs."""
    out = []
    for name in names:
        while name == key or name in out:
            name = f"_{name}"
        out.append(name)
    return out


def remainder(column: str, mod: int):
    """crc32 of the id's decimal text modulo ``mod``; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(mod)


def keyed_share(column: str, salt: str):
    """A number in [0, 1) that depends on the id and the salt only: draws samples without randomness."""
    return (F.xxhash64(F.lit(salt), F.col(column).cast("string")).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))

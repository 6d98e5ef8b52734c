"""Releases: column contract, encrypted artifact, manifest and guards.

An artifact is a table of blocks. A block holds up to BLOCK_ROWS rows, and each of its columns is one value: the column
as compressed Arrow data, sealed with AES-GCM under a key of that column. So a reader of two columns reads and opens two
columns, a reader may be given the keys of some columns only, blocks are written and read in parallel without a
shuffle, and a block that is changed, or moved to another place, column or release, does not open. Parquet's own
encryption needs a key service that Spark does not bring along; hence this form.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import os
import secrets
import stat
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..operators.report import manifest as column_manifest

ENV_KEY = "FOLIOLOOM_RELEASE_KEY"
BLOCK_ROWS = 4096


def project(df: DataFrame, fixed: list[str], prefixes: list[str]) -> tuple[DataFrame, list[str]]:
    """(the release's columns in order, the columns left out). Raises where a fixed column or every vector family is absent."""
    absent = [c for c in fixed if c not in df.columns]
    families = [c for p in prefixes for c in df.columns if c.startswith(p)]
    if absent or not families:
        raise ValueError(f"a release lacks {absent or prefixes}")
    kept = [*fixed, *[c for c in families if c not in fixed]]
    return df.select(*kept), [c for c in df.columns if c not in kept]


def fingerprint(key: bytes) -> str:
    """All of a key that is ever shown."""
    return hashlib.sha256(key).hexdigest()[:12]


def resolve_key(path: str, create: bool = False) -> tuple[bytes, str]:
    """(key, origin): from the environment, else from the file, else new where that is allowed."""
    if value := os.environ.get(ENV_KEY):
        key, origin = bytes.fromhex(value), "environment"
    elif Path(path).exists():
        key, origin = bytes.fromhex(Path(path).read_text().strip()), "file"
    elif create:
        key, origin = secrets.token_bytes(32), "created"
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(key.hex())
        os.chmod(path, stat.S_IRUSR | stat.S_IWUSR)
    else:
        raise FileNotFoundError(f"no key in {ENV_KEY} or {path}")
    if len(key) not in (16, 24, 32):
        raise ValueError(f"the key from {origin} has {len(key)} bytes")
    return key, origin


def _rows_hash(df: DataFrame) -> str:
    """A hash of all rows that doesn't depend on their order."""
    row = df.select(F.xxhash64(F.to_json(F.struct(*df.columns))).cast("decimal(38,0)").alias("h")).agg(F.sum("h").alias("h"), F.count("*").alias("n")).first()
    return hashlib.sha256(f"{row['h']}|{row['n']}".encode()).hexdigest()


def column_key(key: bytes, column: str) -> bytes:
    """The key of one column; it tells nothing about the release's key or other columns'."""
    return hmac.new(key, f"column:{column}".encode(), hashlib.sha256).digest()


def _packed(df: DataFrame) -> DataFrame:
    """block, n and the columns c0, c1, ... of each block, as compressed Arrow data."""
    count = len(df.columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part, blobs = batch.slice(at, BLOCK_ROWS), []
                for i in range(count):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, pa.schema([pa.field("v", part.schema.field(i).type)]), options=options) as out:
                        # A filter with all rows makes a copy without the rows before and behind.
                        out.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([part.column(i)])], names=["v"]))
                    blobs.append(pa.array([sink.getvalue().to_pybytes()], pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([part.num_rows], pa.int64()), *blobs], names=["block", "n", *(f"c{i}" for i in range(count))])

    return df.mapInArrow(pack, ", ".join(["block string", "n long", *(f"c{i} binary" for i in range(count))]))


def _unpacked(blocks: DataFrame, schema: StructType) -> DataFrame:
    """The rows of blocks (n, and the columns of ``schema`` in order)."""
    names = schema.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [pa.ipc.open_stream(row[f"c{i}"]).read_all()["v"].combine_chunks() for i in range(len(names))]
                columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
                if any(len(c) != row["n"] for c in columns):
                    raise ValueError("a block's columns differ in length")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.mapInArrow(unpack, schema)


def _bound(release: str, column: str) -> Column:
    """What a sealed value is tied to: its release, column and block."""
    return F.concat_ws("|", F.lit(release), F.lit(column), F.col("block"))


def write_release(df: DataFrame, path: str, key: bytes, provenance: dict | None = None) -> dict:
    """Writes the rows sealed, reads them back, compares, and then writes the manifest; returns the manifest.

    ``df`` is worked out more than once and must give the same rows each time: a stored table. ``provenance`` is
    carried into the manifest (such as commit, dirty, source). A release without a manifest is not complete.
    """
    spark, release = df.sparkSession, secrets.token_hex(8)
    sealed = [F.aes_encrypt(f"c{i}", F.lit(column_key(key, c)), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _bound(release, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    _packed(df).select("block", "n", *sealed).write.mode("overwrite").parquet(f"{path}/rows")
    content = _rows_hash(df)
    payload = {
        "release": release,
        "columns": [r.asDict() for r in column_manifest(df).collect()],
        "content_sha256": content,
        "key_fingerprint": fingerprint(key),
        "column_fingerprints": {c: fingerprint(column_key(key, c)) for c in df.columns},
        "rows": df.count(),
        "schema": json.loads(df.schema.json()),
        "generated": datetime.now(UTC).isoformat(timespec="seconds"),
        "provenance": provenance or {},
    }
    if _rows_hash(_opened(spark, path, payload, df.columns, lambda c: column_key(key, c))) != content:
        raise ValueError("the release doesn't read back as it was written")
    text = json.dumps(payload, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return payload


def read_manifest(path: str, spark: SparkSession | None = None) -> dict | None:
    """The manifest, or None where there is none that can be read."""
    spark = spark or SparkSession.active()
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/manifest").collect()))
    except (AnalysisException, ValueError):
        return None


def _opened(spark: SparkSession, path: str, payload: dict, columns: list[str], key_of: Callable[[str], bytes]) -> DataFrame:
    fields = {f.name: (i, f) for i, f in enumerate(StructType.fromJson(payload["schema"]))}
    plain = [F.aes_decrypt(f"c{fields[c][0]}", F.lit(key_of(c)), F.lit("GCM"), F.lit("DEFAULT"), _bound(payload["release"], c)).alias(f"c{k}") for k, c in enumerate(columns)]
    # Only the chosen columns reach the scan.
    return _unpacked(spark.read.parquet(f"{path}/rows").select("n", *plain), StructType([fields[c][1] for c in columns]))


def read_release(spark: SparkSession, path: str, key: bytes | None = None, columns: list[str] | None = None, column_keys: dict[str, bytes] | None = None) -> DataFrame:
    """The rows of a release, with the named columns only; ``column_keys`` opens those columns without the release's key."""
    payload = read_manifest(path, spark)
    given = column_keys or {}
    if payload is None or (key is not None and payload["key_fingerprint"] != fingerprint(key)):
        raise ValueError("no manifest, or another key")
    columns = columns or (payload["schema"] and [f["name"] for f in payload["schema"]["fields"]] if key else list(given))
    keys = {c: given.get(c) or (column_key(key, c) if key else b"") for c in columns}
    if wrong := [c for c in columns if payload["column_fingerprints"].get(c) != fingerprint(keys[c])]:
        raise ValueError(f"no such columns, or other keys than theirs: {wrong}")
    return _opened(spark, path, payload, columns, keys.__getitem__)


def publish(df: DataFrame, path: str, key: bytes, fixed: list[str], prefixes: list[str], derive: dict[str, Column] | None = None, provenance: dict | None = None) -> tuple[dict, list[str]]:
    """A release by its column contract: (manifest, report). ``derive`` fills columns where they are null."""
    kept, dropped = project(df, fixed, prefixes)
    report = [f"{len(kept.columns)} columns"] + ([f"left out: {', '.join(dropped)}"] if dropped else [])
    if derive:
        before = kept.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in derive)).first()
        kept = kept.withColumns({c: F.coalesce(F.col(c), value.cast(kept.schema[c].dataType)) for c, value in derive.items()})
        after = kept.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in derive)).first()
        report += [f"{c}: {before[c] - after[c]} filled, {after[c]} null" for c in derive]
    payload = write_release(kept, path, key, provenance)
    report += [f"{payload['rows']} rows read back as they were written", f"content {payload['content_sha256'][:12]}, key {payload['key_fingerprint']}"]
    return payload, report


def _newest(spark: SparkSession, path: str) -> datetime | None:
    """When the newest file below ``path`` was written; nothing of the files is read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return files.agg(F.max("modificationTime")).first()[0]
    except AnalysisException:
        return None


def upload_refusals(path: str, key: bytes, remote: dict | None, private: bool, confirmed: bool, force: bool = False, source: str | None = None, spark: SparkSession | None = None) -> list[str]:
    """Why a release must not go out; empty where it may. ``source``: the table that it was made from."""
    spark = spark or SparkSession.active()
    payload = read_manifest(path, spark)
    if payload is None:
        return ["no manifest"]
    out = []
    if payload["key_fingerprint"] != fingerprint(key):
        out.append("made with another key")
    rows, manifest = _newest(spark, f"{path}/rows"), _newest(spark, f"{path}/manifest")
    if rows is None or rows > manifest:
        out.append("the rows are newer than the manifest")
    if source and (made := _newest(spark, source)) and rows and made > rows:
        out.append("the source is newer than the release")
    if payload["provenance"].get("dirty") and not force:
        out.append("made from a checkout with changes that aren't committed")
    if not private:
        out.append("the target is public")
    if remote and remote.get("content_sha256") == payload["content_sha256"] and not force:
        out.append("the target has this content")
    beside = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.col("path").contains("/rows/"))
    if not beside.where(F.col("content").cast("string").contains(key.hex())).isEmpty():
        out.append("the key is among the files")
    if not confirmed:
        out.append("not confirmed")
    return out

"""Tables that grow by numbered batches, each of which counts once.

A batch is written to a folder of its own and then entered in the list of commits; only what is listed is read. A writer
that dies in between leaves a folder that nobody reads, and the same batch, written again, replaces it. There is one
writer at a time, as with a streaming query.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, NullType, StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException


class BatchTable:
    """Committed batches below ``path``; ``snapshots`` stand for all batches up to theirs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> dict[int, dict]:
        """By batch, what was noted with it: one line a batch since the last snapshot, and one for each before."""
        try:
            rows = self.spark.read.option("recursiveFileLookup", "true").text(f"{self.path}/commits").select("value").collect()
        except AnalysisException:
            return {}
        return {x["batch"]: x for x in sorted((json.loads(r.value) for r in rows), key=lambda x: x["batch"])}

    def append(self, df: DataFrame, batch: int, note: dict | None = None, snapshot: bool = False) -> bool:
        """Writes ``df`` as a batch; False, and nothing is written, where that batch is in already."""
        if batch in self.commits():
            return False
        folder = f"{'snapshot' if snapshot else 'batch'}-{batch:08d}"
        df.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        line = json.dumps((note or {}) | {"batch": batch, "folder": folder, "snapshot": snapshot}, sort_keys=True)
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/commits/{folder}")
        return True

    def folders(self) -> list[str]:
        """What is to be read: the last snapshot and the batches behind it."""
        out: list[str] = []
        for x in self.commits().values():
            out = [x["folder"]] if x["snapshot"] else [*out, x["folder"]]
        return [f"{self.path}/{x}" for x in out]

    def read(self, schema: StructType) -> DataFrame:
        """All rows; columns that a batch lacks are null."""
        folders = self.folders()
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def _canonical(kind: DataType) -> DataType:
    if isinstance(kind, IntegerType):
        return LongType()
    if isinstance(kind, ArrayType):
        return ArrayType(_canonical(kind.elementType), True)
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _canonical(f.dataType)) for f in kind])
    return kind


class AppendTable(BatchTable):
    """A table whose columns are those of its first batch, in that order; columns that come later go behind them.

    A column's type is the first one it comes with, 32-bit integers as 64-bit ones; a batch that has another is cast to
    it. A column without a type (all null) takes the first type that a later batch brings, and is text where none does.
    """

    def schema(self) -> StructType:
        fields: dict[str, DataType] = {}
        for x in self.commits().values():
            for f in StructType.fromJson(x["schema"]):
                if isinstance(fields.get(f.name, NullType()), NullType):
                    fields[f.name] = f.dataType
        return StructType([StructField(k, StringType() if isinstance(v, NullType) else v) for k, v in fields.items()])

    def write(self, df: DataFrame, batch: int) -> bool:
        known = {f.name: f.dataType for x in self.commits().values() for f in reversed(StructType.fromJson(x["schema"]).fields) if not isinstance(f.dataType, NullType)}
        known = {f.name: known[f.name] for f in self.schema() if f.name in known}
        kinds = {f.name: known.get(f.name, _canonical(f.dataType)) for f in df.schema}
        typed = [c for c in df.columns if not isinstance(kinds[c], NullType) and not isinstance(df.schema[c].dataType, NullType)]
        # Columns without a type are noted, not written: nothing is in the files that a later type could clash with.
        note = {"schema": json.loads(StructType([StructField(c, kinds[c]) for c in df.columns]).json())}
        rows = df.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in typed)) if typed else df.select(F.lit(True).alias("_row"))
        return self.append(rows, batch, note)

    def table(self) -> DataFrame:
        return self.read(self.schema())


def append_stream(stream: DataFrame, path: str, checkpoint: str, transform=None) -> AppendTable:
    """Takes all that a stream has, batch by batch, into an AppendTable: a batch that runs again after a failure adds nothing."""
    table = AppendTable(stream.sparkSession, path)

    def keep(batch: DataFrame, number: int) -> None:
        table.write(transform(batch) if transform else batch, number)

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table

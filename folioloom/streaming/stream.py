"""Incremental forms of the build: a stream of placements is filtered, deduplicated and counted as it comes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """Parquet files of a folder as they arrive, ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def deduplicated(df: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key; state older than the watermark goes."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def filtered(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """The curation filters, which need no state."""
    from ..operators.curation import surviving

    return surviving(df, filters)


def windowed(df: DataFrame, time: str, by: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Rows by window and group, late rows within the watermark included."""
    return df.withWatermark(time, late).groupBy(F.window(time, size), by).agg(F.count("*").alias("n"))


def table_stream(spark: SparkSession, sf_dir: str, name: str, files: int = 16) -> DataFrame:
    """A table of the input folder as a stream, ``files`` of its files a batch."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    # A stream reads folders: the table's own where it is one, else the file of that name in its parent.
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
    return reader.parquet(path) if is_folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def counts_of(spark: SparkSession, sf_dir: str, name: str, by: str, value: str) -> DataFrame:
    """Counts and sums by group, kept by a stream over the table; read once it has taken all there is."""
    folder = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = table_stream(spark, sf_dir, name)
    counts = source.groupBy(by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    sink = f"{folder}-counts"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(sink)  # all groups so far: a batch that runs again writes the same

    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink)

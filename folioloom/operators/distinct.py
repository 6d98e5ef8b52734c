"""Computing on distinct values and mapping back: an expensive function runs once a value, not once a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType


ROWS = 256  # values that are Python objects at a time: whole pages may be long


def map_distinct(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series], kind: str, out: str | None = None, only: Column | None = None) -> DataFrame:
    """``column`` (or ``out``) = ``fn`` of the column's values, called on batches of at most ROWS distinct values.

    ``only`` restricts the work to values that can change; the others stay (or are null under a new name).
    """
    result = to_arrow_type(DataType.fromDDL(kind))
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull() if only is None else only).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.Array.from_pandas(fn(part.column(0).to_pandas()), type=result)], names=["_value", "_made"])

    made = values.mapInArrow(run, f"_value {df.schema[column].dataType.simpleString()}, _made {kind}")
    joined = df.join(made, df[column] == made["_value"], "left")
    result = F.coalesce("_made", F.col(column)) if out is None else F.col("_made")
    return joined.withColumn(out or column, result).drop("_value", "_made")

"""Queries of stores, append-only tables and sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import store
from ..streaming import batches, stream
from .base import query, table


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("store_states", """
WITH i AS (SELECT doc_id, 'items' AS extractor, CASE WHEN doc_id % 10 = 0 THEN 'failed' ELSE 'done' END AS state, CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS attempts FROM documents),
s AS (SELECT doc_id, 'instrument', CASE WHEN doc_id % 10 = 0 THEN 'pending' ELSE 'done' END, CASE WHEN doc_id % 10 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END FROM documents)
SELECT doc_id, extractor, state, attempts::BIGINT AS attempts, CASE WHEN state = 'done' THEN extractor || ' ' || doc_id END AS content FROM (SELECT * FROM i UNION ALL SELECT * FROM s)""")
def store_states(spark, sf):
    """Three runs over all documents, of which some fail once and some twice: cells as the store has them afterwards."""
    keys = table(spark, sf, "documents").select("doc_id")
    cells = store.CellStore(spark, _folder(spark, "store"), {"instrument": ["items"], "items": []})
    doc, tries = F.col("key").cast("long"), F.col("attempts")
    fails = ((F.col("extractor") == "items") & (doc % F.when(tries == 0, 5).otherwise(10) == 0)) | ((F.col("extractor") == "instrument") & (tries == 0) & (doc % 3 == 0))

    def extract(work):
        return work.select("key", "extractor", F.concat_ws(" ", "extractor", "key").alias("content"), F.when(fails, "TimeoutError").alias("error"))

    for _ in range(3):
        cells.run(keys, extract, retry_failed=True, max_attempts=2)
    return cells.states(keys).select(F.col("key").cast("long").alias("doc_id"), "extractor", "state", "attempts", "content")


@query("appended_lines", """SELECT doc_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, NULL::VARCHAR AS remark
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def appended_lines(spark, sf):
    """Documents as a stream, exploded to lines batch by batch into an append-only table with a column that is never filled."""
    folder = _folder(spark, "lines")

    def lines(batch):
        return batch.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("remark", F.lit(None))

    kept = batches.append_stream(stream.table_stream(spark, sf, "documents"), folder, f"{folder}-checkpoint", lines).table()
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.max("remark").alias("remark"))

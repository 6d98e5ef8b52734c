"""The build's steps, its counters and the streaming forms."""

import datetime

import pytest
from pyspark.sql import functions as F

from folioloom.functions.pages import page_fields
from folioloom.operators import encode
from folioloom.operators.distinct import map_distinct
from folioloom.plans import assemble
from folioloom.streaming import stream

COLUMNS = "path string, corpus_source string, item_language string, item_item_id long, item_item_text string, bucket string, x_extractor_ttft double"
ROWS = [
    ("a", "s", "EN-us", 0, "1. I worry &amp;lt; much", "scaled", 1.0),
    ("a", "s", "German", 1, "  ", "scaled", 1.0),
    ("b", "s", None, 3, "N/A", "scaled", None),
    ("b", "s", "", 4, "kept text", "unscaled", None),
    (None, "s", "fr", 0, "no path", "scaled", None),
]


def test_build(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    out, ctx = assemble.build(df)
    rows = {(r.path, r.item_item_id): r for r in out.collect()}
    assert set(rows) == {("a", 1), (None, 1)}
    assert rows["a", 1].item_item_text == "I worry &amp;lt; much" and rows["a", 1].flag_item_translated is False and rows["a", 1].observed_item_count == 2
    assert rows[None, 1].flag_item_translated is True and rows[None, 1].observed_item_count is None
    assert "x_extractor_ttft" not in out.columns and ctx.stats["filter.empty_item_text.new"] == 2


def test_steps_keep_their_order_and_refuse_unknown_names():
    assert assemble.selected(assemble.PATCH, ["items", "schema"]) == ["schema", "items"]
    with pytest.raises(ValueError):
        assemble.selected(assemble.PATCH, ["none"])


def test_patch_is_idempotent(spark):
    once = assemble.run_steps(spark.createDataFrame(ROWS, COLUMNS), assemble.PATCH, assemble.Context())
    twice = assemble.run_steps(once, assemble.PATCH, assemble.Context())
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_stats_sidecar(tmp_path):
    artifact = tmp_path / "a.parquet"
    artifact.write_text("x")
    assert assemble.read_stats(str(artifact)) is None and assemble.stats_stale(str(artifact))
    ctx = assemble.Context()
    ctx.stat("k", 1)
    assemble.write_stats(str(artifact), "patch", ctx)
    assert assemble.read_stats(str(artifact))["stats"] == {"k": 1} and not assemble.stats_stale(str(artifact))
    assemble.stats_path(str(artifact)).write_text("{broken")
    assert assemble.read_stats(str(artifact)) is None


def test_each_text_is_encoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(texts):
        seen.add(len(texts))
        return encode.hash_encoder(4)(texts)

    df = spark.createDataFrame([("one two",), ("one two",), (" ",), (None,), ("three",)], "t string")
    rows = encode.encode(df, "t", "v", counting).collect()
    assert sum(r.v is not None for r in rows) == 3 and seen.value == 2


def test_map_distinct_under_a_new_name(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "t string")
    assert [r.u for r in map_distinct(df, "t", lambda v: v + "!", "string", out="u").collect()].count("a!") == 2


def test_page_fields(spark):
    page = "A Title\nof two lines\nDOI: https://doi.org/10.1037/t00001-000\nInstrument Type:\n Rating Scale\nAuthors: Doe, J.;\n Roe, R.\nPermissions:\nContact Publisher.\n"
    got = spark.createDataFrame([(page,), (None,)], "p string").select(page_fields(F.col("p")).alias("f")).collect()
    f = next(r.f for r in got if r.f.title)
    assert (f.title, f.doi, f.instrument_type, f.authors, f.permissions, f.year) == ("A Title of two lines", "10.1037/t00001-000", "Rating Scale", "Doe, J.; Roe, R.", "Contact Publisher.", None)


def test_streams(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1, 12)
    rows = [(1, "a", at), (1, "a", at), (2, "b", at + datetime.timedelta(hours=2)), (3, None, at)]
    df = spark.createDataFrame(rows, "id long, kind string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    source = stream.read_stream(spark, str(tmp_path / "in"), df.schema, 10)
    once = stream.deduplicated(stream.filtered(source, {"empty": F.col("kind").isNull()}), ["id"], "ts")
    once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.table("once").collect()) == [1, 2]
    hours = stream.windowed(stream.read_stream(spark, str(tmp_path / "in"), df.schema, 10), "ts", "kind", "1 hour", "0 seconds")
    hours.writeStream.format("memory").queryName("hours").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination()
    assert {r.kind: r.n for r in spark.table("hours").collect()} == {"a": 2, None: 1}


def test_map_distinct_calls_on_few_values_at_a_time(spark):
    def sized(values):
        return values.map(lambda v: str(len(values)))

    df = spark.range(0, 2000, 1, 1).selectExpr("cast(id as string) t").coalesce(1)
    assert {int(r.u) for r in map_distinct(df, "t", sized, "string", out="u").collect()} <= set(range(1, 257))

"""The store of cells and append-only tables: resumption, replayed batches, gating, policies."""

import itertools

import pytest
from pyspark.sql import functions as F

from folioloom.sources import store
from folioloom.streaming import batches, stream

DEPENDS = {"instrument": ["items", "scales"], "items": [], "scales": ["items"], "meta": []}


def keys(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("path"))


def runner(fails="false", lost="false", calls=None):
    def extract(work):
        if calls is not None:
            calls.append(sorted((r.key, r.extractor, r.attempts, tuple(sorted(r.context))) for r in work.collect()))
        return work.select("key", "extractor", F.concat_ws("/", "extractor", "key").alias("content"), F.when(F.expr(fails), "TimeoutError: slow").alias("error"), F.expr(lost).alias("unreachable"))

    return extract


def test_waves():
    assert store.waves(DEPENDS) == [["items", "meta"], ["scales"], ["instrument"]]
    with pytest.raises(ValueError):
        store.waves({"a": ["b"], "b": ["a"]})


def test_gating_failures_and_policies(spark, tmp_path):
    cells = store.CellStore(spark, str(tmp_path), DEPENDS)
    calls = []
    out = cells.run(keys(spark, 4), runner("extractor = 'items' AND key = '1' AND attempts = 0", calls=calls))
    assert out == {"done": 13, "failed": 1, "waiting": 2, "unreachable": 0}
    assert ("2", "instrument", 0, ("items", "meta", "scales")) in calls[2] and all(k != "1" for k, *_ in calls[1] + calls[2])
    states = {(r.key, r.extractor): (r.state, r.attempts, r.content) for r in cells.states(keys(spark, 5)).collect()}
    assert states["1", "items"] == ("failed", 1, None) and states["1", "scales"] == ("pending", 0, None) and states["0", "instrument"] == ("done", 1, "instrument/0") and states["4", "meta"][0] == "pending"
    # Without a wish to retry nothing of the failed cell runs, and what waits for it still waits.
    assert cells.run(keys(spark, 4), runner()) == {"done": 0, "failed": 0, "waiting": 2, "unreachable": 0}
    assert cells.run(keys(spark, 4), runner(), retry_error="Reset") == {"done": 0, "failed": 0, "waiting": 2, "unreachable": 0}
    assert cells.run(keys(spark, 4), runner(), retry_error="Time", max_attempts=1)["done"] == 0
    assert cells.run(keys(spark, 4), runner(), retry_error="Time", max_attempts=2) == {"done": 3, "failed": 0, "waiting": 0, "unreachable": 0}
    wide = {r.key: r for r in cells.documents(keys(spark, 4), lambda c: F.concat(c["instrument"], F.lit("+"), c["meta"])).collect()}
    assert wide["1"].items_extractor_attempts == 2 and not wide["1"].has_errors and wide["1"].extraction_output == "instrument/1+meta/1"
    # A forced failure takes the content away.
    cells.run(keys(spark, 1), runner("true"), selected=["meta"], force=True)
    meta = cells.states(keys(spark, 1), ["meta"]).first()
    assert (meta.state, meta.content, meta.attempts) == ("failed", None, 2)


def test_out_of_reach_records_nothing(spark, tmp_path):
    cells = store.CellStore(spark, str(tmp_path), {"a": [], "b": ["a"]})
    assert cells.run(keys(spark, 4), runner(lost="key = '2'")) == {"done": 3, "failed": 0, "waiting": 0, "unreachable": 1}
    assert sorted(r.key for r in cells.cells().collect()) == ["0", "1", "3"] and cells.states(keys(spark, 4), ["a"]).where("key = '2'").first().attempts == 0
    assert cells.run(keys(spark, 4), runner())["done"] == 5


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path):
    whole = store.CellStore(spark, str(tmp_path / "whole"), {"a": [], "b": ["a"]})
    whole.run(keys(spark, 8), runner("key = '5' AND extractor = 'b'"), batches=2)
    killed = store.CellStore(spark, str(tmp_path / "killed"), {"a": [], "b": ["a"]})
    counter = itertools.count()

    def dies(work):
        if next(counter) == 3:
            raise KeyboardInterrupt
        return runner("key = '5' AND extractor = 'b'")(work)

    with pytest.raises(KeyboardInterrupt):
        killed.run(keys(spark, 8), dies, batches=2)
    assert 0 < killed.cells().count() < 16
    # A batch that was written but not committed is not read, and is replaced.
    spark.createDataFrame([("x", "a")], "key string, extractor string").write.parquet(f"{tmp_path}/killed/batch-{max(killed.log.commits()) + 1:08d}")
    killed.run(keys(spark, 8), runner("key = '5' AND extractor = 'b'"), batches=2)
    same = lambda s: sorted((r.key, r.extractor, r.content, r.error, r.attempts) for r in s.cells().collect())
    assert same(killed) == same(whole) and len(same(whole)) == 16
    before = same(whole)
    whole.compact()
    assert len(whole.log.folders()) == 1 and same(whole) == before
    whole.run(keys(spark, 8), runner(), retry_failed=True)
    assert [r for r in same(whole) if r[0] == "5" and r[1] == "b"] == [("5", "b", "b/5", None, 2)]


def test_lookups_are_kept(spark, tmp_path):
    asked = []

    def look(work):
        asked.extend(r.key for r in work.collect())
        return work.select("key", "extractor", F.concat(F.lit("v"), "key").alias("content"), F.lit(None).cast("string").alias("error"))

    assert store.looked_up(spark, str(tmp_path), keys(spark, 3), look).count() == 3
    out = store.looked_up(spark, str(tmp_path), keys(spark, 5), look, batches=2)
    assert sorted(map(tuple, out.collect())) == [(str(i), f"v{i}") for i in range(5)] and sorted(asked) == list("01234")


def test_append_tables(spark, tmp_path):
    table = batches.AppendTable(spark, str(tmp_path))
    first = spark.createDataFrame([(1, "a")], "id int, t string").withColumn("later", F.lit(None)).withColumn("never", F.lit(None))
    assert table.write(first, 0) and not table.write(first, 0)
    assert table.table().dtypes == [("id", "bigint"), ("t", "string"), ("later", "string"), ("never", "string")]
    second = spark.createDataFrame([("2", [1, 2], "5")], "id string, later array<int>, more string")
    assert table.write(second, 1) and table.write(first.drop("t"), 2)
    assert table.table().dtypes == [("id", "bigint"), ("t", "string"), ("later", "array<bigint>"), ("never", "string"), ("more", "string")]
    assert sorted(map(str, table.table().collect())) == sorted(["Row(id=1, t='a', later=None, never=None, more=None)", "Row(id=2, t=None, later=[1, 2], never=None, more='5')", "Row(id=1, t=None, later=None, never=None, more=None)"])
    nothing = batches.AppendTable(spark, str(tmp_path / "n"))
    assert nothing.table().count() == 0


def test_a_stream_that_dies_between_data_and_commit(spark, tmp_path, monkeypatch):
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    source = lambda: stream.read_stream(spark, f"{tmp_path}/in/*", "id long")
    write, calls = batches.AppendTable.write, itertools.count()

    def dies(self, df, batch):
        out = write(self, df, batch)
        if next(calls) == 1:
            raise RuntimeError("killed")  # the batch is in, the stream does not know it
        return out

    monkeypatch.setattr(batches.AppendTable, "write", dies)
    with pytest.raises(Exception, match="killed"):
        batches.append_stream(source(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    table = batches.append_stream(source(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(r.id for r in table.table().collect()) == list(range(40)) and len(table.commits()) == 4


def test_joins_of_a_store_broadcast_nothing(spark, tmp_path, capsys):
    cells = store.CellStore(spark, str(tmp_path), {"a": []})
    cells.run(keys(spark, 4), runner())
    cells.states(keys(spark, 4)).explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out

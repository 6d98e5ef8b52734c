"""Sealed releases: round trip of all types, keys of columns, what a projection reads, tampering, guards."""

import datetime
import decimal
import math

import pytest
from pyspark.sql import functions as F

from folioloom.sources import release
from harness import differences

KEY, OTHER = bytes(range(32)), bytes(32)


@pytest.fixture
def frame(spark):
    rows = [
        (1, "é🙂", [1.5, float("inf")], True, datetime.datetime(2024, 2, 29, 1, 2, 3, 456), decimal.Decimal("1.10"), b"\x00\xff", {"a": [1]}, (1, "x")),
        (2, "", [], None, None, None, None, {}, None), (3, None, None, False, datetime.datetime(1900, 1, 1), decimal.Decimal("-9.99"), b"", None, (None, None)), (3, None, None, False, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, "id long, t string, v array<double>, f boolean, at timestamp, d decimal(9,2), b binary, m map<string,array<int>>, s struct<x:int,y:string>")


def same(a, b):
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_round_trip(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(release, "BLOCK_ROWS", 2)
    payload = release.write_release(frame.repartition(2), str(tmp_path), KEY)
    same(release.read_release(spark, str(tmp_path), KEY), frame)
    assert payload["rows"] == 4 and release.read_manifest(str(tmp_path)) == payload
    again = release.write_release(frame.repartition(3), str(tmp_path / "b"), OTHER)
    assert again["content_sha256"] == payload["content_sha256"] and again["key_fingerprint"] != payload["key_fingerprint"]
    empty = frame.limit(0)
    release.write_release(empty, str(tmp_path / "e"), KEY)
    same(release.read_release(spark, str(tmp_path / "e"), KEY), empty)


def test_a_projection_reads_its_columns_only(spark, tmp_path):
    wide = spark.range(3000).select("id", *(F.sha2(F.concat_ws("-", "id", F.lit(i)), 512).alias(f"c{i}") for i in range(19)))
    release.write_release(wide, str(tmp_path), KEY)
    two = release.read_release(spark, str(tmp_path), KEY, ["c7", "id"])
    same(two, wide.select("c7", "id"))
    read = two._jdf.queryExecution().executedPlan().toString()
    schema = read[read.index("ReadSchema") :].splitlines()[0]
    assert "c8:binary" in schema and "c0:binary" in schema and schema.count("binary") == 2
    # The bytes of those columns in the files, against all.
    import pyarrow.parquet as pq

    sizes: dict[str, int] = {}
    for file in (tmp_path / "rows").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                sizes[column.path_in_schema] = sizes.get(column.path_in_schema, 0) + column.total_compressed_size
    assert sizes["c8"] + sizes["c0"] < 0.12 * sum(sizes.values())


def test_keys_of_columns(spark, frame, tmp_path):
    release.write_release(frame, str(tmp_path), KEY)
    some = {c: release.column_key(KEY, c) for c in ("t", "id")}
    same(release.read_release(spark, str(tmp_path), column_keys=some), frame.select("t", "id"))
    for wrong in ({"key": OTHER}, {"column_keys": {"t": release.column_key(KEY, "id")}}, {"column_keys": some, "columns": ["v"]}, {"key": KEY, "columns": ["absent"]}):
        with pytest.raises(ValueError):
            release.read_release(spark, str(tmp_path), **wrong)
    with pytest.raises(ValueError):
        release.read_release(spark, str(tmp_path / "nothing"), KEY)


def test_what_was_changed_or_moved_does_not_open(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(release, "BLOCK_ROWS", 2)
    df = spark.createDataFrame([(i, f"t{i}") for i in range(8)], "id long, t string").coalesce(1)
    path = str(tmp_path / "r")
    release.write_release(df, path, KEY)
    rows = spark.createDataFrame(spark.read.parquet(f"{path}/rows").collect(), "block string, n long, c0 binary, c1 binary").coalesce(1)
    for n, forged in enumerate([rows.withColumn("c1", F.col("c0")), rows.withColumn("c1", F.concat("c1", F.lit(b"x"))), rows.select("block", "n", "c0", F.lag("c1", 1, rows.first().c1).over(__import__("pyspark").sql.Window.orderBy("block")).alias("c1"))]):
        target = str(tmp_path / f"f{n}")
        forged.write.parquet(f"{target}/rows")
        spark.read.text(f"{path}/manifest").coalesce(1).write.text(f"{target}/manifest")
        with pytest.raises(Exception, match="(?i)AES|decrypt|tag"):
            release.read_release(spark, target, KEY).collect()
        assert release.read_release(spark, target, KEY, ["id"]).count() == 8  # the other column is untouched


def test_publish_and_guards(spark, tmp_path):
    df = spark.createDataFrame([(1, None, [0.5], 4), (2, 7, [math.pi], 9)], "id long, n_items int, item_pooled_a array<double>, note int")
    source, path = str(tmp_path / "source"), str(tmp_path / "r")
    df.write.parquet(source)
    payload, report = release.publish(spark.read.parquet(source), path, KEY, ["id", "n_items"], ["item_pooled_", "scale_pooled_"], {"n_items": F.lit(3)}, {"commit": "abc", "dirty": True})
    assert report[:3] == ["3 columns", "left out: note", "n_items: 1 filled, 0 null"] and payload["provenance"]["commit"] == "abc"
    assert sorted(r.n_items for r in release.read_release(spark, path, KEY).collect()) == [3, 7]
    dirty = "made from a checkout with changes that aren't committed"
    assert release.upload_refusals(path, KEY, None, True, True, source=source) == [dirty]
    assert release.upload_refusals(path, KEY, payload, True, True, force=True, source=source) == []
    assert release.upload_refusals(path, OTHER, payload, False, False) == ["made with another key", dirty, "the target is public", "the target has this content", "not confirmed"]
    df.write.mode("append").parquet(source)
    assert "the source is newer than the release" in release.upload_refusals(path, KEY, None, True, True, True, source)
    df.select("id").write.mode("append").parquet(f"{path}/rows")
    (tmp_path / "r" / "note.txt").write_text(KEY.hex())
    assert release.upload_refusals(path, KEY, None, True, True, True) == ["the rows are newer than the manifest", "the key is among the files"]
    with pytest.raises(ValueError):
        release.publish(df, path, KEY, ["absent"], ["item_"])


def test_query(spark):
    from folioloom.plans import registry

    assert differences(spark, registry.QUERIES["release_columns"], registry.ORACLE_SQL["release_columns"], "/root/testdata/sf0.01") == ""

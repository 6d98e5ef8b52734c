"""The pipeline's stages one after the other, and the queries with SQL."""

import random
from pathlib import Path

import pytest

import corpus_pipeline
from folioloom.llm import entry
from harness import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_oracles(spark, name):
    assert differences(spark, entry.QUERIES[name], entry.ORACLE_SQL[name], SF) == ""


def test_pipeline_on_planted_rows(spark, tmp_path):
    rng = random.Random(1)
    words = ["".join(rng.choice(["an", "er", "th", "on"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item, original = prose(40), prose(200)
    rows = [
        (1, original, "en", "a", 5),
        (2, original, "en", "b", 5),
        (3, original + " one more", "en", None, 5),
        (4, prose(100) + " " + item, None, "a", 5),
        (5, "short", "en", "a", 5),
        (6, prose(90) + " token = '04dbebab91ab85687d33eeaaf9ac699e1188f962' " + prose(10), "en", "a", 5),
        (None, prose(120), "en", "a", None),
        (8, None, "en", "a", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        left.append({r.doc_id for r in docs.collect()})
    assert left == [{1, 2, 3, 4, 6, None}, {1, 4, 6, None}, {1, 6, None}, {1, 6, None}]
    assert "[SECRET]" in docs.where("doc_id = 6").first().text
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == {1, 6, None}


def test_every_query_runs(spark):
    assert Path(SF).exists() and len(corpus_pipeline.STAGES) == 5
    for number in range(1, 11):
        names = [q for q in entry.QUERIES if q.startswith(f"op{number}_")]
        assert len(names) == 1
        assert entry.QUERIES[names[0]](spark, SF).count() >= 0

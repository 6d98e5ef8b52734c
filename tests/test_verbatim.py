"""The index of items against plain containment, and the check of extractions by hand."""

import random

import pytest

from folioloom.operators import verbatim
from folioloom.plans import registry
from harness import differences


@pytest.mark.parametrize("block", [5, 20_000])
def test_against_plain_containment(spark, block):
    rng = random.Random(block)
    words = ["alpha", "beta", "be", "ta", "x", "long-word", "é漢", "a\tb", "  ", "\n"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(120)] + [None, "", " ", "x"]
    texts += texts[:10]  # repeated rows
    items = [None, "", " ", "x", "lpha be", "pha beta be", "a"]
    for t in texts[:60]:
        a = rng.randrange(len(t) + 1)
        items.append(t[a : a + rng.randint(1, 40)])
    items += ["alpha beta be ta x nowhere alpha", items[10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, t string").repartition(3)
    stated = spark.createDataFrame(list(enumerate(items)), "id long, q string")
    want = sorted((d, i) for d, t in enumerate(texts) if t is not None for i, q in enumerate(items) if q and q in t)
    assert sorted(map(tuple, verbatim.contained(docs, stated, "doc", "t", "id", "q", block).collect())) == want
    doubled = verbatim.contained(docs.selectExpr("doc % 2 AS doc", "t"), stated.limit(20), "doc", "t", "id", "q", block)
    assert sorted(map(tuple, doubled.collect())) == sorted((d % 2, i) for d, i in want if i < 20)


def test_no_python_and_no_shuffle_of_texts(spark):
    sf = "/root/testdata/sf0.001"
    plan = registry.QUERIES["verbatim_exact"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan.replace("BroadcastHashJoin", "")


def test_extractions(spark):
    records = spark.createDataFrame([(x,) for x in ("ok", "review", "none", "short", "empty")], "record string")
    rows = [
        ("ok", "I often worry about things (2)", None, None), ("ok", "Item 4 (B2): I sleep well at night.", ["Never or almost never", "Always"], None), ("ok", "shy", None, None),
        ("review", "I often worry about things", ["not in the source at all"], None), ("review", None, None, "Read this aloud, please"), ("none", "I often worry about things", None, None), ("short", "shy", ["no"], None),
    ]
    items = spark.createDataFrame(rows, "record string, text string, options array<string>, note string")
    page = "1. I often <i>worry</i>\nabout things. 2. I SLEEP well at night! never or almost never, always"
    sources = spark.createDataFrame([("ok", page), ("ok", "other page"), ("review", page), ("review", "read this aloud please"), ("short", page), ("empty", page), ("none", " ")], "record string, source_text string")
    got = {r.record: (r.n_items, r.checkable, r.matched, r.status) for r in verbatim.check_extractions(records, items, sources).collect()}
    assert got == {"ok": (3, 2, 2, "ok"), "review": (2, 2, 1, "REVIEW"), "none": (1, None, None, "no_source_text"), "short": (1, 0, 0, "no_checkable_items"), "empty": (0, 0, 0, "no_checkable_items")}


@pytest.mark.parametrize("name", ["verbatim_check", "verbatim_exact", "verbatim_status"])
def test_queries(spark, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], "/root/testdata/sf0.01") == ""

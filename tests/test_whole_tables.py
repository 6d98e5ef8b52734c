"""Queries that read whole tables, against SQL without bounds on ids, where the tables reach beyond those bounds."""

import random

import pytest
from pyspark.sql import functions as F

from folioloom.operators import matching, statistics
from folioloom.plans import registry
from harness import differences

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["agreement", "alpha_nominal", "icc21", "name_match_tiers", "run_grid"])
def test_whole_tables(spark, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], SF) == ""


def test_best_counterparts_in_many_blocks(spark):
    rng = random.Random(3)
    sets = {d: {rng.randrange(30) for _ in range(rng.randint(1, 6))} for d in range(120)}
    rows = spark.createDataFrame([(d, i) for d, s in sets.items() for i in s], "d long, i long")
    want = set()
    for a in range(0, 120, 2):
        j, b = min((-len(sets[a] & sets[b]) / len(sets[a] | sets[b]), b) for b in range(1, 120, 2))
        want |= {(a, b, -j)} if j else set()
    got = matching.best_counterparts(rows, "d", "i", F.col("d") % 2 == 0, F.col("d") % 2 == 1, block=16)
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("wide", [0, 3, 32])
def test_best_counterparts_of_wide_and_equal_sets(spark, wide):
    rng = random.Random(5)
    sets = {d: {rng.randrange(25) for _ in range(rng.randint(1, 7))} for d in range(90)} | {d: {1, 2, 30} for d in range(90, 140)}
    sets[140], sets[141] = {500}, {501, 502}
    rows = spark.createDataFrame([(d, i) for d, s in sets.items() for i in s] + [(0, None)], "d long, i long")
    want = set()
    for a in range(0, 142, 2):
        j, b = min((-len(sets[a] & sets[b]) / len(sets[a] | sets[b]), b) for b in range(1, 142, 2))
        want |= {(a, b, -j)} if j else set()
    got = matching.best_counterparts(rows, "d", "i", F.col("d") % 2 == 0, F.col("d") % 2 == 1, block=16, wide=wide)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert ("FlatMapGroupsInArrow" in got._jdf.queryExecution().analyzed().toString()) == (wide < 7)  # blocks for wide sets only


def slow_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_levenshtein_matches_the_table():
    rng = random.Random(1)
    for _ in range(800):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(0, 80))) for _ in range(2))
        assert matching.levenshtein(a, b) == slow_levenshtein(a, b)


def slow_alpha(runs):
    k = min(map(len, runs))
    cells = [(r, p, t) for r, x in enumerate(runs) for p, t in enumerate(x[:k])]
    obs = every = 0.0
    for r, p, t in cells:
        for s, q, u in cells:
            d = (slow_levenshtein(t, u) / (max(len(t), len(u)) or 1)) ** 2
            every += d
            obs += d / (len(runs) - 1) if p == q and r != s else 0
    return 1 - obs * (len(cells) - 1) / every if every else 1.0


def test_alpha_by_document(spark):
    rng = random.Random(2)
    pool = ["x" * 80 + "".join(rng.choice("abC") for _ in range(20)) for _ in range(6)] + ["", None]
    runs = {doc: [[rng.choice(pool) for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 5))] for doc in [*range(12), None]}
    runs[20], runs[21] = [["same"] * 2] * 3, [["a", "b"]]
    rows = [(doc, r, p, t) for doc, own in runs.items() for r, x in enumerate(own) for p, t in enumerate(x)]
    out = statistics.alpha_text(spark.createDataFrame(rows, "doc long, run long, pos long, t string").repartition(3), "doc", "run", "pos", "t").collect()
    assert len(out) == len(runs)
    for r in out:
        own = [[(t or "").lower() for t in x] for x in runs[r.doc]]
        assert (r.n_runs, r.n_positions) == (len(own), min(map(len, own)))
        assert (r.alpha is None) if len(own) < 2 else abs(r.alpha - slow_alpha(own)) < 1e-9


def test_texts_that_differ_behind_a_prefix(spark, tmp_path):
    rows = [(0, 0, "user", "x" * 70 + "abc" * 50), (0, 1, "user", "x" * 70 + "def" * 50)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = registry.QUERIES["text_clusters"](spark, str(tmp_path)).collect()
    assert sorted((r.turn, r.cluster) for r in out) == [(0, 1), (1, 2)]
    got = registry.QUERIES["item_assignment"](spark, str(tmp_path)).collect()
    assert sorted((r.a, r.b) for r in got) == [(0, 0), (1, 1)]


def test_distances_within_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(matching, "COPIES", 2)
    rng = random.Random(4)
    rows = [(k, rng.choice(["g", "h", None]), rng.choice(["Ab", "ab", "abc", "", None])) for k in range(60)]
    want = set()
    for a, g, x in rows:
        for b, h, y in rows:
            if a < b and g == h and g is not None:
                longest = max(len(x or ""), len(y or ""))
                want.add((a, b, None if x is None or y is None else slow_levenshtein(x.lower(), y.lower()) / longest if longest else 0.0))
    got = matching.distances_within(spark.createDataFrame(rows, "r long, g string, t string").coalesce(1), ["g"], "r", "t")
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    assert got.rdd.getNumPartitions() == 4  # as many as the session's partitions, few as the bytes are


def test_pairs_are_dealt_alike_in_any_order_of_arrival(spark, monkeypatch):
    monkeypatch.setattr(matching, "COPIES", 8)
    rows = [(k, "gh"[k % 2], "abc"[k % 3]) for k in range(180)]
    dealt = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # one plan, as a task that is run again has
    try:
        for arrival in (rows, rows[::-1]):
            got = matching.distances_within(spark.createDataFrame(arrival, "r long, g string, t string").coalesce(1), ["g"], "r", "t")
            dealt.append([sorted((r.a, r.b) for r in part) for part in got.rdd.glom().collect()])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert dealt[0] == dealt[1] and sum(map(len, dealt[0])) == 2 * 90 * 89 // 2


def test_texts_of_documents_are_dealt_by_number(spark, monkeypatch):
    monkeypatch.setattr(matching, "TEXTS_A_TASK", 10)
    rows = spark.createDataFrame([(k // 4, k % 4, f"a text of {k}") for k in range(200)], "d long, i long, t string").coalesce(1)
    got = matching.matched_items(rows, rows, "d", "i", "t")
    assert got.rdd.getNumPartitions() == 20
    assert sorted((r.d, r.a, r.b, r.score) for r in got.collect()) == [(k // 4, k % 4, k % 4, 1.0) for k in range(200)]


def test_alpha_deals_texts_by_number(spark, monkeypatch):
    monkeypatch.setattr(matching, "TEXTS_A_TASK", 10)
    rows = spark.createDataFrame([(k // 4, k % 2, k % 4 // 2, f"Ä text {k}") for k in range(200)], "d long, r long, p long, t string")
    plan = statistics.alpha_text(rows, "d", "r", "p", "t")._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [doc" in plan and ", 20" in plan and "ArrowEvalPython" not in plan
    assert "edits(" in plan  # not F.levenshtein, which takes a step a pair of letters
    values = spark.createDataFrame([("kitten", "sitting"), ("", "abc"), (None, "a"), ("ä", "Ä")], "a string, b string")
    assert [r[0] for r in values.select(matching.text_edits(F.col("a"), F.col("b"))).collect()] == [3, 3, None, 1]

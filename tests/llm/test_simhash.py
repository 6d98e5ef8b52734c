"""Components of whole tables by SimHash, with and without hot fingerprints, against all pairs."""

import random

import pytest

from folioloom.llm import simhash


@pytest.mark.parametrize("hot", [1, 1000])
def test_components_match_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(4)
    base = [[f"w{rng.randrange(300)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for key in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(80)] = f"o{rng.randrange(10**6)}"
        rows.append((key * 3 % 119, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " ")] + [(300 + i, "the same") for i in range(40)]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 or rows[i][0] == rows[j][0] and prints[i] == prints[j]:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    want = sorted((key, prints[i], least[find(i)]) for i, (key, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component) for r in out) == want


def test_a_key_named_like_an_output(spark):
    df = spark.createDataFrame([(5, "a b c d", 1)], "fp long, text string, component int")
    out = simhash.near_duplicates(df, key="fp")
    assert out.columns == ["fp", "_fp", "component"] and out.first()["fp"] == 5
    assert simhash.drop_near_duplicates(df, key="fp").columns == df.columns


def test_buckets_that_go_on_over_many_batches(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(63)
    values = sorted({centre ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(400)} | {centre})
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.root for r in found} == {values[0]} and {r.node for r in found} == set(values[1:])


def test_components_of_few_edges_take_few_tasks(spark):
    from folioloom.llm.components import components

    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    tracker = spark.sparkContext.statusTracker()
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("few-edges", "components")
        edges = spark.range(40).selectExpr("id u", "id + 1 v").repartition(8)
        assert {r.root for r in components(edges).collect()} == {0}
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(j).stageIds]
        wide = [s for s in stages if s is not None and s.numCompletedTasks >= 64]
        assert len(wide) <= 3  # the edges' own distinct, and no stage of a round
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

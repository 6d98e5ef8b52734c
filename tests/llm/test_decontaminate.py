"""Decontamination against tiling of all pairs by brute force: no candidate may be lost before the tiling."""

import random

import pytest

from folioloom.llm import decontaminate
from test_operators import slow_tiles


def shuffled_pieces(rng, words, least, most):
    out, at = [], 0
    while at < len(words):
        n = rng.randint(least, most)
        out.append(words[at : at + n])
        at += n
    rng.shuffle(out)
    return [w for p in out for w in [*p, f"between{rng.randrange(99)}"]]


def planted(seed, vocabulary=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    items = [(k, [word() for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 15, 30]))]) for k in range(30)]
    docs = []
    for d in range(60):
        words = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1]
            words += shuffled_pieces(rng, item, 3, 5) if rng.random() < 0.7 else item
        docs.append((d, words))
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_all_pairs(spark, monkeypatch, seed):
    docs, items = planted(seed)
    want = set()
    for d, words in docs:
        for k, item in items:
            if len(item) < 3:
                leak = any(words[i : i + len(item)] == item for i in range(len(words)))
            else:
                leak = slow_tiles(words, item) >= 0.8 * len(item) - 1e-9
            want |= {(d, k)} if leak else set()
    if seed == 3:
        monkeypatch.setattr(decontaminate, "ITEMS", 7)  # several blocks
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = decontaminate.contaminated_pairs(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 10
    kept = {r.doc_id for r in decontaminate.drop_contaminated(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_tiles_equal_brute_force_on_few_words():
    rng = random.Random(9)
    for _ in range(600):
        doc, item = [rng.choice("abc") for _ in range(rng.randint(0, 40))], [rng.choice("abc") for _ in range(rng.randint(1, 20))]
        assert sum(t[2] for t in decontaminate.tiles(doc, item)) == slow_tiles(doc, item)


def test_short_reordered_pieces_and_short_items(spark):
    item = [f"x{i}" for i in range(24)]
    pieces = [item[i : i + 4] for i in range(0, 24, 4)][::-1]
    text = " and ".join(" ".join(p) for p in pieces)
    docs = spark.createDataFrame([(1, text), (2, "so What is the capital? asked"), (3, None), (4, "what is a capital")], "doc_id long, text string")
    bench = spark.createDataFrame([("a", " ".join(item)), ("b", "What is the capital?"), ("c", None), ("d", "...")], "item_id string, text string")
    got = {(r.doc_id, r.item_id, r.n_tiles) for r in decontaminate.contaminated_pairs(docs, bench).collect()}
    assert got == {(1, "a", 6), (2, "b", 1)}


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 2)], "coverage long, text string, item_id int")
    bench = spark.createDataFrame([(1, "a b c d")], "coverage long, text string")
    out = decontaminate.contaminated_pairs(docs, bench, key="coverage", item="coverage")
    assert out.columns == ["coverage", "_coverage", "__coverage", "n_tiles", "longest"] and out.count() == 1
    assert decontaminate.drop_contaminated(docs, bench, item="coverage").columns == docs.columns

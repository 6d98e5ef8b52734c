"""Windows and distances of the toxicity operator against their definitions, and its accuracy on held-out documents."""

import random

import pytest

from folioloom.llm import toxicity


def test_windows_cover_every_word():
    for n in range(30):
        words = [f"w{i}" for i in range(n)]
        found = toxicity.windows(" ".join(words).encode())
        held = {w for x in found for w in x.decode().split()}
        assert held == set(words) and all(len(x.split()) <= toxicity.WINDOW for x in found)
        starts = [int(x.split()[0][1:]) for x in found]
        assert starts == [toxicity.STRIDE * i for i in range(len(starts))]


def test_distances_are_differences_of_compressed_lengths():
    import zstandard as zstd

    model = toxicity.Model(b" the usual words of every day ", b" the usual words of every day blargh snorfle ", (0.0,) * 6)
    params = zstd.ZstdCompressionParameters(strategy=zstd.STRATEGY_LAZY2, **toxicity.MATCHING, write_checksum=False, write_content_size=False, write_dict_id=False)
    text = b"The usual snorfle of every blargh day and the words of day"
    want = []
    for w in toxicity.windows(text):
        sizes = []
        for content in (model.ordinary, model.toxic):
            known = zstd.ZstdCompressionDict(content + toxicity.LEAD + toxicity.TAIL, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            sizes.append(len(zstd.ZstdCompressor(dict_data=known, compression_params=params).compress(toxicity.LEAD + w + toxicity.TAIL)))
        want.append(sizes[0] - sizes[1])
    assert model.distances()(text) == want and max(want) > 0


def test_ids_with_many_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_ROWS", 20)
    taken = []
    monkeypatch.setattr(toxicity, "fit", taken.extend)
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(200)], "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert len(taken) == 20 == len(set(taken))


def test_a_key_named_like_an_output(spark):
    docs = spark.createDataFrame([(5, "some words", "x")], "score long, text string, distance string")
    out = toxicity.score_documents(docs, toxicity.fit([]), key="score")
    assert out.columns[:2] == ["score", "_score"] and out.first()["score"] == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_one_toxic_word_in_a_long_text_counts(seed):
    rng = random.Random(seed)
    parts = ["an", "er", "th", "on", "ti", "ea", "nd", "ou"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(500):
        words = [word() for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["grubbish", "plonker", "skiving"]))
        rows.append((" ".join(words).encode(), int(i % 3 == 0), i % 5 < 2))
    model = toxicity.fit(rows[:350])
    measure = model.distances()
    right = sum((model.score(model.features(measure(t)))[0] >= 0.5) == bool(y) for t, y, _ in rows[350:])
    assert right >= 0.9 * 150

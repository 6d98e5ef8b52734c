"""Scores and whole predictions of the language operator against slow versions, with many languages and scripts."""

import random

import numpy as np
import pytest

from folioloom.llm import language


def slow_scores(sample, text):
    """word -> language -> score, from counts in dictionaries."""
    langs = sorted({lang for _, lang in sample})
    letter = lambda c: language.unicodedata.category(c)[0] == "L"

    def grams(t):
        two = one = ""
        for c in language.lowered(t) + " ":
            c = c if letter(c) else ""
            if c or one:
                yield two, one, c
            two, one = (one if c and one else ""), c
            if not one:
                two = ""

    counts = {lang: [{}, {}, {}, {}, {}] for lang in langs}
    for t, lang in sample:
        for two, one, c in grams(t):
            for table, key in zip(counts[lang], ((two, one, c), (two, one), (one, c), one, c), strict=True):
                table[key] = table.get(key, 0) + 1
    kinds = {key for c in counts.values() for key in c[4]}
    tri, ctx, bi, bef = ({k for c in counts.values() for k in c[i]} for i in range(4))
    out = []
    word, score = "", None
    for two, one, c in grams(text):
        word += c
        score = score or [0.0] * len(langs)
        for i, lang in enumerate(langs):
            n3, nc, n2, nb, n1 = counts[lang]
            p1 = (n1.get(c, 0) + 1) / (sum(n1.values()) + len(kinds) + 1)
            p2 = n2.get((one, c), 0) / (nb.get(one, 0) + 5) + 5 / (nb.get(one, 0) + 5) * p1
            if (two, one, c) in tri:
                x = max(np.log(n3.get((two, one, c), 0) / (nc.get((two, one), 0) + 2) + 2 / (nc.get((two, one), 0) + 2) * p2), language.FLOOR)
            else:
                x = max(np.log(2 / (nc.get((two, one), 0) + 2)), language.FLOOR) if (two, one) in ctx else 0.0
                if (one, c) in bi:
                    x += max(np.log(p2), language.FLOOR)
                elif c in kinds:
                    x += (max(np.log(5 / (nb.get(one, 0) + 5)), language.FLOOR) if one in bef else 0.0) + max(np.log(p1), language.FLOOR)
                else:
                    x = language.FLOOR
                x = max(x, language.FLOOR)
            score[i] += x
        if not c:
            out.append((word, score))
            word, score = "", None
    return langs, out


def test_word_scores_match_counting():
    rng = random.Random(3)
    sample = [("".join(rng.choice("abcd é") for _ in range(60)), rng.choice(["x", "y", "z"])) for _ in range(12)]
    model = language.fit(sample)
    model.scripts[:] = 0
    for _ in range(20):
        text = "".join(rng.choice("abcdq é1") for _ in range(40))
        langs, want = slow_scores(sample, text)
        scores, starts, sizes = language.word_scores(model, language.letter_tables(), text)
        assert langs == model.langs and [w for w, _ in want] == [text[a : a + n] for a, n in zip(starts, sizes, strict=True)]
        if want:
            assert np.abs(scores - np.array([s for _, s in want])).max() < 1e-3


def test_more_than_64_languages(spark):
    rng = random.Random(5)
    rows, key = [], 0
    for lang in range(80):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 6)
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(40)]
        for _ in range(5):
            rows.append((key, " ".join(rng.choice(words) for _ in range(30)), f"l{lang}"))
            key += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    model = language.train(docs.where("doc_id % 5 <> 0"))
    assert len(model.langs) == 80
    out = {r.doc_id: r.lang_pred for r in language.label_documents(docs.where("doc_id % 5 = 0"), model).collect()}
    assert sum(out[k] == lang for k, _, lang in rows if k in out) >= 0.95 * len(out)


@pytest.mark.parametrize("pair", [(("uk", "їжак і ґава живуть у лісі"), ("ru", "ёжик и галка живут в лесу")), (("zh", "我们在图书馆里看书 他们说中文"), ("zx", "龍國東門馬車鳥魚黃綠 龍門鳥車"))])
def test_languages_of_one_rare_script(pair):
    latin = [("the house and the garden of this town " * 5, "en")] * 5
    model = language.fit([(t, lang) for lang, t in pair for _ in range(3)] + latin)
    for lang, text in pair:
        assert language.label_block(model, language.letter_tables(), [text])[0][0] == lang


def test_ids_with_many_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_SAMPLE", 10)
    taken = []
    monkeypatch.setattr(language, "fit", taken.extend)
    docs = spark.createDataFrame([(1, f"text {i}", "en") for i in range(60)], "doc_id long, text string, lang string")
    language.train(docs)
    assert len(taken) in (0, 10)  # one id: drawn or not


def test_a_key_named_like_an_output(spark):
    model = language.fit([("the house", "en")])
    df = spark.createDataFrame([("k", "the house", 1)], "score string, text string, spans int")
    out = language.label_documents(df, model, key="score")
    assert out.columns == ["score", "lang_pred", "_score", "spans"] and out.first().lang_pred == "en"

"""Repeated passages by the definition, with common passages that fill many buckets, many tasks and little memory of what was sent."""

import random

import numpy as np
import pytest

from folioloom.llm import suffixes
from test_operators import removed


@pytest.fixture
def many_buckets(spark):
    names = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("state", "block", "group"), [(500_000, 1 << 20, 20_000), (50, 1500, 7), (5000, 4000, 60)])
def test_common_passages_in_many_buckets(spark, many_buckets, monkeypatch, state, block, group):
    monkeypatch.setattr(suffixes, "STATE", state)
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "GROUP_ROWS", group)
    rng = random.Random(state)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, second = noise(180), noise(130)
    rows = []
    for i in range(150):
        parts = [noise(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice([common, common, second, common[:110], common[40:]]), rng.choice([noise(rng.randint(1, 60)), "x", noise(2)])]
        rows.append((i * 7 % 151, "".join(parts)))
    rows += [(k, t) for k, t in rows[:20]]  # the same rows again, in other tasks
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(frame).collect()}
    assert got == removed(set(rows)) and sum(x[1] for x in got.values()) > 5000


def test_rows_of_one_id_are_documents_of_their_own(spark, many_buckets):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(30)]
    rows = [(None, t + str(k)) for k, t in enumerate(texts)] + [(1, t) for t in texts]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sum(r.n_removed for r in out if r.doc_id is None) == 0
    assert [r.n_removed for r in out if r.doc_id == 1] == [200] * 30


def test_what_a_task_has_sent():
    rng = np.random.default_rng(2)
    sent, first, grams, mixed = suffixes.Sent(), {}, {}, set()
    for _ in range(30):
        pairs = sorted({(int(g), int(f)) for g, f in rng.integers(0, 12, size=(20, 2))})
        gram, context = (np.array(x, dtype=np.uint64) for x in zip(*pairs, strict=True))
        row = rng.integers(0, 40, size=(len(pairs), 3))
        late, again, direct = sent.judge(gram, context, row)
        known = dict(first)
        was = set(mixed)
        for k, pair in enumerate(pairs):
            r = tuple(row[k].tolist())
            assert late[k] == (pair in known and known[pair] < r) and again[k] == (known.get(pair) == r)
            assert direct[k] == (not late[k] and not again[k] and pair[0] in was)
            if pair not in known or r < known[pair]:
                first[pair] = r
            grams.setdefault(pair[0], set()).add(pair[1])
            if len(grams[pair[0]]) > 1:
                mixed.add(pair[0])


def test_a_key_named_like_an_output(spark):
    df = spark.createDataFrame([(1, "a" * 300, "x")], "n_spans long, text string, kept string")
    out = suffixes.remove_repeats(df, key="n_spans")
    assert out.columns == ["n_spans", "n_bytes", "n_removed", "_n_spans", "kept_sha256", "kept"] and out.first().n_removed == 299

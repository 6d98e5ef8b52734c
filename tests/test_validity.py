"""Draws, read-down cutoffs and dropped keys against plain arithmetic; predicates; the cross-check by hand."""

import hashlib
import math
import statistics as plain

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.operators import validity
from folioloom.plans import registry
from harness import differences


def uniform(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def test_draws(spark):
    rows = [(i, 0.9 * math.sin(i), 0.05, 0.8 * math.sin(i + 0.1)) for i in range(60)]
    cutoffs, related = [0.3, 0.1, 0.6], [0.4, 0.7, 2.0]
    got = validity.shown_shares(spark.createDataFrame(rows, "k long, o double, e double, d double").repartition(3), ["k"], "o", "e", "d", cutoffs, related, 8)
    want, reach = {}, {}
    for draw in range(8):
        truth = [o + e * math.sqrt(-2 * math.log(uniform(draw, k, "r"))) * math.cos(2 * math.pi * uniform(draw, k, "a")) for k, o, e, _ in rows]
        for t in related:
            signed = [r[3] * (1 if x > 0 else -1) for r, x in zip(rows, truth, strict=True) if abs(x) >= t]
            if signed:
                want[t, draw] = (len(signed), [sum(s >= c for s in signed) / len(signed) for c in sorted(cutoffs)])
                reach.setdefault(t, []).append(max((c for c, s in zip(sorted(cutoffs), want[t, draw][1], strict=True) if s >= 0.9), default=None))
    assert {(r.t, r.draw): (r.n, r.shares) for r in got.collect()} == want and {t for t, _ in want} == {0.4, 0.7}
    for r in validity.sensitivity(got, cutoffs).collect():
        shares = [v[1][sorted(cutoffs).index(r.cutoff)] for (t, _), v in want.items() if t == r.t]
        assert abs(r.share - plain.median(shares)) < 1e-9 and abs(r.lower - np.quantile(shares, 0.025)) < 1e-9
    for r in validity.read_down(got, cutoffs, [0.9, 1.1]).collect():
        known = [c for c in reach[r.t] if c is not None] if r.target == 0.9 else []
        assert (r.cutoff is None) if not known else abs(r.cutoff - plain.median(known)) < 1e-9


def test_normal_numbers(spark):
    x = [r[0] for r in spark.range(4000).select(validity.normal(F.col("id"))).collect()]
    assert abs(np.mean(x)) < 0.06 and abs(np.std(x) - 1) < 0.05 and abs(np.mean(np.abs(x) < 1.959964) - 0.95) < 0.015


def test_unmarked_keys(spark):
    rng = np.random.default_rng(3)
    items = [(s, 10 * s + i, rng.normal(size=5).tolist() if i else None, [True, False, None][i % 3]) for s in range(6) for i in range(9)]
    pairs = [(a, b, float(rng.normal())) for a in range(6) for b in range(a)]
    df = spark.createDataFrame(items, "s long, i long, v array<double>, rev boolean").repartition(3)
    got = validity.unmarked(df, spark.createDataFrame(pairs, "a long, b long, r double"), "s", "i", "v", F.col("rev"), "a", "b", "r", [0, 0.4, 1], 3)

    def direction(s, lost):
        v = sum((np.array(x) / np.linalg.norm(x)) * (-1 if rev and (s, i) not in lost else 1) for t, i, x, rev in items if t == s and x is not None)
        return v / np.linalg.norm(v)

    want = {}
    for share, draw in [(0.0, 0), (0.4, 0), (0.4, 1), (0.4, 2), (1.0, 0)]:
        lost = {(s, i) for s, i, x, rev in items if rev and x is not None and uniform(draw, s, i) < share}
        doc, new = {s: direction(s, set()) for s in range(6)}, {s: direction(s, lost) for s in range(6)}
        r = [p[2] for p in pairs]
        want[share, draw, "query"] = (np.corrcoef([new[a] @ doc[b] for a, b, _ in pairs] + [doc[a] @ new[b] for a, b, _ in pairs], r + r)[0, 1], len(lost))
        want[share, draw, "both"] = (np.corrcoef([new[a] @ new[b] for a, b, _ in pairs], r)[0, 1], len(lost))
    out = {(r.share, r.draw, r.condition): (r.accuracy, r.n_dropped) for r in got.collect()}
    assert out.keys() == want.keys()
    assert {k: v[1] for k, v in out.items()} == {k: v[1] for k, v in want.items()}
    assert {k: round(v[0], 9) for k, v in out.items()} == {k: round(float(v[0]), 9) for k, v in want.items()}


def test_one_predicate_three_ways(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id long, x long")
    small, odd = validity.Predicate("small", F.col("x") < 10), validity.Predicate("odd", F.col("id") % 2 == 1)
    ids = lambda d: [r.id for r in d.orderBy("id").collect()]
    assert ids(small.keep(df)) == [1] and ids(small.drop(df)) == [2, 3] and ids(validity.Predicate("small", F.col("x") < 10, True).keep(df)) == [1, 2]
    assert [r.small for r in df.orderBy("id").select(small.mask()).collect()] == [True, False, False]
    assert ids((odd & small.inverted("large")).keep(df)) == [3] and ids(validity.searchable([small, validity.Predicate("three", F.col("id") == 3)]).keep(df)) == [2]


def test_cross_check(spark):
    rows = spark.createDataFrame([("a", True, None), ("a", False, False), ("b", False, True), ("c", None, None), ("x", True, True)], "doc string, f boolean, g boolean")
    audit = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("d", 1), (None, 0)], "doc string, bad int")
    p = validity.Predicate
    out = {r.flag: tuple(r[c] for c in ("audited", "in_corpus", "flagged", "caught", "genuine_total", "precision")) for r in validity.cross_check(audit, rows, "doc", p("bad", F.col("bad") == 1), [p("f", F.col("f")), p("g", F.col("g"))]).collect()}
    assert out == {"f": (5, 3, 1, 1, 2, 1.0), "g": (5, 3, 1, 0, 2, 0.0), "any_flag": (5, 3, 2, 1, 2, 0.5)}


@pytest.mark.parametrize("name", ["sensitivity_draws", "read_down_cutoffs", "unmarked_keys", "flag_cross_check"])
def test_queries(spark, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], "/root/testdata/sf0.01") == ""

"""Hosts, the beta prior and the verdicts of the quality operator against plain arithmetic."""

import random

import pytest
from pyspark.sql import functions as F

from folioloom.llm import quality


def test_hosts(spark):
    rows = [("https://www.Example.org:8080/a?b", "example.org"), ("ftp://u:p@files.example.org/x", "files.example.org"), ("src3", "src3"), (None, ""), ("", ""), ("http://a.b#c", "a.b"), ("not a url", "not a url")]
    out = spark.createDataFrame(rows, "v string, want string").withColumn("got", quality.host_of(F.col("v")))
    assert out.where("got <> want").count() == 0


def plain_verdicts(rows):
    """(key, kept) by the definition, from quality.measure's counts."""
    measured = []
    for key, text, host in rows:
        n, chars, symbols, dup, repeat, lines, upper, letters = quality.measure((text or "").encode())
        base = n < 50 or 100 * repeat > 50 * n
        soft = [symbols > 0.5 * n, symbols > 1.5 * n, dup > 0.3 * lines, repeat > 0.3 * n, upper > 0.7 * letters, n > 0 and not 2 <= chars / n <= 15]
        measured.append((key, host or "", base, sum(soft)))
    hosts = {}
    for _, host, base, soft in measured:
        total, failed = hosts.get(host, (0, 0))
        hosts[host] = (total + 1, failed + (base or soft > 0))
    m = sum(f for _, f in hosts.values()) / sum(n for n, _ in hosts.values())
    rates = [f / n for n, f in hosts.values()]
    mean = sum(rates) / len(rates)
    v = sum((r - mean) ** 2 for r in rates) / len(rates)
    between = max(v - m * (1 - m) * sum(1 / n for n, _ in hosts.values()) / len(hosts), 1e-9)
    weight = min(max(m * (1 - m) / between - 1, 1), 1e6)
    rate = {h: (f + m * weight) / (n + weight) for h, (n, f) in hosts.items()}
    return {key: (not base and not (soft >= 2 or (soft >= 1 and rate[host] > 0.5)), round(rate[host], 9)) for key, host, base, soft in measured}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_verdicts_match_plain_arithmetic(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "WORD", "LOUD", "ab", "x#y", "##", "|"]) + str(rng.randrange(500))
    rows = []
    for key in range(150):
        kind = rng.random()
        words = [word() for _ in range(rng.randint(40, 90))]
        if kind < 0.3:
            words += ["#"] * rng.randint(0, 120)
        elif kind < 0.5:
            words += words[: rng.randint(0, 60)]
        rows.append((key, "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)), rng.choice(["a", "a", "a", "b", "c", None])))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r.doc_id: (r.kept, round(r.host_rate, 9)) for r in quality.verdicts(df).collect()}
    assert got == plain_verdicts(rows) and 10 < sum(k for k, _ in got.values()) < 150
    assert {r.doc_id for r in quality.keep_good(df).collect()} == {k for k, (kept, _) in got.items() if kept}


def test_keys_named_like_an_output(spark):
    df = spark.createDataFrame([(1, "some words", "h", 2)], "kept long, text string, source string, host int")
    out = quality.verdicts(df, key="kept")
    assert out.columns[0] == "kept" and "_kept" in out.columns and out.first()["kept"] == 1
    assert quality.keep_good(df, key="kept").columns == df.columns

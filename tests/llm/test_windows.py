"""Rolling features against plain loops, the checkpoints against whole histograms, and the edge cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.llm import windows
from harness import differences

KINDS = "doc_id long, g string, t long, v long, l string, extra int"


def brute(rows, spans=windows.WINDOWS, percent=windows.PERCENT):
    out = []
    for key, g, t, *_ in rows:
        for w in spans:
            own = [] if t is None else [r for r in rows if r[1] == g and r[2] is not None and t - w <= r[2] < t]
            values = sorted(r[3] for r in own if r[3] is not None)
            ranked = [values[-(-p * len(values) // 100) - 1] if values else None for p in percent]
            out.append((key, t, w, len(own), sum(values), len({r[4] for r in own} - {None}), ranked))
    return sorted(out, key=str)


def results(spark, rows, **options):
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    return sorted(map(tuple, windows.window_features(df, F.col("t"), F.col("g"), F.col("v"), F.col("l"), **options).collect()), key=str)


def made(n, seed, times=100_000, groups=("a", "b", None, "hot", "hot", "hot")):
    rng = random.Random(seed)
    return [(i, rng.choice(groups), rng.choice([rng.randrange(-times, times), rng.randrange(0, 2000), 600, 1200]), rng.choice([None, 0, 3, rng.randrange(50), rng.randrange(10**6)]), rng.choice(["x", "y", "z", None]), 0) for i in range(n)]


def test_against_plain_loops(spark):
    rows = made(400, 1)
    rows += rows[:40]  # repeated rows
    assert results(spark, rows) == brute(rows)
    assert results(spark, rows[:200], windows=(7, 1, 90_000), percent=(1, 100, 33), tile=500) == brute(rows[:200], (7, 1, 90_000), (1, 100, 33))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, 0)], [(1, "a", 5, 2, "x", 0), (None, "a", 6, None, None, 0), (None, None, 6, 4, "y", 0), (2, "a", None, 9, "z", 0), (3, "a", 6, 0, "", 0), (4, "a", 700, 1, "q", 0)]])
def test_odd_rows(spark, rows):
    assert results(spark, rows) == brute(rows)


def test_one_time_holds_most_rows(spark):
    rows = [(i, "hot", 60, i % 7, "x", 0) for i in range(2000)] + [(5000 + i, "hot", 61 + i, None, None, 0) for i in range(5)]
    assert results(spark, rows) == brute(rows)


def test_checkpoints_far_apart_and_blocks_of_one():
    rng = np.random.default_rng(2)
    n = 700
    time, weight = np.sort(rng.integers(0, 300, n)), rng.integers(1, 4, n)
    value = np.ma.masked_array(rng.integers(0, 400, n), rng.random(n) < 0.1)
    label, at = rng.integers(-1, 30, n), np.arange(-5, 320)
    plain = windows.features(time, value, label, weight, at, (20, 200), (50, 90))
    for cells in (1, 200, 5000):
        tight = windows.features(time, value, label, weight, at, (20, 200), (50, 90), cells)
        assert all((plain[k].filled(-1) == tight[k].filled(-1)).all() if k == "ranked" else (plain[k] == tight[k]).all() for k in plain)
    for i, t in enumerate(at):
        for j, w in enumerate((20, 200)):
            inside = (time >= t - w) & (time < t)
            values = np.sort(np.repeat(value.data, weight * (inside & ~value.mask)))
            assert plain["n_events"][i, j] == weight[inside].sum() and plain["n_labels"][i, j] == len(set(label[inside].tolist()) - {-1})
            want = [int(values[math.ceil(p * len(values) / 100) - 1]) if len(values) else None for p in (50, 90)]
            assert plain["ranked"][i, j].tolist() == want


def test_times_of_ids(spark):
    ids = [0, 1, 5, 77, 256_409, -3, -100_000, 2**62, 2**63 - 1, -(2**63), None]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select(windows.event_second()).collect()]
    want = [None if i is None else 60 * ((i + zlib.crc32(str(i).encode()) % 10_000) // 6) for i in ids]
    assert got == [None if x is None or abs(x) >= 2**63 else x for x in want]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "window_s long, n_events int")
    out = windows.window_features(df, F.lit(1), F.lit("a"), F.lit(1), F.lit("b"), key="window_s")
    assert out.columns == ["window_s", "time", "_window_s", "n_events", "sum_values", "n_labels", "ranked"] and out.count() == 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    assert differences(spark, windows.op11_windows, windows.ORACLE, f"/root/testdata/{sf}") == ""

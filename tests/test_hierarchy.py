"""Vectors pooled over hierarchies against a plain pass over the rows, and odd cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.operators import hierarchy
from folioloom.plans import registry
from harness import differences

KINDS = "path string, ord long, scale_id_path array<long>, scale_name_path array<string>, item_item_id long, item_reverse_coded boolean, item_embedding array<float>, scale_embedding array<float>, instrument_embedding array<float>, flag boolean, year int, version string"
COLUMNS = hierarchy.Placements(flags=("flag",), doc_columns=("year",), node_columns=("version",))


def made(n, seed):
    rng = random.Random(seed)
    vec = lambda: rng.choice([None, [0.0] * 4, [rng.uniform(-1, 1) for _ in range(4)]])
    rows = []
    for i in range(n):
        ids = rng.choice([None, [], [1], [1, 2], [1, 2, 3], [1, 4], [5], [5, 6, 7, 8, 9, 10, 11]])
        names = None if ids is None or rng.random() < 0.1 else [f"name {x}" for x in ids]
        rows.append((rng.choice(["a", "b", None]), i, ids, names, rng.choice([None, 1, 2, 3, 4]), rng.choice([None, True, False]), vec(), vec(), vec(), rng.choice([None, True, False]), rng.choice([None, 1999, 2000]), rng.choice([None, "A", "B"])))
    return rows


def plain(rows, lookup):
    """Groups by one pass in order, then means with numpy."""
    groups, own, first, names = {}, {}, {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        doc, order, ids, called, item = r[:5]
        ids = ids or []
        first.setdefault(doc, r)
        tag = item if item is not None else ("row", order)
        for at, node in enumerate([*ids, None]):
            g = groups.setdefault((doc, node), ({}, set(), set()))
            g[0].setdefault(tag, r)
            g[1].update(ids if node is None else ids[at:])
            if ids:
                g[2].add(ids[-1])
            if node is not None:
                names.setdefault((doc, node), (called[at] if called else None, at + 1))
        if ids:
            own.setdefault((doc, ids[-1]), r)
    node_v = {}
    for key, (name, _) in names.items():
        v = own[key][7] if key in own else None
        node_v[key] = v if v is not None else lookup.get(name)
    out = {}
    for (doc, node), (items, below, bearing) in groups.items():
        keyed = []
        for r in items.values():
            if r[6] is not None:
                v = np.array(r[6], np.float32).astype(float)
                length = np.linalg.norm(v)
                keyed.append((v / length if length else v) * (-1 if r[5] else 1))
        keyed = np.array(keyed)
        away = int((((keyed.sum(axis=0) - keyed) * keyed).sum(axis=1) < 0).sum()) if len(keyed) > 1 else 0
        labels = [node_v[doc, x] for x in (bearing if node is None else below) if node_v[doc, x] is not None] + ([first[doc][8]] if first[doc][8] is not None else [])
        flags = [r[9] for r in items.values() if r[9] is not None]
        mine = own.get((doc, node), first[doc])
        out[doc, node] = {
            "is_instrument": node is None, "name": names.get((doc, node), (None,))[0], "depth": names.get((doc, node), (None, None))[1], "n_items": len(items), "n_scales": len(below),
            "flag": any(flags) if flags else None, "item_pooled": keyed.mean(axis=0) if len(keyed) else None, "keying_disagreements": away if len(keyed) else None,
            "scale_pooled": np.mean(np.array(labels, np.float32).astype(float), axis=0) if labels else None, "scale_embedding": None if node is None else node_v[doc, node],
            "instrument_embedding": first[doc][8] if node is None else None, "year": first[doc][10], "version": mine[11],
        }
    return out


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return np.allclose(a, b, atol=1e-6) if isinstance(b, np.ndarray | list) else a == b


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_pass(spark, seed, monkeypatch):
    monkeypatch.setattr(hierarchy, "PARTIAL_ROWS", 7)
    rows = made(150, seed)
    lookup = {f"name {x}": [float(x)] * 4 for x in (1, 5, 6, 8)}
    given = spark.createDataFrame(list(lookup.items()), "name string, vector array<float>")
    out = hierarchy.pool(spark.createDataFrame(rows, KINDS).repartition(4), COLUMNS, given).collect()
    want = plain(rows, lookup)
    assert len(out) == len(want) and {(r.doc, r.node) for r in out} == set(want)
    for r in out:
        for name, value in want[r.doc, r.node].items():
            assert same(r[name], value), (r.doc, r.node, name, r[name], value)


def test_empty_and_without_vectors(spark):
    empty = spark.createDataFrame([], KINDS)
    assert hierarchy.pool(empty, COLUMNS).count() == 0
    bare = hierarchy.Placements(item_vector=None, name_vector=None, title_vector=None)
    out = hierarchy.pool(spark.createDataFrame(made(20, 5), KINDS), bare)
    assert "item_pooled" not in out.columns and out.count() == len(plain(made(20, 5), {}))


def test_sums_of_a_hot_key(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS k", "array(cast(id AS double), 1d) AS v")
    got = {r.k: (r.n, r.sums) for r in hierarchy.vector_sums(df, ["k"], "v").collect()}
    assert got["hot"] == (6667, [float(sum(range(0, 20_000, 3))), 6667.0]) and sum(n for n, _ in got.values()) == 20_000


@pytest.mark.parametrize("name", ["pooled_nodes", "pooled_items", "pooled_labels"])
def test_queries_on_more_rows(spark, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], "/root/testdata/sf0.01") == ""


def test_partial_sums_hold_over_batches(spark, monkeypatch):
    rows = spark.range(9000).select((F.col("id") % 3).alias("k"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")).coalesce(1)
    out = hierarchy.vector_sums(rows, ["k"], "v")
    want = [(k, 3000, [float(sum(range(k, 9000, 3))), 3000.0]) for k in range(3)]
    assert sorted((r.k, r.n, r.sums) for r in out.collect()) == want
    monkeypatch.setattr(hierarchy, "PARTIAL_ROWS", 4)  # keys that don't repeat are sent on
    one = hierarchy.vector_sums(rows.limit(60).withColumn("k", F.col("v")[0].cast("long")), ["k"], "v")
    assert sorted((r.k, r.n) for r in one.collect()) == [(k, 1) for k in range(60)]


@pytest.mark.parametrize("most", [0, 10_000])
def test_vectors_by_reference(spark, monkeypatch, most):
    monkeypatch.setattr(hierarchy, "FIRSTS", most)  # 0: first rows and sums are joined by keys
    monkeypatch.setattr(hierarchy, "SUM_VALUES", most)
    rng = random.Random(8)
    table = {k: [rng.uniform(-1, 1) for _ in range(4)] for k in range(6)}
    rows = [(*r[:6], *(rng.choice([None, 99, *table]) for _ in range(3)), *r[9:]) for r in made(150, 4)]  # 99 is not in the table
    kinds = KINDS.replace("_embedding array<float>", "_embedding long")
    vectors = spark.createDataFrame([*table.items(), (None, [1.0] * 4), (7, None)], "id long, v array<float>")
    names = spark.createDataFrame([("name 1", [2.0] * 4)], "name string, vector array<float>")
    out = hierarchy.pool(spark.createDataFrame(rows, kinds).repartition(3), COLUMNS, names, vectors).collect()
    want = plain([(*r[:6], *(table.get(x) for x in r[6:9]), *r[9:]) for r in rows], {"name 1": [2.0] * 4})
    assert len(out) == len(want) and {(r.doc, r.node) for r in out} == set(want)
    for r in out:
        for name, value in want[r.doc, r.node].items():
            assert same(r[name], value), (r.doc, r.node, name, r[name], value)


def test_rows_move_without_their_vectors(spark, monkeypatch):
    tables = {}
    monkeypatch.setattr(hierarchy, "stored", lambda df, name, f=hierarchy.stored: tables.setdefault(name, f(df, name)))
    many = F.array_repeat((F.col("id") % 3 - 1).cast("float"), 50)
    rows = spark.range(3000).select(F.lit("d").alias("path"), F.col("id").alias("ord"), F.expr("array(1L, 2L + id % 2)").alias("scale_id_path"), F.lit(None).cast("array<string>").alias("scale_name_path"), (F.col("id") % 900).alias("item_item_id"), (F.col("id") % 4 == 0).alias("item_reverse_coded"), many.alias("item_embedding"))
    c = hierarchy.Placements(name_vector=None, title_vector=None)
    out = {r.node: (r.n_items, len(r.item_pooled)) for r in hierarchy.pool(rows, c).collect()}
    assert out == {None: (900, 50), 1: (900, 50), 2: (450, 50), 3: (450, 50)}
    # Three vectors: as many are kept, and a node has a row for each; no row carries one along.
    assert tables["vectors"].count() == 3 and tables["weights"].count() == 12 and tables["paths"].count() == 2
    assert not [f for name in ("weights", "paths", "firsts") for f in tables[name].schema if "float" in f.dataType.simpleString() or "double" in f.dataType.simpleString()]


def test_two_vectors_of_one_hash(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "_hash", lambda vector, seed, f=hierarchy._hash: F.lit(1).cast("long") if seed == 0 else f(vector, seed))
    rows = made(60, 6)
    out = hierarchy.pool(spark.createDataFrame(rows, KINDS), COLUMNS).collect()
    want = plain(rows, {})
    assert len(out) == len(want) and all(same(r[x], want[r.doc, r.node][x]) for r in out for x in ("item_pooled", "scale_pooled", "keying_disagreements"))


def test_placements_hold_no_vectors(spark):
    from folioloom.plans import hierarchies

    assert not [f.name for f in hierarchies.placements(spark, "/root/testdata/sf0.001").schema if "float" in f.dataType.simpleString()]

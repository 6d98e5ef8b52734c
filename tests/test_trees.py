"""Trees of any depth against a plain walk, and declared models."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioloom.functions.model import Field, Model
from folioloom.operators import trees
from folioloom.plans import registry
from harness import differences

ITEM = Model((
    Field("item_id", "bigint", "id"), Field("item_text", "string", "text"), Field("has_image", "boolean", "img", False), Field("item_type", "string", "type", "rating_scale", blank=True),
    Field("options", "array<string>"), Field("language", "string", "lang", "en", blank=True),
))
META = Model((Field("language", "string"), Field("intake_form", "boolean", default=False), Field("pages", "bigint")))


def walk(tree):
    def node(n, ids, names):
        ids, names = [*ids, n.get("id")], [*names, n.get("scale_name")]
        for x in n.get("items") or []:
            yield "scaled", n.get("id"), len(ids), ids, names, x
        for sub in n.get("subscales") or []:
            yield from node(sub, ids, names)

    for top in tree.get("scales") or []:
        yield from node(top, [], [])
    for bucket in ("orphan", "unscaled"):
        for x in tree.get(f"{bucket}_items") or []:
            yield bucket, None, None, None, None, x


def resolved(x):
    return (x.get("id"), x.get("text"), bool(x.get("img")), x.get("type") or "rating_scale", x.get("options"), x.get("lang") or "en")


def made(rng, depth):
    item = lambda: {k: v for k, v in {"id": rng.randrange(99), "text": rng.choice(["q", "", None]), "img": rng.choice([True, False, None]), "type": rng.choice(["open", "", None]), "options": rng.choice([["a", "b"], [], None]), "lang": rng.choice(["de", None])}.items() if rng.random() < 0.7}

    def node(left):
        out = {"id": rng.randrange(1000), "scale_name": rng.choice(["n", None]), "items": [item() for _ in range(rng.randrange(3))]}
        if left > 1:
            out["subscales"] = [node(left - 1) for _ in range(rng.randrange(1, 3) if left > depth - 2 else 1)]
        elif rng.random() < 0.5:
            out["subscales"] = rng.choice([[], None])
        return out

    return {"scales": [node(depth)], "orphan_items": [item()], "meta": rng.choice([None, {"pages": 3}, {"language": "fr", "intake_form": True}])}


@pytest.mark.parametrize("depth", [1, 3, 9, 12])
def test_any_depth(spark, depth):
    rng = random.Random(depth)
    docs = {i: made(rng, rng.randint(1, depth) if i else depth) for i in range(8)}
    rows = [(i, json.dumps(t)) for i, t in docs.items()] + [(90, None), (91, "{}"), (92, '{"scales": null, "unscaled_items": [{}]}'), (93, "no json")]
    df = spark.createDataFrame(rows, "doc long, tree string").repartition(2)
    assert trees.tree_depth(df, "tree") == depth
    got = {}
    for r in trees.explode_trees(df, "doc", "tree", ITEM).orderBy("doc", "ord").collect():
        got.setdefault(r.doc, []).append((r.bucket, r.scale_id, r.scale_depth, r.scale_id_path, r.scale_name_path, tuple(r["item"]) if r["item"] else None))
    want = {i: [(*p[:5], resolved(p[5])) for p in walk(t)] for i, t in docs.items()} | {90: [(None,) * 6], 92: [("unscaled", None, None, None, None, resolved({}))]}
    assert got == {k: v for k, v in want.items() if v}


def test_columns_are_those_of_the_models(spark):
    rows = [("a", "x", "{}", json.dumps({"scales": [{"id": 1, "items": [{"id": 5}]}], "meta": {"pages": 2}})), ("b", "y", None, None)]
    docs = spark.createDataFrame(rows, "path string, note string, items_extractor_content string, output string")
    out = trees.explode_extractions(docs, "output", ITEM, META)
    assert out.columns == ["path", "note", "bucket", *trees.SCALE_COLUMNS, "meta_language", "meta_intake_form", "meta_pages", *(f"item_{f.name}" for f in ITEM.fields), "ord"]
    assert dict(out.dtypes)["item_options"] == "array<string>" and dict(out.dtypes)["meta_language"] == "string"
    a, b = out.orderBy("path").collect()
    assert (a.meta_pages, a.meta_intake_form, a.item_item_id, a.item_item_type, a.scale_id_path) == (2, False, 5, "rating_scale", [1])
    assert b.path == "b" and b.note == "y" and b.bucket is None and b.meta_intake_form is None and b.item_has_image is None
    assert trees.explode_extractions(docs.limit(0), "output", ITEM, META).schema == out.schema


def test_models(spark):
    full = '{"id": 1, "text": "t", "img": true, "type": "open", "options": ["o"], "lang": "de"}'
    df = spark.createDataFrame([(full,), ("{}",), (None,)], "j string").select(F.from_json("j", ITEM.wire_schema()).alias("r"))
    assert [r[0] and tuple(r[0]) for r in df.select(ITEM.resolved(F.col("r"))).collect()] == [(1, "t", True, "open", ["o"], "de"), (None, None, False, "rating_scale", None, "en"), None]
    needed = Model((Field("a", "string", required=True), Field("b", "bigint")))
    df = spark.createDataFrame([("{}",), ('{"a": "x"}',)], "j string").select(F.from_json("j", needed.wire_schema()).alias("r"))
    assert [r[0] for r in df.select(needed.incomplete(F.col("r"))).collect()] == [["a"], []]
    with pytest.raises(ValueError):
        Model((Field("a", "string"), Field("b", "string", "a")))


def test_written_out_schemas():
    schema = Model((Field("id", "bigint", required=True), Field("tags", "array<string>"))).json_schema("subscales", 3)
    levels = 0
    while schema.get("properties"):
        assert schema["required"] == ["id"] and schema["properties"]["tags"] == {"type": "array", "items": {"type": "string"}}
        schema, levels = schema["properties"]["subscales"]["items"], levels + 1
    assert levels == 3 and schema == {"type": "null"}


def test_query_of_nine_levels(spark):
    sf = "/root/testdata/sf0.1"
    assert differences(spark, registry.QUERIES["explode_deep"], registry.ORACLE_SQL["explode_deep"], sf) == ""
    assert registry.QUERIES["explode_deep"](spark, sf).agg(F.max("scale_depth")).first()[0] == 9

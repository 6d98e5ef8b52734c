"""Rendering, the report, configuration and fixtures."""

import pytest

from folioloom.operators import matching, render
from folioloom.plans import reports
from folioloom.sources import config


def test_render():
    assert [render.number(x) for x in (None, 1234, 1.5, 2.0, True, "a|b", float("nan"))] == ["n/a", "1,234", "1.50", "2", "yes", "a|b", "n/a"]
    assert render.markdown_table(["a"], [["x|y"]]) == ["| a |", "|-|", "| x\\|y |"]
    assert render.flattened({"a": {"b": 1, "c": {"d": 2}}}) == [("a.b", 1), ("a.c.d", 2)]
    tree = [{"id": 1, "scale_name": "A", "subscales": [{"id": 2, "scale_name": "B"}]}]
    assert render.node_names(tree) == ["A", "B"] and render.node_count(tree) == 2
    assert render.tree_lines(tree, ids=True) == ["- [1] A", "  - [2] B"]
    assert render.mark_grid([{1: {(1, False)}, 2: {(1, True)}}, {1: {(1, False)}}]) == ["1: ✓ ✓", "2: R - *"]


def test_report(spark):
    rows = [("s", "a", 1, 10, [1, 10], "scaled", "en"), ("s", "a", 2, None, None, "orphan", "en"), ("t", "b", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "corpus_source string, path string, item_item_id long, scale_id long, scale_id_path array<long>, bucket string, item_language string")
    text = reports.describe(df, {"filter": {"x": 3}})
    assert [x for x in text if x.startswith("##")] == ["## Structure", "## Items per document", "## Nesting", "## Buckets", "## Languages", "## Counters"]
    assert "| (all) | 2 | 3 | 2 | 2 | 1 | 2 |" in text and "| filter.x | 3 |" in text
    assert reports.describe(df.select("corpus_source", "bucket"))[0] == "## Buckets"


def test_configuration(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("options: {a: 1, b: 2}\nllm:\n  extractors:\n    items: {options: {b: 3, a: null}}\n")
    loaded = config.load_config(str(tmp_path / "c.yaml"))
    assert config.options_for(loaded, "items") == {"b": 3} and config.options_for(loaded, "scales") == {"a": 1, "b": 2}
    for name in ("x.pdf", "x (2).pdf", "y (3).pdf", "z.txt"):
        (tmp_path / name).write_text("")
    assert [p.rsplit("/", 1)[1] for p in config.expand_inputs([str(tmp_path), str(tmp_path / "*.pdf")])] == ["x.pdf", "y (3).pdf"]
    assert config.shard_of(["c", "a", "b"], 1, 2) == ["b"]
    assert config.log_sections("x\n=== One ===\na\nb\n== Two ==\nc") == {"One": ["a", "b"], "Two": ["c"]}


def test_fixtures(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "f.yaml").write_text("title: !contains worry\nscales: !extras=0\n  - scale_name: Worry\n    items: [{item_text: I worry}, {item_text: !anywhere I sleep}]\n    subscales: [{scale_name: Sub, items: [{item_text: I worry}]}]\n")
    tree = config.load_fixture(str(tmp_path / "f.yaml"))
    plain = config.numbered(tree)
    assert plain["title"] == "worry" and plain["scales"][0]["id"] == 1 and plain["scales"][0]["subscales"][0]["id"] == 2
    assert [i["item_id"] for i in plain["scales"][0]["items"]] == [1, 2] and plain["scales"][0]["subscales"][0]["items"][0]["item_id"] == 1
    actual = {"title": "The Worry Scale", "scales": [{"scale_name": "Worry", "items": [{"item_text": "I worry"}], "subscales": [{"scale_name": "Sub", "items": [{"item_text": "I worry"}, {"item_text": "I sleep"}]}]}]}
    assert matching.compare(tree, actual) == []
    actual["scales"].append({"scale_name": "More"})
    assert [x[1] for x in matching.compare(tree, actual)] == ["warning"]


def test_quantiles_between_two_values_round_as_in_sql(spark):
    from folioloom.operators import report

    rows = [("a", 14.24), ("a", 14.26), ("a", None), (None, 1.0), (None, 1.0), ("e", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(3)
    got = {r.k: (r.n, r.q1, r.median, r.q3, r.p95) for r in report.distribution(df, "x", ["k"]).collect()}
    low, high = 14.24, 14.26
    assert got == {"a": (2, *(low + (high - low) * q for q in report.QUANTILES)), None: (2, 1.0, 1.0, 1.0, 1.0), "e": (0, None, None, None, None)}
    assert got["a"][1] > 14.245

"""Operators and functions on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from folioloom.functions import biblio, language, text, vectors
from folioloom.operators import curation, matching, pooling, report, search, statistics, trees, versions
from folioloom.sources import readers, release


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "want"),
    [("10.1207/s15327752jpa5401&2_19", "10.1207/s15327752jpa5401&2_19"), ("10.1016/0191-8869(85)90007-0", "10.1016/0191-8869(85)90007-0"), ("10.3389/fpsyg.2020.1/full", "10.3389/fpsyg.2020.1"), ("10.1/A).,", "10.1/a")],
)
def test_clean_doi(spark, value, want):
    assert one(spark, value, biblio.clean_doi) == want


def test_dois_in_text(spark):
    assert one(spark, "see 10.1037/t12345-000 and 10.1000/x­y‐z© 2000", biblio.doi_in_text) == "10.1000/xy-z"
    assert one(spark, "none here", biblio.doi_in_text) is None and one(spark, None, biblio.doi_in_text) is None
    assert one(spark, "DOI: https://doi.org/10.1037/T01234-000", biblio.record_doi_on_page) == "10.1037/t01234-000"


@pytest.mark.parametrize(
    ("value", "want"),
    [("the scale of UCLA self-report", "The Scale of UCLA Self-Report"), ("a: the end", "A: The End"), ("finger-to-nose test", "Finger-to-Nose Test"), ("Scale And Of", "Scale and Of"), ("", ""), ("(the) mcX", "(The) mcX")],
)
def test_title_case(spark, value, want):
    assert one(spark, value, text.title_case) == want


def test_text_functions(spark):
    assert one(spark, " a \t b ", text.collapsed) == "a b"
    assert one(spark, "1. ab", text.without_number) == "1. ab" and one(spark, "1. abc", text.without_number) == "abc"
    assert one(spark, ',"x ""y""', text.split_cell_repair) == 'x "y"'
    assert one(spark, "Straße", text.folded) == "strasse"
    assert one(spark, "&amp;amp;lt;", text.core_entities) == "<"
    assert one(spark, "pt-BR", language.language_code) == "pt" and one(spark, "Klingon", language.language_code) is None
    assert one(spark, "Doe | J. | University of X | Roe", biblio.pipe_authors) == "Doe, J., & Roe"
    assert one(spark, "Smith, A. (20(2)) x", biblio.public_year) is None and one(spark, "(85) (1999)", biblio.public_year) == 1999


@pytest.mark.parametrize(
    ("value", "want"),
    [("X Scale--Short Form", ("X Scale", "Short Form")), ("X Scale (Revised)", ("X Scale", "Revised")), ("DSM–IV", ("DSM–IV", None)), ("Survey--X Behavior Scale Revised", ("Survey--X Behavior Scale Revised", None)), ("Xyz - Child Version (Form A)", ("Xyz", "Child Version; Form A")), ("X (Revised)", ("X (Revised)", None)), (None, (None, None)), ("X Scale, 2nd Edition", ("X Scale", "2nd Edition"))],
)
def test_versions(spark, value, want):
    assert tuple(one(spark, value, versions.split_version)) == want


def test_relocate_keeps_an_occupied_version(spark):
    df = spark.createDataFrame([("Xyz (Revised)", None), ("Xyz (Revised)", "other"), ("Xyz (Revised)", "revised form")], "n string, v string")
    assert sorted((r.n, r.v) for r in versions.relocate(df, "n", "v").collect()) == [("Xyz", "Revised"), ("Xyz", "revised form"), ("Xyz (Revised)", "other")]


def test_name_path_keeps_a_qualifier_that_not_all_rows_record(spark):
    rows = [("d", 1, "A", [9, 1], ["Umb (Revised)", "A"], "revised"), ("d", 2, "B", [9, 2], ["Umb (Revised)", "B"], None)]
    df = spark.createDataFrame(rows, "doc string, node long, name string, ids array<long>, names array<string>, version string")
    run = lambda d: sorted(tuple(r.names) for r in versions.node_names(d, "doc", "node", "name", "ids", "names", "version").collect())
    assert run(df) == [("Umb (Revised)", "A"), ("Umb (Revised)", "B")]
    assert run(df.where("node = 1")) == [("Umb", "A")]


def test_filters(spark):
    rows = [(None, "x" * 250, True), ("scaled", " " + "x" * 250 + " ", None), ("scaled", "x" * 251, None), ("scaled", None, None)]
    df = spark.createDataFrame(rows, "bucket string, item_item_text string, has_errors boolean")
    filters = curation.source_filters(df.columns)
    assert list(filters) == ["extraction_error", "null_bucket", "empty_item_text", "long_item_text", "unscaled_bucket"]
    got = [(r.isolated, r.new, r.cumulative) for r in curation.attrition(df, filters).orderBy("step").collect()]
    assert got == [(1, 1, 1), (1, 0, 1), (1, 1, 2), (1, 1, 3), (0, 0, 3)]
    assert curation.surviving(df, filters).count() == 1


def test_intake_form_counts_an_untagged_frame_as_main_source(spark):
    df = spark.createDataFrame([(None,), (False,)], "meta_intake_form boolean")
    assert curation.surviving(df, curation.source_filters(df.columns)).count() == 1


def test_three_valued_flags(spark):
    rows = [(0.05, True), (0.051, True), (None, True), (float("nan"), True), (0.9, False), (0.9, None)]
    df = spark.createDataFrame(rows, "d double, ok boolean")
    assert [r[0] for r in df.select(curation.text_deviates(F.col("d"), F.col("ok"))).collect()] == [False, True, None, None, None, True]
    langs = spark.createDataFrame([("en",), ("EN ",), ("de",), (None,), ("",)], "l string")
    assert [r[0] for r in langs.select(curation.translated(F.col("l"))).collect()] == [False, False, True, None, None]
    shapes = spark.createDataFrame([(300, 3, 6), (3000, 3, 6), (300, 3, 4), (100, 1, 0), (None, 3, 6)], "c int, p int, i int")
    assert [r[0] for r in shapes.select(curation.checkable(F.col("c"), F.col("p"), F.col("i"))).collect()] == [False, True, True, False, None]


def test_copies_go_only_with_their_original(spark):
    df = spark.createDataFrame([("/a/x (2).pdf",), ("/a/x.pdf",), ("/a/y (3).pdf",), (None,)], "path string")
    assert {r.path for r in curation.without_copies(df, "path").collect()} == {"/a/x.pdf", "/a/y (3).pdf", None}


def test_renumbering(spark):
    rows = [("d", 1, 1, 0), ("d", 2, 1, 1), ("d", 1, 2, 2), ("d", 2, 2, 3), ("d", 1, 1, 4), ("e", 7, 1, 5)]
    df = spark.createDataFrame(rows, "doc string, id long, cluster long, ord long")
    assert [r.new_id for r in curation.renumbered(df, "doc", "id", "cluster", "ord").orderBy("ord").collect()] == [1, 2, 3, 4, 1, 7]


def test_repairs_are_idempotent(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, "b", "y"), (2, "b", "z"), (2, "b", None)], "k long, s string, v string")
    once = curation.propagate(df, "k", "v")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, curation.propagate(once, "k", "v").collect()), key=str)
    assert once.where("v is null").count() == 1


def test_keyed_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0], False), (1, [0.0, 1.0], None), (2, [1.0, 0.0], False), (2, [-1.0, 0.0], False), (3, [0.0, 0.0], True), (4, None, None)], "g long, v array<float>, r boolean")
    got = {r.g: list(r.centroid) for r in pooling.keyed_centroid(df, ["g"], "v", F.col("r")).collect()}
    assert got[1] == [0.5, 0.5] and got[2] == [0.0, 0.0] and 4 not in got
    away = {r.g: (r.n_items, r.n_disagree) for r in pooling.keying_disagreement(df, ["g"], "v", F.col("r")).collect()}
    assert away == {1: (2, 0), 2: (2, 2), 3: (1, 0)}


def test_pooling_over_a_hierarchy(spark):
    rows = [("d", [1, 10], 1, 0, False), ("d", [1, 11], 1, 1, None), ("d", None, 1, 2, None), ("d", [1, 11], None, 3, None), ("d", [1, 11], None, 4, None), (None, None, 5, 5, None)]
    df = spark.createDataFrame(rows, "doc string, path array<long>, item long, ord long, flag boolean")
    got = {(r.doc, r.node): (r.depth, r.n_items, r.n_scales, r.flag) for r in pooling.pooled(df, "doc", "path", "item", ["ord"], ["flag"]).collect()}
    assert got[("d", 1)] == (1, 3, 3, False) and got[("d", 10)] == (2, 1, 1, False) and got[("d", 11)] == (2, 3, 1, None)
    assert got[("d", None)] == (None, 3, 3, False) and got[(None, None)] == (None, 1, 0, None)


def test_ranking(spark):
    df = spark.createDataFrame([("a", [0.9, 0.4359]), ("b", [-0.95, 0.3122]), ("c", [0.2, 0.9798]), ("d", None), ("e", [0.0, 0.0])], "n string, v array<double>")
    query = vectors.literal_vector([1.0, 0.0])
    assert [r.n for r in search.top_k(df, "v", query, 4, tie=["n"]).collect()] == ["a", "c", "e", "b"]
    assert [r.n for r in search.top_k(df, "v", query, 2, True, ["n"]).collect()] == ["b", "a"]


def test_trees_explode_and_refuse_depth(spark):
    leaf = '{"id": 3, "scale_name": "s", "items": [{"item_id": 4, "item_text": "q"}], "subscales": []}'
    tree = '{"scales": [{"id": 1, "scale_name": "top", "items": [{"item_id": 1}], "subscales": [%s]}], "orphan_items": [{"item_id": 8}], "unscaled_items": [{"item_id": 9}]}' % leaf
    df = spark.createDataFrame([("a", tree), ("b", None)], "doc string, tree string")
    rows = trees.explode_trees(df, "doc", "tree", "item_id bigint, item_text string", depth=2).orderBy("doc", "ord").collect()
    assert [(r.doc, r.bucket, r.scale_id, r.scale_depth, r["item"] and r["item"].item_id) for r in rows] == [("a", "scaled", 1, 1, 1), ("a", "scaled", 3, 2, 4), ("a", "orphan", None, None, 8), ("a", "unscaled", None, None, 9), ("b", None, None, None, None)]
    with pytest.raises(Exception, match="deeper"):
        trees.explode_trees(df, "doc", "tree", "item_id bigint", depth=1).collect()


def test_distances():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert matching.lcs_length(a, b) == table[-1][-1]
    assert matching.partial_distance("abc", "xxabcxx") == (0, 0.0) and matching.partial_distance("", "x") is None
    assert matching.partial_distance("abcd", "xxabzdxx") == (1, 0.25)
    assert matching.levenshtein("kitten", "sitting") == 3


def test_assignment_is_optimal():
    from itertools import permutations

    rng = random.Random(5)
    for _ in range(60):
        n, m = rng.randint(1, 5), rng.randint(1, 5)
        score = [[rng.random() for _ in range(m)] for _ in range(n)]
        best = max(sum(score[i][p[i]] for i in range(n) if p[i] < m) for p in permutations(range(max(n, m)), n))
        assert abs(sum(score[i][j] for i, j in matching.assignment(score)) - best) < 1e-9


def test_tree_similarity_and_comparator():
    a = [{"name": "Worry", "children": [{"name": "Mind"}, {"name": "Body"}]}]
    assert matching.tree_similarity(a, a) == 1 and matching.tree_similarity([], []) == 1 and matching.tree_similarity(a, []) == 0
    actual = {"title": "The Worry Scale", "scales": [{"scale_name": "Worry", "items": [{"item_text": "I worry"}, {"item_text": "I sleep"}]}]}
    fine = {"title": matching.Tag("worry", "contains"), "scales": [{"scale_name": "Worri", "items": [{"item_text": "I worry"}]}]}
    assert matching.compare(fine, actual) == []
    strict = {"title": matching.Tag("worry", "exact"), "scales": [{"scale_name": "Worry", "items": matching.Tag([{"item_text": "I worry"}], extras=0)}, {"scale_name": "Joy"}]}
    assert sorted(x[0] for x in matching.compare(strict, actual)) == ["$.scales[0].items", "$.scales[1]", "$.title"]
    assert matching.compare({"x": matching.Tag("I sleep", "anywhere")}, actual) == []


def test_renumbering_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(curation, "ROWS_A_TASK", 50)
    rows = [(d, i, c) for d in range(60) for i in (1, 2, None) for c in ((1, None, 2) if d % 2 else (1, 1, 1))]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc long, id long, cluster long, ord long")
    out = curation.renumbered(df, "doc", "id", "cluster", "ord")
    assert out.rdd.getNumPartitions() == 11  # 540 rows
    got = [(r.id, r.cluster, r.new_id) for r in out.where("doc = 1").orderBy("ord").collect()]
    assert got == [(1, 1, 1), (1, None, None), (1, 2, 3), (2, 1, 4), (2, None, None), (2, 2, 6), (None, 1, None), (None, None, None), (None, 2, None)]
    assert all(r.new_id == r.id for r in out.where("doc = 2").collect())


def test_rows_that_are_no_copies_stay_apart(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 400, 1, 4).selectExpr("concat('/a/', id, '.pdf') path")
        assert curation.without_copies(df, "path").select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_structure_counts_multiply_no_rows_by_their_counts(spark, capsys):
    rows = [("x", "d", 1, 5, [7, None]), ("x", "d", None, 5, None), ("y", "d", 1, None, [7]), ("y", None, 1, 5, [7]), (None, "e", 2, 6, [])]
    out = report.structure_counts(spark.createDataFrame(rows, "src string, d string, i long, s long, p array<long>"), "src", "d", "i", "s", "p")
    got = {r.source: (r.documents, r.rows, r.placements, r["items"], r.bearing_scales, r.nodes) for r in out.collect()}
    assert got == {"x": (1, 2, 1, 1, 1, 1), "y": (1, 2, 2, 2, 1, 1), None: (1, 1, 1, 1, 1, 0), "(all)": (2, 5, 4, 3, 3, 1)}
    out.explain()
    assert "Expand" not in capsys.readouterr().out


def test_clusters(spark):
    df = spark.createDataFrame([("d", 1, "I feel calm today", 0), ("d", 1, "I feel calm today.", 1), ("d", 1, "Something else", 2), ("d", 1, None, 3), ("d", 2, "one", 4)], "doc string, id long, t string, ord long")
    assert [r.cluster for r in matching.clustered(df, ["doc", "id"], "t", "ord").orderBy("ord").collect()] == [1, 1, 2, 0, 1]


def test_greedy_keep_follows_direct_pairs_only(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    assert [tuple(r) for r in matching.greedy_keep(pairs).collect()] == [("b", "a")]
    rank = spark.createDataFrame([("a", 5), ("b", 1), ("c", 5)], "id string, rank int")
    assert sorted(map(tuple, matching.greedy_keep(pairs, rank).collect())) == [("a", "b"), ("c", "b")]
    assert matching.greedy_keep(pairs.limit(0)).count() == 0


def test_greedy_keep_is_the_sequential_rule(spark):
    rng = random.Random(7)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(70)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for r in sorted(near):
        if r not in want:
            want.update({o: r for o in near[r] if o > r and o not in want})
    assert dict(map(tuple, matching.greedy_keep(spark.createDataFrame(sorted(pairs), "a long, b long")).collect())) == want


def test_statistics(spark):
    same = spark.createDataFrame([(u, r, "x") for u in range(4) for r in range(3)], "u long, r long, v string")
    assert statistics.alpha_nominal(same, "u", "v").first().alpha == 1
    mixed = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b")], "u long, v string")
    assert abs(statistics.alpha_nominal(mixed, "u", "v").first().alpha - (1 - 2 * 5 / 18)) < 1e-9
    low, high = spark.range(1).select(statistics.wilson(F.lit(8), F.lit(10)).alias("w")).first().w
    assert abs(low - 0.490162) < 1e-5 and abs(high - 0.943318) < 1e-5


def test_report_counts(spark):
    rows = [("a", "d1", 1, 10, [1, 10]), ("a", "d1", 2, 11, [1, 11]), ("a", "d1", 2, None, None), ("b", "d2", 1, 5, [5]), ("b", "d2", 1, None, None)]
    df = spark.createDataFrame(rows, "src string, d string, i long, s long, p array<long>")
    total = {r.source: r for r in report.structure_counts(df, "src", "d", "i", "s", "p").collect()}["(all)"]
    assert (total.documents, total.rows, total.placements, total["items"], total.bearing_scales, total.nodes) == (2, 5, 5, 3, 3, 4)
    quartiles = report.distribution(spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "x long"), "x").first()
    assert (quartiles.q1, quartiles.median, quartiles.q3) == (1.75, 2.5, 3.25) and abs(quartiles.p95 - 3.85) < 1e-9 and round(quartiles.sd, 3) == 1.291


def test_store_and_readers(spark, tmp_path):
    schema = spark.createDataFrame([], "path string, items_content string, items_error string, items_attempts int").schema
    store = readers.open_store(spark, str(tmp_path / "none"), schema)
    assert store.count() == 0
    first = spark.createDataFrame([("a", "{}", None, 1), ("b", None, "boom", 3), ("c", None, "boom", 1)], schema)
    states = {r.path: (r.state, r.run) for r in readers.cell_states(readers.upsert(store, first, "path"), "path", ["items"]).collect()}
    assert states == {"a": ("done", False), "b": ("failed", False), "c": ("failed", True)}
    again = readers.upsert(first, spark.createDataFrame([("c", "{}")], "path string, items_content string"), "path")
    assert {r.path: (r.items_content, r.items_error) for r in again.collect()}["c"] == ("{}", "boom")
    readers.write_corpus(first, str(tmp_path / "out"))
    assert dict(spark.read.parquet(str(tmp_path / "out")).dtypes)["items_attempts"] == "bigint"
    assert readers.read_columns(spark, str(tmp_path / "out"), ["path", "absent"]).columns == ["path"]
    assert readers.source_of("/x/exploded_hunt.parquet") == "hunt"
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_bytes(b'Scale,I feel "so\r\r\nso" well,"Smith, A. (1999). T";;\r\r\nOther,item,http://x.org/a\r\r\n')
    assert {(r.name, r.item) for r in readers.read_broken_csv(spark, str(tmp_path / "csv")).collect()} == {("Scale", 'I feel "so so" well'), ("Other", "item")}
    (tmp_path / "ref.json").write_text('[{"DOI": "10.1/A", "n": 3}, {"DOI": "10.1/a", "n": 4}, {"DOI": null, "n": 1}, {"DOI": "10.1/b", "n": "x"}]')
    assert {r.DOI: r.n for r in readers.read_reference(spark, str(tmp_path / "ref.json"), "DOI", ["n"]).collect()} == {"10.1/a": 3, "10.1/b": None}
    (tmp_path / "files.json").write_text('[{"doi": "d1", "files": {"a": ["/x/p.pdf", {"b": "q.txt"}]}}, {"doi": "d2", "files": {"a": ["y/p.pdf"]}}]')
    assert {r.file: r.doi for r in readers.file_identifiers(spark, str(tmp_path / "files.json"), "doi", "files").collect()} == {"p.pdf": "d2"}


def test_release_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.delenv(release.ENV_KEY, raising=False)
    key, origin = release.resolve_key(str(tmp_path / "keys" / "k"), create=True)
    assert origin == "created" and release.resolve_key(str(tmp_path / "keys" / "k"))[0] == key
    df = spark.createDataFrame([(1, None, [1.0, 2.0], True), (2, "x", None, None)], "id long, t string, v array<float>, f boolean")
    payload = release.write_release(df, str(tmp_path / "r"), key)
    assert payload["rows"] == 2 and {c["column"]: c["nulls"] for c in payload["columns"]} == {"id": 0, "t": 1, "v": 1, "f": 1}
    back = release.read_release(spark, str(tmp_path / "r"), key)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert release.read_release(spark, str(tmp_path / "r"), key, ["t"]).columns == ["t"]
    with pytest.raises(ValueError):
        release.read_release(spark, str(tmp_path / "r"), b"0" * 32)
    assert release.upload_refusals(str(tmp_path / "r"), key, payload, False, False) == ["the target is public", "the target has this content", "not confirmed"]
    assert release.upload_refusals(str(tmp_path / "r"), key, None, True, True) == []
    with pytest.raises(ValueError):
        release.project(df, ["absent"], ["v"])


def test_matched_items(spark):
    a = spark.createDataFrame([("d", 1, "I worry a lot"), ("d", 2, "I sleep well"), ("e", 1, "alone"), ("d", 3, None)], "doc string, item long, text string")
    b = spark.createDataFrame([("d", 7, "I sleep well."), ("d", 8, "At work I worry a lot these days"), ("d", 9, "other")], "doc string, item long, text string")
    assert sorted((r.a, r.b) for r in matching.matched_items(a, b, "doc", "item", "text").collect()) == [(1, 8), (2, 7)]


def test_tree_frames(spark):
    rows = [(1, 0, '[{"name": "a"}]'), (1, 1, '[{"name": "a"}]'), (1, 2, "[]")]
    df = spark.createDataFrame(rows, "doc long, run long, tree string")
    assert sorted(r.similarity for r in matching.tree_agreement(df, "doc", "run", "tree").collect()) == [0.0, 0.0, 1.0]
    pair = spark.createDataFrame([(1, '{"scales": [{"scale_name": "Worry"}]}', None), (2, None, "{}")], "k long, e string, a string")
    assert [(r.k, r.message) for r in matching.compared_trees(pair, "k", "e", "a").collect()] == [(1, "missing node")]

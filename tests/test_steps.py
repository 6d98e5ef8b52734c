"""The build's steps one by one on small frames with their traps."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioloom.plans import assemble
from folioloom.plans.assemble import Context

MAIN = "apa-psyctests"


def run(spark, step, kinds, rows, **context):
    df = spark.createDataFrame(rows, kinds)
    ctx = Context(**context)
    out = {**assemble.PATCH, **assemble.POSTPROCESS}[step](df, ctx)
    return sorted((r.asDict() for r in out.collect()), key=lambda r: r["n"]), ctx


def test_schema(spark):
    rows, ctx = run(spark, "schema", "n int, item_item_text string, item_item_id double, scale_id double, meta_doi_raw double", [(1, " \t ", 1.0, 1.5, None), (2, "x", None, 2.0, None)])
    assert [r["item_item_text"] for r in rows] == [None, "x"] and rows[0]["item_item_id"] == 1 and isinstance(rows[0]["item_item_id"], int)
    assert rows[0]["scale_id"] == 1.5 and rows[0]["meta_source_doi"] is None and ctx.stats["schema.blank_cells"] == 1


def test_text_repair(spark):
    kinds = "n int, corpus_source string, item_item_text string, version_attached string, meta_source_raw string, source_url string, retrieval_notes string, item_admin_note string, scale_name_path array<string>"
    rows, _ = run(spark, "text_repair", kinds, [
        (1, "semanticnet", "Item 3 statement group", "none", "self?report¶", "self?report¶", "a &amp;amp; b", "x\\ny", ["A", " N/A ", " "]),
        (2, MAIN, "Item 3 statement group", "v", "SUPPLIED by  author", None, "a &amp;amp; b", None, None),
        (3, "aligns", "UNKNOWN", None, "(replace with real citation)", None, None, None, []),
    ])
    a, b, c = rows
    assert (a["item_item_text"], a["version_attached"], a["meta_source_raw"], a["source_url"]) == (None, None, "self-report", "self-report")
    assert (a["retrieval_notes"], a["item_admin_note"], a["scale_name_path"]) == ("a & b", "x\ny", ["A", None, None])
    assert (b["item_item_text"], b["retrieval_notes"]) == ("Item 3 statement group", "a &amp;amp; b")
    assert c["item_item_text"] is None and c["meta_source_raw"] is None


def test_pages_and_record_identifiers(spark):
    pages = spark.createDataFrame([("/p/999912345.pdf", "DOI: https://doi.org/10.1037/t12345-000 from 10.1000/abc", "body text")], "path string, first_page string, body string")
    files = spark.createDataFrame([("999912345.pdf", "10.1037/T12345-000"), ("999900001.pdf", "10.1037/t99999-000")], "file string, doi string")
    kinds = "n int, corpus_source string, path string, meta_doi_raw string, meta_source_doi string, doi string"
    data = [(1, MAIN, "/p/999912345.pdf", None, "old", "x"), (2, MAIN, "/p/999900001.pdf", "10.1037/t00001-000", None, "x"), (3, "aligns", "/q/999954321.pdf", None, "kept", "x"), (4, "aligns", None, None, None, "x")]
    rows, _ = run(spark, "meta_dois", kinds, data, pages=pages)
    assert [(r["meta_doi_raw"], r["meta_source_doi"]) for r in rows] == [("10.1037/t12345-000", "10.1000/abc"), ("10.1037/t00001-000", None), (None, "kept"), (None, None)]
    rows, _ = run(spark, "pdf_full_text", kinds, data, pages=pages)
    assert [r["pdf_full_text"] for r in rows] == ["body text", None, None, None]
    rows, ctx = run(spark, "doi_psyctests", kinds, data, record_files=files)
    assert [r["doi_psyctests"] for r in rows] == ["10.1037/t12345-000", None, "10.1037/t54321-000", None]
    assert "doi" not in rows[0] and ctx.stats["doi_psyctests.resolved"] == 2


def test_source_fields(spark):
    kinds = "n int, corpus_source string, meta_source_raw string, source_url string, retrieval_notes string"
    cite = "Smith, A. (2004). A title that is long enough. Journal."
    rows, ctx = run(spark, "source_fields", kinds, [
        (1, "aligns", "https://a.org/x", "https://a.org/x", None), (2, "aligns", cite, cite, None), (3, "aligns", "www.a.org", None, "old"),
        (4, "aligns", "hm", "hm", None), (5, "aligns", "hm", "https://b.org", None), (6, MAIN, "hm", None, None),
    ])
    assert [(r["meta_source_raw"], r["source_url"]) for r in rows] == [(None, "https://a.org/x"), (cite, None), (None, "https://www.a.org"), (None, None), ("hm", "https://b.org"), ("hm", None)]
    assert rows[2]["retrieval_notes"] == "old; source_url normalized from 'www.a.org' [patch]"
    assert [ctx.stats[f"source_fields.{k}"] for k in ("citation", "url", "domain", "junk")] == [1, 1, 1, 1]


def test_source_doi_lookups_and_proposals(spark):
    rows, _ = run(spark, "source_doi", "n int, meta_source_raw string, source_url string, meta_source_doi string", [(1, "see 10.1000/abc.", None, None), (2, None, "https://x.org/10.1000%2Fq/full", None), (3, "10.1000/abc", None, "10.9/kept")])
    assert [r["meta_source_doi"] for r in rows] == ["10.1000/abc", "10.1000/q", "10.9/kept"]
    verdicts = spark.createDataFrame([("c", "10.5/c", "Doe, J.", 1999, "J"), ("b", "10.5/b", None, None, None), ("d", None, "X", 1, "Y")], "doc string, doi string, authors string, year int, venue string")
    kinds = "n int, corpus_source string, path string, meta_source_doi string, meta_authors_raw string, meta_publication_year_raw long"
    data = [(1, "s", "a", "10.1/a", None, None), (2, "s", "a", None, None, None), (3, "s", "b", "10.1/x", None, None), (4, "s", "b", "10.1/y", None, None), (5, "s", "b", None, None, None), (6, "s", "c", None, None, 1980), (7, MAIN, "d", None, None, None)]
    rows, _ = run(spark, "crossref", kinds, data, verdicts=verdicts)
    assert [r["meta_source_doi"] for r in rows] == ["10.1/a", "10.1/a", "10.1/x", "10.1/y", None, "10.5/c", None]
    assert (rows[5]["meta_authors_raw"], rows[5]["meta_publication_year_raw"], rows[6]["meta_authors_raw"]) == ("Doe, J.", 1980, None)
    probes = spark.createDataFrame([("c", "10.7/c"), ("a", "10.7/a")], "stem string, doi string")
    rows, _ = run(spark, "doi_probe", kinds, [(n, s, f"/x/{p}.pdf", *rest) for n, s, p, *rest in data], probes=probes)
    assert [r["meta_source_doi"] for r in rows] == ["10.1/a", None, "10.1/x", "10.1/y", None, "10.7/c", None]


def test_language(spark):
    kinds = "n int, corpus_source string, path string, meta_language string, meta_language_raw string, item_language string, meta_title_raw string, item_item_text string"
    long = "ich bin ein ganz normaler satz der lang genug ist"
    data = [
        (1, "s", "a", "German", "German", "pt-BR", "X", "short"), (2, "s", "b", None, None, None, "Worry - Kurdish Version", None), (3, MAIN, "c", None, None, None, "Worry - Kurdish Version", None),
        (4, "s", "d", None, None, "", "Y", long), (5, "s", "d", None, None, "de", "Y", long), (6, "s", "e", None, None, "fr", "Z", long),
    ]
    rows, _ = run(spark, "language", kinds, data, detect=lambda t: pd.Series(["de"] * len(t)))
    assert [(r["meta_language"], r["meta_language_raw"], r["item_language"]) for r in rows] == [("de", None, "pt"), ("ku", "Kurdish Version", None), (None, None, None), ("de", None, "de"), ("de", None, "de"), ("en", None, "fr")]


def test_permissions_constants_and_types(spark):
    rows, _ = run(spark, "permissions", "n int, corpus_source string, meta_permissions_raw string, permissions_category string", [(1, "s", "Contact Publisher", "wrong"), (2, MAIN, "Contact Publisher", None), (3, "s", "odd", "x")])
    assert [(r["meta_permissions_raw"], r["permissions_category"]) for r in rows] == [("Contact Publisher.", "contact_publisher"), ("Contact Publisher", "contact_publisher"), ("odd", None)]
    kinds = "n int, corpus_source string, source_grade string, extraction_confidence string, verbatim_claimed boolean"
    rows, _ = run(spark, "fabricated", kinds, [(1, "semanticnet", "semanticnet", "medium", True), (2, "semanticnet", None, "high", True), (3, "aligns", "semanticnet", "medium", None)])
    assert [(r["source_grade"], r["extraction_confidence"], r["verbatim_claimed"]) for r in rows] == [(None, "medium", None), (None, "high", None), ("semanticnet", None, None)]
    rows, _ = run(spark, "item_type", "n int, corpus_source string, item_item_type string", [(1, "aligns", None), (2, "aligns", "open"), (3, "other", None), (4, None, None)])
    assert [r["item_item_type"] for r in rows] == ["rating_scale", "open", None, None]
    rows, _ = run(spark, "reverse_coded", "n int, item_item_id long, item_reverse_coded boolean", [(1, 1, None), (2, 1, True), (3, None, None)])
    assert [r["item_reverse_coded"] for r in rows] == [False, True, None]
    rows, _ = run(spark, "authors", "n int, corpus_source string, meta_authors_raw string", [(1, "s", "Doe | J. | Roe"), (2, MAIN, "Doe | J."), (3, "s", "| |")])
    assert [r["meta_authors_raw"] for r in rows] == ["Doe, J., & Roe", "Doe | J.", "| |"]


def test_items(spark):
    kinds = "n int, corpus_source string, path string, scale_id long, item_item_id long, item_item_text string, item_options array<string>"
    data = [
        (1, "s", "a", 1, 0, "1. I worry a lot", []), (2, "s", "a", 1, 1, "I sleep well", ["x"]), (3, MAIN, "b", 1, 0, "1. kept as it is", None),
        # ids start anew in the second scale; the same item with other punctuation is one item; no text: the id's first item
        (4, "s", "c", 1, 1, "I like to be alone", None), (5, "s", "c", 1, 2, "I enjoy parties", None), (6, "s", "c", 2, 1, "Rules are there to be kept", None),
        (7, "s", "c", 2, 2, "I enjoy parties!", None), (8, "s", "c", 2, 1, None, None), (9, "s", "d", 1, 5, "one", None), (10, "s", "d", 1, None, "none", None),
    ]
    rows, _ = run(spark, "items", kinds, data, order="n")
    assert [r["item_item_id"] for r in rows] == [1, 2, 0, 1, 2, 3, 2, 1, 5, None]
    assert rows[0]["item_options"] is None and rows[0]["item_item_text"] == "I worry a lot" and rows[2]["item_item_text"] == "1. kept as it is"


def test_versions_and_titles(spark):
    kinds = "n int, path string, scale_id long, scale_name string, meta_title_raw string, version string, scale_id_path array<long>, scale_name_path array<string>"
    data = [
        (1, "d", 1, "worry scale (short form)", "big title--revised", None, [9, 1], ["umbrella, revised", "worry scale (short form)"]),
        (2, "d", 2, "sleep scale (revised)", "big title", "something else", [9, 2], ["umbrella, revised", "sleep scale (revised)"]),
    ]
    rows, _ = run(spark, "version_split", kinds, data)
    assert [(r["scale_name"], r["meta_title_raw"], r["version"], r["scale_name_path"]) for r in rows] == [
        ("worry scale", "big title", "Short Form; Revised", ["umbrella, revised", "worry scale"]),
        ("sleep scale (revised)", "big title", "something else", ["umbrella, revised", "sleep scale (revised)"]),
    ]
    rows, _ = run(spark, "title_case", kinds, data)
    assert rows[1]["scale_name"] == "Sleep Scale (Revised)" and rows[0]["scale_name_path"][0] == "Umbrella, Revised"


def test_derive(spark):
    kinds = "n int, corpus_source string, doi_psyctests string, meta_source_doi string, meta_authors_raw string, meta_publication_year_raw string, meta_title_raw string, meta_journal_venue_raw string, meta_source_raw string, item_item_text string"
    rows, _ = run(spark, "derive", kinds, [
        (1, MAIN, "10.1037/t1-000", "10.5/s", "Doe, J.", "2001.0", "Worry.", "J", "raw", " abc "),
        (2, "s", "10.1037/t2-000", "10.5/s", None, None, None, None, "Roe, R. (1999). Text.", None),
        (3, "s", None, "10.5/s", "Doe, J.", "2001", "Worry", "Journal", " ", "x"),
        (4, "s", "10.1037/t4-000", None, None, None, None, None, None, "x"),
    ])
    assert [r["public_doi"] for r in rows] == ["10.1037/t1-000", "10.5/s", "10.5/s", "10.1037/t4-000"]
    assert [r["public_year"] for r in rows] == [2001, 1999, 2001, None] and [r["item_text_chars"] for r in rows] == [3, None, 1, 1]
    assert rows[1]["public_source"] == "Roe, R. (1999). Text. https://doi.org/10.5/s"
    assert rows[2]["public_source"] == "Doe, J. (2001). Worry. Journal. https://doi.org/10.5/s" and "10.1037/t4-000" in rows[3]["public_source"]


def test_pdf_match_and_flags(spark):
    records = spark.createDataFrame([("10.1037/T1-000", 2, 0), ("10.1037/t9-000", 1, 1)], "doi string, record_item_count int, record_scale_count int")
    body = "z" * 300 + " I worry about many things " + "y" * 300
    kinds = "n int, corpus_source string, path string, doi_psyctests string, item_item_id long, scale_id long, item_item_text string, item_language string, pdf_full_text string, meta_page_count int, meta_image_count int, bucket string, x_extractor_ttft double"
    data = [
        (1, MAIN, "a", " 10.1037/t1-000 ", 1, 1, "I worry about many things", "en", body, 3, 3, "scaled", 1.0), (2, MAIN, "a", "10.1037/t1-000", 2, 1, "I worrx abouq manz things", "de", body, 3, 3, "scaled", 1.0),
        (3, MAIN, "a", "10.1037/t1-000", 3, 2, "x" * 251, None, body, 3, 3, "scaled", 1.0), (4, "s", "b", "10.1037/t9-000", 1, 1, "text", "", None, None, None, "scaled", 1.0), (5, MAIN, "c", None, 1, 1, "thin", "en", "thin layer", 2, 0, "scaled", 1.0),
    ]
    df = spark.createDataFrame(data, kinds)
    ctx = Context(records=records)
    out = assemble.run_steps(df, assemble.POSTPROCESS, ctx)
    rows = {r.n: r for r in out.collect()}
    assert set(rows) == {1, 2, 4, 5} and not {"pdf_full_text", "meta_page_count", "x_extractor_ttft"} & set(out.columns)
    assert [(rows[n].flag_item_count_deviation, rows[n].flag_scale_count_deviation, rows[n].flag_item_text_deviation, rows[n].flag_item_translated) for n in (1, 2, 4, 5)] == [
        (True, None, False, False), (True, None, True, True), (None, None, None, None), (None, None, None, False),
    ]
    assert (rows[1].pdf_match_edit_distance, rows[2].pdf_match_edit_distance, rows[4].pdf_match_edit_distance) == (0, 3, None)
    assert rows[5].pdf_text_checkable is False and rows[1].observed_item_count == 3
    assert ctx.stats["filter.long_item_text.new"] == 1 and ctx.stats["flags.flag_item_text_deviation"] == 1 and ctx.stats["pdf_match.not_checkable"] == 1


def test_patched_marks_changed_rows_once(spark):
    kinds = "n int, corpus_source string, path string, item_item_id double, item_item_text string, doi string"
    data = [(1, "s", "a", 1.0, "1. long enough", None), (2, MAIN, "b", 1.0, "kept", None), (3, "s", "/x/999912345.pdf", 1.0, "kept", "10.1037/t12345-000"), (4, "s", "c (2).pdf", 1.0, "copy", None), (5, "s", "c.pdf", 1.0, "kept", None)]
    ctx = Context()
    names = ["duplicate_files", "schema", "doi_psyctests", "items"]
    once = assemble.written(assemble.patch(spark.createDataFrame(data, kinds), ctx, names))
    rows = {r.n: r.is_patched for r in once.collect()}
    assert rows == {1: True, 2: False, 3: False, 5: False} and ctx.stats["is_patched.rows"] == 1
    again = {r.n: r.is_patched for r in assemble.patch(once, Context(), names).collect()}
    assert again == rows


@pytest.mark.parametrize("name", [*assemble.PATCH, *assemble.POSTPROCESS])
def test_steps_without_their_columns_change_no_rows(spark, name):
    df = spark.createDataFrame([(1, "a")], "n int, other string")
    assert {**assemble.PATCH, **assemble.POSTPROCESS}[name](df, Context()).select("n", "other").collect() == df.collect()

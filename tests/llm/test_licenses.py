"""Licences behind all sorts of copyright lines, a caller's own texts, and the public texts that the digests stand for."""

from pathlib import Path

import pytest

from folioloom.llm import licenses

LINES = ["Copyright © 2020 A", "© 2020 A", "Copyright: 2020 A", "Copyright Jane Doe", "Copyright (C) 1999-2003 A, all", "(c) 2001 by B", "# Copyright by The Authors", "COPYRIGHT Élodie", "All rights reserved.", "&copy; x", "Copyright &copy; 2011 C"]


def test_copyright_lines_are_dropped(spark):
    rows = [(i, f"MIT License\n{line}\n\n{licenses._MIT}") for i, line in enumerate(LINES)]
    out = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [LINES[i] for i, name in sorted(out.items()) if name != "MIT"] == ["&copy; x"]


def test_lines_of_the_text_itself_stay():
    for text in (licenses._MIT, licenses._BSD_HEAD + licenses._BSD_TAIL, "COPYRIGHT HOLDERS AND CONTRIBUTORS", "copyright notice, this list"):
        assert len(licenses.canonical_text(text).split()) >= 0.95 * len(licenses.re.findall("[a-z0-9]+", text.lower()))


def test_python_and_column_forms_agree(spark):
    texts = [*LINES, licenses._MIT, "A\n\nLicence v2 \n(c) 2020 x\nV.3 sub-licensed and/or", "", "  \n ", None, "İ Version2\nver 2", "é\r\nb\x0bc"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        want = licenses.hashlib.sha256(licenses.canonical_text(texts[r.doc_id] or "").encode()).hexdigest()
        assert r.digest == want, texts[r.doc_id]


def test_a_callers_own_lines_are_all_looked_up(spark):
    known = [("OWN", "zebra quagga okapi"), ("TWO", "first line\nsecond line")]
    rows = [(1, "x\nZebra, quagga: okapi!\ny"), (2, "First line.\nSecond line?"), (None, "zebra quagga okapi")]
    out = {r.doc_id: (r.license, r.notices) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known=known).collect()}
    assert out == {1: (None, "OWN"), 2: ("TWO", ""), None: ("OWN", "OWN")}
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known=[]).where("license is not null or notices <> ''").count() == 0


def test_a_key_named_like_an_output(spark):
    df = spark.createDataFrame([(1, "a", 2)], "digest long, text string, notices int")
    assert licenses.scan(df, key="digest").columns == ["digest", "_digest", "license", "notices"]


FILES = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "GPL-2.0": "GPL-2", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}


@pytest.mark.parametrize("name", FILES)
def test_long_public_texts(spark, name):
    path = Path("/usr/share/common-licenses") / FILES[name]
    if not path.exists():
        pytest.skip("the system has no copy of the text")
    text = path.read_text()
    changed = "Copyright (c) 2020 Somebody\n" + text.replace("license", "licence").replace("\n", "\r\n")
    df = spark.createDataFrame([(1, text), (2, changed)], "doc_id long, text string")
    found = {r.doc_id: r.license for r in licenses.scan(df).collect()}
    assert found == {1: name, 2: name}

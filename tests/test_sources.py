"""Broken CSV files read in splits against a reader of whole files; nested lists of files; first records of a key."""

import json
import random
import re

import pytest

from folioloom.functions.model import Field, Model
from folioloom.sources import readers, store


def whole_file(raw: bytes):
    """The records of a file and their fields, line by line from the start."""
    text = "".join(chr(b) if bytes([b]).decode("cp1252", "ignore") == "" else bytes([b]).decode("cp1252") for b in raw)
    records, held = [], ""
    for line in re.split(r"\r*\n", text):
        line = re.sub(r";+\s*$", "", line).strip()
        held = f"{held} {line}".strip() if held else line
        if held and held.count('"') % 2 == 0:
            records.append(held)
            held = ""
    if held:
        records.append(held)
    return records


def fields(record):
    body = record[1:-1].replace('""', '"') if record.startswith('"') and record.endswith('"') and '","' not in record else record
    clean = lambda x: " ".join(x.strip().strip('"').split())
    if m := re.search(r"^(.*),\s*\"?((?:[A-Z][\w'’ -]*,\s*[A-Z]\.[^()]*\((?:18|19|20)\d{2}[a-z]?\)|https?://).*)$", body):
        name, _, item = m[1].partition(",")
        return tuple(map(clean, (name, item, m[2])))
    return tuple(clean(x) for x in (body.rsplit(",", 2) + ["", ""])[:3])


def broken(rng, n):
    pieces = [b"Scale", b"item, with comma", b'"quoted', b'"', b'""', b",", b"\x92s own", b"\x81", b"\xe9t\xe9", b"Smith, A. (1999). T", b"M\xfcller, B. C. (2001a). X", b"http://x.org/a,b", b"  ", b";;", b"; ", b'","', b"\t", b"O\x92Neil, K. (1950)"]
    ends = [b"\n", b"\r\n", b"\r\r\n", b";;\r\r\n", b"\n\n", b" \n"]
    return b"".join(b",".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) + rng.choice(ends) for _ in range(n))


@pytest.fixture
def small_splits(spark):
    for key, value in {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0"}.items():
        spark.conf.set(key, value)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_broken_file_in_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(4)
    files = {f"f{i}.csv": broken(rng, n) for i, n in enumerate([0, 1, 40, 150])} | {"open.csv": b'a,"b\nc\nd', "plain.csv": b"x,y,z"}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    lines = readers._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5 and lines.select("file", "block").distinct().count() > 8
    got = {}
    for r in readers.logical_records(lines).orderBy("file", "number").collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.record)
    want = {name: whole_file(raw) for name, raw in files.items()}
    assert got == {k: v for k, v in want.items() if v}
    triples = {}
    for name in sorted(want):
        for record in want[name]:
            triples.setdefault(fields(record), name)
    out = readers.read_broken_csv(spark, str(tmp_path)).collect()
    assert {tuple(r)[1:]: r.file.rsplit("/", 1)[1] for r in out} == triples and len(out) == len(triples)


def test_fields_of_records(spark):
    rng = random.Random(9)
    records = sorted({x for _ in range(30) for x in whole_file(broken(rng, 20))} | {"a", "a,b", "a,b,c", "a,b,c,d", '"a,b,c"', 'a,"b",c', ",", ",,", '"', '""'})
    df = spark.createDataFrame([(x,) for x in records], "record string")
    got = {r.record: tuple(r.r) for r in df.select("record", readers.split_record(df.record).alias("r")).collect()}
    assert got == {x: fields(x) for x in records}


def test_nested_lists_of_files(spark, tmp_path):
    names = ['deep/"odd" \\name.pdf', "é/ü.pdf", "key.pdf", "plain.txt"]
    records = [{"doi": "d1", "files": {"key.pdf": [names[0], {"b": [[names[1]]]}]}}, {"doi": "d2", "files": {"a": [names[3]]}}, {"doi": "d3", "files": {"z": ["x/key.pdf"]}}]
    (tmp_path / "f.json").write_text(json.dumps(records))
    out = readers.file_identifiers(spark, str(tmp_path / "f.json"), "doi", "files").collect()
    assert {r.file: r.doi for r in out} == {'"odd" \\name.pdf': "d1", "ü.pdf": "d1", "key.pdf": "d3"}


def test_first_record_over_several_files(spark, tmp_path):
    for i, n in enumerate([5, 7]):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"DOI": " X ", "n": n}, {"DOI": f"y{i}", "n": None}]))
    out = readers.read_reference(spark, str(tmp_path), "DOI", ["n"]).collect()
    assert {r.DOI: r.n for r in out} == {"x": 5, "y0": None, "y1": None}


def test_a_cell_as_a_record_of_its_model(spark, tmp_path):
    cells = store.CellStore(spark, str(tmp_path), {"items": []})
    cells.record(spark.createDataFrame([("a", "items", '{"text": "q"}', None), ("b", "items", None, "boom")], "key string, extractor string, content string, error string"), 0)
    model = Model((Field("item_text", "string", "text"), Field("item_type", "string", "type", "rating_scale")))
    assert tuple(cells.load("a", "items", model)) == ("q", "rating_scale") and cells.load("b", "items", model) is None and cells.load("c", "items", model) is None

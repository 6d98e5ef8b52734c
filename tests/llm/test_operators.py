"""The operators against brute force on small inputs, with the edge cases that their docstrings define."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioloom.llm import components, decontaminate, language, licenses, packing, pii, quality, secrets, simhash, suffixes, toxicity

ODD = [(None, "no id"), (7, None), (8, ""), (9, " \n\t "), (10, "x" * 30_000), (11, "same text twice"), (11, "same text twice"), (12, "ünï cödé 漢字 🙂")]
KINDS = "doc_id long, text string"


def frame(spark, rows, kinds=KINDS, parts=3):
    return spark.createDataFrame(rows, kinds).repartition(parts)


@pytest.fixture
def prose():
    rng = random.Random(4)
    words = ["the", "of", "and", "in", *["".join(rng.choice(["an", "er", "th", "on", "ti", "ea"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]]
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


# Toxicity


def toxic_rows(prose, n=240):
    rng = random.Random(2)
    out = []
    for i in range(n):
        words = prose(60).split()
        toxic = i % 4 == 0
        if toxic:
            for w in ("blargh", "snorfle" + rng.choice(["a", "on", "ing"])):
                words.insert(rng.randrange(len(words)), w)
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_toxicity_tells_held_out_documents_apart(spark, prose):
    rows = toxic_rows(prose)
    model = toxicity.fit([(t.encode(), y, i % 5 < 2) for i, t, y in rows[:160]])
    measure = model.distances()
    right = sum((model.score(model.features(measure(t.encode())))[0] >= 0.5) == bool(y) for _, t, y in rows[160:])
    assert right >= 0.95 * len(rows[160:])


def test_toxicity_edge_cases(spark, prose):
    docs = frame(spark, [(i, t) for i, t, _ in toxic_rows(prose)] + ODD)
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_rows(prose)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()
    assert len(out) == 240 + len(ODD) and all(0 <= r.score <= 1 for r in out)
    empty = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, empty).collect()} == set(toxicity.fit([]).score(toxicity.Model.features([])).tolist())
    assert toxicity.score_documents(docs.limit(0), empty).count() == 0


# Language


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(10):
        sizes = rng.integers(1, 200, 4)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        scores = (rng.normal(size=(sizes.sum(), 3)) * 2).astype(np.float32)
        labels = language.viterbi(scores, first, 3.0)
        for a, n in zip(first, sizes, strict=True):
            s, found = scores[a : a + n].astype(float), labels[a : a + n]
            best = s[0].copy()
            for row in s[1:]:
                best = np.maximum(best, best.max() - 3.0) + row
            assert abs(best.max() - (s[np.arange(n), found].sum() - 3.0 * (np.diff(found) != 0).sum())) < 1e-2


def test_language_spans_and_edge_cases(spark):
    sample = {"en": "the house and the garden with this thing", "de": "das haus und der garten mit dem schönen ding", "ru": "это дом и сад"}
    model = language.fit([(t, lang) for lang, t in sample.items() for _ in range(3)])
    mixed = "the garden and the house " * 4 + "das schöne haus und der garten " * 3 + "the thing with the garden " * 4
    rows = [*ODD, (20, mixed), (21, "сад и дом"), (22, "12345 !!"), (23, "the house " * 40_000)]
    out = {r.doc_id: r for r in language.label_documents(frame(spark, rows), model).collect()}
    assert out[20].lang_pred == "en" and [s.lang for s in out[20].spans] == ["en", "de", "en"]
    assert mixed[out[20].spans[1].start : out[20].spans[1].end].startswith("das")
    assert out[21].lang_pred == "ru" and out[22].lang_pred == "und" and out[22].score == 0
    assert out[7].lang_pred == out[8].lang_pred == out[9].lang_pred == "und"
    assert out[23].lang_pred == "en" and len(out[23].spans) == 1
    assert language.label_documents(frame(spark, rows).limit(0), model).count() == 0
    assert {r.lang_pred for r in language.label_documents(frame(spark, rows), language.fit([])).collect()} == {"und"}


# Repeated passages


def removed(rows):
    """By the definition: every 100-byte string that also starts earlier."""
    seen, out = set(), {}
    for key, _, text in sorted({(-1 if k is None else k, hash(t), (t or "").encode()) for k, t in rows}):
        flag = np.zeros(len(text) + 1, dtype=int)
        for p in range(len(text) - 99):
            s = text[p : p + 100]
            if s in seen:
                flag[p] += 1
                flag[p + 100] -= 1
            seen.add(s)
        cover = np.cumsum(flag)[: len(text)] > 0
        kept = bytes(np.frombuffer(text, np.uint8)[~cover].tobytes())
        out[key] = (len(text), int(cover.sum()), int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block", [700, 1 << 20])
def test_suffixes_match_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde ") for _ in range(400)) for _ in range(5)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            x, a = rng.choice(base), rng.randint(0, 300)
            parts += [x[a : a + rng.randint(50, 300)], "".join(rng.choice("xyzé") for _ in range(rng.randint(0, 60)))]
        rows.append((i, "".join(parts)))
    rows += [(500, None), (501, ""), (502, "a" * 1000), (503, "ab" * 400), (504, "a" * 99), (505, "a" * 100), (506, "abc" * 200 + "q" + "abc" * 200), (507, "é" * 300), (None, "a" * 150)]
    got = {-1 if r.doc_id is None else r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(frame(spark, rows, parts=5)).collect()}
    assert got == removed(rows)


def test_suffixes_repeated_rows_and_empty_table(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    out = suffixes.remove_repeats(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 300)]
    assert suffixes.remove_repeats(frame(spark, [(1, text)]).limit(0)).count() == 0


def test_multikey_order_sorts():
    rows = np.random.default_rng(3).integers(0, 3, size=(500, 4)).astype(np.uint64)
    order = suffixes.multikey_order(rows)
    assert [tuple(r) for r in rows[order]] == sorted(tuple(r) for r in rows)


# Personal data


def test_pii_keeps_format_and_coreference(spark):
    rows = [(1, "Mail a.Bc-9@mail8.example.com, +1 (017) 555-7713 or 1 (017) 555-7713"), (2, "4532015112830366 4532-0151-1283-0366 ip 97.51.17.173"), (3, None), (4, ""), (5, "Mrs. Anna Smith, Mr Smith, Г-жа Иванова"), (6, "A.BC-9@mail8.example.com"), (6, "A.BC-9@mail8.example.com")]
    out = defaultdict(list)
    for r in pii.with_surrogates(frame(spark, rows)).collect():
        out[r.doc_id].append(r)
    mail = re.search(r"\S+@[\w.]+", out[1][0].text)[0]
    assert mail.lower() == out[6][0].text.lower() and out[6][0].text == out[6][1].text and mail.endswith(".com")
    cards = out[2][0].text.split()[:2]
    assert cards[0] == cards[1].replace("-", "") and cards[0] != "4532015112830366"
    digits = [int(c) for c in cards[0]]
    assert sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert out[3][0].text is None and out[4][0].text == "" and out[3][0].n_entities == 0
    assert re.fullmatch(r"Mrs\. \w+ \w+, Mr \w+, Г-жа [А-Яа-яё]+", out[5][0].text) and out[5][0].text.split()[1].rstrip(",").endswith(tuple(pii.SCRIPTS["latin"][2]))
    assert out[5][0].text.split()[2].rstrip(",") == out[5][0].text.split()[4].rstrip(",")


def test_pii_collisions_stay_distinct(spark, monkeypatch):
    numbers = [f"({a:02d}) {b:03d}-{c:03d}" for a in range(2) for b in range(3) for c in range(10)]
    monkeypatch.setattr(pii, "PHONE", r"\([0-9]{2}\) [0-9]{3}-[0-9]{3}")
    monkeypatch.setitem(pii.KINDS, "phone", pii.PHONE)
    monkeypatch.setattr(pii, "ANY", pii.PHONE)
    monkeypatch.setattr(pii, "HINT", r"\(")
    # A weak stream (one of 100 values) makes collisions certain.
    weak = lambda kind, normal, attempt, key: pii.F.sha2(pii.F.pmod(pii.F.xxhash64(normal, attempt.cast("string")), pii.F.lit(100)).cast("string"), 256)
    monkeypatch.setattr(pii, "_stream", weak)
    monkeypatch.setattr(pii, "MAX_ROUNDS", 60)
    rows = [(i, f"call {n}") for i, n in enumerate(numbers[:25])]
    a = pii.with_surrogates(frame(spark, rows)).collect()
    assert len({r.text for r in a}) == 25 and not {r.text for r in a} & {t for _, t in rows}
    monkeypatch.setattr(pii, "MAP_ROWS", 0)  # the way by a shuffle gives the same
    assert sorted(map(tuple, pii.with_surrogates(frame(spark, rows)).collect())) == sorted(map(tuple, a))


def test_pii_other_columns_and_empty_table(spark):
    rows = [(1, "x@y.example", "kept", 5)]
    df = frame(spark, rows, "doc_id long, text string, kind string, normal int")
    assert pii.with_surrogates(df).columns == ["doc_id", "text", "kind", "normal", "n_entities"]
    assert pii.with_surrogates(df).first().kind == "kept"
    assert pii.with_surrogates(df.limit(0)).count() == 0


# Secrets


def base_spans(text):
    """The base patterns as stated: leftmost, non-overlapping, short matches dropped after they matched."""
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secrets_base_matches_brute_force():
    rng = random.Random(9)
    bits = ["password", "TOKEN", "secret", "api_key", "apikey", " = ", ":", '"', "'", "=", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "xyz", " ", "\n", "ſecret", "toKen", "Z9+/_.=-", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert [s for s in secrets.scan(text) if s[1] < 3] == base_spans(text), text


def test_secrets_of_any_length(spark):
    rng = random.Random(13)
    key = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(900))
    name = "a_" * 50 + "private_key"
    texts = [f'private_key = "{key}"', f'"signing_key": \'{key}\' end', f"access_key={key}", f'{name} = "{key[:40]}"']
    for text, size in zip(texts, (900, 900, 900, 40), strict=True):
        at = text.index(key[:size])
        assert (at, 3, at + size) in secrets.scan(text), text
    clean = secrets.redact(frame(spark, list(enumerate(texts)))).collect()
    assert not any(key[20:40] in r.text or key[-20:] in r.text for r in clean)
    inner = "S3cr3t!pass99"
    for text in (f'note = "{"words " * 120}password=\'{inner}\' {"words " * 9}"', f"note=?{'page&' * 120}token={inner}"):
        at = text.index(inner)
        assert secrets.joined(secrets.scan(text)).endswith(f"literal:{at}:{at + len(inner)}")
    long = ["token=" * 30_000, "a" * 300_000, "a=" * 100_000, "key=\"" * 60_000, "x" + " " * 300_000 + "token", "'a':'" * 60_000]
    began = time.perf_counter()
    for text in long:
        secrets.lexed(text)
    assert time.perf_counter() - began < 20


def test_secrets_follow_names_to_all_their_literals():
    one, two = "S3cr3t!pass99", "0ther!Key#77"
    texts = {
        f'k2 = "{one}"\npassword = k2\n': [one],
        f'db_v2: "{one}"\ndb_password: db_v2\n': [one],
        f'k = "{one}"\npassword = k\nk = "{two}"\n': [one, two],
        f'k-2 = "{one}"\ntoken = k-2\n': [one],
        "password = n0\n" + "".join(f"n{i} = n{i + 1}\n" for i in range(40)) + f'n40 = "{one}"\n': [one],
        f'a = b\nb = a\npassword = a\nb = "{one}"\n': [one],
        f'k = "{one}"\nother = k\n': [],
        f"password = {one}\n": [one],
    }
    for text, want in texts.items():
        assert sorted(text[a:b] for a, b in secrets.lexed(text)) == sorted(want), text


def test_secrets_method_and_edge_cases(spark):
    assert secrets.joined(secrets.scan('x = "S3cr3t!pass99"\ndb_password = x\n')) == "literal:5:18"
    assert secrets.joined(secrets.scan('db_pwd="S3cr3t!pass"')) == "literal:8:19"
    assert secrets.scan('password_file = "conf/settings.yaml"') == [] and secrets.scan("token count: 12") == []
    rows = [*ODD, (20, "token = '04dbebab91ab85687d33eeaaf9ac699e1188f962' é")]
    out = {r.doc_id: r for r in secrets.scan_documents(frame(spark, rows)).collect()}
    assert (out[20].n_assign, out[20].n_access, out[20].n_hex) == (1, 0, 1)
    assert out[7].spans == "" and out[8].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in secrets.redact(frame(spark, [(*r, 5) for r in rows], KINDS + ", n_chars long"), count="n_chars").collect()}
    assert clean[20].text == "[SECRET]' é" and clean[20].n_chars == len(clean[20].text) and clean[7].text is None and clean[12].n_chars == 5
    assert secrets.scan_documents(frame(spark, rows).limit(0)).count() == 0


# Quality


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def test_quality_counts_match_brute_force():
    rng = random.Random(3)
    for _ in range(800):
        text = "".join(rng.choice(["a", "b", "é", " ", "\n", "#", "a b c ", "\x0b", "\x85", "漢 "]) for _ in range(rng.randint(0, 60)))
        assert quality.measure(text.encode())[:5] == counted(text), text


def test_quality_hosts_and_edge_cases(spark, prose):
    good = [(1000 + i, prose(80), "fine") for i in range(20)]
    bad = [(100 + i, "## " * 60 + prose(10), "spam") for i in range(20)]
    border = [(300, prose(60) + " # " * 40, "spam"), (301, prose(60) + " # " * 40, "fine")]
    odd = [(k, t, None) for k, t in ODD]
    df = frame(spark, good + bad + border + odd, "doc_id long, text string, source string")
    out = quality.verdicts(df).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(good + bad + border + odd)
    assert [by[i] for i, *_ in good if not by[i].kept] == [] and not any(by[i].kept for i, *_ in bad)
    assert by[300].n_soft == by[301].n_soft == 1 and not by[300].kept and by[301].kept
    assert by[7].base_failed and by[7].n_words == 0
    kept = quality.keep_good(df.withColumn("host", quality.F.lit(1)).withColumn("n_words", quality.F.lit(2)))
    assert kept.columns == ["doc_id", "text", "source", "host", "n_words"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r.kept)
    assert quality.verdicts(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0


def test_quality_salted_join_gives_the_same(spark, prose, monkeypatch):
    df = frame(spark, [(i, prose(80), f"h{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    want = sorted((r.doc_id, r.kept, round(r.host_rate, 9)) for r in quality.verdicts(df).collect())
    monkeypatch.setattr(quality, "HOST_BROADCAST_ROWS", 1)
    assert sorted((r.doc_id, r.kept, round(r.host_rate, 9)) for r in quality.verdicts(df).collect()) == want


# Licences


def test_licenses(spark):
    mit = licenses._MIT
    rows = [(1, mit), (2, "The MIT Licence (MIT)\nCopyright (c) 2019 A. Person\n\n" + mit.upper().replace(",", " ,")), (3, "words\nReleased under the MIT Licence!\nwords"), (4, mit + " more"), *ODD]
    out = licenses.scan(frame(spark, rows)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert by[1].license == by[2].license == "MIT" and by[4].license is None and by[4].notices == ""
    assert by[3].license is None and by[3].notices == "MIT" and by[7].digest == hashlib.sha256(b"").hexdigest()
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


# SimHash and near copies


def slow_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_brute_force(prose):
    for text in ["", " ", "One", "One two", "É e  \x0b x Y z", prose(50), prose(200)]:
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("block", [4, 2048])
def test_links_lose_no_component(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(8)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    values = sorted(values)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    got = components.components(simhash.links(spark.createDataFrame([(signed(v),) for v in values], "fp long"))).collect()
    mine = {r.node: r.root for r in got}
    groups, want = defaultdict(set), defaultdict(set)
    for v in values:
        groups[mine.get(signed(v), signed(v))].add(v)
        want[find(v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_simhash_edge_cases(spark, prose):
    text = prose(120)
    rows = [*ODD, (20, text), (21, text), (22, text.upper()), (23, prose(120))]
    out = simhash.near_duplicates(frame(spark, rows)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and by[21].component == by[22].component == 20 and by[23].component == 23
    assert by[7].fp == by[8].fp == by[9].fp == 0 and by[9].component == 7
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_near_copies_leave_one(spark, prose):
    rng = random.Random(6)
    rows, key = [], 0
    for _ in range(12):
        words = prose(200).split()
        for copy in range(4):
            changed = list(words)
            for _ in range(copy):
                changed[rng.randrange(200)] = f"other{key}"
            rows.append((key, " ".join(changed), "s"))
            key += 1
    rows += [(900, None, "s"), (901, "", "s"), (902, prose(3), "s")]
    df = frame(spark, rows, "doc_id long, text string, row string")
    out = simhash.drop_near_duplicates(df).collect()
    assert sorted(r.doc_id for r in out) == [*range(0, 48, 4), 900, 902]
    assert simhash.drop_near_duplicates(df.unionByName(df)).count() == len(out)
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_near_copies_behind_a_shared_template(spark, prose, monkeypatch):
    """Copies of one original lead the buckets; pairs that meet the others only there are found as well."""
    monkeypatch.setattr(simhash, "REST_BLOCK", 16)
    rng = random.Random(12)
    template = prose(160).split()
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts, tail = [], own(26)
    for _ in range(40):  # the leading group: one text with few changes
        words = template + tail
        words[rng.randrange(160, 186)] = own(1)[0]
        texts.append(words)
    for _ in range(30):  # pairs of near copies, far from all others
        first = template + own(26)
        texts += [first, first[:168] + own(18)]
    rows = [(k, " ".join(x)) for k, x in enumerate(texts)]
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in texts]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = sorted({find(i) for i in range(len(rows))})
    assert len(want) == 31
    got = sorted(r.doc_id for r in simhash.drop_near_duplicates(frame(spark, rows)).collect())
    assert got == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[i] == 100 for i in range(101, 160))
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# Decontamination


def slow_tiles(doc, item, least=3):
    used_a, used_b, out = [False] * len(doc), [False] * len(item), 0
    while True:
        best, longest = [], least
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > longest:
                    best, longest = [(i, j)], k
                elif k == longest:
                    best.append((i, j))
        if not best:
            return out
        for i, j in best:
            if not any(used_a[i : i + longest]) and not any(used_b[j : j + longest]):
                used_a[i : i + longest] = used_b[j : j + longest] = [True] * longest
                out += longest


def test_tiles_cover_what_brute_force_covers():
    rng = random.Random(3)
    for _ in range(150):
        doc, item = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 50))], [rng.choice("abcdefgh") for _ in range(rng.randint(1, 25))]
        if rng.random() < 0.6 and len(doc) > 10:
            item = item[:5] + doc[2:20] + item[5:]
        assert sum(t[2] for t in decontaminate.tiles(doc, item)) == slow_tiles(doc, item)


def test_decontamination(spark, prose, monkeypatch):
    item = prose(40)
    parts = item.split()
    reordered = " ".join([*parts[20:], "between", *parts[:20]])
    rows = [*ODD, (20, prose(100) + " " + item + " " + prose(50)), (21, reordered.upper()), (22, prose(300)), (23, " ".join(parts[:15]))]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, item), (2, prose(40)), (3, None), (4, "too short"), (5, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_tiles) for r in decontaminate.contaminated_pairs(docs, bench).collect())
    assert got == [(20, 1, 1), (20, 5, 1), (21, 1, 2), (21, 5, 2)]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.count() == len(rows) - 2 and kept.columns == ["doc_id", "text"]
    monkeypatch.setattr(decontaminate, "ITEMS", 1)  # many blocks give the same
    assert sorted((r.doc_id, r.item_id, r.n_tiles) for r in decontaminate.contaminated_pairs(docs, bench).collect()) == got
    assert decontaminate.contaminated_pairs(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated_pairs(docs.limit(0), bench).count() == 0


# Packing


def test_encoder_gives_the_tokenizers_ids(prose):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY[0]))
    encode = packing.token_encoder(*map(public_tokenizers.path, packing.VOCABULARY))
    texts = ["  a  b\n\n c\t d '’s don't I'LL 12 3½ ²  日本語 x  y​ \r\n ", "", "\n", "a\x85b \x1c c", "é" * 50 + " " * 30, "<|endoftext|> a", "ab̀ ć", "x" * 5000 + " y", " " * 5000 + "y", "🙂🙂 a", prose(300)]
    for text in texts:
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pool", [500, 1 << 21])
def test_packing_round_trip(spark, prose, monkeypatch, pool):
    import public_tokenizers

    monkeypatch.setattr(packing, "POOL_TOKENS", pool)
    rows = [*ODD, *((100 + i, prose(n)) for i, n in enumerate([1, 5, 80, 300, 700, 1500, 3000] * 6))]
    out = packing.pack_documents(frame(spark, rows)).collect()
    encode = packing.token_encoder(*map(public_tokenizers.path, packing.VOCABULARY))
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        size = sum(r.length for r in pieces)
        assert size <= 1024 and size & (size - 1) == 0, "no padding is needed anywhere"
    for key, text in {k: t for k, t in rows if k != 11}.items():
        ids = encode(text or "") + b"\0\0\0\0"
        pieces = sorted(docs[key], key=lambda r: r.start)
        assert pieces[0].doc_tokens == len(ids) // 4 and [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids) // 4
        assert all(zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for p in pieces)
    assert sum(r.length for r in docs[11]) == 2 * docs[11][0].doc_tokens
    groups = defaultdict(int)
    for pieces in sequences.values():
        groups[pieces[0].step_group] += sum(r.length for r in pieces)
    assert max(groups.values()) <= packing.GROUP_TOKENS
    assert packing.pack_documents(frame(spark, rows).limit(0)).count() == 0

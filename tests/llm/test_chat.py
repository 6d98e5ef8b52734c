"""Chat examples against plain string code: escaping, masks, contexts, the round trip, and the edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from folioloom.llm import chat
from harness import differences

KINDS = "conv_id long, turn long, role string, text string, example int"
MARKS = ["[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]"]
ROLES = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}


def escape(text):
    """One backslash more after the first character of each control string, found by looking at every place."""
    out = ""
    for i, c in enumerate(text):
        rest = text[i + 1 :].lstrip("\\")
        out += c + ("\\" if any(c == m[0] and rest.startswith(m[1:]) for m in MARKS) else "")
    return out


def brute(rows):
    """conv_id to (turns, examples); an example is (number, text, start, end, last)."""
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        whole, found = "", []
        for i, (_, _, role, text) in enumerate(sorted(turns)):
            a, b = ROLES.get(role, (f"[ROLE]{escape(role)}[/ROLE]", "[/TURN]"))
            start = len(whole) + len(a)
            whole += a + escape(text) + b
            if role == "assistant":
                found.append((i, whole, start, len(whole) - len(b), i == len(turns) - 1))
            elif i == len(turns) - 1:
                found.append((i, whole, len(whole), len(whole), True))
        out[conv] = ([t[2:] for t in sorted(turns)], found)
    return out


def made(n, seed):
    rng = random.Random(seed)
    pieces = [*MARKS, "<", "[", "/s>", "s>", "INST]", "/INST]", "\\", "\\\\", "ok", " ", "\n", "é漢🙂", "$1", "{}"]
    text = lambda: rng.choice([None, "", "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))])
    return [(rng.randrange(n // 4), rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(["user", "assistant", "assistant", "system", "tool", "", None, "[/ROLE]x", "<s>"]), text(), 0) for _ in range(n)]


def test_examples_and_round_trip(spark):
    rows = made(400, 3)
    rows += rows[:20]
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    want = brute(rows)
    formatted = chat.examples(df)
    got = {}
    for r in formatted.collect():
        got.setdefault(r[0], []).append(tuple(r[1:]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    parsed = formatted.where("last").select("conv_id", chat.Template().turns(F.col("text")).alias("turns")).collect()
    assert {r[0]: [tuple(t) for t in r[1]] for r in parsed} == {k: v[0] for k, v in want.items()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in chat.read_back(formatted).collect():
        turns, found = want[r[0]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert tuple(r)[1:] == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss), sum(len(x[1]) for x in found))


def test_odd_conversations(spark):
    rows = [(None, None, None, None, 1), (None, 1, "assistant", "a", 1), (5, 0, "user", "only a question", 1), (6, 0, "assistant", "", 1), (7, 0, "assistant", "x" * 300_000 + "</s>", 1), (7, 0, "assistant", "", 1)]
    out = {r[0]: r for r in chat.read_back(chat.examples(spark.createDataFrame(rows, KINDS))).collect()}
    assert {k: (r["n_turns"], r["loss_chars"], r["formatted_chars"]) for k, r in out.items()} == {None: (2, 1, 28), 5: (1, 0, 28), 6: (1, 0, 7), 7: (2, 300_004, 300_026)}
    assert chat.read_back(chat.examples(spark.createDataFrame([], KINDS))).count() == 0


def test_own_template_and_names(spark):
    own = chat.Template({"model": ("<m>", "</m>")}, ("<r>", "</r>", "</t>"), "model")
    df = spark.createDataFrame([(1, 0, "a<r>", "q</t>", 3), (1, 1, "model", "<\\m>", 3)], "example long, turn long, role string, text string, last int")
    out = chat.examples(df, own, conv="example")
    assert [tuple(r) for r in out.collect()] == [(1, 1, "<r>a<\\r></r>q<\\/t></t><m><\\\\m></m>", 25, 30, True)]
    assert out.columns == ["example", "_example", "text", "loss_start", "loss_end", "last"] and chat.read_back(out, own, "example").first()["loss_chars"] == 4
    with pytest.raises(ValueError):
        chat.Template({"assistant": ("<<a", "b")})


def test_no_python_on_the_path(spark):
    plan = chat.op12_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    assert differences(spark, chat.op12_chat, chat.ORACLE, f"/root/testdata/{sf}") == ""

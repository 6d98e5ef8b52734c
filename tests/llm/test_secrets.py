"""The lexer of the secrets operator: syntax forms, and random programs against an interpreter of assignments."""

import random
import time

import pytest

from folioloom.llm import secrets

ONE, TWO = "S3cr3t!pass99", "0ther!Key#77"


def literals(text):
    return sorted(text[a:b] for a, b in secrets.lexed(text))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f'db_pwd = """{ONE}"""', [ONE]),
        ("db_pwd = 'S3cr3t\\'pass99'", ["S3cr3t\\'pass99"]),
        (f'cfg["db_pwd"] = "{ONE}"', [ONE]),
        (f'db_pwd: str = "{ONE}"', [ONE]),
        (f"<password>{ONE}</password>", [ONE]),
        (f"<user password='{ONE}'/>", [ONE]),
        ('db_pwd = "S3cr3t!" + "pass99"', ["S3cr3t!", "pass99"]),
        ('db_pwd = ("S3cr3t!"\n   "pass99")', ["S3cr3t!", "pass99"]),
        (f"password: |\n  {ONE}\nnext: 1", [ONE]),
        (f"export DB_PASSWORD={ONE}", [ONE]),
        (f"run --password={ONE} --verbose", [ONE]),
        (f"$k = '{ONE}'; $password = $k;", [ONE]),
        (f'cfg["k2"] = "{ONE}"\npassword = cfg["k2"]', [ONE]),
        (f'prefix = "{ONE}"\npassword = prefix + "x"', [ONE]),
        ('if password == "hunter2hunter2": x', []),
        (f'"private_key": "{ONE}", "b": 1', [ONE]),
        (f'password <- "{ONE}"', [ONE]),
        (f"let apiKey = `{ONE}`;", [ONE]),
        (f"url = 'http://h/?token={ONE}&x=1'", [ONE]),
        (f'password = r"{ONE}"', [ONE]),
        (f'a = "{ONE}"; password_x = a; a = "plain"', [ONE]),
        ("password = os.environ['X']", []),
    ],
)
def test_syntax(text, want):
    assert literals(text) == sorted(want)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f"<password>{ONE}</password>", [ONE]),
        (f"<a>b</a> <db_pwd>{ONE}</db_pwd>", [ONE]),
        (f'db_pwd =\n  "{ONE}"', [ONE]),
        (f'db_pwd = \\\n  "{ONE}"', [ONE]),
        (f'password:\n  "other": "{ONE}"', []),
        (f'db_pwd = ["{ONE}", "{TWO}"]', [ONE, TWO]),
        (f'db_pwd = ("{ONE}", \'{TWO}\')', [ONE, TWO]),
        (f"db_pwds:\n  - '{ONE}'\n  - {TWO}\nx: 1", [ONE, TWO]),
        (f'db_pwd, x = "{ONE}", 1', [ONE]),
        (f'x, db_pwd = 1, "{ONE}"', [ONE]),
        (f'x, y = "{TWO}", "{ONE}"', []),
        (f'<add key="db_pwd" value="{ONE}"/>', [ONE]),
        (f"<property value='{ONE}' name='db.password'/>", [ONE]),
        (f'"credential": {{"value": "{ONE}", "id": 4}}', [ONE]),
        (f'credential = {{"a": {{"b": ["{ONE}"]}}, "c": "{TWO}"}}', [ONE, TWO]),
        (f'db_pwd = os.environ.get("DB_PASSWORD_MAIN", "{ONE}")', [ONE]),
        (f'k = ["{TWO}"]; db_pwd: list[str] = ["{ONE}"]', [ONE]),
        (f'p.w.d = "{ONE}"', [ONE]),
    ],
)
def test_syntax_through_the_scan(spark, text, want):
    found = sorted({text[a:b] for a, k, b in secrets.scan(text) if k == 3})
    assert found == sorted(want)


def test_random_programs_against_an_interpreter():
    """A program of assignments: what reaches a sensitive name through names, sums and subscripts, by a plain fixed point."""
    rng = random.Random(6)
    names = ["a", "b2", "c_x", "self.d", "password", "db_token", "other"]
    for _ in range(400):
        lines, given, passed = [], {n: set() for n in names}, {n: set() for n in names}
        for _ in range(rng.randint(1, 8)):
            target, operands = rng.choice(names), []
            for _ in range(rng.randint(1, 2)):
                if rng.random() < 0.5:
                    value = "Zq9!" + "".join(rng.choice("abcdXYZ0123456789") for _ in range(14))
                    quote = rng.choice(["'", '"', '"""'])
                    operands.append(quote + value + quote)
                    given[target].add(value)
                else:
                    other = rng.choice(names)
                    operands.append(other)
                    passed[target].add(other)
            form = rng.choice(["{} = {}", "{}: str = {}", "{} := {}"] if "." not in target else ["{} = {}"])
            lines.append(form.format(target, rng.choice([" + ", "+ "]).join(operands)))
        want, reach = set(), {"password", "db_token"}
        while True:
            more = reach | {o for n in reach for o in passed[n]}
            if more == reach:
                break
            reach = more
        for n in reach:
            want |= given[n]
        text = "\n".join(lines) + "\n"
        # A sum is one literal: its pieces are reported together, so a name's sum may bring none that is not its own.
        assert set(literals(text)) == want, text


def test_long_and_odd_texts_take_linear_time():
    long = [
        "token=" * 30_000, "a" * 300_000, "a=" * 100_000, 'key="' * 60_000, "x" + " " * 300_000 + "token", "'a':'" * 60_000, '"' + '\\"' * 100_000,
        'password="' + '\\"=\\"' * 50_000, "a-" * 100_000, "password:" + " a|" * 100_000, "<password " * 30_000, "'''token='''" * 20_000, 'x="""' * 50_000,
        "password: |\n " * 20_000, 'token="a" + ' * 30_000, "token: (\n" * 30_000, "$" * 200_000, 'x = "a\\\n' * 50_000,
        "token: [{(" * 30_000, "token," * 50_000, "a, " * 100_000, "token = f(" * 30_000, "token:\n - " * 30_000, "<a token=" * 40_000, 'token=["' * 40_000, "token = \n\n" * 50_000, "<t name='token'" + " a='b'" * 50_000 + ">",
    ]
    began = time.perf_counter()
    for text in long:
        secrets.lexed(text)
    assert time.perf_counter() - began < 30


def test_a_key_named_like_an_output(spark):
    df = spark.createDataFrame([("k", f'password = "{ONE}"', 3)], "spans string, text string, n_hex int")
    assert secrets.scan_documents(df, key="spans").columns == ["spans", "n_assign", "n_access", "n_hex", "base_sha256", "_spans", "n_literal"]
    assert secrets.redact(df).columns == df.columns and ONE not in secrets.redact(df).first().text

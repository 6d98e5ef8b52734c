"""Every query against its SQL, and the flagship query."""

import pytest

import __spark_entry__
from folioloom.plans import registry
from harness import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, name):
    assert differences(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and all(-1 <= r.similarity <= 1 for r in rows)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_names_are_known_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True, timeout=120)

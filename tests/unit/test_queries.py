import math
import subprocess
import sys

import duckdb
import pytest

from podium.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    show = lambda x: "nan" if isinstance(x, float) and math.isnan(x) else str(x)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.collect(), df.columns) == sorted_rows(found.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_lives_without_the_subpackage():
    code = "import sys; sys.modules['podium.llm'] = None; import __spark_entry__ as e; assert 'consensus_percentile' in e.queries() and not any(k.startswith('op') for k in e.queries()) and 'pipeline' not in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_entry_lives_with_an_emptied_subpackage(tmp_path):
    """The folder is there, its modules are not: a leftover cache is enough to make it a namespace."""
    import pathlib
    import shutil

    root = pathlib.Path(__file__).parents[2]
    shutil.copytree(root / "podium", tmp_path / "podium", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "podium" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from podium.llm import decontaminate\n")
    code = "import __spark_entry__ as e; assert 'consensus_percentile' in e.queries() and 'pipeline' not in e.queries() and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})

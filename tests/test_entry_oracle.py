"""Driver contract and every registered query against its DuckDB oracle (sf0.001)."""

import os
import re
import subprocess
import sys

import duckdb
import pytest

from tools.compare import digest
from tidemark.plans.queries import BATCH_QUERIES
from tidemark.sources.tables import TABLES
from tidemark.streaming.jobs import STREAM_QUERIES

SF = "/root/testdata/sf0.001"
HAVE_DATA = os.path.exists(f"{SF}/events.parquet")

import __spark_entry__ as E  # noqa: E402

NAMES = sorted(E.oracle_sql())
CORE = set(BATCH_QUERIES) | set(STREAM_QUERIES)


def test_contract_keys():
    sql, queries = set(E.oracle_sql()), set(E.queries())
    assert sql <= queries
    assert CORE <= sql   # only training-data operators may go without SQL
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in queries - CORE)


def test_entry_without_training_operators():
    """The rest is importable, with its queries and SQL, when the operators are not."""
    code = ("import sys\n"
            "class Absent:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('tidemark.llm', 'corpus_pipeline')):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Absent())\n"
            "import __spark_entry__ as E\n"
            "assert set(E.queries()) == set(E.oracle_sql()), set(E.queries()) ^ set(E.oracle_sql())\n"
            "print(len(E.queries()))\n")
    root = os.path.dirname(os.path.abspath(E.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) == len(CORE)


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["title", "name", "value"]
    assert df.count() == 3


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]

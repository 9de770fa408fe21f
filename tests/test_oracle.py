"""Every registered query against its SQL twin in DuckDB, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return v

    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("key", sorted(entry_module.ORACLES))
def test_query_equals_its_twin(spark, duck, key):
    df = entry_module.queries()[key](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = _sorted(df.select(*columns).collect())
    answer = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({entry_module.oracle_sql()[key]})")
    names = {d[0]: str(d[1]) for d in answer.description}
    theirs = _sorted(answer.fetchall())
    assert names == {c: TYPES[t] for c, t in df.dtypes}
    assert ours == theirs


def test_all_queries_have_a_twin():
    own = entry_module.QUERIES
    assert set(own) <= set(entry_module.queries()) and set(own) == set(entry_module.ORACLES)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert {"track_id", "composite_suspicion_score", "recommended_action"} <= set(df.columns)

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lumenreef.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def canon(rows):
    def show(x):
        return "null" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted(tuple(map(show, r)) for r in rows)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(DIR), reason="test tables are not there")
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    mine = canon(tuple(r[c] for c in columns) for r in df.collect())
    found = duck.execute(registry.ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    theirs = canon(tuple(r[names.index(c)] for c in columns) for r in found.fetchall())
    assert mine == theirs


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)

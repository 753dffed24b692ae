"""SQL checks of the registered corpus queries."""

import duckdb
import __spark_entry__ as entry
from lumenreef.llm import registry

DIR = "/root/testdata/sf0.001"


def test_names():
    found = registry.queries()
    assert [n for n in found if n.startswith("op")] == sorted((n for n in found if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len([n for n in found if n.startswith("op")]) == 13 and "pipeline" in entry.queries()


def test_quality_rules_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    df = registry.queries()["op2_quality_rules"](spark, DIR)
    found = con.execute(registry.oracle_sql()["op2_quality_rules"])
    names = [c[0] for c in found.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(map(tuple, found.fetchall()))

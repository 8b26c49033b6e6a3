"""Every query against its SQL on the smallest tables; queries without SQL must run and return rows."""

import pytest
from conftest import as_rows

from tidemark.plans.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    wanted = duck.sql(SQL[name])
    assert sorted(wanted.columns) == columns
    kinds = dict(zip(wanted.columns, map(str, wanted.types), strict=True))
    assert all(TYPES.get(t, kinds[c]) == kinds[c] for c, t in df.dtypes)
    found = as_rows(tuple(r[c] for c in columns) for r in df.collect())
    assert found == as_rows(wanted.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_does_not_use_the_pipeline_operators():
    import pathlib

    root = pathlib.Path(__file__).parents[1] / "tidemark"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "tidemark.llm" not in path.read_text(), path

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + ":" + os.environ.get("PYTHONPATH", "")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
    }
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con


def as_rows(rows):
    """Comparable rows: lists as tuples, nulls first."""
    plain = lambda v: "~null" if v is None else tuple(map(plain, v)) if isinstance(v, list) else v
    return sorted((str(tuple(plain(v) for v in r)) for r in rows))

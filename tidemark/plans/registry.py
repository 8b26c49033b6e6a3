"""The register of queries and their SQL, and the bindings of coverage tables to the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Orders as dated, tagged articles: segment = newspaper, customer's nation = country.
ARTICLES = """articles as (
    select o_orderkey as article_id, cast(o_orderdate as date) as day, c_mktsegment as newspaper, n_name as country, r_name as region,
           o_orderpriority as category, o_orderstatus as status, o_totalprice as price, o_custkey as file_id
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""


def query(name: str, sql: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame and the SQL that gives the same rows. `{articles}` in the SQL is the binding above."""

    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql.replace("{articles}", ARTICLES)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    files = t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = t("orders").join(files, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("article_id"), F.to_date("o_orderdate").alias("day"), F.col("c_mktsegment").alias("newspaper"), "country", "region",
        F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("file_id"),
    )

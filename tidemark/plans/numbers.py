"""Scalars over numbers, arrays, maps and JSON."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.plans.aggregates import CELLS, shares
from tidemark.plans.registry import articles, query, table

CHANGES = CELLS + ", c as (select country, week, round(share - lag(share) over (partition by country order by week), 6) as change from shares)"


def changes(spark, d):
    change = F.col("share") - F.lag("share").over(Window.partitionBy("country").orderBy("week"))
    return shares(spark, d).select("country", "week", F.round(change, 6).alias("change"))


@query("m1_colour_step", f"with {CHANGES} select country, week, cast(floor(10 * least(1, sqrt(abs(change) / 3.5)) + 0.5) * sign(change) as integer) as step from c")
def m1(spark, d):
    return changes(spark, d).select("country", "week", scores.colour_step(F.col("change")).alias("step"))


@query("m2_rounded", "select c_custkey, round(c_acctbal / 7, 3) as r3, round(c_acctbal / 7, 2) as r2 from customer")
def m2(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(F.col("c_acctbal") / 7, 3).alias("r3"), F.round(F.col("c_acctbal") / 7, 2).alias("r2"))


@query("m3_percent_labels", """
with m as (select date_trunc('month', o_orderdate) as month, count(*) filter (where o_orderstatus = 'P') as n from orders group by 1), b as (select cast(month as date) as month, n, lag(n) over (order by month) as before from m)
select month, case when before = 0 and n = 0 then 'n/a' when before = 0 then 'new' else case when round(100.0 * (n - before) / before, 0) >= 0 then '+' else '' end || cast(cast(round(100.0 * (n - before) / before, 0) as bigint) as varchar) || '%' end as label from b where before is not null""")
def m3(spark, d):
    m = table(spark, d, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count_if(F.col("o_orderstatus") == "P").alias("n"))
    b = m.withColumn("before", F.lag("n").over(Window.orderBy("month"))).where("before is not null")
    return b.select("month", scores.percent_label(F.col("n"), F.col("before")).alias("label"))


@query("m5_low_flags", "with {articles}, n as (select country, newspaper, count(*) as n from articles group by 1, 2) select country, list(n < 120 order by newspaper) as low from n group by 1")
def m5(spark, d):
    n = articles(spark, d).groupBy("country", "newspaper").agg(F.count("*").alias("n"))
    rows = n.groupBy("country").agg(F.array_sort(F.collect_list(F.struct("newspaper", "n"))).alias("s"))
    return rows.select("country", F.transform("s", lambda x: x["n"] < 120).alias("low"))


@query("m6_nested_payload", """with {articles}, n as (select region, country, count(*) as n from articles group by 1, 2)
select region, '{"region":"' || region || '","countries":{' || string_agg('"' || country || '":' || n, ',' order by country) || '}}' as payload from n group by 1""")
def m6(spark, d):
    n = articles(spark, d).groupBy("region", "country").agg(F.count("*").alias("n"))
    rows = n.groupBy("region").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("country", "n")))).alias("countries"))
    return rows.select("region", F.to_json(F.struct("region", "countries")).alias("payload"))


@query("m6_payload_by_paper", """with {articles}, n as (select region, newspaper, country, count(*) as n from articles group by all),
p as (select region, newspaper, '"' || newspaper || '":{' || string_agg('"' || country || '":' || n, ',' order by country) || '}' as part from n group by 1, 2)
select region, '{"region":"' || region || '","per_paper":{' || string_agg(part, ',' order by newspaper) || '}}' as payload from p group by 1""")
def m6_by_paper(spark, d):
    nested = lambda key, value: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))
    n = articles(spark, d).groupBy("region", "newspaper", "country").agg(F.count("*").alias("n"))
    papers = n.groupBy("region", "newspaper").agg(F.to_json(nested("country", "n")).alias("countries"))
    rows = papers.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("newspaper", "countries"))).alias("p"))
    part = F.array_join(F.transform("p", lambda x: F.concat(F.to_json(F.array(x["newspaper"])).substr(F.lit(2), F.length(F.to_json(F.array(x["newspaper"]))) - 2), F.lit(":"), x["countries"])), ",")
    return rows.select("region", F.concat(F.lit('{"region":"'), "region", F.lit('","per_paper":{'), part, F.lit("}}")).alias("payload"))


@query("m7_payload_state", f"with {CHANGES} select country, week, case when change is null then 'none' when n_named < 5 then 'low' else cast(cast(floor(10 * least(1, sqrt(abs(change) / 3.5)) + 0.5) * sign(change) as integer) as varchar) end as state from c join shares using (country, week)")
def m7(spark, d):
    s = changes(spark, d).join(shares(spark, d).select("country", "week", "n_named"), ["country", "week"])
    state = F.when(F.col("change").isNull(), "none").when(F.col("n_named") < 5, "low").otherwise(scores.colour_step(F.col("change")).cast("string"))
    return s.select("country", "week", state.alias("state"))


@query("m8_json_fields", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def m8(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("m9_assignments", """
with a as (select l_orderkey, l_partkey, l_suppkey % 7 as n, l_linenumber as pos from lineitem)
select l_orderkey, l_partkey, arg_min(n, (pos, n)) as n from a where n between 1 and 5 and l_partkey in (select p_partkey from part where p_size > 10) group by 1, 2""")
def m9(spark, d):
    a = table(spark, d, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").alias("pos"), F.col("l_partkey").cast("string").alias("id"), (F.col("l_suppkey") % 7).cast("string").alias("n")).alias("e"))
    lists = a.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list("e"))).alias("assigned"))
    entries = lists.select("l_orderkey", F.explode(F.from_json("assigned", "array<struct<pos:int,id:string,n:string>>")).alias("e"))
    rows = entries.select("l_orderkey", F.expr("try_cast(e.id as bigint)").alias("l_partkey"), F.expr("try_cast(e.n as bigint)").alias("n"), "e.pos").where("n between 1 and 5")
    valid = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return rows.join(valid, "l_partkey", "left_semi").groupBy("l_orderkey", "l_partkey").agg(F.min_by("n", F.struct("pos", "n")).alias("n"))


@query("m10_intensity_scale", "with {articles}, n as (select region, count(*) as n from articles group by 1) select region, round(cast(n as double) / max(n) over (), 6) as level, round(20 + 35 * cast(n as double) / max(n) over (), 4) as percent from n")
def m10(spark, d):
    n = articles(spark, d).groupBy("region").agg(F.count("*").alias("n"))
    level = F.col("n") / F.max("n").over(Window.partitionBy())
    return n.select("region", F.round(level, 6).alias("level"), F.round(20 + 35 * level, 4).alias("percent"))


@query("m11_breaks_crossed", """
with b as (select * from (values ('sources', 3), ('countries', 10), ('rules', 11)) t(axis, at_week)), w as (select unnest(range(4, 20)) as week)
select cast(week as integer) as week, list(axis order by axis) as axes from w join b on at_week > week - 4 and at_week <= week group by 1""")
def m11(spark, d):
    breaks = spark.createDataFrame([("sources", 3), ("countries", 10), ("rules", 11)], "axis string, at_week int")
    weeks = spark.range(4, 20).select(F.col("id").cast("int").alias("week"))
    crossed = weeks.join(F.broadcast(breaks), F.expr("at_week > week - 4 and at_week <= week"))
    return crossed.groupBy("week").agg(F.array_sort(F.collect_list("axis")).alias("axes"))

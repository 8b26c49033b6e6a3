"""The flagship trend and its payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import trends
from tidemark.plans.registry import query, table


@query("week_trend", """
with e as (select event_type, user_id, event_id, cast(ts as date) as day from events), f as (select min(day) as first, max(day) as last from e),
g as (select cast(unnest(range(0, cast(floor(date_diff('day', first, last) / 7.0) as bigint) + 1)) as integer) as week from f),
n as (select event_type, cast(floor(date_diff('day', first, day) / 7.0) as integer) as week, count(distinct user_id) as s, count(distinct event_id) as i from e, f group by 1, 2)
select k.event_type, g.week, coalesce(n.s, 0) as n_sources, coalesce(n.i, 0) as n_items, coalesce(n.i, 0) < 10 as low_volume, first + g.week * 7 + 6 > last as partial
from (select distinct event_type from e) k cross join g cross join f left join n on n.event_type = k.event_type and n.week = g.week""")
def week_trend(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return trends.distinct_trend(e, "event_type", "day", "user_id", "event_id")


@query("m4_aligned_series", """
with f as (select min(cast(ts as date)) as first from events), n as (select event_type, cast(floor(date_diff('day', first, cast(ts as date)) / 7.0) as integer) as week, count(distinct event_id) as n from events, f group by 1, 2)
select event_type, list(n order by week) as series, list(n < 500 order by week) as low from n group by 1""")
def m4(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    t = trends.distinct_trend(e, "event_type", "day", "user_id", "event_id")
    rows = t.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct("week", "n_items"))).alias("s"))
    values = F.transform("s", lambda x: x["n_items"])
    return rows.select("event_type", values.alias("series"), F.transform(values, lambda n: n < 500).alias("low"))

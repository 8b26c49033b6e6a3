"""Aggregations. Distinct counts are exact."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scores, text
from tidemark.operators import trends
from tidemark.plans.registry import articles, query, table


@query("a1_distinct_by_day", "with {articles} select day as rdate, count(distinct article_id) as n from articles group by 1")
def a1(spark, d):
    return articles(spark, d).groupBy(F.col("day").alias("rdate")).agg(F.countDistinct("article_id").alias("n"))


@query("a2_distinct_rows", "with {articles} select distinct newspaper, country, category from articles")
def a2(spark, d):
    return articles(spark, d).select("newspaper", "country", "category").distinct()


@query("a3_tag_ratios", """
with per as (select l_orderkey, count(*) as n from lineitem where l_returnflag != 'N' group by 1),
a as (select cast(date_trunc('month', o_orderdate) as date) as month, case when o_orderpriority = '5-LOW' then null else o_orderpriority end as mode,
      count(*) as articles, count(per.n) as primary_tags, coalesce(sum(per.n - 1), 0) as secondary_tags from orders left join per on l_orderkey = o_orderkey group by 1, 2)
select month, mode, articles, primary_tags, cast(secondary_tags as bigint) as secondary_tags, round(secondary_tags / nullif(primary_tags, 0), 3) as ratio from a""")
def a3(spark, d):
    per = table(spark, d, "lineitem").where("l_returnflag != 'N'").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    o = table(spark, d, "orders").join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    o = o.withColumns({"month": F.trunc(F.to_date("o_orderdate"), "month"), "mode": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))})
    out = o.groupBy("month", "mode").agg(F.count("*").alias("articles"), F.count("n").alias("primary_tags"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("secondary_tags"))
    return out.withColumn("ratio", F.round(F.try_divide("secondary_tags", "primary_tags"), 3))


@query("a4_sum_or_zero", "select cast(coalesce(sum(case when event_type = 'none' then 1 end), 0) as bigint) as none, cast(coalesce(sum(event_id), 0) as bigint) as total from events")
def a4(spark, d):
    return table(spark, d, "events").agg(F.coalesce(F.sum(F.when(F.col("event_type") == "none", 1)), F.lit(0).cast("long")).alias("none"), F.coalesce(F.sum("event_id"), F.lit(0).cast("long")).alias("total"))


@query("a5_conditional", """
select o_orderstatus, count(*) filter (where o_orderpriority = '1-URGENT') as urgent, cast(sum(case when o_totalprice > 200000 then 1 else 0 end) as bigint) as large from orders group by 1""")
def a5(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.sum(F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)).alias("large"))


@query("a6_min_per_group", "select l_suppkey, min(l_orderkey) as first_order, cast(min(l_shipdate) as date) as first_day from lineitem group by 1")
def a6(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min("l_orderkey").alias("first_order"), F.to_date(F.min("l_shipdate")).alias("first_day"))


USAGE = """usage as (
    select cast(l_shipdate as date) as day, case when l_returnflag = 'R' then 'screen_batch' when l_returnflag = 'A' then 'analyze' else 'synthesize' end as stage,
           cast(l_quantity * 100 as bigint) as tokens_in, cast(l_linenumber * 10 as bigint) as tokens_out, cast(l_partkey % 50 as bigint) as written, cast(l_suppkey % 90 as bigint) as read,
           case when l_linestatus = 'O' then 2.0 when l_shipdate < timestamp '1996-01-01' then 1.0 end as price_in, l_orderkey as ref
    from lineitem), priced as (
    select *, (tokens_in * price_in + written * price_in * 1.25 + read * price_in * 0.1 + tokens_out * price_in * 5) / 1e6 * (case when stage like '%\\_batch' escape '\\' then 0.5 else 1.0 end) as cost from usage)"""


def usage(spark, d):
    """Line items as a log of calls with a price for some models only."""
    li = table(spark, d, "lineitem")
    stage = F.when(F.col("l_returnflag") == "R", "screen_batch").when(F.col("l_returnflag") == "A", "analyze").otherwise("synthesize")
    price = F.when(F.col("l_linestatus") == "O", 2.0).when(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp"), 1.0)
    u = li.select(
        F.to_date("l_shipdate").alias("day"), stage.alias("stage"), (F.col("l_quantity") * 100).cast("long").alias("tokens_in"), (F.col("l_linenumber") * 10).cast("long").alias("tokens_out"),
        (F.col("l_partkey") % 50).alias("written"), (F.col("l_suppkey") % 90).alias("read"), price.alias("price_in"), F.col("l_orderkey").alias("ref"),
    )
    return u.withColumn("cost", scores.call_cost(*map(F.col, ("tokens_in", "tokens_out", "written", "read", "price_in")), F.col("price_in") * 5, F.col("stage")))


@query("a7_usage_rollup", f"""with {USAGE}
select case when grouping(month) = 0 then month end as month, case when grouping(stage) = 0 then stage end as stage, count(*) as calls, cast(sum(tokens_in) as bigint) as tokens_in,
       cast(sum(tokens_out) as bigint) as tokens_out, round(coalesce(sum(cost), 0), 4) as cost, count(*) filter (where cost is null) as unpriced
from (select *, cast(date_trunc('month', day) as date) as month from priced) group by grouping sets ((month), (stage), (month, stage), ())""")
def a7(spark, d):
    u = usage(spark, d).withColumn("month", F.trunc("day", "month"))
    sums = [F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.round(F.coalesce(F.sum("cost"), F.lit(0.0)), 4).alias("cost"), F.count_if(F.col("cost").isNull()).alias("unpriced")]
    return u.groupingSets([["month"], ["stage"], ["month", "stage"], []], "month", "stage").agg(*sums)


@query("a8_cache_rate", f"""with {USAGE}
select stage, count(*) as calls, round(coalesce(sum(read) / nullif(sum(tokens_in) + sum(written) + sum(read), 0), 0), 6) as hit_rate from priced where day >= date '1998-01-01' and stage like 's%' group by 1""")
def a8(spark, d):
    u = usage(spark, d).where((F.col("day") >= "1998-01-01") & F.col("stage").startswith("s"))
    rate = F.coalesce(F.try_divide(F.sum("read"), F.sum("tokens_in") + F.sum("written") + F.sum("read")), F.lit(0.0))
    return u.groupBy("stage").agg(F.count("*").alias("calls"), F.round(rate, 6).alias("hit_rate"))


@query("a9_call_cost", f"with {USAGE} select ref, stage, tokens_in, round(cost, 10) as cost from priced")
def a9(spark, d):
    return usage(spark, d).select("ref", "stage", "tokens_in", F.round("cost", 10).alias("cost"))


@query("a10_coverage", """with {articles}, n as (select count(distinct day) as days from articles)
select country, round(count(distinct day) / max(days), 6) as fraction from articles, n group by 1""")
def a10(spark, d):
    a = articles(spark, d)
    n = a.agg(F.countDistinct("day").alias("days"))
    return a.groupBy("country").agg(F.countDistinct("day").alias("n")).crossJoin(F.broadcast(n)).select("country", F.round(F.col("n") / F.col("days"), 6).alias("fraction"))


@query("a11_eligible", """with {articles}, n as (select count(distinct date_trunc('month', day)) as months from articles)
select country, newspaper from articles, n group by 1, 2 having count(distinct date_trunc('month', day)) / max(months) >= 0.85""")
def a11(spark, d):
    a = articles(spark, d).withColumn("month", F.trunc("day", "month"))
    n = a.agg(F.countDistinct("month").alias("months"))
    per = a.groupBy("country", "newspaper").agg(F.countDistinct("month").alias("n"))
    return per.crossJoin(F.broadcast(n)).where(F.col("n") / F.col("months") >= 0.85).select("country", "newspaper")


@query("a12_weekly_distinct", """
with e as (select event_type, user_id, event_id, cast(ts as date) as day from events), f as (select min(day) as first, max(day) as last from e),
g as (select cast(unnest(range(0, cast(floor(date_diff('day', first, last) / 7.0) as bigint) + 1)) as integer) as week from f),
n as (select event_type, cast(floor(date_diff('day', first, day) / 7.0) as integer) as week, count(distinct user_id) as s, count(distinct event_id) as i from e, f where event_id % 3 = 0 group by 1, 2)
select k.event_type, g.week, coalesce(n.s, 0) as n_sources, coalesce(n.i, 0) as n_items, coalesce(n.i, 0) < 10 as low_volume, first + g.week * 7 + 6 > last as partial
from (select distinct event_type from e) k cross join g cross join f left join n on n.event_type = k.event_type and n.week = g.week""")
def a12(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return trends.distinct_trend(e, "event_type", "day", "user_id", "event_id", F.col("event_id") % 3 == 0)


@query("a13_weekly_by_region", """with {articles}, f as (select min(day) as first from articles)
select region, cast(floor(date_diff('day', first, day) / 7.0) as integer) as week, count(distinct newspaper) as n_sources, count(distinct article_id) as n_items from articles, f group by 1, 2""")
def a13(spark, d):
    a = trends.with_week(articles(spark, d), "day")
    return a.groupBy("region", "week").agg(F.countDistinct("newspaper").alias("n_sources"), F.countDistinct("article_id").alias("n_items"))


CELLS = """{articles}, f as (select min(day) as first from articles),
cells as (select newspaper, cast(floor(date_diff('day', first, day) / 28.0) as integer) as week, country, count(distinct article_id) as n from articles, f group by all),
paired as (select *, sum(n) over (partition by week, newspaper) as pairs from cells),
totals as (select week, count(distinct newspaper) as reporting, sum(n) as all_pairs from cells group by 1),
shares as (select week, country, 100 * sum(n / pairs) / max(reporting) as share, 100 * sum(n) / max(all_pairs) as pooled, sum(n) as n_named from paired join totals using (week) group by all)"""


def shares(spark, d):
    """Equal-weight shares of countries over runs of four weeks."""
    return trends.source_shares(trends.with_week(articles(spark, d), "day", 28), "week", "newspaper", "country", "article_id")


@query("a14_cells", f"with {CELLS} select newspaper, week, country, n, cast(pairs as bigint) as pairs from paired")
def a14(spark, d):
    cells = trends.with_week(articles(spark, d), "day", 28).groupBy("newspaper", "week", "country").agg(F.countDistinct("article_id").alias("n"))
    return cells.withColumn("pairs", F.sum("n").over(Window.partitionBy("week", "newspaper")))


@query("a15_equal_weight_share", f"with {CELLS} select week, country, round(share, 6) as share, cast(n_named as bigint) as n_named from shares")
def a15(spark, d):
    return shares(spark, d).select("week", "country", F.round("share", 6).alias("share"), "n_named")


@query("a16_pooled_share", f"with {CELLS} select week, country, round(pooled, 6) as pooled from shares")
def a16(spark, d):
    return shares(spark, d).select("week", "country", F.round("pooled", 6).alias("pooled"))


@query("a17_remainder", f"with {CELLS} select week, round(greatest(0, 100 - sum(share)), 4) as other from shares where n_named >= 8 group by 1")
def a17(spark, d):
    return shares(spark, d).where("n_named >= 8").groupBy("week").agg(F.round(F.greatest(F.lit(0.0), 100 - F.sum("share")), 4).alias("other"))


@query("a18_candidates", """with {articles}, n as (select country, count(*) as n from articles where newspaper in ('BUILDING', 'AUTOMOBILE') group by 1), tiles as (select distinct n_name as country from nation where n_regionkey < 3)
select coalesce(n.country, tiles.country) as country, case when tiles.country is null then 'without tile' when coalesce(n.n, 0) < 230 then 'tile below' else 'tile' end as kind
from (select * from n where n >= 230) big full join tiles on tiles.country = big.country left join n on n.country = coalesce(big.country, tiles.country)""")
def a18(spark, d):
    n = articles(spark, d).where(F.col("newspaper").isin("BUILDING", "AUTOMOBILE")).groupBy("country").agg(F.count("*").alias("n"))
    tiles = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_name").alias("country")).distinct().withColumn("tile", F.lit(True))
    kind = F.when(F.col("tile").isNull(), "without tile").when(F.coalesce("n", F.lit(0)) < 230, "tile below").otherwise("tile")
    return n.join(tiles, "country", "full").where("n >= 230 or tile").select("country", kind.alias("kind"))


@query("a19_roster", """with {articles}, f as (select min(day) as first from articles)
select cast(floor(date_diff('day', first, day) / 7.0) as integer) as week, list_sort(list(distinct newspaper)) as roster from articles, f group by 1""")
def a19(spark, d):
    return trends.with_week(articles(spark, d), "day").groupBy("week").agg(F.array_sort(F.collect_set("newspaper")).alias("roster"))


DAYS = """{articles}, tags as (select l_orderkey, count(*) as tags from lineitem group by 1), days as (
    select day, case when dayofweek(day) in (0, 6) then 'weekend' else 'weekday' end as kind, newspaper, count(*) as items, cast(coalesce(sum(tags), 0) as bigint) as tags
    from articles left join tags on l_orderkey = article_id group by all)"""


def day_metrics(spark, d):
    """Articles and tags by day and newspaper."""
    tags = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("article_id")).agg(F.count("*").alias("tags"))
    a = articles(spark, d).join(tags, "article_id", "left")
    kind = F.when(F.weekday("day") >= 5, "weekend").otherwise("weekday")
    return a.groupBy("day", kind.alias("kind"), "newspaper").agg(F.count("*").alias("items"), F.coalesce(F.sum("tags"), F.lit(0)).alias("tags"))


@query("a20_mix_baseline", f"with {DAYS} select kind, newspaper, cast(sum(items) as bigint) as items, cast(sum(tags) as bigint) as tags from days group by 1, 2")
def a20(spark, d):
    return day_metrics(spark, d).groupBy("kind", "newspaper").agg(F.sum("items").alias("items"), F.sum("tags").alias("tags"))


RATIOS = DAYS + """, base as (select kind, newspaper, sum(tags) / sum(items) as rate from days group by 1, 2),
ratios as (select day, kind, sum(items) as items, sum(tags) as actual, sum(items * rate) as expected, sum(tags) / sum(items * rate) as ratio from days join base using (kind, newspaper) group by 1, 2)"""


@query("a21_expected", f"with {RATIOS} select day, kind, cast(items as bigint) as items, cast(actual as bigint) as actual, round(expected, 6) as expected, round(ratio, 6) as ratio from ratios")
def a21(spark, d):
    r = trends.mix_adjusted(day_metrics(spark, d), "day", "kind", "newspaper", "items", "tags")
    return r.select("day", "kind", "items", "actual", F.round("expected", 6).alias("expected"), F.round("ratio", 6).alias("ratio"))


SPREAD = RATIOS + """, sums as (select *, count(ratio) over (partition by kind) - 1 as others, sum(ratio) over (partition by kind) - ratio as t, sum(ratio * ratio) over (partition by kind) - ratio * ratio as q from ratios where items >= 5),
spread as (select *, case when others >= 3 then t / others end as mean, sqrt(greatest(q / nullif(others, 0) - (t / others) * (t / others), 0)) as sd from sums)"""


def spread(spark, d):
    r = trends.mix_adjusted(day_metrics(spark, d), "day", "kind", "newspaper", "items", "tags").where("items >= 5")
    return trends.leave_one_out(r, ["kind"], "ratio")


@query("a22_leave_one_out", f"with {SPREAD} select day, cast(others as bigint) as others, round(mean, 6) as mean, round(sd, 5) as sd from spread")
def a22(spark, d):
    return spread(spark, d).select("day", "others", F.round("mean", 6).alias("mean"), F.round("sd", 5).alias("sd"))


@query("a23_z_scores", f"with {SPREAD} select day, kind, round((ratio - mean) / nullif(sd, 0), 4) as z from spread")
def a23(spark, d):
    return spread(spark, d).select("day", "kind", F.round("z", 4).alias("z"))


@query("a24_orphans", """
select source, count(*) as total, count(*) filter (where l.doc_id is null) as orphans, round(100.0 * count(*) filter (where l.doc_id is null) / count(*), 1) as pct
from documents d left join labels l using (doc_id) group by 1""")
def a24(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", F.lit(1).alias("linked")), "doc_id", "left")
    out = docs.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("linked").isNull()).alias("orphans"))
    return out.withColumn("pct", F.round(100 * F.col("orphans") / F.col("total"), 1))


@query("a25_orphan_cause", """
select o_orderkey, case when n is null then 1 when first_ship < o_orderdate + interval 30 day then 2 else 3 end as cause
from orders left join (select l_orderkey, count(*) as n, min(l_shipdate) as first_ship from lineitem where l_returnflag = 'R' group by 1) on l_orderkey = o_orderkey""")
def a25(spark, d):
    r = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    o = table(spark, d, "orders").join(r, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return o.select("o_orderkey", F.when(F.col("first_ship").isNull(), 1).when(F.col("first_ship") < F.col("o_orderdate") + F.expr("interval 30 days"), 2).otherwise(3).alias("cause"))


@query("a26_span_histogram", """
with runs as (select cast(l_shipdate as date) as run, count(distinct date_trunc('month', o_orderdate)) as days, date_diff('day', min(cast(o_orderdate as date)), max(cast(o_orderdate as date))) as span
              from lineitem join orders on o_orderkey = l_orderkey group by 1)
select cast(span // 30 as bigint) as span_months, count(*) as runs, count(*) filter (where days >= 2) as backlogs from runs group by 1""")
def a26(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    day = F.to_date("o_orderdate")
    runs = li.groupBy(F.to_date("l_shipdate").alias("run")).agg(F.countDistinct(F.trunc(day, "month")).alias("days"), F.datediff(F.max(day), F.min(day)).alias("span"))
    return runs.groupBy(F.expr("span div 30").alias("span_months")).agg(F.count("*").alias("runs"), F.count_if(F.col("days") >= 2).alias("backlogs"))


@query("a27_inverted_index", "with {articles} select region, country, list_sort(list(distinct article_id)) as ids from articles where category = '1-URGENT' and price > 200000 group by 1, 2")
def a27(spark, d):
    return articles(spark, d).where("category = '1-URGENT' and price > 200000").groupBy("region", "country").agg(F.array_sort(F.collect_set("article_id")).alias("ids"))


@query("a28_coverage_pair", "with {articles} select day, count(*) as n_sources, count(distinct case when region = 'EUROPE' then 'eu' else country end) as n_languages from articles group by 1")
def a28(spark, d):
    language = F.coalesce(F.when(F.col("region") == "EUROPE", "eu"), F.col("country"))
    return articles(spark, d).groupBy("day").agg(F.count("*").alias("n_sources"), F.countDistinct(language).alias("n_languages"))


@query("a29_grouping_audit", """
with valid as (select p_partkey from part), seen as (select l_partkey, count(distinct l_suppkey) as n from lineitem group by 1)
select (select count(*) from valid where p_partkey not in (select l_partkey from seen)) as missing, (select count(*) from seen where n > 1) as duplicated,
       round(((select count(*) from valid where p_partkey not in (select l_partkey from seen)) + (select count(*) from seen where n > 1)) / nullif((select count(*) from valid), 0), 6) as problem_ratio""")
def a29(spark, d):
    valid = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    seen = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.countDistinct("l_suppkey").alias("n"))
    out = valid.join(seen, "id", "left").agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("duplicated"), F.count("*").alias("all"))
    return out.select("missing", "duplicated", F.round(F.try_divide(F.col("missing") + F.col("duplicated"), F.col("all")), 6).alias("problem_ratio"))


@query("a30_multi_assigned", "select l_partkey, list_sort(list(distinct l_suppkey)) as groups from lineitem group by 1 having count(distinct l_suppkey) > 1")
def a30(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("groups"))
    return g.where(F.size("groups") > 1)


@query("a31_topics", """
select l_suppkey, list_sort(list(distinct cast(o_orderdate as date))) as dates, count(distinct cast(o_orderdate as date)) as n_days, count(distinct o_custkey) as n_sources
from lineitem join orders on o_orderkey = l_orderkey group by 1 having count(distinct cast(o_orderdate as date)) >= 5""")
def a31(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    day = F.to_date("o_orderdate")
    out = li.groupBy("l_suppkey").agg(F.array_sort(F.collect_set(day)).alias("dates"), F.countDistinct(day).alias("n_days"), F.countDistinct("o_custkey").alias("n_sources"))
    return out.where("n_days >= 5").orderBy(F.desc("n_sources"), "l_suppkey")


@query("a32_depth_tiers", """
select case when n >= 8 then 'deep' when n >= 5 then 'developed' else 'concise' end as tier, count(*) as n from (select l_orderkey, count(*) as n from lineitem group by 1) group by 1""")
def a32(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return n.groupBy(scores.depth_tier(F.col("n")).alias("tier")).agg(F.count("*").alias("n"))


@query("a38_order_statistics", """
with p as (select event_type, value, row_number() over (partition by event_type order by value) - 1 as p, count(*) over (partition by event_type) as n from events)
select event_type, count(*) as n, round(sum(value), 4) as total, round(avg(value), 6) as mean, max(case when p = n // 2 then value end) as median, max(case when p = least(cast(floor(0.95 * n) as bigint), n - 1) then value end) as p95, max(value) as max from p group by 1""")
def a38(spark, d):
    out = trends.order_statistics(table(spark, d, "events").select("event_type", "value"), ["event_type"], "value")
    return out.withColumns({"total": F.round("total", 4), "mean": F.round("mean", 6)})


@query("a39_title_groups", r"""
select name, count(*) as n, min(file) as first_file, max(file) as last_file from (
    select regexp_replace(s_name, '#', ' #') as file, trim(regexp_replace(regexp_replace(regexp_replace(lower(s_name), '\.[a-z0-9]{2,4}$', ''), '\d+', ' ', 'g'), '[\s_\-.,]+', ' ', 'g')) as name from supplier) group by 1 having count(*) >= 2""")
def a39(spark, d):
    s = table(spark, d, "supplier").select(F.replace("s_name", F.lit("#"), F.lit(" #")).alias("file"), text.without_dates(F.col("s_name")).alias("name"))
    return s.groupBy("name").agg(F.count("*").alias("n"), F.min("file").alias("first_file"), F.max("file").alias("last_file")).where("n >= 2")


@query("a40_volume_note", "select cast(ts as date) as day, count(*) as n, count(*) > 320 as warning from events group by 1")
def a40(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")).withColumn("warning", F.col("n") > 320)


@query("a41_stage_counts", """
select (select count(*) from pages) as pages, (select count(*) from documents) as items, (select count(*) from labels where quality = 1) as relevant,
       round((select count(*) from pages) * 0.002 + (select count(*) from documents) * 0.005::double, 4) as estimate""")
def a41(spark, d):
    count = lambda t, c, n: table(spark, d, t).where(c).agg(F.count("*").alias(n))
    one = count("pages", "true", "pages").crossJoin(count("documents", "true", "items")).crossJoin(count("labels", "quality = 1", "relevant"))
    return one.withColumn("estimate", F.round(F.col("pages") * 0.002 + F.col("items") * 0.005, 4))


@query("a42_flags_by_source", "select source, count(*) filter (where length(text) < 50) as short, count(*) filter (where regexp_matches(text, '</\\w+')) as tagged from documents group by 1")
def a42(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count_if(F.length("text") < 50).alias("short"), F.count_if(F.col("text").rlike(r"</\w+")).alias("tagged"))


@query("a43_intensity", "with {articles}, n as (select country, count(*) as n from articles group by 1) select country, n, round(20 + 35 * n / max(n) over (), 6) as intensity from n")
def a43(spark, d):
    n = articles(spark, d).groupBy("country").agg(F.count("*").alias("n"))
    most = n.agg(F.max("n").alias("most"))
    return n.crossJoin(F.broadcast(most)).select("country", "n", F.round(20 + 35 * F.col("n") / F.col("most"), 6).alias("intensity"))

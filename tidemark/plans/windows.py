"""Orders within groups: outliers, first rows, streaks, packing, paging, top rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.operators import ordered, relational, trends
from tidemark.plans.aggregates import CELLS, SPREAD, shares, spread
from tidemark.plans.registry import articles, query, table


@query("w1_neighbour_outliers", """
with n as (select cast(o_orderdate as date) as day, count(*) as total from orders group by 1),
b as (select day, total, list_sort(list_concat(coalesce(list(total) over (order by day rows between 3 preceding and 1 preceding), []), coalesce(list(total) over (order by day rows between 1 following and 3 following), []))) as around from n),
m as (select day, total, (around[(len(around) + 1) // 2] + around[len(around) // 2 + 1]) / 2 as baseline from b)
select day, total, baseline, coalesce(total / nullif(baseline, 0) >= 2.5, false) as flagged from m""")
def w1(spark, d):
    days = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("total"))
    return trends.neighbour_outliers(days, "day", "total")


@query("w2_first_of_text", "select doc_id, min(doc_id) over (partition by source, md5(text)) = doc_id as is_first from documents")
def w2(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("h"))
    return relational.duplicates_of_first(docs, ["source", "h"], ["doc_id"]).select("doc_id", "is_first")


@query("w3_canonical_in_batch", "select doc_id, min(doc_id) over (partition by md5(text), doc_id // 100) as canonical from documents")
def w3(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("h"), F.expr("doc_id div 100").alias("batch"))
    return relational.duplicates_of_first(docs, ["h", "batch"], ["doc_id"]).select("doc_id", F.col("first_doc_id").alias("canonical"))


GRID = CELLS + """, g as (select country, cast(week as integer) as week from (select distinct country from shares), (select unnest(range(0, (select max(week) + 1 from shares))) as week)),
series as (select g.country, g.week, shares.share, cast(coalesce(n_named, 0) as bigint) as n_named from g left join shares using (country, week))"""


def series(spark, d):
    s = shares(spark, d)
    weeks = s.agg(F.max("week").alias("last")).select(F.explode(F.sequence(F.lit(0), "last")).alias("week"))
    return relational.filled_grid(s.select("country", "week", "share", "n_named"), s.select("country").distinct(), weeks, ["country", "week"], "n_named")


@query("w4_strict_change", f"""with {GRID}
select country, week, round(case when week >= 4 then share - avg(coalesce(share, 0)) over (partition by country order by week rows between 4 preceding and 1 preceding) end, 6) as change from series""")
def w4(spark, d):
    return trends.strict_change(series(spark, d), "country", "week", "share", 4).select("country", "week", F.round("change", 6).alias("change"))


@query("w5_thin_evidence", f"""with {GRID}
select country, week, n_named < 5 or coalesce(avg(n_named) over (partition by country order by week rows between 4 preceding and 1 preceding), 0) < 5 as thin from series""")
def w5(spark, d):
    mean = F.avg("n_named").over(Window.partitionBy("country").orderBy("week").rowsBetween(-4, -1))
    return series(spark, d).withColumn("mean", mean).select("country", "week", trends.thin_evidence(F.col("n_named"), F.col("mean"), 5).alias("thin"))


@query("w6_sign_agreement", f"""with {CELLS}, c as (select country, week, round(share - lag(share) over w, 9) as a, round(pooled - lag(pooled) over w, 9) as b from shares window w as (partition by country order by week))
select country, week, sign(a) = sign(b) as same from c""")
def w6(spark, d):
    w = Window.partitionBy("country").orderBy("week")
    step = lambda c: F.round(F.col(c) - F.lag(c).over(w), 9)
    return shares(spark, d).withColumns({"a": step("share"), "b": step("pooled")}).select("country", "week", trends.same_sign(F.col("a"), F.col("b")).alias("same"))


@query("w7_drift_alerts", f"""with {SPREAD}, z as (select day, kind, round((ratio - mean) / nullif(sd, 0), 4) as z from spread)
select day, coalesce(z < -2 or (date_diff('day', lag(day, 2) over w, day) = 2 and max(z) over (partition by kind order by day rows between 2 preceding and current row) < -1.5), false) as alert from z window w as (partition by kind order by day)""")
def w7(spark, d):
    return trends.drift_alerts(spread(spark, d).select("day", "kind", F.round("z", 4).alias("z")), "kind", "day", "z").select("day", "alert")


@query("w8_week_over_week", """with {articles}, f as (select min(day) as first from articles), n as (
    select country, cast(floor(date_diff('day', first, day) / 28.0) as integer) as week, count(*) as n from articles, f group by all),
g as (select country, cast(week as integer) as week from (select distinct country from n), (select unnest(range(0, (select max(week) + 1 from n))) as week)),
s as (select country, week, coalesce(n, 0) as n from g left join n using (country, week)), b as (select *, lag(n) over (partition by country order by week) as before from s)
select country, week, round(case when before = 0 and n = 0 then 0.0 when before = 0 then null else cast(100 as double) * (n - before) / before end, 6) as pct from b""")
def w8(spark, d):
    n = trends.with_week(articles(spark, d), "day", 28).groupBy("country", "week").agg(F.count("*").alias("n"))
    weeks = n.agg(F.max("week").alias("last")).select(F.explode(F.sequence(F.lit(0), "last")).alias("week"))
    grid = relational.filled_grid(n, n.select("country").distinct(), weeks, ["country", "week"], "n")
    return trends.week_change(grid, "country", "week", "n").select("country", "week", F.round("pct", 6).alias("pct"))


@query("w9_period_totals", """
with m as (select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n from orders group by 1), b as (select month, n, lag(n) over (order by month) as before from m)
select month, n, before, round(100.0 * (n - before) / before, 3) as pct from b""")
def w9(spark, d):
    m = table(spark, d, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count("*").alias("n"))
    b = m.withColumn("before", F.lag("n").over(Window.orderBy("month")))
    return b.withColumn("pct", F.round(100 * (F.col("n") - F.col("before")) / F.col("before"), 3))


@query("w10_latest_full_week", """
with f as (select min(cast(ts as date)) as first, max(cast(ts as date)) as last from events)
select last, first + cast((date_diff('day', first, last) + 1) // 7 * 7 - 7 as integer) as week_start, first + cast((date_diff('day', first, last) + 1) // 7 * 7 - 1 as integer) as week_end from f""")
def w10(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    full = trends.week_grid(e, "day").where("not partial").agg(F.max(F.struct("week", "start", "end")).alias("w"))
    return full.crossJoin(e.agg(F.max("day").alias("last"))).select("last", F.col("w.start").alias("week_start"), F.col("w.end").alias("week_end"))


@query("w11_citation_groups", "select conv_id, turn, count(*) over (partition by conv_id, role) > 1 as grouped from conversations")
def w11(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", (F.count("*").over(Window.partitionBy("conv_id", "role")) > 1).alias("grouped"))


@query("w12_first_of_category", "with {articles} select category, arg_min(article_id, (-price, article_id)) as first_id from articles where day = (select max(day) from articles) group by 1")
def w12(spark, d):
    a = articles(spark, d)
    last = a.agg(F.max("day").alias("last"))
    return a.join(F.broadcast(last), F.col("day") == F.col("last")).groupBy("category").agg(F.min_by("article_id", F.struct(-F.col("price"), F.col("article_id"))).alias("first_id"))


PACKED = """
with recursive d as (select lang, doc_id, n_chars, row_number() over (partition by lang order by doc_id) as k from documents),
f as (select lang, doc_id, n_chars, k, 0 as w, cast(n_chars as double) as used from d where k = 1
      union all select d.lang, d.doc_id, d.n_chars, d.k, case when f.used > 0 and f.used + d.n_chars > 20000 then f.w + 1 else f.w end, case when f.used > 0 and f.used + d.n_chars > 20000 then d.n_chars else f.used + d.n_chars end
      from f join d on d.lang = f.lang and d.k = f.k + 1)"""


@query("w13_budget_packing", PACKED + " select lang, doc_id, cast(w as integer) as \"window\" from f")
def w13(spark, d):
    return trends.packed(table(spark, d, "documents"), "lang", "doc_id", "n_chars", 20000).select("lang", "doc_id", "window")


@query("w14_bounded_chunks", PACKED + " select lang, cast(w as integer) as chunk, count(*) as n, cast(sum(n_chars) as bigint) as chars from f group by 1, 2")
def w14(spark, d):
    packed = trends.packed(table(spark, d, "documents"), "lang", "doc_id", "n_chars", 20000)
    return packed.groupBy("lang", F.col("window").alias("chunk")).agg(F.count("*").alias("n"), F.sum("n_chars").cast("long").alias("chars"))


@query("w15_round_robin_sample", """
with t as (select doc_id, lang, source, cast(row_number() over (partition by lang, source order by md5('7:' || doc_id), doc_id) as integer) as turn from documents),
p as (select *, cast(row_number() over (partition by lang order by turn, source nulls first) as integer) as place from t) select doc_id, lang, source, turn, place from p where place <= 20""")
def w15(spark, d):
    # each stratum's first 20 rows are enough: tasks drop the others before anything is shuffled
    drawn = F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string")))
    turn = F.row_number().over(Window.partitionBy("lang", "source").orderBy(drawn, "doc_id"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "source"))
    first = table(spark, d, "documents").select("doc_id", "lang", "source").withColumn("turn", turn).where("turn <= 20")
    return first.withColumn("place", place).where("place <= 20")


@query("o1_multi_key", "select o_orderkey, cast(row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as integer) as place from orders where cast(o_orderdate as date) = date '1996-01-02'")
def o1(spark, d):
    o = table(spark, d, "orders").where(F.to_date("o_orderdate") == "1996-01-02")
    return o.select("o_orderkey", F.row_number().over(Window.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")).alias("place"))


@query("o2_newest_first", "select event_id from events order by ts desc, event_id limit 50")
def o2(spark, d):
    return table(spark, d, "events").orderBy(F.desc("ts"), "event_id").limit(50).select("event_id")


@query("o3_top_k", "select user_id, cast(count(*) as bigint) as n from events group by 1 order by n desc, user_id limit 15")
def o3(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(15)


@query("o4_total_then_code", "with {articles}, n as (select country, count(*) as n from articles group by 1) select country, n, cast(row_number() over (order by n desc, country) as integer) as place from n")
def o4(spark, d):
    n = articles(spark, d).groupBy("country").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "country")))


@query("o5_sections", "with {articles}, s as (select day, count(distinct country) as sources, count(distinct region) as languages from articles group by 1) select *, cast(row_number() over (order by sources desc, languages desc, day) as integer) as place from s")
def o5(spark, d):
    s = articles(spark, d).groupBy("day").agg(F.countDistinct("country").alias("sources"), F.countDistinct("region").alias("languages"))
    return s.withColumn("place", F.row_number().over(Window.orderBy(F.desc("sources"), F.desc("languages"), "day")))


@query("o6_filter_order", "with {articles} select article_id, day from articles where region = 'ASIA' order by day desc, article_id limit 100")
def o6(spark, d):
    return articles(spark, d).where("region = 'ASIA'").orderBy(F.desc("day"), "article_id").limit(100).select("article_id", "day")


@query("o7_paging", "with {articles}, n as (select count(*) as n from articles where region = 'ASIA') select article_id, n - 45 as remaining from (select article_id from articles where region = 'ASIA' order by day desc, article_id limit 15 offset 30), n")
def o7(spark, d):
    a = articles(spark, d).where("region = 'ASIA'")
    page = a.orderBy(F.desc("day"), "article_id").offset(30).limit(15).select("article_id")
    return page.crossJoin(F.broadcast(a.agg((F.count("*") - 45).alias("remaining"))))


LAST = CELLS + ", c as (select country, share - lag(share) over (partition by country order by week) as change, week from shares), l as (select country, round(change, 6) as change from c where week = (select max(week) - 1 from shares) and change is not null)"


def last_changes(spark, d):
    s = shares(spark, d)
    change = F.col("share") - F.lag("share").over(Window.partitionBy("country").orderBy("week"))
    last = s.agg((F.max("week") - 1).alias("last"))
    return s.withColumn("change", F.round(change, 6)).join(F.broadcast(last), F.col("week") == F.col("last")).where("change is not null").select("country", "change")


@query("o8_movers", f"""with {LAST}, p as (select *, row_number() over (order by change desc, country) as up, row_number() over (order by change, country) as down from l)
select country, change, 'rising' as side, cast(up as integer) as place from p where up <= 4 union all select country, change, 'falling', cast(down as integer) from p where down <= 4""")
def o8(spark, d):
    return trends.movers(last_changes(spark, d), "country", "change")


@query("o9_biggest_mover", f"with {LAST} select country, change from l order by abs(change) desc, country limit 1")
def o9(spark, d):
    return last_changes(spark, d).orderBy(F.desc(F.abs("change")), "country").limit(1)


@query("o10_random_sample", """
select doc_id, quality from (select doc_id, quality, row_number() over (partition by quality order by md5('11:' || doc_id), doc_id) as place from labels) where place <= 10""")
def o10(spark, d):
    labels = table(spark, d, "labels")
    place = F.row_number().over(Window.partitionBy("quality").orderBy(F.md5(F.concat(F.lit("11:"), F.col("doc_id").cast("string"))), "doc_id"))
    return labels.withColumn("place", place).where("place <= 10").select("doc_id", "quality")


@query("o11_costliest", "select l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) as cost from lineitem group by 1 order by cost desc, l_orderkey limit 15")
def o11(spark, d):
    cost = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(cost.alias("cost")).orderBy(F.desc("cost"), "l_orderkey").limit(15)


@query("o12_nulls_placed", """
with v as (select c_custkey, case when c_acctbal > 0 then c_acctbal end as v from customer)
select c_custkey, cast(row_number() over (order by v desc nulls first, c_custkey) as integer) as first, cast(row_number() over (order by v asc nulls last, c_custkey) as integer) as last from v""")
def o12(spark, d):
    v = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    first = ordered.with_place(v, [F.col("v").desc_nulls_first(), "c_custkey"], "first")
    last = ordered.with_place(first, [F.col("v").asc_nulls_last(), "c_custkey"], "last")
    return last.select("c_custkey", F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"))

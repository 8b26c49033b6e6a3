"""Calendar rules over the dates of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.operators import trends
from tidemark.plans.registry import query, table


def days(spark, d):
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


DAYS = "d as (select distinct cast(o_orderdate as date) as day from orders)"


@query("t1_download_day", """
with e as (select event_id, ts, ts + interval 2 hour as local, case when event_id % 3 = 0 then cast(cast(ts + interval 2 hour as date) as varchar) end as told from events)
select event_id, case when hour(local) >= 3 then cast(local as date) when told is not null then cast(local as date) else cast(local as date) - 1 end as day from e""")
def t1(spark, d):
    # January: the zone is two hours ahead of UTC throughout; a third of the names tell the local day
    e = table(spark, d, "events")
    local = F.from_utc_timestamp("ts", "Asia/Jerusalem")
    name = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Paper_"), F.date_format(local, "ddMM"), F.lit(".pdf"))).otherwise("Paper.pdf")
    return e.select("event_id", calendar.download_day(F.col("ts"), name, "Asia/Jerusalem").alias("day"))


@query("t2_named_day", f"""with {DAYS}
select day as true_day, cast(dayofmonth(day) as integer) as day, cast(month(day) as integer) as month, case when dayofmonth(day) % 2 = 0 then cast(year(day) as integer) end as year from d""")
def t2(spark, d):
    name = F.when(F.dayofmonth("day") % 2 == 0, F.concat(F.lit("Die Welt - "), calendar.long_form(F.col("day"), "en"), F.lit(".pdf"))).otherwise(F.concat(F.lit("USA Today_"), F.date_format("day", "ddMM"), F.lit(".pdf")))
    told = calendar.named_day(name)
    return days(spark, d).select(F.col("day").alias("true_day"), told["day"].alias("day"), told["month"].alias("month"), told["year"].alias("year"))


@query("t3_week_chunks", f"""with {DAYS}, f as (select min(day) as first, max(day) as last from d), g as (select cast(unnest(range(0, date_diff('day', first, last) // 7 + 1)) as integer) as week from f)
select week, first + week * 7 as "start", least(first + week * 7 + 6, last) as "end", cast(date_diff('day', first + week * 7, least(first + week * 7 + 6, last)) + 1 as integer) as n_days, first + week * 7 + 6 > last as partial from g, f""")
def t3(spark, d):
    return trends.week_grid(days(spark, d), "day")


@query("t4_week_index", f"with {DAYS} select day, cast(floor(date_diff('day', date '1996-01-01', day) / 7.0) as integer) as week from d")
def t4(spark, d):
    return days(spark, d).select("day", calendar.week_index(F.col("day"), F.lit("1996-01-01").cast("date")).alias("week"))


@query("t5_rolling_window", f'with {DAYS} select day, day - 14 as "start", day - 1 as "stop" from d')
def t5(spark, d):
    start, stop = calendar.rolling_window(F.col("day"))
    return days(spark, d).select("day", start.alias("start"), stop.alias("stop"))


@query("t6_latest_thursday", f"with {DAYS} select day, day - cast((isodow(day) + 3) % 7 as integer) as thursday from d")
def t6(spark, d):
    return days(spark, d).select("day", calendar.latest_weekday(F.col("day")).alias("thursday"))


@query("t7_fortnight", f"""with {DAYS} select day, date '1998-01-01' + cast(floor(date_diff('day', date '1998-01-01', day) / 14.0) as integer) * 14 as "start", date '1998-01-01' + cast(floor(date_diff('day', date '1998-01-01', day) / 14.0) as integer) * 14 + 13 as "stop" from d""")
def t7(spark, d):
    start, stop = calendar.fortnight(F.col("day"), F.lit("1998-01-01").cast("date"))
    return days(spark, d).select("day", start.alias("start"), stop.alias("stop"))


@query("t8_latest_closed", f"""with {DAYS}, c as (select day, cast(floor(date_diff('day', date '1996-01-01', day) / 14.0) as integer) as k from d),
e as (select day, case when k > 0 then date '1996-01-01' + k * 14 - 1 end as closed from c) select day, closed, case when date_diff('day', closed, day) <= 8 then closed end as recent from e""")
def t8(spark, d):
    anchor = F.lit("1996-01-01").cast("date")
    return days(spark, d).select("day", calendar.latest_closed_fortnight_end(F.col("day"), anchor).alias("closed"), calendar.latest_closed_fortnight_end(F.col("day"), anchor, 8).alias("recent"))


@query("t8_closed_fortnights", f"""with {DAYS}, c as (select day, cast(floor(date_diff('day', date '1996-01-01', day + 1) / 14.0) as integer) as n from d)
select day, [date '1996-01-01' + cast(k * 14 + 13 as integer) for k in range(0, greatest(n, 0))] as ends, case when date_diff('day', date '1996-01-01', day) % 14 in (13, -1) then day - 13 end as closing from c""")
def t8_closed(spark, d):
    anchor = F.lit("1996-01-01").cast("date")
    ends = F.transform(calendar.closed_fortnights(F.col("day"), anchor), lambda p: p["stop"])
    return days(spark, d).select("day", ends.alias("ends"), calendar.fortnight_closing_on(F.col("day"), anchor)[0].alias("closing"))


@query("t9_report_periods", f"""with {DAYS} select day, day - 7 as week_start, day - 14 as before_start, cast(date_trunc('month', day) - interval 1 month as date) as month_start, cast(date_trunc('month', day) - interval 1 day as date) as month_end from d""")
def t9(spark, d):
    start, end = calendar.preset("previous_month", F.col("day"))
    return days(spark, d).select("day", F.date_sub("day", 7).alias("week_start"), F.date_sub("day", 14).alias("before_start"), start.alias("month_start"), end.alias("month_end"))


@query("t10_month_chunks", f"""with {DAYS}, m as (select distinct cast(date_trunc('month', day) as date) as month, cast(date_trunc('month', day) + interval 1 month - interval 1 day as date) as last from d)
select month, cast(s as date) as "start", least(cast(s as date) + 6, last) as "stop" from m, unnest(generate_series(month, last, interval 7 day)) t(s)""")
def t10(spark, d):
    m = days(spark, d).select(F.trunc("day", "month").alias("month")).distinct()
    chunks = m.select("month", F.explode(F.sequence("month", F.last_day("month"), F.expr("interval 7 days"))).alias("start"))
    return chunks.select("month", "start", F.least(F.date_add("start", 6), F.last_day("month")).alias("stop"))


@query("t11_day_kind", f"with {DAYS} select day, isodow(day) >= 6 as weekend from d")
def t11(spark, d):
    return days(spark, d).select("day", calendar.is_weekend(F.col("day")).alias("weekend"))


@query("t12_local_day", "select event_id, cast(ts as date) as utc_day, cast(ts + interval 9 hour as date) as local_day from events")
def t12(spark, d):
    return table(spark, d, "events").select("event_id", F.to_date("ts").alias("utc_day"), F.to_date(F.from_utc_timestamp("ts", "Asia/Tokyo")).alias("local_day"))


@query("t13_age_limit", """
with a as (select * from (values ('7'), ('0'), ('9999'), ('all'), ('x')) t(asked)), l as (select max(cast(ts as date)) as latest from events)
select asked, case when asked = 'all' then null else latest - cast(greatest(1, least(365, coalesce(try_cast(asked as integer), 30))) as integer) end as first_day from a, l""")
def t13(spark, d):
    asked = spark.createDataFrame([(x,) for x in ("7", "0", "9999", "all", "x")], "asked string")
    latest = table(spark, d, "events").agg(F.max(F.to_date("ts")).alias("latest"))
    return asked.crossJoin(F.broadcast(latest)).select("asked", calendar.age_limit(F.col("asked"), F.col("latest")).alias("first_day"))


@query("t14_revised", "select o_orderkey, left(cast(cast(o_orderdate as date) as varchar), 10) != left(cast(s as varchar), 10) as revised from orders join (select l_orderkey, cast(min(l_shipdate) as date) as s from lineitem group by 1) on l_orderkey = o_orderkey")
def t14(spark, d):
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("s"))
    day = lambda c: F.substring(F.col(c).cast("string"), 1, 10)
    return table(spark, d, "orders").join(s, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", (day("o_orderdate") != day("s")).alias("revised"))


@query("t15_cadence", """
with n as (select user_id, count(distinct cast(ts as date)) as seen from events where event_type = 'error' group by 1), r as (select user_id, seen, seen / 30.0::double as rate from n)
select user_id, case when rate < 0.35 then 'weekly' else 'daily' end as cadence, seen >= case when rate < 0.35 then 1.0 else greatest(1.0, 0.5 * 28) end as active from r""")
def t15(spark, d):
    n = table(spark, d, "events").where("event_type = 'error'").groupBy("user_id").agg(F.countDistinct(F.to_date("ts")).alias("seen"))
    rate = F.col("seen") / 30.0
    return n.select("user_id", calendar.cadence(rate).alias("cadence"), calendar.is_active(rate, F.col("seen"), F.lit(28.0)).alias("active"))


@query("t16_report_days_in_week", f"""with {DAYS}, f as (select min(day) as first, max(day) as last from d)
select cast(floor(date_diff('day', first, day) / 7.0) as integer) as week, count(*) as report_days, max(first + cast(floor(date_diff('day', first, day) / 7.0) as integer) * 7 + 6 > last) as partial from d, f group by 1""")
def t16(spark, d):
    present = trends.with_week(days(spark, d), "day").groupBy("week").agg(F.count("*").alias("report_days"))
    return trends.week_grid(days(spark, d), "day").join(present, "week").select("week", "report_days", "partial")


@query("t17_written_dates", f"""with {DAYS} select day, dayofmonth(day) || ' ' || ['January','February','March','April','May','June','July','August','September','October','November','December'][month(day)] || ' ' || year(day) as en,
dayofmonth(day) || '. ' || ['Januar','Februar','März','April','Mai','Juni','Juli','August','September','Oktober','November','Dezember'][month(day)] || ' ' || year(day) as de,
dayofmonth(day) || ' ב' || ['ינואר','פברואר','מרץ','אפריל','מאי','יוני','יולי','אוגוסט','ספטמבר','אוקטובר','נובמבר','דצמבר'][month(day)] || ' ' || year(day) as he,
['January','February','March','April','May','June','July','August','September','October','November','December'][month(day)] || ' ' || dayofmonth(day) || '–' || dayofmonth(day + 13) || ', ' || year(day + 13) as period,
dayofmonth(day) || '.–' || dayofmonth(day + 13) || '. ' || ['Januar','Februar','März','April','Mai','Juni','Juli','August','September','Oktober','November','Dezember'][month(day + 13)] || ' ' || year(day + 13) as zeitraum from d""")
def t17(spark, d):
    return days(spark, d).select("day", calendar.long_form(F.col("day"), "en").alias("en"), calendar.long_form(F.col("day"), "de").alias("de"), calendar.long_form(F.col("day"), "he").alias("he"), calendar.range_form(F.col("day"), F.date_add("day", 13), "en").alias("period"), calendar.range_form(F.col("day"), F.date_add("day", 13), "de").alias("zeitraum"))

"""Scans, filters and changes to tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import calendar, text
from tidemark.operators import facets, relational
from tidemark.plans.registry import articles, query, table
from tidemark.sources import files, records, sqlite
from tidemark.sources.scratch import fresh_folder, written


@query("s1_scan", "select o_orderkey, o_orderstatus from orders")
def s1(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus")


@query("s2_point_lookup", "select c_custkey, c_name from customer where c_custkey = 17")
def s2(spark, d):
    return table(spark, d, "customer").where("c_custkey = 17").select("c_custkey", "c_name")


@query("s3_existence", "select exists(select 1 from orders where o_orderstatus = 'F') as found")
def s3(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F'").limit(1).agg((F.count("*") > 0).alias("found"))


@query("s4_watermark", "select cast(max(ts) as date) as latest, max(event_id) as latest_id from events")
def s4(spark, d):
    return table(spark, d, "events").agg(F.to_date(F.max("ts")).alias("latest"), F.max("event_id").alias("latest_id"))


@query("s5_scan_limit", """
select user_id, cast(greatest(200, date_diff('day', cast(max(ts) as date), date '2024-02-15') * 50) as bigint) as scan_limit from events group by user_id""")
def s5(spark, d):
    gap = F.datediff(F.lit("2024-02-15").cast("date"), F.to_date(F.max("ts")))
    return table(spark, d, "events").groupBy("user_id").agg(calendar.scan_limit(gap).alias("scan_limit"))


@query("s6_walk_from_newest", "select event_id, cast(ts as date) as day from events where cast(ts as date) > date '2024-01-20'")
def s6(spark, d):
    return table(spark, d, "events").where("ts >= timestamp'2024-01-21'").select("event_id", F.to_date("ts").alias("day"))


@query("s8_json_lists", """
select o_orderstatus, list_sort(list(distinct o_orderpriority)) as priorities from orders group by 1""")
def s8(spark, d):
    stored = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.to_json(F.array_sort(F.collect_set("o_orderpriority"))).alias("priorities"))
    return files.with_list(stored, "priorities")


@query("s9_bound_parameters", "select event_type, count(*) as n from events where cast(ts as date) between date '2024-01-05' and date '2024-01-11' group by 1")
def s9(spark, d):
    bound = {"first": "2024-01-05", "last": "2024-01-11"}
    return spark.sql("select event_type, count(*) as n from {events} where to_date(ts) between cast(:first as date) and cast(:last as date) group by 1", args=bound, events=table(spark, d, "events"))


@query("s9_sqlite_source", "select event_id, cast(ts as date) as day, event_type, value from events where cast(ts as date) >= date '2024-01-05' and cast(ts as date) <= date '2024-01-11' and event_type in ('view', 'click')")
def s9_sqlite(spark, d):
    # written to files of another store and read from them with the tests inside
    sqlite.register(spark)
    folder = fresh_folder(spark, "sqlite")
    events = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), "event_type", "value")
    events.write.format(sqlite.FORMAT).mode("append").option("path", folder).save()
    return sqlite.stored(spark, folder, [("day", ">=", dt.date(2024, 1, 5)), ("day", "<=", dt.date(2024, 1, 11)), ("event_type", "in", ["view", "click"])])


@query("s10_json_payload", """
select o_orderstatus, '{"status":"' || o_orderstatus || '","n":' || count(*) || '}' as payload from orders group by 1""")
def s10(spark, d):
    n = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return n.select("o_orderstatus", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), "n")).alias("payload"))


@query("s12_page_copies", """
select conv_id, string_agg('--- page ' || turn || ' ---' || chr(10) || coalesce(text, ''), chr(10) order by turn, coalesce(text, '')) as copy from conversations group by conv_id""")
def s12(spark, d):
    return files.page_copies(table(spark, d, "conversations"), "conv_id", "turn", "text")


@query("s14_retention", """
with days as (select distinct cast(o_orderdate as date) as day from orders), limits as (select max(day) as newest from days)
select day from days, limits
where date_diff('day', day, newest) <= 14 or (date_diff('day', day, newest) <= 60 and dayofweek(day) = 0) or day = newest""")
def s14(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    latest = days.agg(F.max("day").alias("today"))
    return files.retained(days.crossJoin(F.broadcast(latest)), "day", F.col("today")).select("day")


@query("s16_schema_migration", """
select c_custkey as key, c_name as name, c_mktsegment as segment from customer
union all select s_suppkey, s_name, null from supplier""")
def s16(spark, d):
    new = table(spark, d, "customer").selectExpr("c_custkey as key", "c_name as name", "c_mktsegment as segment")
    return files.evolved(new, table(spark, d, "supplier").selectExpr("s_suppkey as key", "s_name as name"))


_DRIFTED = """drifted as (
    select event_id, case event_id % 4 when 0 then props when 1 then '{"k":"' || (event_id % 50) || '","source":"v2"}' when 2 then '{"k":' || (event_id % 7) || '.5,"source":{"id":' || event_id || '}}'
        else case event_id % 12 when 3 then '{"k":"many"}' when 7 then '[' || event_id || ']' else '{"k":' end end as text from events)"""


@query("s16_drifting_records", f"""with {_DRIFTED}, j as (select event_id, text, case when json_valid(text) then text end as ok from drifted)
select event_id, try_cast(json_extract_string(ok, '$.k') as double) as k, case when ok is null then 'not JSON' when json_type(ok) != 'OBJECT' then 'not an object' when try_cast(json_extract_string(ok, '$.k') as double) is null then 'not a double: k' end as reason from j""")
def s16_drifting(spark, d):
    # the field k is a number, a text, a fraction and something else in four versions; a twelfth of the records is cut off
    text = F.expr("""case event_id % 4 when 0 then props when 1 then '{"k":"' || (event_id % 50) || '","source":"v2"}' when 2 then '{"k":' || (event_id % 7) || '.5,"source":{"id":' || event_id || '}}'
        else case event_id % 12 when 3 then '{"k":"many"}' when 7 then '[' || event_id || ']' else '{"k":' end end""")
    rows = records.as_variants(table(spark, d, "events").select("event_id", text.alias("text")), "text")
    return records.typed(rows, "text", {"k": "double"}, ["k"]).select("event_id", "k", "reason")


@query("d1_insert_ignore", """
with new as (select o_custkey as k, min(o_orderkey) as v from orders group by 1)
select c_custkey as k, cast(-1 as bigint) as v from customer where c_custkey % 3 = 0
union all select k, v from new where k % 3 != 0 or k not in (select c_custkey from customer)""")
def d1(spark, d):
    existing = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.lit(-1).cast("long").alias("v"))
    new = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    return relational.insert_ignore(existing, new, ["k"], ["v"])


@query("d2_upsert_counters", """
select cast(ts as date) as date, event_type, cast(count(*) as bigint) as count from events group by 1, 2""")
def d2(spark, d):
    e = table(spark, d, "events").withColumn("date", F.to_date("ts"))
    part = lambda c: e.where(c).groupBy("date", "event_type").agg(F.count("*").alias("count"))
    return relational.merged_counts(part("event_id % 2 = 0"), part("event_id % 2 = 1"), ["date", "event_type"])


@query("d3_six_counters", """
select 'total' as counter, '' as value, cast(count(*) as bigint) as count from events
union all select 'type', event_type, count(*) from events group by 2
union all select 'day', cast(cast(ts as date) as varchar), count(*) from events group by 2
union all select 'user', cast(user_id as varchar), count(*) from events group by 2""")
def d3(spark, d):
    e = table(spark, d, "events")
    dims = {"total": F.lit(""), "type": F.col("event_type"), "day": F.to_date("ts").cast("string"), "user": F.col("user_id").cast("string")}
    parts = [e.groupBy(c.alias("value")).agg(F.count("*").alias("count")).select(F.lit(n).alias("counter"), "value", "count") for n, c in dims.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("d4_cascading_delete", """
select l_orderkey, l_linenumber from lineitem where l_orderkey not in (
    select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING'))""")
def d4(spark, d):
    files_ = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    doomed = table(spark, d, "orders").join(files_, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    return relational.delete_cascading(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), doomed, ["l_orderkey"])


@query("d5_replace_unit", """
select event_id, event_type, cast(ts as date) as day from events where cast(ts as date) != date '2024-01-03'
union all select event_id + 1000000, 'rebuilt', date '2024-01-03' from events where cast(ts as date) = date '2024-01-03' and event_type = 'click'""")
def d5(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    unit = e.where("day = date'2024-01-03' and event_type = 'click'").select((F.col("event_id") + 1000000).alias("event_id"), F.lit("rebuilt").alias("event_type"), "day")
    return relational.replaced_unit(e, unit, ["day"])


@query("d6_keep_created", """
select o_orderkey, case when o_orderkey % 2 = 0 then date '2024-01-01' else date '2024-02-01' end as created_at,
       case when o_orderkey % 2 = 0 then date '2024-02-01' end as updated_at from orders""")
def d6(spark, d):
    now = table(spark, d, "orders").select("o_orderkey")
    before = now.where("o_orderkey % 2 = 0").withColumn("created_at", F.lit("2024-01-01").cast("date"))
    return relational.rebuilt(before, now, ["o_orderkey"], F.lit("2024-02-01").cast("date")).select("o_orderkey", "created_at", "updated_at")


@query("d7_headers_with_children", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)")
def d7(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("d8_conditional_status", """
select o_orderkey, case when n > 3 and o_orderstatus = 'O' then 'large' when n is null then 'empty' else o_orderstatus end as status
from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey""")
def d8(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    joined = table(spark, d, "orders").join(n, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    status = F.when((F.col("n") > 3) & (F.col("o_orderstatus") == "O"), "large").when(F.col("n").isNull(), "empty").otherwise(F.col("o_orderstatus"))
    return joined.select("o_orderkey", status.alias("status"))


@query("d9_claim_once", """
select o_orderkey, cast(o_orderdate as date) as original,
       case when shipped > cast(o_orderdate as date) + 60 then shipped else cast(o_orderdate as date) end as day
from orders join (select l_orderkey, cast(min(l_shipdate) as date) as shipped from lineitem group by 1) on l_orderkey = o_orderkey""")
def d9(spark, d):
    from tidemark.streaming.counters import late_day

    first = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("shipped"))
    rows = table(spark, d, "orders").join(first, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("original", F.to_date("o_orderdate"))
    return rows.select("o_orderkey", "original", late_day(F.col("original"), F.col("shipped"), F.datediff("shipped", "original") > 60).alias("day"))


@query("d10_links_in_order", """
with lists as (select l_orderkey, l_partkey, min(l_linenumber) as pos from lineitem group by 1, 2)
select l_orderkey, l_partkey, cast(row_number() over (partition by l_orderkey order by pos, l_partkey) as bigint) as place from lists where l_partkey in (select p_partkey from part where p_size > 10)""")
def d10(spark, d):
    from pyspark.sql import Window

    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("parts"))
    links = lists.select("l_orderkey", F.posexplode(F.array_distinct("parts")).alias("pos", "l_partkey"))
    valid = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    kept = links.join(valid, "l_partkey", "left_semi")
    return kept.select("l_orderkey", "l_partkey", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("pos")).cast("long").alias("place"))


@query("d11_fill_missing", "select doc_id, coalesce(case when doc_id % 2 = 0 then n_chars end, length(text)) as n from documents")
def d11(spark, d):
    stored = table(spark, d, "documents").withColumn("n", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")))
    return stored.select("doc_id", F.coalesce("n", F.length("text").cast("long")).alias("n"))


@query("d12_added_since", "select l_orderkey, l_linenumber from lineitem where (l_orderkey, l_linenumber) not in (select l_orderkey, l_linenumber from lineitem where l_shipdate < timestamp '1998-01-01')")
def d12(spark, d):
    now = table(spark, d, "lineitem")
    return relational.added_rows(now.select("l_orderkey", "l_linenumber"), now.where("l_shipdate < timestamp'1998-01-01'"), ["l_orderkey", "l_linenumber"])


@query("f1_report_day", """
select event_id, coalesce(case when event_id % 4 = 0 then date '2024-01-10' end, cast(ts as date)) as rdate from events
where coalesce(case when event_id % 4 = 0 then date '2024-01-10' end, cast(ts as date)) = date '2024-01-10'""")
def f1(spark, d):
    e = table(spark, d, "events").withColumn("report_date", F.when(F.col("event_id") % 4 == 0, F.lit("2024-01-10").cast("date")))
    return e.select("event_id", calendar.report_day(F.col("report_date"), F.col("ts")).alias("rdate")).where("rdate = date'2024-01-10'")


@query("f2_day_range", "select count(*) as n from orders where cast(o_orderdate as date) between date '1996-01-01' and date '1996-03-31'")
def f2(spark, d):
    return table(spark, d, "orders").where(F.to_date("o_orderdate").between("1996-01-01", "1996-03-31")).agg(F.count("*").alias("n"))


@query("f3_optional_predicate", "select event_id from events where event_type = 'click' and user_id not in (select user_id from events where value > (select 0.98 * max(value) from events))")
def f3(spark, d):
    e = table(spark, d, "events")
    top = e.agg((0.98 * F.max("value")).alias("limit"))
    return relational.pending(e, e.crossJoin(F.broadcast(top)).where("value > limit"), ["user_id"], F.col("event_type") == "click").select("event_id")


@query("f4_contains", "select p_partkey from part where p_type ilike '%PROMO%' or p_name ilike '%1_'")
def f4(spark, d):
    return table(spark, d, "part").where(F.col("p_type").ilike("%PROMO%") | F.col("p_name").ilike("%1_")).select("p_partkey")


@query("f5_in_list", "select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH')")
def f5(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("f6_length_bounds", "select doc_id from documents where length(text) > 300 and length(text) between 400 and 4000")
def f6(spark, d):
    n = F.length("text")
    return table(spark, d, "documents").where((n > 300) & n.between(400, 4000)).select("doc_id")


@query("f7_not_equal", "select o_orderpriority, count(*) as n from orders where o_orderpriority != '5-LOW' group by 1")
def f7(spark, d):
    return table(spark, d, "orders").where("o_orderpriority != '5-LOW'").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("f8_not_empty", "select conv_id, turn from conversations where text is not null and text != ''")
def f8(spark, d):
    return table(spark, d, "conversations").where("text is not null and text != ''").select("conv_id", "turn")


@query("f9_closed_routing", """
select reason, count(*) as n from (select case when o_orderstatus not in ('F', 'O', 'P') then 'unrecognised' when o_orderstatus = 'P' then 'suspended'
    when o_orderkey % 10 = 0 then 'skip-list' when o_custkey % 3 = 0 then 'present' else 'taken' end as reason from orders) group by 1""")
def f9(spark, d):
    reason = F.when(~F.col("o_orderstatus").isin("F", "O", "P"), "unrecognised").when(F.col("o_orderstatus") == "P", "suspended")
    reason = reason.when(F.col("o_orderkey") % 10 == 0, "skip-list").when(F.col("o_custkey") % 3 == 0, "present").otherwise("taken")
    return table(spark, d, "orders").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("f11_self_exclusion", r"""
select doc_id, regexp_matches(trim(text), '(?i)^(the|and|of)\b') as excluded from documents""")
def f11(spark, d):
    return table(spark, d, "documents").select("doc_id", F.trim("text").rlike(r"(?i)^(the|and|of)\b").alias("excluded"))


@query("f12_letters_page", "select doc_id, contains(left(text, 200), 'LETTERS TO THE EDITOR') or contains(left(text, 200), 'LESERBRIEFE') or contains(left(text, 200), 'Leserbriefe') as letters from documents")
def f12(spark, d):
    return table(spark, d, "documents").select("doc_id", text.is_letters_page(F.col("text")).alias("letters"))


@query("f13_unreadable", r"""
select doc_id, regexp_matches(t, '\(cid:\d+\)') and length(trim(regexp_replace(regexp_replace(t, '\(cid:\d+\)', ' ', 'g'), '\s+', ' ', 'g'))) < 100 as unreadable
from (select doc_id, case when doc_id % 5 = 0 then '(cid:7)' || coalesce(source, '') else text end as t from documents)""")
def f13(spark, d):
    t = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("(cid:7)"), F.coalesce("source", F.lit("")))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", text.is_unreadable(t).alias("unreadable"))


@query("f14_decision_order", r"""
with d as (select doc_id, lang, text, md5(text) as bytes, sha256(replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), 'ß', 'ss')) as folded, length(text) as n from documents),
marked as (select *, min(doc_id) over (partition by bytes) as same_bytes, min(doc_id) over (partition by lang, folded) as same_text from d)
select doc_id, case when same_bytes < doc_id then 'copy' when same_text < doc_id then 'same text' when n < 50 then 'blank' else 'model' end as decision from marked""")
def f14(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.md5("text").alias("bytes"), F.sha2(text.normalised(F.col("text")), 256).alias("folded"), F.length("text").alias("n"))
    joined = relational.duplicates_of_first(docs, ["bytes"], ["doc_id"]).withColumnRenamed("first_doc_id", "same_bytes").drop("is_first")
    joined = relational.duplicates_of_first(joined, ["lang", "folded"], ["doc_id"]).withColumnRenamed("first_doc_id", "same_text")
    decision = F.when(F.col("same_bytes") < F.col("doc_id"), "copy").when(F.col("same_text") < F.col("doc_id"), "same text").when(F.col("n") < 50, "blank").otherwise("model")
    return joined.select("doc_id", decision.alias("decision"))


@query("f15_file_health", """
select page_id, case when html ilike '%scanned%' then 'suspect' when length(html) < 400 and html ilike '%<img%' then 'warn' else 'ok' end as health from pages""")
def f15(spark, d):
    health = F.when(F.col("html").ilike("%scanned%"), "suspect").when((F.length("html") < 400) & F.col("html").ilike("%<img%"), "warn").otherwise("ok")
    return table(spark, d, "pages").select("page_id", health.alias("health"))


@query("f16_record_shape", "select event_id, coalesce(json_valid(props) and json_type(props) = 'OBJECT', false) as is_object from events")
def f16(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.from_json("props", "map<string,string>").isNotNull(), F.lit(False)).alias("is_object"))


@query("f16_required_fields", "select event_id, coalesce(try_cast(json_extract(props, '$.k') as bigint) is not null, false) as is_valid from events")
def f16_required(spark, d):
    records = files.validated(table(spark, d, "events").select("event_id", "props"), "props", T.StructType([T.StructField("k", T.LongType())]), ["k"])
    return records.select("event_id", "is_valid")


@query("f17_facets", """with {articles}
select article_id from articles where (region in ('EUROPE', 'ASIA')) and category in ('1-URGENT', '3-MEDIUM') and day >= date '1996-01-01' and day <= date '1997-12-31'""")
def f17(spark, d):
    regions = F.split(F.lit("EUROPE, ASIA"), r",\s*")
    a = articles(spark, d).where(F.arrays_overlap(F.array("region"), regions) & F.col("category").isin("1-URGENT", "3-MEDIUM") & F.col("day").between("1996-01-01", "1997-12-31"))
    return a.select("article_id")


def _facets(spark, d):
    """The articles' index by region, category and day, written once: what follows reads no article."""
    a = articles(spark, d)
    return written(facets.facet_index(a, "article_id", {"region": F.col("region"), "category": F.col("category"), "day": F.col("day")}))


WANTED = {"region": ["EUROPE", "ASIA"], "category": ["1-URGENT", "3-MEDIUM"], "day": ("1996-01-01", "1997-12-31")}
_IN_FACETS = "region in ('EUROPE', 'ASIA') and category in ('1-URGENT', '3-MEDIUM') and day >= date '1996-01-01' and day <= date '1997-12-31'"


@query("f17_facet_index", f"with {{articles}} select article_id from articles where {_IN_FACETS}")
def f17_index(spark, d):
    return facets.ids_of(facets.matching(_facets(spark, d), WANTED), "article_id")


@query("f17_facet_counts", f"""with {{articles}}, hits as (select * from articles where {_IN_FACETS})
select 'region' as facet, region as value, count(*) as n from hits group by 2 union all select 'category', category, count(*) from hits group by 2 union all select 'day', cast(day as varchar), count(*) from hits group by 2""")
def f17_counts(spark, d):
    index = _facets(spark, d)
    return facets.value_counts(index, facets.matching(index, WANTED))


@query("a27_facet_postings", "with {articles} select 'region' as facet, region as value, count(*) as n from articles group by 2 union all select 'category', category, count(*) from articles group by 2")
def a27_postings(spark, d):
    index = _facets(spark, d).where("facet != 'day'")
    return index.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))


@query("f18_swapped_range", "select o_orderkey from orders where cast(o_orderdate as date) between least(date '1997-01-01', date '1996-06-01') and greatest(date '1997-01-01', date '1996-06-01')")
def f18(spark, d):
    ends = [F.lit("1997-01-01").cast("date"), F.lit("1996-06-01").cast("date")]
    return table(spark, d, "orders").where(F.to_date("o_orderdate").between(F.least(*ends), F.greatest(*ends))).select("o_orderkey")


@query("f19_presets", """
with l as (select max(cast(ts as date)) as latest from events)
select 'last7' as preset, latest - 6 as start, latest as stop from l union all select 'last30', latest - 29, latest from l
union all select 'month', cast(date_trunc('month', latest) as date), latest from l
union all select 'previous_month', cast(date_trunc('month', latest) - interval 1 month as date), cast(date_trunc('month', latest) - interval 1 day as date) from l""")
def f19(spark, d):
    latest = table(spark, d, "events").agg(F.max(F.to_date("ts")).alias("latest"))
    names = ("last7", "last30", "month", "previous_month")
    ranges = F.array(*[F.struct(F.lit(n).alias("preset"), calendar.preset(n, F.col("latest"))[0].alias("start"), calendar.preset(n, F.col("latest"))[1].alias("stop")) for n in names])
    return latest.select(F.inline(ranges))

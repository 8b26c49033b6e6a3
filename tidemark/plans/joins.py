"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scores, text
from tidemark.operators import excerpts, relational, trends
from tidemark.plans.registry import articles, query, table
from tidemark.sources.scratch import written


@query("j1_inner", "with {articles} select article_id, newspaper from articles where day = date '1996-01-02'")
def j1(spark, d):
    return articles(spark, d).where("day = date'1996-01-02'").select("article_id", "newspaper")


@query("j2_composite", """
select l.l_orderkey, l.l_linenumber, p_brand from lineitem l join (select l_orderkey, l_linenumber from lineitem where l_quantity > 45) m
on l.l_orderkey = m.l_orderkey and l.l_linenumber = m.l_linenumber join part on p_partkey = l.l_partkey""")
def j2(spark, d):
    li = table(spark, d, "lineitem")
    marked = li.where("l_quantity > 45").select("l_orderkey", "l_linenumber")
    return li.join(marked, ["l_orderkey", "l_linenumber"]).join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", "p_brand")


@query("j3_anti", "select c_custkey from customer left join orders on o_custkey = c_custkey and o_orderpriority = '1-URGENT' where o_orderkey is null")
def j3(spark, d):
    return relational.pending(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("j4_double_anti", """
select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null) and doc_id not in (select item_id from benchmark where item_id is not null)""")
def j4(spark, d):
    return relational.unlinked(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")), key="doc_id")


@query("j5_semi_as_flag", "select doc_id, exists(select 1 from labels l where l.doc_id = d.doc_id) as labelled from documents d")
def j5(spark, d):
    return relational.with_flag(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", "labelled")


@query("j6_preaggregated", """
select o_orderkey, coalesce(n, 0) as n from orders left join (select l_orderkey, count(*) as n from lineitem where l_returnflag = 'R' group by 1) on l_orderkey = o_orderkey""")
def j6(spark, d):
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.with_counts(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", "n")


@query("j7_scalar_counts", """
select c_custkey, (select count(*) from orders where o_custkey = c_custkey) as n_orders,
       (select count(*) from orders join lineitem on l_orderkey = o_orderkey where o_custkey = c_custkey) as n_lines from customer""")
def j7(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("k"))
    per = o.join(lines, "o_orderkey", "left").groupBy("c_custkey").agg(F.count("*").alias("n_orders"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_lines"))
    out = table(spark, d, "customer").select("c_custkey").join(per, "c_custkey", "left")
    return out.select("c_custkey", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_orders", "n_lines")])


@query("j8_bridge", """
select distinct c_mktsegment, p_brand from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where p_size < 5""")
def j8(spark, d):
    topics = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, d, "part").where("p_size < 5").select("p_partkey", "p_brand")
    links = table(spark, d, "lineitem").join(parts, F.col("p_partkey") == F.col("l_partkey"))
    return topics.join(links, F.col("l_orderkey") == F.col("o_orderkey")).select("c_mktsegment", "p_brand").distinct()


@query("j9_children_with_zero", "select n_name, count(s_suppkey) as n from nation left join supplier on s_nationkey = n_nationkey group by 1")
def j9(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    return relational.with_counts(table(spark, d, "nation").select("n_nationkey", "n_name"), s, "n_nationkey", "n").select("n_name", "n")


@query("j10_range_to_week", """
with f as (select min(cast(ts as date)) as first from events)
select event_id, cast(floor(date_diff('day', first, cast(ts as date)) / 7.0) as integer) as week from events, f""")
def j10(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return trends.with_week(e, "day").select("event_id", "week")


@query("j11_range_to_interval", """
with w as (select * from (values ('a', date '1996-01-01', date '1996-06-30'), ('b', date '1997-01-01', date '1997-03-31')) t(name, s, e))
select o_orderkey, name from orders left join w on cast(o_orderdate as date) between s and e""")
def j11(spark, d):
    spans = spark.createDataFrame([("a", "1996-01-01", "1996-06-30"), ("b", "1997-01-01", "1997-03-31")], "name string, s string, e string").selectExpr("name", "date(s) as s", "date(e) as e")
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return relational.in_intervals(o, "day", spans, "s", "e").select("o_orderkey", "name")


@query("j11_first_event_span", """
with spans as (select event_id as span, cast(ts as date) as s, cast(ts as date) + cast(event_id % 9 - 1 as integer) as e from events),
days as (select distinct cast(ts as date) as day from events),
firsts as (select day, span, row_number() over (partition by day order by s, e, span) as n from days join spans on day between s and e)
select event_id, span from events left join firsts on day = cast(ts as date) and n = 1""")
def j11_spans(spark, d):
    # every event is also an interval of up to eight days, or an empty one; they overlap by the thousand
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    spans = e.select(F.col("event_id").alias("span"), F.col("day").alias("s"), F.date_add("day", (F.col("event_id") % 9 - 1).cast("int")).alias("e"))
    return relational.in_intervals(e.select("event_id", "day"), "day", spans, "s", "e").select("event_id", "span")


@query("j12_dictionary_default", """
select s_suppkey, coalesce(case n_name when 'FRANCE' then 'fr' when 'GERMANY' then 'de' end, 'other') as lang from supplier join nation on s_nationkey = n_nationkey""")
def j12(spark, d):
    codes = spark.createDataFrame([("FRANCE", "fr"), ("GERMANY", "de")], "n_name string, lang string")
    s = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return relational.with_default(s, codes, "n_name", "lang", F.lit("other")).select("s_suppkey", "lang")


@query("j13_first_occurrence", r"""
with d as (select doc_id, source, case when length(n) < 200 then '' else sha256(n) end as h
           from (select doc_id, source, replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), 'ß', 'ss') as n from documents))
select doc_id, min(doc_id) over (partition by source, h) as first_doc from d where h != ''""")
def j13(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", "source", text.text_hash(F.col("text")).alias("h")).where("h != ''")
    # texts are read and hashed once; both sides of the join read the narrow table
    return relational.duplicates_of_first(written(hashed), ["source", "h"], ["doc_id"]).select("doc_id", F.col("first_doc_id").alias("first_doc"))


@query("j14_greedy_match")
def j14(spark, d):
    # headline: a turn's first words; excerpt: all of it
    items = table(spark, d, "conversations").select("conv_id", "turn", excerpts.plain_words(text.first_words(F.col("text"))).alias("h"), text.word_set(F.col("text")).alias("w"))
    a, b = items.where("turn % 2 = 0"), items.where("turn % 2 = 1").toDF("conv_id", "other", "g", "v")
    pairs = a.join(b, "conv_id").select("conv_id", "turn", "other", scores.pair_score(F.col("h"), F.col("g"), F.col("w"), F.col("v"), 0.2).alias("score"))
    return relational.greedy_matches(pairs, "conv_id", "turn", "other", "score", 0.2)


@query("j15_grid", """
with k as (select distinct event_type from events), f as (select min(cast(ts as date)) as first, max(cast(ts as date)) as last from events),
g as (select cast(unnest(range(0, cast(floor(date_diff('day', first, last) / 7.0) as bigint) + 1)) as integer) as week from f),
n as (select event_type, cast(floor(date_diff('day', first, cast(ts as date)) / 7.0) as integer) as week, count(*) as n from events, f where value > 90 group by 1, 2)
select k.event_type, g.week, coalesce(n.n, 0) as n from k cross join g left join n on n.event_type = k.event_type and n.week = g.week""")
def j15(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    n = trends.with_week(e, "day").where("value > 90").groupBy("event_type", "week").agg(F.count("*").alias("n"))
    return relational.filled_grid(n, e.select("event_type").distinct(), trends.week_grid(e, "day").select("week"), ["event_type", "week"], "n")


@query("u1_difference", "select doc_id from documents except select doc_id from labels")
def u1(spark, d):
    return table(spark, d, "documents").select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("u2_union", "select c_nationkey as k from customer union select s_nationkey from supplier")
def u2(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("u3_intersection", "select c_nationkey as k from customer where c_acctbal > 9000 intersect select s_nationkey from supplier where s_acctbal > 5000")
def u3(spark, d):
    return table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("u4_ordered_distinct", """
select l_orderkey, list(l_suppkey order by pos, l_suppkey) as suppliers from (select l_orderkey, l_suppkey, min(l_linenumber) as pos from lineitem group by 1, 2) group by 1""")
def u4(spark, d):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"])
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_distinct(listed).alias("suppliers"))


@query("u5_missing_days", """
with f as (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders where o_orderstatus = 'F')
select cast(unnest(generate_series(a, b, interval 1 day)) as date) as day from f except select cast(o_orderdate as date) from orders where o_orderstatus = 'F'""")
def u5(spark, d):
    days = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.to_date("o_orderdate").alias("day")).distinct()
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return relational.missing_days(F.col("a"), F.col("b"), span, days)


@query("u6_full_merge", """
select coalesce(c.k, s.k) as k, coalesce(c.n, 0) as n_customers, coalesce(s.n, 0) as n_suppliers
from (select c_nationkey as k, count(*) as n from customer where c_acctbal > 9500 group by 1) c
full join (select s_nationkey as k, count(*) as n from supplier where s_acctbal > 3000 group by 1) s on c.k is not distinct from s.k""")
def u6(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"))
    s = table(spark, d, "supplier").where("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_suppliers"))
    return relational.merged_groups(c, s, ["k"], ["n_customers", "n_suppliers"])

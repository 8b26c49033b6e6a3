"""Streaming jobs run to the end of their input; each has the batch answer as its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query, table
from tidemark.sources.scratch import fresh_folder
from tidemark.streaming import counters, runs


def _stream(spark, d, name):
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parquet*")


@query("r1_pending_queue", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def r1(spark, d):
    from tidemark.operators.relational import pending

    return pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query("r2_ingest_once", "select user_id, event_type from events group by 1, 2")
def r2(spark, d):
    f = fresh_folder(spark)
    counters.ingest_once(_stream(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], f"{f}/target", f"{f}/checkpoint", ["event_id"]).awaitTermination()
    return spark.read.parquet(f"{f}/target").select("user_id", "event_type")


@query("r3_running_counters", "select cast(ts as date) as date, event_type, count(*) as count from events group by 1, 2")
def r3(spark, d):
    f = fresh_folder(spark)
    counters.run_counters(_stream(spark, d, "events"), "ts", ["event_type", "user_id"], f"{f}/out", f"{f}/checkpoint").awaitTermination()
    return counters.counters(spark.read.parquet(f"{f}/out/event_type"), "event_type")


@query("r4_late_arrivals", """
select event_id, case when event_id % 20 = 0 and cast(ts as date) < date '2024-01-15' then date '2024-01-15' else cast(ts as date) end as day from events""")
def r4(spark, d):
    # a twentieth of the events is looked at for the first time in the middle of the month; all are then seen again on its last day, which changes nothing
    f = fresh_folder(spark)
    day = F.to_date("ts")
    processed = F.when(F.col("event_id") % 20 == 0, F.greatest(day, F.lit("2024-01-15").cast("date"))).otherwise(day)
    e = _stream(spark, d, "events").select("event_id", day.alias("report_day"), F.explode(F.array(processed, F.lit("2024-12-31").cast("date"))).alias("processed_day"))
    counters.shift_late(e, ["event_id"], "report_day", "processed_day", f"{f}/target", f"{f}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{f}/target").select("event_id", F.col("counts_for").alias("day"))


@query("r5_open_batches_first", "select event_id, upper(event_type) as result, event_id % 10 = 0 as resumed from events")
def r5(spark, d):
    # an earlier run has begun a tenth of the events and not come to their end
    f = fresh_folder(spark)
    begun = table(spark, d, "events").where("event_id % 10 = 0").select("event_id", "event_type", F.lit("2024-01-01").cast("timestamp").alias("begun_at"))
    begun.write.parquet(f"{f}/work/begun/batch=-1")
    work = lambda rows: rows.select("event_id", F.upper("event_type").alias("result"))
    counters.run_with_open_batches(_stream(spark, d, "events").select("event_id", "event_type"), ["event_id"], work, f"{f}/work", f"{f}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{f}/work/done").select("event_id", "result", "resumed")


@query("r6_failure_streak", "with f as (select event_id, event_type = 'error' as failed from events) select event_id, failed and coalesce(lag(failed) over (order by event_id), false) as tripped from f")
def r6(spark, d):
    from tidemark.operators.ordered import with_previous

    e = table(spark, d, "events").select("event_id", (F.col("event_type") == "error").alias("failed"))
    return with_previous(e, ["event_id"], "failed").select("event_id", (F.col("failed") & F.coalesce("previous", F.lit(False))).alias("tripped"))


@query("r6_run_state", """
with o as (select user_id, event_id, case event_type when 'error' then 'failed' when 'purchase' then 'published' when 'signup' then 'skipped' else 'started' end as outcome from events),
g as (select *, sum(case when outcome in ('published', 'skipped') then 1 else 0 end) over (partition by user_id order by event_id) as since from o),
f as (select *, sum(case when outcome = 'failed' then 1 else 0 end) over (partition by user_id, since order by event_id) as failures from g)
select user_id as job, event_id as run, cast(failures as integer) as failures, outcome = 'failed' and failures >= 2 as tripped from f""")
def r6_state(spark, d):
    # every user is a job, and every event one of its runs
    f = fresh_folder(spark)
    outcome = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "published").when(F.col("event_type") == "signup", "skipped").otherwise("started")
    streaks = runs.failure_streaks(_stream(spark, d, "events").select("user_id", "event_id", outcome.alias("outcome")), "user_id", "event_id", "outcome")
    streaks.writeStream.format("parquet").option("path", f"{f}/streaks").option("checkpointLocation", f"{f}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(streaks.schema).parquet(f"{f}/streaks")


WEEK = "cast(date '1970-01-01' + cast(date_diff('day', date '1970-01-01', cast(ts as date)) // 7 * 7 as integer) as date)"


@query("r7_tumbling_weeks", f"select {WEEK} as start, event_type, count(*) as n from events group by 1, 2")
def r7(spark, d):
    f = fresh_folder(spark)
    counters.run_weekly(_stream(spark, d, "events"), "ts", "event_type", f"{f}/weeks", f"{f}/checkpoint").awaitTermination()
    return counters.latest_counts(spark.read.parquet(f"{f}/weeks"), "event_type")


@query("r7_sliding_fortnights", f"""
select start, event_type, count(*) as n from (select {WEEK} as start, event_type from events union all select {WEEK} - 7, event_type from events) group by 1, 2""")
def r7_sliding(spark, d):
    f = fresh_folder(spark)
    counters.run_weekly(_stream(spark, d, "events"), "ts", "event_type", f"{f}/weeks", f"{f}/checkpoint", length="14 days", slide="7 days").awaitTermination()
    return counters.latest_counts(spark.read.parquet(f"{f}/weeks"), "event_type")


@query("r9_first_in_run", "select doc_id, min(doc_id) over (partition by md5(text)) as first_doc from documents")
def r9(spark, d):
    from tidemark.operators.relational import duplicates_of_first

    return duplicates_of_first(table(spark, d, "documents").select("doc_id", F.md5("text").alias("h")), ["h"], ["doc_id"]).select("doc_id", F.col("first_doc_id").alias("first_doc"))


@query("s11_partitioned_sink", "select cast(ts as date) as day, event_id, 'en' as lang from events union all select cast(ts as date), event_id, 'de' from events where event_id % 2 = 0")
def s11(spark, d):
    from tidemark.sources.files import write_by_language

    f = fresh_folder(spark)
    rows = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    write_by_language(rows, "day", "event_id", {"en": F.col("event_type"), "de": F.when(F.col("event_id") % 2 == 0, F.col("event_type"))}, f"{f}/out")
    return spark.read.schema("event_id bigint, text string, day date, lang string").json(f"{f}/out").select("day", "event_id", "lang")


@query("s13_csv_sink", "select p_partkey, p_name, p_retailprice from part")
def s13(spark, d):
    f = fresh_folder(spark)
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    rows.write.csv(f"{f}/out", header=True)
    return spark.read.csv(f"{f}/out", header=True, schema=rows.schema)


@query("s15_usage_log", "select l_orderkey, cast(l_linenumber as bigint) as tokens from lineitem where l_linenumber % 2 = 0")
def s15(spark, d):
    from tidemark.sources.files import append_usage

    f = fresh_folder(spark)
    tokens = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("string")).otherwise("n/a")
    append_usage(table(spark, d, "lineitem").select("l_orderkey", tokens.alias("tokens")), f"{f}/log", ["tokens"])
    return spark.read.parquet(f"{f}/log")


@query("f10_skip_list", "select l_suppkey as id, count(*) as n from lineitem where l_suppkey in (3, 17, 44) group by 1")
def f10(spark, d):
    from tidemark.sources.files import skip_list

    f = fresh_folder(spark)
    lines = spark.createDataFrame([("# suspended",), ("3",), ("17 # twice",), ("",), ("x9",), ("44",)], "value string")
    lines.write.text(f"{f}/skip")
    ids, _ = skip_list(spark, f"{f}/skip")
    li = table(spark, d, "lineitem").join(F.broadcast(ids), F.col("l_suppkey") == F.col("id"), "left_semi")
    return li.groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n"))


@query("x3_file_hashes")
def x3(spark, d):
    from tidemark.sources.digests import file_hashes

    return file_hashes(spark, d).select("sha256")

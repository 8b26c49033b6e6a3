"""Streams: running counters, ingest once, late arrivals, tumbling and sliding weeks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_counts(events: DataFrame, ts: str, dimension: str | None = None) -> DataFrame:
    """Events a day, or a day and one dimension. Dimensions are never crossed: each published table has one."""
    keys = [F.to_date(ts).alias("date")] + ([F.coalesce(F.col(dimension).cast("string"), F.lit("unknown")).alias(dimension)] if dimension else [])
    return events.groupBy(*keys).agg(F.count("*").alias("count"))


def run_counters(events: DataFrame, ts: str, dimensions: Sequence[str], folder: str, checkpoint: str) -> StreamingQuery:
    """One stream that feeds a total and a table for each dimension; every batch adds its increments under its own number, so a batch that runs again replaces itself."""

    def add(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        for name in [None, *dimensions]:
            daily_counts(batch, ts, name).write.mode("overwrite").parquet(f"{folder}/{name or 'total'}/batch={number}")
        batch.unpersist()

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(increments: DataFrame, dimension: str | None = None) -> DataFrame:
    """The counters' values from all batches."""
    return increments.groupBy("date", *([dimension] if dimension else [])).agg(F.sum("count").alias("count"))


def _before(spark: SparkSession, folder: str, number: int, schema: str) -> DataFrame:
    """What earlier batches have written to a folder; nothing, if none has."""
    try:
        return spark.read.schema(f"{schema}, batch int").parquet(folder).where(F.col("batch") < number)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{schema}, batch int")


def ingest_once(arrivals: DataFrame, keys: Sequence[str], target: str, checkpoint: str, order: Sequence[str], buckets: int = 256) -> StreamingQuery:
    """Appends arrivals whose key the target has not had in all its history; of several in a batch the first in `order`.

    The keys of all history lie in buckets of their hash under {target}/_keys. A batch reads the buckets that its own keys fall into, and of each only the last version, and writes
    these anew with its keys added; {target}/_versions has a row for each bucket. So the files that a batch reads don't grow with the number of batches before. Everything is
    written under the batch's number: a batch that runs again replaces itself.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        types = ", ".join(f"`{k}` {dict(batch.dtypes)[k]}" for k in keys)
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        fresh = batch.withColumn("_n", place).where("_n = 1").drop("_n").withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        touched = {r["_bucket"] for r in fresh.select("_bucket").distinct().collect()}
        versions = {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version int").parquet(f"{target}/_versions/batch={number - 1}").collect()} if number else {}
        held = [f"{target}/_keys/batch={versions[b]}/_bucket={b}" for b in sorted(touched & versions.keys())]
        known = spark.read.schema(types).option("basePath", f"{target}/_keys").parquet(*held) if held else None
        added = fresh
        if known is not None:
            same = None
            for k in keys:
                one = fresh[k].eqNullSafe(known[k])
                same = one if same is None else same & one
            added = fresh.join(known.select(*keys), same, "left_anti")
        added.drop("_bucket").write.mode("overwrite").parquet(f"{target}/batch={number}")
        own = fresh.select(*keys, "_bucket")
        if known is not None:
            # keys that are there again and those that are new: together with what the bucket had, each once
            own = own.unionByName(known.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"))).distinct()
        own.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/_keys/batch={number}")
        now = versions | dict.fromkeys(touched, number)
        spark.createDataFrame(sorted(now.items()), "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{target}/_versions/batch={number}")
        fresh.unpersist()

    return arrivals.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_day(report_day: Column, processed_day: Column, first_time: Column) -> Column:
    """The day an item counts for: an item that is looked at for the first time on a later day moves to that day; published days stay closed."""
    return F.when(first_time & (processed_day > report_day), processed_day).otherwise(report_day)


def shift_late(arrivals: DataFrame, keys: Sequence[str], report_day: str, processed_day: str, target: str, checkpoint: str) -> StreamingQuery:
    """Appends each key's first arrival with the day it counts for (see late_day), in every batch against all batches before: later arrivals of a key change nothing, so published days stay closed."""
    day = late_day(F.col(report_day), F.col(processed_day), F.lit(True))
    return ingest_once(arrivals.withColumn("counts_for", day), keys, target, checkpoint, [processed_day, report_day])


def run_with_open_batches(arrivals: DataFrame, keys: Sequence[str], work: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str) -> StreamingQuery:
    """Does `work` on arrivals in batches whose rows are recorded when they are begun and when they are done.

    Batches that an earlier run has begun and not done are followed before any new work, with the time at which they were begun; their keys, and those done, are
    not begun again. Tables in folder: begun (batch, begun_at) and done (batch, begun_at, resumed, the rows of work).
    """

    def table(spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
        try:
            return spark.read.parquet(f"{folder}/{name}")
        except Exception as e:  # nothing has been written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return like.limit(0)

    def finish(rows: DataFrame, number: int, resumed: bool) -> None:
        begun = F.first("begun_at")
        stamp = rows.agg(begun.alias("begun_at"))
        work(rows.drop("begun_at", "batch")).crossJoin(F.broadcast(stamp)).withColumn("resumed", F.lit(resumed)).write.mode("overwrite").parquet(f"{folder}/done/batch={number}")

    def follow(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        empty = batch.withColumns({"begun_at": F.current_timestamp(), "batch": F.lit(0)})
        begun = table(spark, "begun", empty)
        done = table(spark, "done", empty).select("batch").distinct()
        # batches are few: one number each
        waiting = [r["batch"] for r in begun.where(F.col("batch") < number).select("batch").distinct().join(done, "batch", "left_anti").orderBy("batch").collect()]
        for earlier in waiting:
            finish(begun.where(F.col("batch") == earlier), earlier, True)
        fresh = batch.dropDuplicates(list(keys)).join(begun.where(F.col("batch") != number).select(*keys), list(keys), "left_anti")
        fresh.withColumn("begun_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{folder}/begun/batch={number}")
        finish(spark.read.parquet(f"{folder}/begun/batch={number}"), number, False)

    return arrivals.writeStream.foreachBatch(follow).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_weekly(events: DataFrame, ts: str, key: str, folder: str, checkpoint: str, watermark: str = "2 days", length: str = "7 days", slide: str | None = None) -> StreamingQuery:
    """Counts of events for each tumbling or sliding run of days as a stream: every batch adds its own counts under its number, and latest_counts() sums them.

    No event is dropped for coming late. A window is closed when the latest event of earlier batches is more than the watermark behind its end; events for closed windows go, whole, to
    {folder}/_late as well, and the counts that they add are marked, so that published weeks can be corrected by them.
    """

    def update(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("_ts", F.col(ts).cast("timestamp")).persist()
        clock = _before(batch.sparkSession, f"{folder}/_clock", number, "latest timestamp").agg(F.max("latest") - F.expr(f"interval {watermark}")).first()[0]
        window = F.window("_ts", length, slide) if slide else F.window("_ts", length)
        late = F.col("window.end") <= F.lit(clock).cast("timestamp") if clock else F.lit(False)
        placed = batch.select("*", window.alias("window")).withColumn("late", late)
        counts = placed.groupBy("window", key, "late").agg(F.count("*").alias("n"))
        counts.select(F.col("window.start").cast("date").alias("start"), key, "n", "late").write.mode("overwrite").parquet(f"{folder}/batch={number}")
        placed.where("late").select(*[c for c in batch.columns if c != "_ts"], F.col("window.start").cast("date").alias("start")).write.mode("overwrite").parquet(f"{folder}/_late/batch={number}")
        batch.agg(F.max("_ts").alias("latest")).write.mode("overwrite").parquet(f"{folder}/_clock/batch={number}")
        batch.unpersist()

    return events.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counts(updates: DataFrame, key: str) -> DataFrame:
    """Each window's count from all batches, late events included."""
    return updates.groupBy("start", key).agg(F.sum("n").alias("n"))


def corrections(updates: DataFrame, key: str) -> DataFrame:
    """What late events have added to windows after they were closed: start, key, n, and how many batches did so."""
    return updates.where("late").groupBy("start", key).agg(F.sum("n").alias("n"), F.count_distinct("batch").alias("batches"))


def weekly(events: DataFrame, ts: str, key: str, watermark: str = "2 days", length: str = "7 days", slide: str | None = None) -> DataFrame:
    """Events for each tumbling or sliding run of days, counted by the engine, which drops rows later than the watermark; run_weekly() keeps them."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.withWatermark(ts, watermark).groupBy(window, key).agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("start"), key, "n")

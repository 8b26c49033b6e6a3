"""Streams that are cut into batches and begun again give the batch answer; facets and order statistics by plain versions."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facets, trends
from tidemark.streaming import counters, runs


def written_one_by_one(spark, folder, parts, schema):
    """A folder with a file for each part, in order of their times."""
    import os
    import time

    for k, rows in enumerate(parts):
        target = f"{folder}/{k:03}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            if name.endswith(".parquet"):
                os.rename(f"{target}/{name}", f"{folder}/part-{k:03}.parquet")
                at = time.time() - 1000 + k
                os.utime(f"{folder}/part-{k:03}.parquet", (at, at))


def stream(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/part-*.parquet")


def test_failure_streaks_over_batches_and_restarts(spark, tmp_path):
    random.seed(2)
    runs_of = [(random.choice(["a", "b", None]), i, random.choice(["failed", "failed", "published", "skipped", "started", None])) for i in range(60)]
    schema, source, out = "job string, run long, outcome string", str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    for half in (runs_of[:30], runs_of):
        # the second run finds the files of the first and as many more
        done = len(list((tmp_path / "in").glob("part-*")))
        for k in range(done, len(half) // 6):
            part = tmp_path / f"w{k}"
            part.mkdir()
            written_one_by_one(spark, str(part), [half[6 * k : 6 * k + 6]], schema)
            (part / "part-000.parquet").rename(tmp_path / "in" / f"part-{k:03}.parquet")
        streaks = runs.failure_streaks(stream(spark, source, schema), "job", "run", "outcome")
        streaks.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    failures, wanted = Counter(), set()
    for job, run, outcome in runs_of:
        failures[job] = failures[job] + 1 if outcome == "failed" else 0 if outcome in ("published", "skipped") else failures[job]
        wanted.add((job, run, failures[job], outcome == "failed" and failures[job] >= 2))
    assert {tuple(r) for r in spark.read.schema(streaks.schema).parquet(out).collect()} == wanted


@pytest.mark.parametrize("slide", [None, "7 days"])
def test_late_rows_correct_closed_weeks(spark, tmp_path, slide):
    """A second run brings rows three weeks late: counts are the batch answer, and what was late is told and kept."""
    random.seed(5)
    at = lambda day: dt.datetime(2024, 3, 1, 12) + dt.timedelta(day)
    schema = "ts timestamp, kind string, n_id int"
    first = [[(at(d), random.choice(["x", "y", None]), 100 * d + i) for i in range(3)] for d in range(0, 40, 2)]
    late = [[(at(d - 21), "late", d) for d in (38, 39, 40)] + [(at(41), "x", 1)]]
    folder, out = tmp_path / "in", str(tmp_path / "weeks")
    folder.mkdir()
    length = "14 days" if slide else "7 days"
    go = lambda: counters.run_weekly(stream(spark, str(folder), schema, 2), "ts", "kind", out, str(tmp_path / "c"), length=length, slide=slide).awaitTermination()
    written_one_by_one(spark, str(folder), first, schema)
    go()
    assert spark.read.parquet(f"{out}/_late").count() == 0
    more = tmp_path / "more"
    more.mkdir()
    written_one_by_one(spark, str(more), late, schema)
    (more / "part-000.parquet").rename(folder / "part-900.parquet")
    go()
    rows = [r for part in first + late for r in part]
    windows = F.window("ts", length, slide) if slide else F.window("ts", length)
    batch = spark.createDataFrame(rows, schema).groupBy(windows.alias("w"), "kind").count().select(F.col("w.start").cast("date").alias("start"), "kind", F.col("count").alias("n"))
    updates = spark.read.parquet(out)
    assert {tuple(r) for r in counters.latest_counts(updates, "kind").collect()} == {tuple(r) for r in batch.collect()}
    # every window that such a row falls into ended weeks before
    times = 2 if slide else 1
    assert spark.read.parquet(f"{out}/_late").select("n_id").distinct().count() == 3
    assert counters.corrections(updates, "kind").agg(F.sum("n")).first()[0] == 3 * times


def test_ingest_once_reads_only_what_it_touches(spark, tmp_path):
    """The answer of one batch over all; the key files a batch reads don't grow with the batches before."""
    random.seed(6)
    schema = "id string, ts int"
    parts = [[(random.choice([None, *(f"k{random.randint(0, 60)}" for _ in range(5))]), 1000 * k + i) for i in range(12)] for k in range(12)]
    folder, target = tmp_path / "in", str(tmp_path / "t")
    folder.mkdir()
    written_one_by_one(spark, str(folder), parts, schema)
    counters.ingest_once(stream(spark, str(folder), schema), ["id"], target, str(tmp_path / "c"), ["ts"], buckets=8).awaitTermination()
    first = {}
    for part in parts:
        for i, ts in part:
            first.setdefault(i, ts)
    got = spark.read.parquet(target).select("id", "ts").collect()
    assert {r.id: r.ts for r in got} == first and len(got) == len(first)
    versions = spark.read.parquet(f"{target}/_versions/batch=11").collect()
    assert len(versions) == len({r.bucket for r in versions}) <= 8
    held = sum(len(list((tmp_path / "t" / "_keys" / f"batch={r.version}" / f"_bucket={r.bucket}").glob("*.parquet"))) for r in versions)
    assert held == len(versions)


def test_facet_index_by_filters(spark):
    random.seed(1)
    ids = random.sample(range(-70000, 200000), 3000) + [0, 1, 32768, 32769, -32768, -1]
    rows = [(i, random.choice(["n", "s", None]), random.choice([["p"], ["p", "q"], [], None]), dt.date(2024, 1, 1) + dt.timedelta(random.randint(0, 99))) for i in ids]
    df = spark.createDataFrame([*rows, (None, "n", ["p"], dt.date(2024, 1, 1))], "id long, side string, tags array<string>, day date").repartition(3)
    index = facets.facet_index(df, "id", {"side": F.col("side"), "tags": F.col("tags"), "day": F.col("day")}).cache()
    wanted = {"side": ["n", "s"], "tags": ["q"], "day": ("2024-01-10", "2024-02-20")}
    hits = [r for r in rows if r[1] and r[2] and "q" in r[2] and dt.date(2024, 1, 10) <= r[3] <= dt.date(2024, 2, 20)]
    matches = facets.matching(index, wanted)
    assert sorted(r.id for r in facets.ids_of(matches).collect()) == sorted(r[0] for r in hits) and hits
    assert facets.number_of(matches).first().n == len(hits)
    counts = Counter([("side", r[1]) for r in hits] + [("tags", t) for r in hits for t in r[2]] + [("day", str(r[3])) for r in hits])
    assert {(r.facet, r.value): r.n for r in facets.value_counts(index, matches).collect()} == counts
    assert facets.number_of(facets.matching(index, {"side": ["none"]})).first().n == 0
    assert index.groupBy("facet", "value", "bucket").count().where("count > 1").count() == 0


def test_order_statistics_of_a_frequent_value(spark):
    """Nine tenths of a group have one value, which is one row to order."""
    random.seed(3)
    groups = {"a": [5.0] * 900 + [random.random() * 10 for _ in range(100)], "b": [1.0], "c": [None, None, 2.0], None: [3.0, 4.0]}
    rows = spark.createDataFrame([(g, v) for g, some in groups.items() for v in some], "g string, v double").repartition(5)
    found = {r.g: r for r in trends.order_statistics(rows, ["g"], "v").collect()}
    for g, some in groups.items():
        order = sorted(some, key=lambda v: (v is not None, v or 0))
        r = found[g]
        assert (r.n, r.median, r.p95, r.max) == (len(some), order[len(some) // 2], order[min(int(0.95 * len(some)), len(some) - 1)], max(v for v in some if v is not None))

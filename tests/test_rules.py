"""Small hand-written cases for the rules of calendars, texts, shares, scores and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar, places, scores, text, web
from tidemark.operators import relational, trends
from tidemark.sources import files
from tidemark.streaming import counters

day = dt.date.fromisoformat


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("at,name,wanted", [
    ("2026-09-21 12:00:00", None, "2026-09-21"), ("2026-09-21 21:42:00", "unlabeled.pdf", "2026-09-21"), ("2026-09-29 21:39:55", "The Daily Telegraph_2909.pdf", "2026-09-29"),
    ("2026-09-29 21:31:32", "The Washington Post - September 29, 2026.pdf", "2026-09-29"), ("2026-09-29 21:29:05", "USA Today Sports Weekly_3009.pdf", "2026-09-30"),
    ("2026-09-22 00:00:00", None, "2026-09-22"), ("2026-09-21 23:59:59", None, "2026-09-21"), ("2026-09-21 21:42:00", "Some Newspaper 42.pdf", "2026-09-21"),
])
def test_download_day(spark, at, name, wanted):
    c = calendar.download_day(F.lit(at).cast("timestamp"), F.lit(name).cast("string"), "Asia/Jerusalem")
    assert value(spark, c) == day(wanted)


def test_windows_and_fortnights(spark):
    lit = lambda s: F.lit(s).cast("date")
    assert tuple(value(spark, F.struct(*calendar.rolling_window(lit("2026-10-22"))))) == (day("2026-10-08"), day("2026-10-21"))
    assert value(spark, calendar.latest_weekday(lit("2026-10-25"))) == day("2026-10-22")
    assert value(spark, calendar.latest_weekday(lit("2026-10-21"))) == day("2026-10-15")
    anchor = lit("2026-10-01")
    assert value(spark, calendar.latest_closed_fortnight_end(lit("2026-10-15"), anchor)) == day("2026-10-14")
    assert value(spark, calendar.latest_closed_fortnight_end(lit("2026-10-22"), anchor, 8)) == day("2026-10-14")
    assert value(spark, calendar.latest_closed_fortnight_end(lit("2026-10-23"), anchor, 8)) is None
    assert value(spark, calendar.latest_closed_fortnight_end(lit("2026-10-10"), anchor)) is None
    assert value(spark, calendar.week_index(lit("2026-09-30"), anchor, 14)) == -1


@pytest.mark.parametrize("rate,kind", [(0.16, "weekly"), (0.25, "weekly"), (0.62, "daily"), (0.95, "daily")])
def test_cadence(spark, rate, kind):
    assert value(spark, calendar.cadence(F.lit(rate))) == kind


@pytest.mark.parametrize("rate,seen,expected,active", [(0.2, 1, 1.0, True), (0.2, 0, 1.0, False), (0.9, 3, 6.0, True), (0.9, 2, 6.0, False), (0.9, 1, 1.4, True), (0.9, 5, 0.0, False)])
def test_active(spark, rate, seen, expected, active):
    assert value(spark, calendar.is_active(F.lit(rate), F.lit(seen), F.lit(expected))) is active


@pytest.mark.parametrize("said,codes", [
    ("Russia's economy", ["RU"]), ("Die iranischen Raketen trafen die ukrainische Stadt", ["IR", "UA"]), ("South Sudan talks", ["SS"]), ("Südsudan und Sudan", ["SD", "SS"]),
    ("Reported by the Washington Post", []), ("They polish the table and eat turkey", []), ("Chinatown and Iranwhatever", []), ("The state of Georgia", []), ("äUS", []),
])
def test_named_countries(spark, said, codes):
    assert value(spark, places.named(F.lit(said))) == codes
    assert value(spark, places.named(places.item_text(F.lit("Kyiv"), F.lit(None).cast("string"), F.lit("Berlin")))) == ["DE", "UA"]


def test_page_text(spark):
    long = "Straße und " * 30
    a, b, c = (value(spark, text.text_hash(F.lit(t))) for t in (long, long.upper().replace(" ", " \n\t"), long + "anders"))
    assert a != "" and a == value(spark, text.text_hash(F.lit(long.replace(" ", "  ")))) and a != c
    assert value(spark, text.text_hash(F.lit("short"))) == ""
    assert value(spark, text.text_hash(F.lit(None).cast("string"))) == ""
    assert value(spark, text.is_unreadable(F.lit("(cid:12)" * 50))) and not value(spark, text.is_unreadable(F.lit("short")))


def test_claimed_counts_and_openings(spark):
    assert value(spark, text.claimed_sources(F.lit("Four newspapers and 12 daily papers; seven rivers"), "en")) == [4, 12]
    assert value(spark, text.claimed_sources(F.lit("drei große Zeitungen"), "de")) == [3]
    assert value(spark, text.opening_sentence(F.lit("The U.S. said so. Then not."))) == "The US said so."
    assert value(spark, text.one_for_and(F.lit("Brandt-1 Smith"))) and not value(spark, text.one_for_and(F.lit("the B-1 bomber")))
    repaired = text.joined_prefix_repaired(F.lit("вBerlin und вкParis"), "[а-я]", "[A-Za-z]")
    assert value(spark, repaired) == "в-Berlin und вк Paris"
    assert value(spark, text.joined_prefix_repaired(repaired, "[а-я]", "[A-Za-z]")) == "в-Berlin und вк Paris"
    assert value(spark, text.script_ratio(F.lit("short"), "a-z")) is None


def test_visits(spark):
    assert value(spark, web.primary_language(F.lit("en-US,de;q=0.5"))) == "en" and value(spark, web.primary_language(F.lit(""))) == "unknown"
    assert value(spark, web.referrer_host(F.lit("https://www.example.com/x?y"))) == "www.example.com" and value(spark, web.referrer_host(F.lit("::no"))) == "direct"
    assert value(spark, web.device_family(F.lit(None).cast("string"))) == "other"


def test_country_week_trend(spark):
    rows = spark.createDataFrame([("FR", "2026-10-01", "Guardian", 1, False), ("FR", "2026-10-08", "Die Welt", 2, True)], "country string, d string, paper string, item long, named boolean").withColumn("day", F.to_date("d"))
    got = {r.week: (r.n_sources, r.n_items) for r in trends.distinct_trend(rows, "country", "day", "paper", "item", F.col("named")).collect()}
    assert got == {0: (0, 0), 1: (1, 1)}


def test_equal_weight_and_pooled_shares(spark):
    tags = [("Guardian", "FR"), ("Guardian", "FR"), ("Guardian", "DE"), ("Guardian", "DE"), ("Die Welt", "FR")]
    rows = spark.createDataFrame([(0, p, c, i) for i, (p, c) in enumerate(tags)], "week int, paper string, country string, item long")
    got = {r.country: (r.share, r.pooled, r.n_named, r.n_reporting) for r in trends.source_shares(rows, "week", "paper", "country", "item").collect()}
    assert got == {"FR": (75.0, 60.0, 3, 2), "DE": (25.0, 40.0, 2, 2)}


def test_strict_change(spark):
    series = spark.createDataFrame([("x", w, s) for w, s in enumerate([None, None, None, 10.0, 12.0, 14.0, 16.0, 20.0])], "k string, week int, share double")
    change = lambda base, first: {r.week: r.change for r in trends.strict_change(series, "k", "week", "share", base, first).collect()}
    assert change(4, 3)[7] == 7.0 and change(1, 3)[4] == 2.0 and change(1, 3)[3] is None and change(4, 3)[6] is None
    same = lambda a, b: value(spark, trends.same_sign(F.lit(a), F.lit(b)))
    assert (same(1.5, 0.2), same(0.4, -0.1), same(0.0, 0.1), same(0.0, 0.0)) == (True, False, False, True)
    thin = lambda a, b: value(spark, trends.thin_evidence(F.lit(a), F.lit(b)))
    assert (thin(10.0, 10.0), thin(9.9, 40.0), thin(1.0, 14.0)) == (False, True, True)


def test_drift_alerts(spark):
    def alerts(zs, days):
        rows = [("s", dt.date(2026, 1, d), z) for d, z in zip(days, zs, strict=True)]
        return [r.alert for r in trends.drift_alerts(spark.createDataFrame(rows, "s string, day date, z double"), "s", "day", "z").orderBy("day").collect()]

    assert alerts([-2.01], [1]) == [True] and alerts([-1.99], [1]) == [False]
    assert alerts([-1.6, -1.7, -1.55], [1, 2, 3])[-1] and not alerts([-1.6, -1.7, -1.55], [1, 2, 4])[-1] and not alerts([-1.6, -1.2, -1.55], [1, 2, 3])[-1]


def test_cost_and_intervals(spark):
    cost = lambda w, r: scores.call_cost(F.lit(1000), F.lit(100), F.lit(w), F.lit(r), F.lit(2.0), F.lit(10.0), F.lit("screen"))
    total = value(spark, cost(4000, 0) + cost(0, 4000))
    assert total == pytest.approx((2000 * 2 + 4000 * 2.5 + 4000 * 0.2 + 200 * 10) / 1e6)
    assert value(spark, scores.call_cost(F.lit(1), F.lit(1), F.lit(1), F.lit(1), F.lit(None).cast("double"), F.lit(1.0), F.lit("x"))) is None
    assert tuple(value(spark, F.struct(*scores.wilson(F.lit(0.0), F.lit(0.0))))) == (0.0, 0.0)
    low, high = value(spark, F.struct(*scores.wilson(F.lit(8.0), F.lit(10.0))))
    assert (round(low, 3), round(high, 3)) == (0.490, 0.943)
    assert value(spark, scores.percent_label(F.lit(28), F.lit(25))) == "+12%" and value(spark, scores.percent_label(F.lit(3), F.lit(0))) == "new"


def test_packing_and_matching(spark):
    rows = spark.createDataFrame([("r", i, s) for i, s in enumerate([5, 5, 5, 30, 1])], "run string, i int, size long")
    assert [r.window for r in trends.packed(rows, "run", "i", "size", 10).orderBy("i").collect()] == [0, 0, 1, 2, 3]
    pairs = spark.createDataFrame([("t", "a", "x", 0.9), ("t", "a", "y", 0.8), ("t", "b", "x", 0.85), ("t", "b", "y", 0.7), ("t", "c", "z", 0.5)], "t string, l string, r string, s double")
    assert {(r.l, r.r) for r in relational.greedy_matches(pairs, "t", "l", "r", "s").collect()} == {("a", "x"), ("b", "y")}


def test_weekly_roster_gap_and_insert(spark):
    existing = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "k long, v string")
    assert sorted(map(tuple, relational.insert_ignore(existing, new, ["k"], ["v"]).collect())) == [(1, "a"), (2, "c")]
    assert relational.insert_ignore(existing.where("false"), new.where("false"), ["k"]).count() == 0


def test_streams(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "2026-01-01 10:00:00", "a"), (2, "2026-01-01 11:00:00", "b"), (1, "2026-01-02 10:00:00", "a")], "id long, t string, kind string").withColumn("ts", F.to_timestamp("t"))
    rows.write.parquet(source)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    for _ in range(2):
        counters.run_counters(stream(), "ts", ["kind"], out, str(tmp_path / "c1")).awaitTermination()
        counters.ingest_once(stream(), ["id"], str(tmp_path / "once"), str(tmp_path / "c2"), ["ts"]).awaitTermination()
        rows.write.mode("append").parquet(source)
    total = {str(r.date): r["count"] for r in counters.counters(spark.read.parquet(f"{out}/total")).collect()}
    assert total == {"2026-01-01": 4, "2026-01-02": 2}
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "once")).collect()) == [1, 2]
    query = counters.weekly(stream(), "ts", "kind").writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.kind, r.n) for r in spark.table("weeks").collect()} == {("a", 6), ("b", 3)}


def test_files(spark, tmp_path):
    log = str(tmp_path / "log")
    files.append_usage(spark.createDataFrame([("x", "5"), ("y", "many")], "ref string, tokens string"), log, ["tokens"])
    assert [tuple(r) for r in spark.read.parquet(log).collect()] == [("x", 5)]
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "z")], "a int, b string")
    assert sorted((r.a, r.b) for r in files.evolved(old, new).collect()) == [(1, None), (2, "z")]

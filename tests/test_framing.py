"""Rules on framing, national labels, defects, audits, excerpts, ordered tables and open batches, by hand-written cases and brute force."""

import datetime as dt
import difflib
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar, framing, places, scores, text
from tidemark.operators import audit, excerpts, ordered, relational, trends
from tidemark.sources import files
from tidemark.streaming import counters

PAPERS = {"The Guardian": "UK", "The Daily Telegraph": "UK", "Los Angeles Times": "US", "The Washington Post": "US", "Süddeutsche Zeitung": "Germany", "Neue Zürcher Zeitung": "Switzerland", "The Economist": "International"}


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("said,lang,wanted", [
    ("Coverage splits between the British press and German-language outlets. More.", "en", True), ("The papers differ less along national lines than over tone.", "en", False),
    ("The split runs along national lines.", "en", True), ("Britain and Germany differ over fish.", "en", False), ("The British press and American media do not differ.", "en", False),
    ("British coverage alone diverges.", "en", False), ("Die britische Presse und die deutschen Medien fallen auseinander.", "de", True), ("Die Berichterstattung teilt sich nach Ländern.", "de", True),
    ("Nicht entlang nationaler Linien, sondern im Ton.", "de", False), ("הסיקור הבריטי שונה מהדיווח הגרמני.", "he", True), ("הממשלה הבריטית שונה.", "he", False), ("", "en", False), (None, "en", False),
    ("It is not a surprise, since after all these many long weeks of talks the coverage is split by country.", "en", True),
])
def test_frames_by_nationality(spark, said, lang, wanted):
    assert value(spark, framing.frames_by_nationality(F.lit(said).cast("string"), lang)) is wanted


def test_same_country_and_conflict(spark):
    papers = F.array(*map(F.lit, ("The Guardian", "The Daily Telegraph", "The Economist", "The Washington Post", "unknown")))
    assert value(spark, framing.same_country(papers, PAPERS)) == {"UK": ["The Daily Telegraph", "The Guardian"]}
    texts = {"en": F.lit("The split runs along national lines."), "de": F.lit("Alle berichten.")}
    assert value(spark, framing.framing_conflict(texts, papers, PAPERS)) == ["en"]
    assert value(spark, framing.framing_conflict(texts, F.array(F.lit("The Guardian")), PAPERS)) == []


@pytest.mark.parametrize("said,lang,wanted", [
    ("All three major American papers - The Guardian, Los Angeles Times and The Washington Post - agree.", "en", [("American papers", ["The Guardian"])]),
    ("British newspapers such as The Guardian and The Daily Telegraph agree.", "en", []), ("German-language newspapers, especially Neue Zürcher Zeitung, agree.", "en", []),
    ("American outlets: The Economist and Süddeutsche Zeitung.", "en", [("American outlets", ["Süddeutsche Zeitung"])]), ("The German paper differs where The Guardian agrees.", "en", []),
    ("Die deutschen Zeitungen, darunter die Süddeutschen Zeitung und The Guardian, sagen es.", "de", [("deutschen Zeitungen", ["The Guardian"])]), (None, "en", []),
])
def test_nationality_conflicts(spark, said, lang, wanted):
    found = value(spark, framing.nationality_conflicts(PAPERS, lang)(F.lit(said).cast("string")))
    assert [(r.label, r.wrong) for r in found] == wanted


def test_a_batch_of_long_texts_is_not_held_as_strings():
    """Rules on texts get them one by one: 40 MB of texts take no more than a few texts' memory."""
    long = "papers such as The Guardian agree. " * 5000
    texts = pa.array([long + str(i) for i in range(200)])
    for rule in (framing.nationality_conflicts(PAPERS, "en"), framing.nationality_conflicts(PAPERS, "de")):
        tracemalloc.start()
        found = rule.func(texts.slice(0, 200))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == 200 and peak < 8 * len(long), peak


def test_defects(spark):
    hebrew = "א-ת"
    defects = lambda said, expected=None: value(spark, text.text_defects(F.lit(said), rf"[{hebrew}\x00-\x7FÀ-ÿ–]", (f"[{hebrew}]", "[A-Za-zÀ-ÿ]", f"[{hebrew}]{{1,2}}[A-ZÀ-Þ][A-Za-zÀ-ÿ]*"), expected))
    assert defects("The Daily Telegraph ו-Frankfurter Allgemeine ב-3") == {}
    assert defects("הממשלהThe и") == {"foreign_chars": ["и"], "mixed_script": ["הממשלהThe"]} and defects("בSüddeutsche") == {}
    assert defects("overview_he: x</comparison_text_he>") == {"tag_fragment": ["overview_he", "</comparison_text_he"]} and defects("2 > 1 <- 3") == {}
    english = "While all three articles address the drone dimension of the war, the coverage splits. "
    assert defects(english, hebrew) == {"low_script_ratio": ["0.0"]} and defects("The Guardian", hebrew) == {}
    assert value(spark, text.priority_defect(text.text_defects(F.lit("x</b y и"), "[a-z]|[^a-zи]", ("q", "r")))) == "foreign_script_chars"
    repaired = lambda said: value(spark, text.joined_prefix_repaired(F.lit(said), f"[{hebrew}]", "[A-Za-zÀ-ÿ]", ("של", "עם")))
    assert repaired("בSüddeutsche והThe של Los שלLos") == "ב-Süddeutsche וה-The של Los של Los"
    assert value(spark, text.claimed_sources(F.lit("שני עיתונים ושניים עיתונים, 12 עיתוני"), "he")) == [2, 2, 12]


def test_section_flags(spark):
    rows = [(1, "Four newspapers agree on it.", "x"), (2, "The split runs along national lines.", "x"), (3, "American papers - The Guardian - agree и.", "x"), (4, "All is well here.", "x"), (5, None, "x"), (6, "Some 20 outlets say so", "x")]
    sections = spark.createDataFrame(rows, "id long, said string, kind string")
    papers = F.array(F.lit("The Guardian"), F.lit("The Daily Telegraph"))
    found = audit.section_flags(sections, "id", {"said": "en"}, papers, PAPERS, r"[\x00-\x7F]", ("[é]", "[A-Z]"), {"en": "a-z"}, {"en": ["well"]}, ["en"]).collect()
    assert sorted((r.id, r.kind, r.detail) for r in found) == [(1, "paper_count", "4"), (2, "framing", "en"), (3, "foreign_chars", "и"), (3, "nationality", "American papers: The Guardian"), (4, "name_tell", "well")]


def test_excerpts(spark):
    pages = spark.createDataFrame([(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa. By Jane Smith")], "p long, body string")
    items = spark.createDataFrame([(1, "a", "beta gamma   DELTA", "Smith"), (1, "b", "alpha gamma beta delta epsilon zeta eta theta iota xyz", "Brown"), (1, "c", " ", ""), (1, "d", "alpha omega", None)], "p long, i string, e string, w string")
    got = {r.i: (r.verbatim, r.mostly, r.author_missing) for r in excerpts.excerpt_checks(items, pages, ["p"], "e", "w", "body").collect()}
    assert got == {"a": (True, True, False), "b": (False, True, True), "c": (False, False, False), "d": (False, False, False)}
    random.seed(1)
    word = lambda: random.choice(["a", "bb", "c", "dd", "e", "f", "ggg"])
    texts = [(i, " ".join(word() for _ in range(60))) for i in range(30)] + [(99, None), (98, "")]
    passages = [(i, random.choice(texts[:30])[1][k : k + 25]) for i, k in enumerate(range(40))] + [(100, "bb c"), (101, None), (102, "dd e f ggg nowhere at all here")]
    found = excerpts.passages_found(spark.createDataFrame(texts, "t long, x string"), "t", "x", spark.createDataFrame(passages, "p long, y string"), "p", "y")
    assert sorted(map(tuple, found.collect())) == sorted((t, p) for t, x in texts for p, y in passages if x is not None and y is not None and y in x)


def test_scores_by_brute_force(spark):
    pairs = [("kitten on the mat", "sitting on a mat"), ("", ""), (None, "x"), ("abc", "abc")]
    got = [r.x for r in spark.createDataFrame(pairs, "a string, b string").select(scores.sequence_ratio("a", "b").alias("x")).collect()]
    assert got == [difflib.SequenceMatcher(None, a or "", b or "", autojunk=False).ratio() for a, b in pairs]
    both = spark.createDataFrame([("one two", "one two", ["a"], ["b"]), ("x", "y", ["a", "b"], ["a", "b"])], "h string, g string, w array<string>, v array<string>")
    assert [r.x for r in both.select(scores.pair_score(F.col("h"), F.col("g"), F.col("w"), F.col("v")).alias("x")).collect()] == [1.0, 1.0]


def test_names_of_all_countries(spark):
    every = places.with_country_names(files.country_names(spark))
    said = lambda t: value(spark, places.named(F.lit(t), every))
    assert len(every) > 200
    assert said("Italiens Regierung, Mexico and South Korea's") == ["IT", "KR", "MX"] and said("the state of Georgia") == [] and said("Südsudan und Sudan") == ["SD", "SS"]


def test_fortnights_and_ranges(spark):
    lit = lambda s: F.lit(s).cast("date")
    closed = [(str(p.start), str(p.stop)) for p in value(spark, calendar.closed_fortnights(lit("2026-09-16"), lit("2026-08-20")))]
    assert closed == [("2026-08-20", "2026-09-02"), ("2026-09-03", "2026-09-16")] and value(spark, calendar.closed_fortnights(lit("2026-09-01"), lit("2026-08-20"))) == []
    closing = lambda day: value(spark, calendar.fortnight_closing_on(lit(day), lit("2026-08-20"))[0])
    assert (closing("2026-09-02"), closing("2026-09-03")) == (dt.date(2026, 8, 20), None)
    shown = [value(spark, calendar.range_form(lit("2026-09-24"), lit("2026-10-07"), lang)) for lang in ("en", "de", "he")]
    assert shown == ["September 24–7, 2026", "24.–7. Oktober 2026", "24.9–7.10.2026"]


def greedy(sizes, budget):
    window, used, out = 0, 0.0, []
    for s in sizes:
        if used > 0 and used + s > budget:
            window, used = window + 1, 0.0
        used += s
        out.append(window)
    return out


def test_packing_over_many_ranges(spark):
    """Windows that go over ranges of rows, rows of no size and rows above the budget."""
    random.seed(6)
    groups = {g: [random.choice([0, 1, 3, 7, 20, 40]) for _ in range(random.randint(1, 300))] for g in ("a", "b", None, "c")} | {"d": [0, 0, 50, 0, 0, 1], "e": [1] * 400}
    rows = spark.createDataFrame([(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sizes)], "g string, i int, s long").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 13)
        for budget in (10, 45, 1000):
            got = {}
            for r in sorted(ordered.packed(rows, "g", "i", "s", budget).collect(), key=lambda r: r.i):
                got.setdefault(r.g, []).append(r.window)
            assert got == {g: greedy(sizes, budget) for g, sizes in groups.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ordered.packed(rows.where("false"), "g", "i", "s", 5).count() == 0


def test_places_and_previous_rows(spark):
    random.seed(7)
    data = [(i, random.choice([None, 1.0, 2.0, 5.0]), random.choice(["x", "y", None])) for i in range(300)]
    rows = spark.createDataFrame(data, "i int, v double, g string").repartition(5)
    got = {r.i: r.place for r in ordered.with_place(rows, [F.col("v").desc_nulls_first(), "i"]).collect()}
    assert got == {i: k + 1 for k, (i, _, _) in enumerate(sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0])))}
    within = {r.i: r.place for r in ordered.with_place(rows, ["i"], "place", ["g"]).collect()}
    assert within == {i: sum(h == g and j <= i for j, _, h in data) for i, _, g in data}
    before = {r.i: r.previous for r in ordered.with_previous(rows, ["i"], "v").collect()}
    assert before == {i: data[i - 1][1] if i else None for i in range(300)}
    stats = {r.g: (r.n, r.median, r.p95, r.max) for r in trends.order_statistics(rows, ["g"], "v").collect()}
    for g in ("x", "y", None):
        v = sorted((v for _, v, h in data if h == g), key=lambda v: (v is not None, v or 0))
        assert stats[g] == (len(v), v[len(v) // 2], v[min(int(0.95 * len(v)), len(v) - 1)], v[-1])


def test_null_keys_are_groups(spark):
    rows = spark.createDataFrame([(1, None, "h"), (2, None, "h"), (3, "s", None), (4, "s", None), (5, "s", "h")], "i int, s string, h string")
    got = {r.i: (r.first_i, r.is_first) for r in relational.duplicates_of_first(rows, ["s", "h"], ["i"]).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (3, False), 5: (5, True)}
    spans = spark.createDataFrame([("b", 5, 9), ("a", 1, 6)], "name string, s int, e int")
    got = [(r.i, r.name) for r in relational.in_intervals(spark.createDataFrame([(5,), (8,), (20,)], "i int"), "i", spans, "s", "e").orderBy("i").collect()]
    assert got == [(5, "a"), (8, "b"), (20, None)]


def test_open_batches_come_first(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    rows = spark.createDataFrame([(i, "a") for i in range(6)], "id long, kind string")
    rows.write.parquet(source)
    rows.where("id < 2").withColumn("begun_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{work}/begun/batch=-1")
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    double = lambda df: df.select("id", (F.col("id") * 2).alias("twice"))
    counters.run_with_open_batches(stream(), ["id"], double, work, str(tmp_path / "c")).awaitTermination()
    rows.union(spark.createDataFrame([(9, "b")], rows.schema)).write.mode("append").parquet(source)
    done = {r.id: (r.twice, r.resumed, r.begun_at.year) for r in spark.read.parquet(f"{work}/done").collect()}
    assert {i: v[:2] for i, v in done.items()} == {i: (2 * i, i < 2) for i in range(6)} and done[0][2] == 2024
    counters.run_with_open_batches(stream(), ["id"], double, work, str(tmp_path / "c")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{work}/done").collect()) == [0, 1, 2, 3, 4, 5, 9]


def test_late_arrivals_and_weekly_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    day = lambda d: dt.date(2026, 1, d)
    rows = spark.createDataFrame([(1, day(1), day(1)), (2, day(1), day(3)), (2, day(1), day(9)), (3, day(4), day(2))], "id long, report date, seen date")
    rows.write.parquet(source)
    target = str(tmp_path / "target")
    for _ in range(2):
        counters.shift_late(spark.readStream.schema(rows.schema).parquet(source), ["id"], "report", "seen", target, str(tmp_path / "c")).awaitTermination()
        spark.createDataFrame([(1, day(1), day(20))], rows.schema).write.mode("append").parquet(source)
    assert {r.id: r.counts_for for r in spark.read.parquet(target).collect()} == {1: day(1), 2: day(3), 3: day(4)}
    events = spark.createDataFrame([("a", dt.datetime(2026, 1, 1, 5)), ("a", dt.datetime(2026, 1, 9, 5)), ("b", dt.datetime(2026, 1, 8))], "k string, ts timestamp")
    events.write.parquet(str(tmp_path / "e"))
    for _ in range(2):
        counters.run_weekly(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), "ts", "k", str(tmp_path / "w"), str(tmp_path / "cw"), length="14 days", slide="7 days").awaitTermination()
        spark.createDataFrame([("a", dt.datetime(2026, 1, 10)), ("a", dt.datetime(2025, 6, 1))], events.schema).write.mode("append").parquet(str(tmp_path / "e"))
    got = {(str(r.start), r.k): r.n for r in counters.latest_counts(spark.read.parquet(str(tmp_path / "w")), "k").collect()}
    # the row of June is later than the watermark allows: it is counted, and kept apart as well
    late = {("2025-05-22", "a"): 1, ("2025-05-29", "a"): 1}
    assert {(str(r.start), r.k): r.n for r in counters.corrections(spark.read.parquet(str(tmp_path / "w")), "k").collect()} == late
    assert got == late | {("2025-12-25", "a"): 1, ("2026-01-01", "a"): 3, ("2026-01-01", "b"): 1, ("2026-01-08", "a"): 2, ("2026-01-08", "b"): 1}

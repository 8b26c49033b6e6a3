"""Operators by plain versions: named places, range joins, greedy matching, sequence similarity."""

import datetime as dt
import difflib
import random
import re

import pytest
from conftest import as_rows
from pyspark.sql import functions as F

from tidemark.functions import places, scores
from tidemark.operators import relational


def plain_codes(text, names, adjectives):
    """The rule as patterns, one country after the other."""
    out = set()
    for code, some in names.items():
        for n in some:
            before = "(?<!South )" if n == "Sudan" else ""
            after = "(?! Post)" if n == "Washington" else "(?!s)" if n == "Island" else ""
            if re.search(rf"(?<![\w-]){before}{re.escape(n)}{after}s?(?!\w)", text):
                out.add(code)
    for code, some in adjectives.items():
        for a in some:
            if re.search(rf"(?<!\w)[{a[0]}{a[0].upper()}]{re.escape(a[1:])}", text):
                out.add(code)
    return sorted(out)


def test_named_places_in_whole_texts(spark):
    """Names and adjectives of all 94 countries, planted in the texts of documents with and without endings."""
    random.seed(7)
    names = places.usual_names(spark)
    assert len(names) == 94 and all(names.values())
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    planted = [(c, n) for table in (names, places.ADJECTIVES) for c, some in table.items() for n in some]
    said = []
    for k, (_, n) in enumerate(planted):
        t, at = texts[k % len(texts)], random.random()
        form = random.choice(["{}", "{}s", "{}'s", "{}en", "-{}", "x{}", "{}-x", "South {}", "{} Post", "{}.", "({})", "{}ss"]).format(n)
        said.append(t[: int(at * len(t))] + random.choice([" ", "\n", ""]) + form + random.choice([" ", "\n", ""]) + t[int(at * len(t)) :])
    said += [f"in {n}'s" for _, n in planted] + ["Island", "Islands", "Washington Post", "Washingtons Post", "U.S.", "U.S.s", "Hong Kong SAR China", "", "Sudan South Sudan"]
    rows = spark.createDataFrame(list(enumerate([*said, None])), "i int, t string").repartition(4)
    found = {r.i: r.codes for r in rows.select("i", places.named(F.col("t")).alias("codes")).collect()}
    for i, t in enumerate([*said, ""]):
        assert found[i] == plain_codes(t, names, places.ADJECTIVES), t[:300]
    # every country is found
    assert {c for some in found.values() for c in some} == set(names)
    assert [r.c for r in rows.where("i < 2").select(places.named(F.col("t"), {}, {}).alias("c")).collect()] == [[], []]


def test_range_join_by_brute_force(spark):
    random.seed(3)
    day = lambda n: dt.date(1995, 12, 1) + dt.timedelta(n)
    spans = [(day(a := random.randint(0, 400)), day(a + random.choice([-1, 0, 1, 7, 30, 500])), random.randint(0, 5)) for _ in range(300)]
    spans += [(None, day(3), 1), (day(3), None, 2), (day(390), day(395), None), (dt.date(1, 1, 1), dt.date(1900, 1, 1), 9), (day(3000), dt.date(9999, 12, 31), 8)]
    days = [(i, day(random.randint(-50, 1000)) if i % 17 else None) for i in range(400)] + [(400, day(5)), (400, day(5)), (401, dt.date(1899, 7, 7)), (402, dt.date(5000, 1, 1))]
    key = lambda s: (s[0], s[1], s[2] is not None, s[2] or 0)
    first = lambda d: min((s for s in spans if d and s[0] and s[1] and s[0] <= d <= s[1]), key=key, default=(None, None, None))
    rows = spark.createDataFrame(days, "i int, day date")
    found = relational.in_intervals(rows, "day", spark.createDataFrame(spans, "s date, e date, n int"), "s", "e")
    assert as_rows(tuple(r) for r in found.collect()) == as_rows((i, d, *first(d)) for i, d in days)
    inner = relational.in_intervals(rows, "day", spark.createDataFrame(spans, "s date, e date, n int"), "s", "e", "inner")
    assert inner.count() == sum(first(d)[0] is not None for _, d in days)
    numbers = spark.createDataFrame([(-3, -1, "a"), (-(2**31), 2**31 - 1, "z"), (4, 4, "b")], "s int, e int, name string")
    got = [(r.i, r.name) for r in relational.in_intervals(spark.createDataFrame([(-3,), (-4,), (4,), (2**31 - 1,)], "i int"), "i", numbers, "s", "e").orderBy("i").collect()]
    assert got == [(-4, "z"), (-3, "z"), (4, "z"), (2**31 - 1, "z")]


def test_a_million_overlapping_intervals(spark):
    """Of all intervals that hold a day only the first of a range is kept: the plan has no nested loop, and nothing is collected."""
    spans = spark.range(1_000_000).select(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("s"), F.lit("2010-01-01").cast("date").alias("e"), F.col("id").alias("n"))
    rows = spark.range(2000).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    joined = relational.in_intervals(rows, "day", spans, "s", "e")
    assert joined.where("s = date'2000-01-01' and n = 0").count() == 2000
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def plain_greedy(pairs, least):
    out = set()
    for group in {p[0] for p in pairs}:
        left, right = set(), set()
        order = sorted((p for p in pairs if p[0] == group and p[3] is not None and p[3] >= least), key=lambda p: (-p[3], p[1] is not None, p[1] or "", p[2] is not None, p[2] or ""))
        for g, a, b, s in order:
            if a not in left and b not in right:
                left.add(a)
                right.add(b)
                out.add((g, a, b, s))
    return out


def test_greedy_matching_by_the_plain_rule(spark):
    """Ties, repeated pairs, null members and groups, a chain, and a group of many pairs."""
    random.seed(4)
    pairs = [(random.choice(["a", "b", None]), random.choice(["p", "q", "r", "s", None]), random.choice(["x", "y", "z", None]), random.choice([0.5, 0.6, 0.7, 0.8, None])) for _ in range(150)]
    pairs += [("chain", f"l{i // 2:02}", f"r{(i + 1) // 2:02}", 0.61 + i / 100) for i in range(12)]
    pairs += [("many", f"m{i}", f"n{j}", random.randint(60, 99) / 100) for i in range(40) for j in range(40)]
    found = relational.greedy_matches(spark.createDataFrame(pairs, "g string, l string, r string, s double").repartition(3), "g", "l", "r", "s")
    assert {tuple(r) for r in found.collect()} == plain_greedy(pairs, 0.6) and found.columns == ["g", "l", "r", "s"]
    assert relational.greedy_matches(spark.createDataFrame([], "g string, l int, r int, s double"), "g", "l", "r", "s").count() == 0


@pytest.mark.parametrize("small", [0, 40, 1 << 16])
def test_sequence_ratio_is_the_standard_librarys(spark, monkeypatch, small):
    monkeypatch.setattr(scores, "SMALL", small)
    random.seed(small)
    pairs = [(None, None), ("", "a"), ("ab" * 50, "ba" * 40), ("a" * 70, "a" * 50), ("é漢🙂" * 9, "漢🙂é" * 8)]
    for k in range(150):
        letters = "ab" if k % 3 == 0 else "abcdefgh é漢🙂"
        x, y = ("".join(random.choice(letters) for _ in range(random.randint(0, 130))) for _ in "xy")
        pairs.append((x, x[20:60] + y + x[:30]) if k % 4 == 0 else (x, y))
    for x, y in pairs:
        x, y = x or "", y or ""
        blocks = difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
        assert scores.matching_characters(x, y) == sum(m.size for m in blocks), (x, y)
    if small:
        return
    rows = spark.createDataFrame(pairs, "a string, b string")
    ratio = lambda x, y: difflib.SequenceMatcher(None, x or "", y or "", autojunk=False).ratio()
    for r in rows.select("a", "b", scores.sequence_ratio("a", "b").alias("x"), scores.sequence_ratio("a", "b", 0.6).alias("y"), scores.ratio_bound(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("bound")).collect():
        true = ratio(r.a, r.b)
        assert abs(r.x - true) < 1e-9 and r.bound >= true - 1e-9
        assert abs(r.y - true) < 1e-9 if true >= 0.6 else r.y in (0.0, r.x)


def test_sequence_ratio_of_long_texts():
    random.seed(5)
    words = ["".join(random.choice("etaoinshrdlu") for _ in range(random.randint(2, 9))) for _ in range(3000)]
    x = " ".join(random.choice(words) for _ in range(6000))
    assert scores.matching_characters(x, x) == len(x)
    assert scores.matching_characters(x, x[:9000] + x[20000:]) >= len(x) - 11000
    assert scores.matching_characters("ab" * 20000, "ab" * 15000 + "c") == 30000

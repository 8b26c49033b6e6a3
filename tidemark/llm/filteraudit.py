"""Filter interaction audit: words as rows, flags joined by document, and counts of every combination of five filters."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import numbered
from tidemark.llm.store import settled

FILTERS = "ABCDE"
#: What separates words, and what is neither an upper-case Latin letter nor a mark, as Java patterns.
SPACES, NO_UPPER, MARKS = r"[\x09-\x0D\x20]+", "[^A-Z]+", "[#$%&*|]"
#: Words that a document needs, distinct words per hundred words, upper-case letters per hundred code points.
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 2
CELLS = 1 << len(FILTERS)
#: Parts that the copies of one text are dealt to.
SALTS = 16


def word_totals(docs: DataFrame, row: str, text: str) -> DataFrame:
    """row, words, distinct_words of every document with a word: a row for each word, counted by (row, word) and then by row.

    Documents are dealt by row once, so that neither aggregate shuffles words, of which there are more bytes than of texts. (explode would also split each text
    once more, to leave out empty arrays, of which there are none.)
    """
    words = docs.select(row, text).repartition(row).select(row, F.explode_outer(F.split(text, SPACES)).alias("word")).where("word != ''")
    return words.groupBy(row, "word").agg(F.count("*").alias("n")).groupBy(row).agg(F.sum("n").alias("words"), F.count("*").alias("distinct_words"))


def _bit(flag: Column, letter: str) -> Column:
    return F.when(flag, 1 << FILTERS.index(letter)).otherwise(0)


def failures(docs: DataFrame, labels: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """part, mask, good, toxic of every row of docs: bit k of mask is set if it fails filter k of ABCDE.

    Flags of the text itself and its hash are written once, without the text; words, first copies and labels join them as narrow tables.
    """
    own = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text")), "row")
    upper = F.length(F.regexp_replace("text", NO_UPPER, "")).cast("long")
    flags = settled(
        own.select(
            "row", "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"),
            (_bit(100 * upper > MOST_UPPER * F.length("text").cast("long"), "C") + _bit(F.col("text").rlike(MARKS), "D")).alias("of_text"),
        )
    )
    firsts = flags.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = firsts.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # one text may have a third of all rows
    flags = flags.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    joined = flags.join(word_totals(own, "row", "text"), "row", "left").join(firsts, ["key", "salt"], "left").join(known, "doc_id", "left")
    words, distinct = (F.coalesce(c, F.lit(0)) for c in ("words", "distinct_words"))
    mask = F.col("of_text") + _bit(words < LEAST_WORDS, "A") + _bit(100 * distinct < LEAST_DISTINCT * words, "B") + _bit(F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)), "E")
    return joined.select("part", mask.alias("mask"), *[F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in ("good", "toxic")])


def _total(counts: str, wanted, weight=lambda m: F.lit(1)) -> Column:
    """The sum of the cells of an array of counts, by mask, for which wanted(mask) holds."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(CELLS - 1)), F.lit(0).cast("long"), lambda total, m: total + F.when(wanted(m), F.get(F.col(counts), m) * weight(m)).otherwise(F.lit(0)))


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """One row for each source, order of the filters ABCDE and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A: too few words. B: too few distinct ones. C: too many upper-case letters. D: a mark of `#$%&*|`. E: the text of a smaller doc_id.
    Words are exploded to rows and counted by (row, word), then by row, where their document lies; the other flags are joined to
    these totals, and one aggregate by source counts the 32 combinations of failures (and, of these, good and toxic rows). Every order and step
    is then a sum over those 32 counts, so the 120 orders cost nothing that grows with the documents.

    Every row is a document of its own, also with a repeated or null doc_id. Null texts are empty ones, and null sources the part ''. A null doc_id
    is nobody's smaller one and has no smaller one. A row is good or toxic if any row of labels for its doc_id says 1. Without rows there is no part and no result. Texts
    go whole, whatever their length; copies of one text, however many, meet as a minimum with partial sums before the shuffle. Other columns are ignored.
    """
    rows = failures(docs, labels, text, source)
    cells = {"n": "true", "good": "good", "toxic": "toxic"}
    counted = rows.groupBy("part").agg(*[F.expr(f"count_if(mask = {m} and {wanted}) as {name}{m}") for name, wanted in cells.items() for m in range(CELLS)])
    counted = counted.selectExpr("part", *[f"array({', '.join(f'{name}{m}' for m in range(CELLS))}) as {name}" for name in cells])
    orders = F.split(F.lit(" ".join("".join(order) for order in permutations(FILTERS))), " ")
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    bit = lambda step: F.get(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))]), F.instr(F.lit(FILTERS), F.substr("filter_order", step, F.lit(1))) - 1)
    placed = counted.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(steps).alias("step"))
    before = F.aggregate(F.filter(steps, lambda k: k < F.col("step")), F.lit(0), lambda total, k: total + bit(k))
    placed = placed.select("*", bit(F.col("step")).alias("bit"), before.alias("before"))
    has = lambda m, c: m.bitwiseAND(F.col(c)) != 0
    removed = lambda m: has(m, "bit") & ~has(m, "before")
    return placed.select(
        "part", "filter_order", "step",
        _total("n", lambda m: ~has(m, "before") & ~has(m, "bit")).alias("kept"),
        _total("n", removed).alias("removed"),
        _total("n", lambda m: has(m, "bit") & has(m, "before")).alias("redundant"),
        F.get("n", F.col("bit")).alias("unique_fails"),
        _total("good", removed).alias("good_lost"),
        _total("toxic", removed).alias("toxic_lost"),
        # of all orders, the filter comes first among the filters that a row fails in one of so many
        _total("n", lambda m: has(m, "bit"), lambda m: (F.lit(factorial(len(FILTERS))) / F.bit_count(m)).cast("long")).alias("shapley"),
    )

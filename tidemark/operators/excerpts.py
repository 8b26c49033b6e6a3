"""Excerpts against the texts that they are from."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as rules
from tidemark.functions.rowwise import STRINGS, one_by_one

#: Words in a row by which passages are looked up, and the share of an excerpt's words that counts as found.
ANCHOR, MOSTLY = 5, 0.9
#: Bytes of short passages that are looked for at once.
BLOCK = 8 << 20


def plain_words(text: Column) -> Column:
    """A text's words in lower case with single blanks between."""
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0)), " ")


def excerpt_checks(items: DataFrame, pages: DataFrame, on: Sequence[str], excerpt: str, author: str, text: str) -> DataFrame:
    """items with verbatim (the excerpt's words follow each other on the page), mostly (nine tenths of its words of three letters or more are there) and author_missing
    (none of the author's are). An empty excerpt is never found, an empty author never missing."""
    joined = items.join(pages.select(*on, F.col(text).alias("_page")), list(on))
    has = F.coalesce(F.trim(excerpt) != "", F.lit(False))
    page, own, by = rules.word_set(F.col("_page")), rules.word_set(F.col(excerpt)), rules.word_set(F.col(author))
    return joined.select(
        *items.columns,
        (has & F.contains(plain_words(F.col("_page")), plain_words(F.col(excerpt)))).alias("verbatim"),
        (has & (F.size(F.array_intersect(own, page)) >= MOSTLY * F.greatest(F.size(own), F.lit(1)))).alias("mostly"),
        (F.coalesce(F.trim(author) != "", F.lit(False)) & ~F.arrays_overlap(by, page)).alias("author_missing"),
    )


def _short_found(texts: DataFrame, key: str, text: str, short: DataFrame) -> DataFrame:
    """key, _p of every text that holds one of the distinct short passages, in blocks of passages of bounded size: each block is an automaton that texts run through once, whatever its number of passages."""
    size = short.agg(F.sum(F.octet_length("_p") + 1)).first()[0] or 0
    blocks = -(-size // BLOCK)
    parts = []
    for b in range(blocks):
        block = [r["_p"] for r in short.where(F.pmod(F.xxhash64("_p"), F.lit(blocks)) == b).collect()]
        parts.append(texts.select(F.col(key), F.explode(_held(block)(text)).alias("_p")))
    found = parts[0] if parts else texts.join(short, F.lit(False)).select(key, "_p")
    for part in parts[1:]:
        found = found.union(part)
    return found


def _held(passages: Sequence[str]):
    """A UDF: which of some passages a text holds."""
    built, always = [], {""} if "" in passages else set()

    def held(text: str | None) -> list[str] | None:
        if not built:
            automaton = ahocorasick.Automaton()
            for p in passages:
                if p:
                    automaton.add_word(p, p)
            if len(automaton):
                automaton.make_automaton()
            built.append(automaton)
        return None if text is None else sorted(always | ({p for _, p in built[0].iter(text)} if len(built[0]) else set()))

    return one_by_one(held, "array<string>", STRINGS)


def passages_found(texts: DataFrame, key: str, text: str, passages: DataFrame, passage_key: str, passage: str) -> DataFrame:
    """key, passage_key of every text that holds a passage as it stands.

    A passage is looked up by five words in a row from its inside, which a text that holds it has between blanks. Texts meet passages
    in an equi-join on the hash of such runs, whatever the tables' sizes; only texts that share a run with a passage are then searched. Passages too short for that are looked for by an automaton.
    """
    runs = lambda words: F.transform(F.sequence(F.lit(0), F.size(words) - ANCHOR), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(ANCHOR)]))
    words = F.split(F.col("_p"), " ", -1)
    held = passages.select(F.col(passage_key), F.col(passage).alias("_p")).where("_p is not null").withColumn("_w", words)
    anchored = held.where(F.size("_w") >= ANCHOR + 2).select(passage_key, "_p", F.xxhash64(*[F.get("_w", F.lit(k + 1)) for k in range(ANCHOR)]).alias("_run"))
    short = held.where(F.size("_w") < ANCHOR + 2).select(passage_key, "_p")
    cut = texts.select(F.col(key), F.split(F.col(text), " ", -1).alias("_t")).where(F.size("_t") >= ANCHOR)
    met = cut.select(key, F.explode(F.array_distinct(rules.once(F.col("_t"), runs))).alias("_run")).join(anchored.select(passage_key, "_run"), "_run").select(key, passage_key).distinct()
    whole = texts.select(F.col(key), F.col(text).alias("_text"))
    found = met.join(whole, key).join(anchored.select(passage_key, "_p"), passage_key).where(F.contains("_text", "_p")).select(key, passage_key)
    rest = _short_found(texts, key, text, short.select("_p").distinct()).join(short, "_p").select(key, passage_key)
    return found.union(rest).distinct()

"""Bounded samples of labelled rows, drawn by a hash of the row's number, and the split into learning and held-out rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import numbered
from tidemark.llm.store import settled

_SPAN = 1 << 20


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def drawn(share: float | Column, row: Column, salt: int) -> Column:
    """True for about this share of all numbers of rows, always the same ones."""
    return F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(_SPAN)) < (share * _SPAN + 0.999).cast("long") if isinstance(share, Column) else F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(_SPAN)) < int(share * _SPAN + 0.999)


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, salt: int, text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """row, doc_id, text, y of about `most` documents of each class (all, if there are fewer) that may be learned from, and the classes' full sizes, in documents.

    Learning rows have crc32(doc_id) mod 4 != 2. The draw is by row, not by doc_id: rows that share an id are drawn each for itself, so their number is bounded like that of
    any others. It is on a narrow table of rows and labels, whose drawn rows have a known size, so the texts meet them in a join that moves no text: drawn rows are broadcast.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    usable = usable.groupBy("doc_id").agg(F.max("y").alias("y"))
    own = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), "row")
    known = settled(own.select("row", "doc_id").join(usable, "doc_id").select("row", "y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    take = F.lit(False)
    for y, n in counts.items():
        take = take | ((F.col("y") == y) & drawn(min(1.0, most / n), F.col("row"), salt))
    return own.join(F.broadcast(known.where(take)), "row"), counts


def carried(docs: DataFrame, keep: Sequence[str]) -> list[Column]:
    """Columns that a scoring map passes on untouched, so that its rows needn't be joined with docs again."""
    return [docs[c].alias(f"kept_{c}") for c in keep]


def schema(own: str, rows: DataFrame, keep: Sequence[str]) -> str:
    return ", ".join([own, *(f"`kept_{c}` {dict(rows.dtypes)[f'kept_{c}']}" for c in keep)])

"""From raw documents to token ids: language, quality, near-duplicates, mixing, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.language import languages
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.piecebpe import encode_pieces
from tidemark.llm.quality import quality_scores
from tidemark.llm.rows import numbered
from tidemark.llm.store import fresh_folder

#: A language is accepted from this score on: below it the two best are all but tied. A document's quality from that one on.
LEAST_LANGUAGE, LEAST_QUALITY = 0.51, 0.5


def _restored(scored: DataFrame, docs: DataFrame) -> DataFrame:
    return scored.select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter and those whose language is a tie."""
    scored = languages(docs, keep=docs.columns)
    return _restored(scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)), docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are likelier bad than good."""
    scored = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=docs.columns)
    return _restored(scored.where(F.col("score") >= LEAST_QUALITY), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest doc_id. Rows without doc_id come last, and ties are decided by the text's hash.

    Every row is a document: rows without doc_id, or with one that others have too, are kept if their texts are no near copies.
    """
    row = next(c for c in ("_row", "_row_number", "_row_of_stage") if c not in docs.columns)
    rows = numbered(docs, row)
    found = near_duplicates(rows, doc_id=row).select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("text"), F.col(row).alias("row"))
    first = rows.select(row, place.alias("_place")).join(found, row).groupBy("_group").agg(F.min("_place").alias("_first"))
    return rows.join(first.select(F.col("_first.row").alias(row)), row, "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes whole documents, repeated or left out as their source's target asks, in training order."""
    planned = mixing.plan(docs, whole=True, keep=docs.columns)
    return _restored(mixing.training_order(planned), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_le (little-endian unsigned 32-bit) of every row."""
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), "ids_le")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]
#: Three stages are learned or hashed models, which SQL can't express: the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents; what each keeps is written to the shared folder and read again by the next.

    Null and blank texts go in the first stage, which finds no letter in them. Repeated rows and rows with one doc_id are documents
    each until the third stage keeps one of each group of copies; null ids stay null. Texts of any length go whole. The
    result of an empty table is empty. Columns beyond those of documents are carried up to the last stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shards
from tidemark.llm.sampling import carried, labelled, remainder, schema
from tidemark.llm.store import fresh_folder
from tidemark.llm.textcore import NO_LETTER, Words, mixed, pieces

#: Hash buckets; documents of each class to learn from at most; passes over them.
BUCKETS, MOST, PASSES = 1 << 22, 5000, 8
#: Per-coordinate rates (alpha, beta) and the L1 and L2 strengths.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.01
#: Gaps of the word pairs: neighbours, and pairs that skip one or two words.
GAPS = (1, 2, 3)
#: Longer words also count by their first bytes, so that a stem is known with any ending.
HEAD = 5
THRESHOLD = 0.3
#: Files of the stored sample.
FILES = 16


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts' words, heads of words and word pairs, and which text each is of; an occurrence each."""
    words = Words(texts, NO_LETTER)
    h, n = words.hash, words.counts()
    of = np.repeat(np.arange(len(n)), n)
    found, owner = [h], [of]
    longer = words.end - words.begin > HEAD
    found.append(words.heads(HEAD)[longer] ^ np.uint64(77))
    owner.append(of[longer])
    with np.errstate(over="ignore"):
        for gap in GAPS:
            if len(h) > gap:
                same = of[:-gap] == of[gap:]
                found.append(mixed(h[:-gap] * np.uint64(2 * gap + 1) + h[gap:] + np.uint64(gap))[same])
                owner.append(of[:-gap][same])
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int32), np.concatenate(owner)


def _rows(batches):
    """Each sampled document's distinct buckets."""
    for batch in batches:
        rows, ids, texts, y = (batch.column(c) for c in ("row", "doc_id", "text", "y"))
        for lo, hi in pieces(texts):
            bucket, of = features(texts.slice(lo, hi - lo).to_pylist())
            own = [np.unique(bucket[of == i]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([rows.slice(lo, hi - lo), ids.slice(lo, hi - lo), y.slice(lo, hi - lo), pa.array(own, pa.binary())], ["row", "doc_id", "y", "buckets"])


class Stored:
    """The sample's rows in the order of their files, a few at a time, as often as they are asked for."""

    def __init__(self, folder: str):
        self.folder = folder

    def __iter__(self) -> Iterator[tuple[np.ndarray, int]]:
        system, base = shards.opened(self.folder)
        for name, _ in shards.sizes(self.folder, ".parquet"):
            with system.open_input_file(f"{base}/{name}") as file:
                for batch in pq.ParquetFile(file).iter_batches(32, columns=["y", "buckets"]):
                    for y, own in zip(batch.column("y").to_pylist(), batch.column("buckets"), strict=True):
                        yield np.frombuffer(own.as_buffer(), np.int32), y


def _learner(folder: str):
    """Learns in one task from the stored sample; gives the weights that aren't zero and, as bucket -1, the intercept."""

    def learn(batches):
        for batch in batches:
            if batch.num_rows:
                w, bias = ftrl(Stored(folder))
                at = np.flatnonzero(w)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], ["bucket", "weight"])

    return learn


def ftrl(examples: Iterable[tuple[np.ndarray, int]], buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Weights (mostly exact zeros) and the intercept, updated document by document; examples are gone through PASSES times."""
    z, n = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for _ in range(PASSES):
        for own, y in examples:
            at = np.append(own, buckets)
            zi, root = z[at], np.sqrt(n[at])
            w = _weights(zi, root)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, w.sum())))) - y
            new = np.sqrt(n[at] + g * g)
            z[at] = zi + g - (new - root) / ALPHA * w
            n[at] += g * g
    w = _weights(z, np.sqrt(n))
    return w[:-1], float(w[-1])


def _weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + root) / ALPHA + L2))


def _scorer(model, kept: list[str]):
    def score(batches):
        at, w, bias = model.value
        weight = np.zeros(BUCKETS)
        weight[at] = w
        for batch in batches:
            ids, texts, out = batch.column(0), batch.column(1), batch.column(2)
            for lo, hi in pieces(texts):
                bucket, of = features(texts.slice(lo, hi - lo).to_pylist())
                hit = np.flatnonzero(weight[bucket])
                pairs = np.unique(of[hit].astype(np.int64) * BUCKETS + bucket[hit])
                total = np.bincount(pairs // BUCKETS, weight[pairs % BUCKETS], hi - lo) + bias
                p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), out.slice(lo, hi - lo), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), *(c.slice(lo, hi - lo) for c in batch.columns[3:])], ["doc_id", "held_out", "score", "predicted", *kept])

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (score >= 0.3) and the columns named in keep, as kept_<name>.

    Learned from at most about 5000 documents of each class, drawn by a hash of the row among learning rows, so that rows that share a doc_id are drawn each for itself. Their distinct
    hashed features are written to the shared folder in an order set by a hash of doc_id, then the row, and one task runs FTRL over
    them, a few documents in memory at a time; the driver gets some thousand weights. As the classes are drawn
    apart, the intercept is shifted by the log-odds of their full sizes. The weights are
    broadcast; all whole texts are then scored in a map without a shuffle.

    Null and empty texts have no feature and get the intercept's score. Without labels of both classes every score is the known share of toxic rows (0 without any).
    Repeated rows get a row each, also in learning. Texts of any length count whole. Other columns of docs are ignored but for those in keep.
    """
    spark = docs.sparkSession
    sample, counts = labelled(docs, labels, label, MOST, 3, text)
    folder = fresh_folder(spark, "toxicity-sample")
    rows = sample.select("row", "doc_id", "text", "y").mapInArrow(_rows, "row long, doc_id long, y int, buckets binary")
    # ranges are drawn by narrow columns only: what is sampled for them goes to the driver
    keys = ["place", "doc_id", "row"]
    rows = rows.withColumn("place", F.xxhash64("doc_id", F.lit(9))).repartitionByRange(FILES, *keys)
    rows.sortWithinPartitions(*keys).select("y", "buckets").write.parquet(folder)
    drawn = {0: 0, 1: 0} | {r["y"]: r["n"] for r in spark.read.schema("y int").parquet(folder).groupBy("y").agg(F.count("*").alias("n")).collect()}
    if all(drawn.values()):
        learned = spark.range(0, 1, 1, 1).mapInArrow(_learner(folder), "bucket long, weight double").toArrow()
        at, w = np.asarray(learned.column("bucket")), np.asarray(learned.column("weight"))
        bias = float(w[at < 0][0]) + math.log(counts[1] / counts[0]) - math.log(drawn[1] / drawn[0])
        at, w = at[at >= 0].astype(np.int32), w[at >= 0]
    else:
        at, w, bias = np.zeros(0, np.int32), np.zeros(0), 35.0 if drawn[1] else -35.0
    model = spark.sparkContext.broadcast((at, w.astype(np.float32), bias))
    held_out = remainder(F.col("doc_id"), 4) == 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"), *carried(docs, keep))
    return rows.mapInArrow(_scorer(model, [f"kept_{c}" for c in keep]), schema("doc_id long, held_out boolean, score double, predicted int", rows, keep))

"""Ranked lexical search: Fagin's threshold algorithm over impact-sorted lists, shard by shard, with a forward index at hand."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.llm import shards
from tidemark.llm.store import fresh_folder, settled, shuffle_width
from tidemark.llm.textcore import NO_LETTER, Words, pieces

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BEST = 50
#: Entries (document, term) and documents of a shard; bytes of items that are searched for at once.
ENTRIES, DOCUMENTS, ITEM_BYTES = 4 << 20, 1 << 20, 16 << 20
#: Entries of each list that are read in a round at first, and at most.
FIRST_STEP, LAST_STEP = 8, 1024
#: One of so many shards is searched first: its scores are what all others have to beat.
WAVE = 8


def terms_of(text: str | None) -> list[str]:
    """The distinct terms of a text: runs of letters and digits, A-Z lowered, everything beyond ASCII a letter."""
    return sorted(set(TERM.findall((text or "").translate(LOWER))))


class Vocabulary:
    """The terms that are searched for, found among the words of texts by hash and then by their bytes."""

    def __init__(self, terms: list[str]):
        words = Words(terms, NO_LETTER)
        order = np.argsort(words.hash, kind="stable")
        self.hash, self.number = words.hash[order], order
        self.begin, self.size = words.begin[order], (words.end - words.begin)[order]
        self.data = words.data
        if len(np.unique(self.hash)) < len(self.hash):
            raise ValueError("two terms have one hash")

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, and the terms' numbers."""
        if not len(self.hash) or not len(words.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        size = words.end - words.begin
        place = np.flatnonzero((self.hash[at] == words.hash) & (self.size[at] == size))
        at = at[place]
        left, same = np.arange(len(place)), np.ones(len(place), bool)
        k = 0
        while len(left):
            a, b = words.data[words.begin[place[left]] + k], self.data[self.begin[at[left]] + k]
            a = a + ((a >= 65) & (a <= 90)) * np.uint8(32)
            same[left[a != b]] = False
            k += 1
            left = left[self.size[at[left]] > k]
        return place[same], self.number[at[same]]


class _Shard:
    """Documents of one task until there are enough of them for a file."""

    def __init__(self):
        self.ids, self.known, self.n, self.entries, self.term, self.tf = [], [], [], [], [], []
        self.size = self.docs = 0

    def add(self, ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        self.ids.append(np.asarray(ids.fill_null(0)))
        self.known.append(np.asarray(ids.is_valid()))
        self.n.append(n)
        self.entries.append(np.bincount(doc, minlength=len(n)))
        self.term.append(term.astype(np.int32))
        self.tf.append(tf.astype(np.int32))
        self.size, self.docs = self.size + len(term), self.docs + len(n)

    def write(self, folder: str, name: str) -> tuple:
        joined = {k: np.concatenate(getattr(self, k)) for k in ("ids", "known", "n", "entries", "term", "tf")}
        held = io.BytesIO()
        np.savez(held, **joined)
        out = shards.ShardWriter(folder, name)
        out.write(held.getbuffer())
        out.commit()
        terms, df = np.unique(joined["term"], return_counts=True)
        return name, int((joined["n"] > 0).sum()), int(joined["n"].sum()), terms, df


def _indexer(vocabulary, folder: str):
    """Writes forward indexes of the terms searched for, a shard of bounded size each, and gives what the statistics need of them."""

    def index(batches):
        terms, shard, count, partition = vocabulary.value, _Shard(), 0, TaskContext.get().partitionId()

        def done() -> pa.RecordBatch:
            name, docs, words, found, df = shard.write(folder, f"{partition:07d}-{count:06d}.npz")
            values = [pa.array([v]) for v in (name, docs, words)] + [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (found, df)]
            return pa.RecordBatch.from_arrays(values, ["name", "docs", "words", "terms", "df"])

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for lo, hi in pieces(texts):
                words = Words(texts.slice(lo, hi - lo).to_pylist(), NO_LETTER)
                place, term = terms.find(words)
                doc = np.searchsorted(words.first, place, "right") - 1
                pair, tf = np.unique(doc * len(terms.hash) + term, return_counts=True)
                shard.add(ids.slice(lo, hi - lo), words.counts(), pair // max(len(terms.hash), 1), pair % max(len(terms.hash), 1), tf)
                if shard.size >= ENTRIES or shard.docs >= DOCUMENTS:
                    yield done()
                    shard, count = _Shard(), count + 1
        if shard.docs:
            yield done()

    return index


class Index:
    """A shard in memory: the forward index (entries of each document) and, over the same entries, a list for each term by falling impact."""

    def __init__(self, held: dict[str, np.ndarray], weight: np.ndarray, total: int, words: int):
        self.ids, self.known = held["ids"], held["known"]
        entries = held["entries"].astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(entries)])
        self.doc = np.repeat(np.arange(len(entries)), entries)
        self.term = held["term"].astype(np.int64)
        m = 50 + (50 * held["n"].astype(np.int64) * total) // max(words, 1)
        tf = held["tf"].astype(np.int64)
        self.impact = weight[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc]))
        self.sorted = np.lexsort((-self.impact, self.term))
        bounds = np.searchsorted(self.term[self.sorted], np.arange(len(weight) + 1))
        self.begin, self.end = bounds[:-1], bounds[1:]
        # ties go by doc_id, rows without one last
        self.place = np.empty(len(self.ids), np.int64)
        self.place[np.lexsort((self.ids, ~self.known))] = np.arange(len(self.ids))
        self.seen, self.wanted = np.zeros(len(self.ids), bool), np.zeros(len(weight), bool)
        self.read = 0

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Full scores of documents, each of which has an entry, by random access."""
        size = self.first[docs + 1] - self.first[docs]
        start = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.first[docs] - start, size)
        return np.add.reduceat(np.where(self.wanted[self.term[at]], self.impact[at], 0), start)

    def top(self, terms: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best (fewer, if fewer score above 0, or if the others are below floor), best first.

        The terms' lists are read in turn, some entries of each in a round; a document that a list shows first is looked up at once. No
        document that is still unseen can score above the threshold, the sum of the last impacts read, so the lists are left when that is below the kth score or floor.
        """
        terms = terms[self.end[terms] > self.begin[terms]]
        begin, end = self.begin[terms], self.end[terms]
        self.wanted[terms] = True
        docs, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        touched, at, step = [], 0, FIRST_STEP
        while len(terms):
            rows = begin[:, None] + np.arange(at, at + step)
            rows = self.sorted[rows[rows < end[:, None]]]
            self.read += len(rows)
            new = np.unique(self.doc[rows])
            new = new[~self.seen[new]]
            if len(new):
                self.seen[new] = True
                touched.append(new)
                docs, score = np.concatenate([docs, new]), np.concatenate([score, self.scores(new)])
                best = np.lexsort((self.place[docs], -score))[:k]
                docs, score = docs[best], score[best]
            at, step = at + step, min(2 * step, LAST_STEP)
            open_ = begin + at < end
            threshold = self.impact[self.sorted[begin[open_] + at - 1]].sum()
            if not open_.any() or threshold < max(floor, score[-1] if len(score) == k else 0):
                break
            terms, begin, end = terms[open_], begin[open_], end[open_]
        for new in touched:
            self.seen[new] = False
        self.wanted[:] = False
        good = (score > 0) & (score >= floor)
        return docs[good], score[good]


def _searcher(shared, folder: str, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total, words, items, floors = shared.value
        for name in (n for batch in batches for n in batch.column("name").to_pylist()):
            system, base = shards.opened(folder)
            with system.open_input_file(f"{base}/{name}") as file, np.load(io.BytesIO(file.read())) as held:
                index = Index({key: held[key] for key in held.files}, weight, total, words)
            for i, terms in enumerate(items):
                docs, score = index.top(terms, k, floors.get(i, 0))
                ids = pa.array(index.ids[docs], pa.int64(), mask=~index.known[docs])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), i, np.int32)), ids, pa.array(score)], ["item", "doc_id", "score"])

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.select("item", "doc_id", "score", place.alias("rank")).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The search for a block of items of bounded size."""
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession, "forward-index")
    wanted: dict = {}
    for r in items.collect():
        wanted.setdefault(r["item_id"], set()).update(terms_of(r["text"]))
    names = sorted(wanted, key=lambda i: (i is None, i))
    vocabulary = sorted(set().union(*wanted.values()))
    number = {t: i for i, t in enumerate(vocabulary)}
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    manifest = settled(docs.mapInArrow(_indexer(shared, folder), "name string, docs long, words long, terms array<long>, df array<long>"))
    total, words, files = manifest.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)), F.count("*")).first()
    # one row for each term of the block
    df = np.zeros(len(vocabulary), np.int64)
    for r in manifest.select(F.inline(F.arrays_zip("terms", "df"))).groupBy("terms").agg(F.sum("df").alias("df")).collect():
        df[r["terms"]] = r["df"]
    weight = np.floor(1000 * np.log((2.0 * total + 2) / (2.0 * df + 1))).astype(np.int64)
    terms = [np.array([number[t] for t in sorted(wanted[i])], np.int64) for i in names]
    first = F.pmod(F.xxhash64("name"), F.lit(WAVE)) == 0

    def searched(part: DataFrame, floors: dict[int, int]) -> DataFrame:
        held = spark.sparkContext.broadcast((weight, total, words, terms, floors))
        return part.select("name").repartition(max(shuffle_width(spark), files // 8), "name").mapInArrow(_searcher(held, folder, k), "item int, doc_id long, score long")

    early = settled(_best(searched(manifest.where(first), {}), k))
    floors = {r["item"]: r["score"] for r in early.where(F.col("rank") == k).select("item", "score").collect()}
    found = _best(early.select("item", "doc_id", "score").union(searched(manifest.where(~first), floors)), k)
    of = spark.createDataFrame([(i, name) for i, name in enumerate(names)], StructType([StructField("item", IntegerType()), items.schema["item_id"]]))
    return found.join(F.broadcast(of), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = BEST, text: str = "text", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents that score highest for each item, of those above 0; equal scores by doc_id, without one last.

    Tasks read whole texts once and write, for shards of bounded size, a forward index of the terms that are searched for; the
    statistics (documents, words, documents of each term) are sums over all shards. Every shard is then searched by the threshold algorithm, in a task that holds it:
    lists in the order of falling impact are read in turn, and each new document is scored by its forward entry, until no unseen document can reach the
    kth score. One of eight shards goes first, and what their merged kth scores are, the others have to reach as well. The shards' best are merged by item.

    Items go in blocks of about 16 MB, for each of which the documents are read again; block, statistics and scores to beat are broadcast, and bounded by that. Rows of items with one
    item_id are one item, with the terms of all of them. Rows of docs are documents each, whatever their ids; null and empty texts have no
    term and are never found. A term counts whatever its length. Empty tables give no rows. Other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select("item_id", F.col(item_text).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    parts = [_block(own, items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k) for b in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found

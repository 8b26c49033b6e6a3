"""Token files: frequency-ranked ids in a byte-aligned code with separate control bytes, and flat files scanned for separators."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import shards
from tidemark.llm.bytebpe import id_type, token_ids
from tidemark.llm.store import fresh_folder, settled, shuffle_width

#: Ids of a block in a coded file (a longer document is a block of its own) and bytes of a block of a flat file.
BLOCK_IDS, BLOCK_BYTES = 1 << 18, 1 << 23
RANKS = "ranks.bin"
#: Lengths in bytes of the four values that a control byte stands for.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of values, whose number is a multiple of four."""
    v = values.astype(np.uint32, copy=False)
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    quads = more.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    end = np.cumsum(more.astype(np.int64) + 1)
    at = end - more - 1
    data = np.empty(end[-1] if len(end) else 0, np.uint8)
    data[at] = v & 0xFF
    for k in (1, 2, 3):
        if (wide := np.flatnonzero(more >= k)).size:
            data[at[wide] + k] = (v[wide] >> (8 * k)) & 0xFF
    return control.astype(np.uint8), data


def unpack(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The values, by table lookup of each control byte's four lengths."""
    lengths = LENGTHS[control].ravel()
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    v = data[at].astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        if (wide := np.flatnonzero(lengths > k)).size:
            v[wide] |= data[at[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return v


def _coder(rank, dtype: str):
    """Each document's ids as ranks, padded with zeros to a multiple of four, as control and data bytes."""

    def code(batches):
        to_rank = rank.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                own = [np.frombuffer(x.as_buffer(), dtype) for x in part.column("ids")]
                n = np.array([len(x) for x in own], np.int64)
                first = np.concatenate([[0], np.cumsum((n + 3) // 4 * 4)])
                values = np.zeros(first[-1], np.uint32)
                for x, at in zip(own, first, strict=False):
                    values[at : at + len(x)] = to_rank[x]
                control, data = pack(values)
                spans = np.concatenate([[0], np.cumsum(LENGTHS[control].sum(axis=1, dtype=np.int64))])[first // 4]
                c = [control[a // 4 : b // 4].tobytes() for a, b in zip(first, first[1:], strict=False)]
                d = [data[a:b].tobytes() for a, b in zip(spans, spans[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(c, pa.binary()), pa.array(d, pa.binary())], ["doc_id", "n", "control", "data"])

    return code


def _writer(folder: str):
    """Writes a sorted partition as one shard. Block: four 32-bit sizes, doc_ids, which of them are null, numbers of ids, control bytes, data bytes."""

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        out, held, n_held, offset, block = None, [], 0, 0, 0

        def flush():
            nonlocal held, n_held, offset, block
            ids, sizes, control, data = zip(*held, strict=True)
            c, d = b"".join(control), b"".join(data)
            raw = b"".join((
                np.array([len(ids), sum(sizes), len(c), len(d)], "<u4").tobytes(), np.array([i or 0 for i in ids], "<i8").tobytes(),
                np.array([i is None for i in ids], "u1").tobytes(), np.array(sizes, "<u4").tobytes(), c, d,
            ))
            out.write(raw)
            row = (shard, block, offset, len(raw), len(ids), sum(sizes))
            held, n_held, offset, block = [], 0, offset + len(raw), block + 1
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["shard", "block", "offset", "bytes", "n_docs", "n_ids"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "control", "data")), strict=True):
                out = out or shards.ShardWriter(folder, f"part-{shard:06d}.tids")
                if held and n_held + row[1] > BLOCK_IDS:
                    yield flush()
                held.append(row)
                n_held += row[1]
        if held:
            yield flush()
        if out:
            out.commit()

    return write


_MANIFEST = "shard long, block long, offset long, bytes long, n_docs long, n_ids long"


def frequency_ranks(tokens: DataFrame, vocabulary: int, dtype: str) -> np.ndarray:
    """The id of each rank, most frequent first, ties by id; ids that don't occur come last. Sums per task, then per id: the driver gets a number for each id of the vocabulary."""

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = b"".join(x.as_buffer() for x in batch.column("ids").slice(lo, 512))
                total += np.bincount(np.frombuffer(some, dtype), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(vocabulary, np.int64)
    for r in rows:
        total[r["id"]] = r["n"]
    return np.argsort(-total, kind="stable").astype("<u4")


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, vocabulary: int = 1 << 16, added: bool = False) -> DataFrame:
    """Writes all documents' ids in ascending doc_id order (null ids first) as coded shards and returns the manifest of their blocks.

    Ids become ranks by frequency, so that the 256 most frequent take one byte. Tokenised documents are kept
    once as a Parquet table; what is shuffled into ranges of doc_id is the coded form, about a third of the texts.

    Null and empty texts have the end id only. Rows with one doc_id, or without, are documents each, in the order of their
    number of ids and a hash of the coded bytes, then the bytes: a shard that is written again is the same, byte for byte, and many
    rows of one id spread over shards. A text of any length is a block of its own. An empty table writes the ranks only. Other columns are ignored.
    """
    spark = docs.sparkSession
    dtype = id_type(vocabulary).str
    kept = fresh_folder(spark, "token-ids")
    token_ids(docs, tokenizer_path, end_id, added=added).write.option("compression", "zstd").parquet(kept)
    tokens = spark.read.schema("doc_id long, ids binary").parquet(kept)
    by_rank = frequency_ranks(tokens, vocabulary, dtype)
    ranks = shards.ShardWriter(folder, RANKS)
    ranks.write(by_rank.tobytes())
    ranks.commit()
    to_rank = np.empty(vocabulary, np.uint32)
    to_rank[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    coded = tokens.mapInArrow(_coder(spark.sparkContext.broadcast(to_rank), dtype), "doc_id long, n long, control binary, data binary")
    tie = F.xxhash64("control", "data").alias("tie")
    ordered = coded.select("*", tie).repartitionByRange(shuffle_width(spark), "doc_id", "n", "tie").sortWithinPartitions("doc_id", "n", "tie", "control", "data")
    return settled(ordered.drop("tie").mapInArrow(_writer(folder), _MANIFEST))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of every document, decoded from the shards.

    A block's start is a running sum over its shard's blocks after the sums of the shards before; only the manifest is summed.
    """
    totals = manifest.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    bases = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    before = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    blocks = manifest.withColumn("before", before).join(F.broadcast(bases), "shard").select("shard", "offset", "bytes", (F.col("base") + F.col("before")).alias("start"))

    def read(batches):
        by_rank = None
        for batch in batches:
            for shard, offset, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if by_rank is None:
                    n = dict(shards.sizes(folder, RANKS))[RANKS]
                    by_rank = np.frombuffer(shards.read_range(folder, RANKS, 0, n), "<u4")
                raw = np.frombuffer(shards.read_range(folder, f"part-{shard:06d}.tids", offset, size), np.uint8)
                docs, _, nc, nd = (int(x) for x in raw[:16].view("<u4"))
                ids, rest = raw[16 : 16 + 8 * docs].tobytes(), raw[16 + 8 * docs :]
                null, sizes = rest[:docs].astype(bool), np.frombuffer(rest[docs : 5 * docs].tobytes(), "<u4").astype(np.int64)
                control, data = rest[5 * docs : 5 * docs + nc], rest[5 * docs + nc : 5 * docs + nc + nd]
                values = by_rank[unpack(control, data)]
                first = np.concatenate([[0], np.cumsum((sizes + 3) // 4 * 4)])
                lists = [values[a : a + n].tobytes() for a, n in zip(first, sizes, strict=False)]
                starts = start + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, "<i8"), mask=null), pa.array(starts), pa.array(sizes), pa.array(lists, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def with_crc(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of read_token_files' rows."""

    def run(batches):
        for batch in batches:
            crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return documents.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_flat_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> DataFrame:
    """Writes ids with end_id after each document as flat little-endian files without any index, one for each input partition, in input order.

    Returns shard, ordinal, doc_id of the documents written. A map without a shuffle.

    Added tokens that a text holds literally are plain text here, so that end_id stands after documents only. Null and empty
    texts have the end id only. Repeated rows and ids are documents each, in input order; texts of any length are written as they come. An empty table writes nothing. Other columns are ignored.
    """

    def write(batches):
        from pyspark import TaskContext

        shard, out, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            out = out or shards.ShardWriter(folder, f"flat-{shard:06d}.bin")
            for x in batch.column("ids"):
                out.write(x.as_buffer())
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([shard] * k, pa.int64()), pa.array(np.arange(n, n + k)), batch.column("doc_id")], ["shard", "ordinal", "doc_id"])
            n += k
        if out:
            out.commit()

    return settled(token_ids(docs, tokenizer_path, end_id).mapInArrow(write, "shard long, ordinal long, doc_id long"))


def scan_separators(spark: SparkSession, folder: str, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """shard, ordinal, start, n_tokens, ended of every document in a folder of flat token files.

    Blocks of block_bytes are read apart from each other and searched for end_id; a document that goes over
    blocks is stitched by a prefix scan: the last separator and the number of separators of all blocks before, over
    each file's block summaries. Token counts leave the separator out. Tokens after a file's last separator
    are a document with ended = false. An empty folder gives no rows. The driver only lists the files.
    """
    listed = [(int(name[5:-4]), size) for name, size in shards.sizes(folder, ".bin")]
    files = spark.createDataFrame(listed, "shard long, size long")
    step = block_bytes // width * width
    blocks = files.where("size > 0").select("shard", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {step})")).alias("block"))
    blocks = blocks.repartition(max(1, min(sum(s // step + 1 for _, s in listed), 4 * shuffle_width(spark))))

    def search(batches):
        for batch in batches:
            for shard, size, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                length = min(step, size - block * step)
                ids = np.frombuffer(shards.read_range(folder, f"flat-{shard:06d}.bin", block * step, length), f"<u{width}")
                at = np.flatnonzero(ids == end_id) + block * (step // width)
                last = int(at[-1]) if len(at) else None
                row = (shard, block, len(at), last, size // width, at.astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (*[pa.int64()] * 5, pa.binary()), strict=True)], ["shard", "block", "n", "last", "length", "ends"])

    found = settled(blocks.mapInArrow(search, "shard long, block long, n long, last long, length long, ends binary"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        "shard", "length", "ends", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinal"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"),
        (F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("block"))) == 1).alias("final"),
    )

    def stitch(batches):
        for batch in batches:
            for shard, length, ends, ordinal, carry, final in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = np.frombuffer(ends, "<i8")
                stops = np.append(ends, length) if final and (ends[-1] if len(ends) else carry) < length - 1 else ends
                starts = np.concatenate([[carry], ends])[: len(stops)] + 1
                k = len(stops)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * k, pa.int64()), pa.array(np.arange(ordinal, ordinal + k)), pa.array(starts.astype(np.int64)), pa.array((stops - starts).astype(np.int64)), pa.array(np.arange(k) < len(ends))], ["shard", "ordinal", "start", "n_tokens", "ended"])

    return carried.mapInArrow(stitch, "shard long, ordinal long, start long, n_tokens long, ended boolean")

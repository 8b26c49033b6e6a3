"""SHA-256 of whole files of any size: large ones are read in pieces, and each piece goes on from the digest's state after the piece before."""

from __future__ import annotations

import _hashlib
import ctypes
import ctypes.util
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import fresh_folder

#: Bytes of a file that is read at once, and of a piece of a larger one; bytes of a row of a piece.
PIECE, ROW = 1 << 27, 1 << 18
#: Fixed value: endings of names that Spark's line reader would unpack.
PACKED = ("gz", "bz2", "deflate", "lz4", "snappy", "zst")
_BOM = b"\xef\xbb\xbf"


class _Context(ctypes.Structure):
    """SHA256_CTX of openssl/sha.h."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32), ("data", ctypes.c_uint32 * 16), ("held", ctypes.c_uint), ("length", ctypes.c_uint)]


class Sha256:
    """The digest of OpenSSL with its state as bytes, which hashlib doesn't give out."""

    def __init__(self, state: bytes | None = None):
        for name in (getattr(_hashlib, "__file__", None), ctypes.util.find_library("crypto")):
            library = ctypes.CDLL(name)
            if hasattr(library, "SHA256_Init"):
                break
        else:
            raise RuntimeError("files of more than a piece need OpenSSL's libcrypto on every worker")
        self.library, self.context = library, _Context.from_buffer_copy(state) if state else _Context()
        if not state:
            library.SHA256_Init(ctypes.byref(self.context))

    @property
    def read(self) -> int:
        """Bytes so far."""
        return (self.context.high << 32 | self.context.low) >> 3

    def update(self, data: pa.Buffer) -> None:
        self.library.SHA256_Update(ctypes.byref(self.context), ctypes.c_void_p(data.address), ctypes.c_size_t(data.size))

    def state(self) -> bytes:
        return bytes(self.context)

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self.library.SHA256_Final(out, ctypes.byref(_Context.from_buffer_copy(self.context)))
        return out.raw.hex()


def _rows(batches):
    """Lines of one split after the other as rows of about ROW bytes."""
    n = 0
    for batch in batches:
        file, start, lines = (batch.column(c) for c in ("file", "start", "line"))
        read = np.cumsum(pc.binary_length(lines).to_numpy(), dtype=np.int64)
        first = start.to_numpy()
        cut = (np.diff(first) != 0) | (np.diff(read // ROW) != 0) | pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(cut) + 1), len(lines)] if len(lines) else []
        for lo, hi in pairwise(map(int, bounds)):
            data = b"".join(lines.slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays([file.slice(lo, 1), start.slice(lo, 1), pa.array([n]), pa.array([len(data)]), pa.array([data], pa.binary())], ["file", "start", "n", "bytes", "data"])
            n += 1


def _pieces(spark: SparkSession, folder: str, piece: int) -> DataFrame:
    """All bytes of the files that are larger than a piece, from Spark's line reader, as rows by piece; each line ends in a line feed, the file's last one too."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(folder)
    of = lambda name: F.col(f"_metadata.{name}")
    large = lines.where((of("file_size") > piece) & ~of("file_name").rlike(r"\.(" + "|".join(PACKED) + ")$"))
    whole = large.select(of("file_path").alias("file"), of("file_block_start").alias("start"), F.concat(F.col("value").cast("binary"), F.lit(bytearray(b"\n"))).alias("line"))
    # one line can be as long as a file
    cuts = F.transform(F.sequence(F.lit(0), F.expr(f"int((octet_length(line) - 1) div {ROW})")), lambda i: F.substring("line", i * ROW + 1, ROW))
    rows = whole.select("file", "start", F.explode(cuts).alias("line")).mapInArrow(_rows, "file string, start long, n long, bytes long, data binary")
    kept = fresh_folder(spark, "pieces")
    rows.withColumn("piece", F.expr(f"start div {piece}")).write.option("compression", "none").partitionBy("piece").parquet(kept)
    return spark.read.schema("file string, start long, n long, bytes long, data binary, piece long").parquet(kept)


def _step(files: dict[str, tuple[int, bytes | None, bool]]):
    """The states of files after the next piece of each. files: size, state, and whether the reader has left a byte order mark out."""

    def run(batches):
        digest = last = None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.state()])], ["file", "state"])

        for batch in batches:
            for file, data in zip(batch.column("file").to_pylist(), batch.column("data"), strict=True):
                size, state, marked = files[file]
                if file != last:
                    if digest:
                        yield row()
                    digest, last = Sha256(state), file
                    if marked and not state:
                        digest.update(pa.py_buffer(_BOM))
                digest.update(data.as_buffer().slice(0, min(len(data.as_buffer()), size - digest.read)))
        if digest:
            yield row()

    return run


def _large_hashes(spark: SparkSession, folder: str, sizes: dict[str, int], piece: int) -> dict[str, str]:
    """SHA-256 by file, in rounds: a round reads the next piece of every file that has one. The driver holds a state of 112 bytes for each file."""
    rows = _pieces(spark, folder, piece)
    files = {}
    for r in rows.groupBy("file").agg(F.sum("bytes").alias("bytes")).collect():
        # beside the file's own bytes: a line feed more if it ends in none, three bytes less if it begins with a byte order mark
        marked = r["bytes"] < sizes[r["file"]]
        if r["bytes"] + 3 * marked - sizes[r["file"]] not in (0, 1):
            raise RuntimeError(f"{r['file']} has {sizes[r['file']]} bytes, but {r['bytes']} were read")
        files[r["file"]] = (sizes[r["file"]], None, marked)
    if files.keys() != sizes.keys():
        raise RuntimeError(f"not read: {sorted(sizes.keys() - files.keys())[:3]}")
    for k in range((max(sizes.values()) - 1) // piece + 1):
        own = {f: x for f, x in files.items() if x[0] > k * piece}
        dealt = rows.where(F.col("piece") == k).select("file", "start", "n", "data").repartition(len(own), "file").sortWithinPartitions("file", "start", "n")
        for r in dealt.mapInArrow(_step(own), "file string, state binary").collect():
            files[r["file"]] = (files[r["file"]][0], bytes(r["state"]), files[r["file"]][2])
    digests = {f: Sha256(state) for f, (_, state, _) in files.items()}
    short = [f for f, d in digests.items() if d.read != sizes[f]]
    if short:
        raise RuntimeError(f"not read to their ends: {short[:3]}")
    return {f: d.hexdigest() for f, d in digests.items()}


def file_hashes(spark: SparkSession, folder: str, piece: int = PIECE) -> DataFrame:
    """path, sha256 of all files in a folder and the folders in it.

    Files up to a piece are read at once. A larger one may have any size: no task reads more of it than a piece, as splits of
    `spark.sql.files.maxPartitionBytes` make it, and the line that goes over its end. One file's pieces follow each other, as SHA-256 asks for; files go on side by side. The pieces are written once, without compression.
    Empty files have no row, as Spark's listing leaves them out. Large files whose names end as those of packed texts do (see PACKED) are read at once, up to 2 GB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    hashed = lambda rows: rows.select("path", F.sha2("content", 256).alias("sha256"))
    found = files.load(folder)
    out = hashed(found.where(F.col("length") <= piece))
    listed = found.where(F.col("length") > piece).select("path", "length", F.col("_metadata.file_path").alias("file")).collect()
    packed = [r for r in listed if r["path"].endswith(tuple(f".{p}" for p in PACKED))]
    if packed:
        out = out.union(hashed(files.option("pathGlobFilter", "*.{" + ",".join(PACKED) + "}").load(folder).where(F.col("length") > piece)))
    large = [r for r in listed if r not in packed]
    if large:
        hashes = _large_hashes(spark, folder, {r["file"]: r["length"] for r in large}, piece)
        out = out.union(spark.createDataFrame([(r["path"], hashes[r["file"]]) for r in large], "path string, sha256 string"))
    return out

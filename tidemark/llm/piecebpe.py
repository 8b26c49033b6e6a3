"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a piece of text the last token of its encoding is unique. The table holds that token for each
prefix, from left to right: of the vocabulary's pieces that end there (an automaton reports them all) it is the one
that is compatible with the last token of the prefix before it. Two tokens are compatible where no merge crosses
from one to the other when both are encoded side by side. The ids are read off the table from the end backwards.
"""

from __future__ import annotations

import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytebpe import Remembered

SPACE = "▁"
#: Pairs of tokens whose compatibility a Python worker remembers, and characters it cuts at once.
PAIRS, STRETCH = 1_000_000, 1 << 20


class PrefixTable:
    """Encodes as the library does with a BPE model that has an identity normaliser, a dummy prefix, escaped white space and byte fallback."""

    def __init__(self, model: bytes):
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in normal}
        scores = np.array([sp.get_score(i) for i in normal])
        order = np.argsort(-scores, kind="stable")
        self.rank = {self.text[normal[k]]: n for n, k in enumerate(order)}
        if any(len(t) > 1 and (SPACE in t.lstrip(SPACE) or any(c not in self.rank for c in t)) for t in self.rank):
            raise ValueError("a piece of this model goes over a word's start or has a character that is no piece")
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        automaton = ahocorasick.Automaton()
        for i, t in self.text.items():
            if self.merged(t, 0):
                automaton.add_word(t, (i, len(t)))
        automaton.make_automaton()
        self.matches = automaton.iter
        self.fits: dict[int, bool] = {}
        self.words = Remembered(self.word)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))

    def merged(self, text: str, seam: int) -> bool:
        """Merges text's characters, best piece first and leftmost among equals. True if it ends as one piece (seam 0) or if no merge crosses the seam."""
        parts, rank = list(text), self.rank
        at = seam
        while len(parts) > 1:
            best, where = len(rank), -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1], best)
                if r < best:
                    best, where = r, k
            if where < 0:
                break
            if seam:
                if where == at - 1:
                    return False
                at -= where < at
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return bool(seam) or len(parts) == 1

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            found = self.fits[key] = self.merged(self.text[a] + self.text[b], len(self.text[a]))
        return found

    def word(self, text: str) -> bytes:
        """The ids of one cut of normalised text, as little-endian unsigned 32-bit integers."""
        n = len(text)
        last, size, fits = [-1] * (n + 1), [1] * (n + 1), self.fits
        for end, (token, length) in self.matches(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before >= 0:
                    fit = fits.get(before << 32 | token)
                    if not (self.compatible(before, token) if fit is None else fit):
                        continue
                # an entry of -1 is no token yet, or a character outside the vocabulary, with which nothing merges
                elif text[start - 1] in self.rank:
                    continue
            last[end], size[end] = token, length
        ids = array("I")
        while n:
            if last[n] >= 0:
                ids.append(last[n])
            else:
                ids.extend(self.bytes[b] for b in reversed(text[n - 1].encode()))
            n -= size[n]
        ids.reverse()
        return ids.tobytes()

    def encode(self, text: str | None) -> bytes:
        """All ids with the begin and end ids, as little-endian unsigned 32-bit integers."""
        if not text:
            return self.begin + self.end
        out, words = [self.begin], self.words
        normal = SPACE + text.replace(" ", SPACE)
        at = 0
        while at < len(normal):
            stop = at + STRETCH
            while stop < len(normal) and not (normal[stop] == SPACE and normal[stop - 1] != SPACE):
                stop += 1
            part = normal[at:stop]
            if SPACE * 2 in part:
                cuts = self.cut.findall(part)
            else:
                cuts = list(filter(None, part.replace(SPACE, " " + SPACE).replace("\n", " \n ").split(" ")))
            at = stop
            out.extend(map(words.__getitem__, cuts))
        out.append(self.end)
        return b"".join(out)


_tables: dict[int, PrefixTable] = {}


def _encoder(model):
    def encode(batches):
        proto = model.value
        table = _tables.get(hash(proto)) or _tables.setdefault(hash(proto), PrefixTable(proto))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [table.encode(t) for t in part.column(1).to_pylist()]
                decoded = table.processor.decode([np.frombuffer(x, "<u4").tolist() for x in ids], num_threads=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids_le", "decoded"])

    return encode


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, ids_le (all ids with begin and end ids, little-endian unsigned 32-bit), decoded (the library's decoding of those ids).

    A map without a shuffle; the model (about half a megabyte) is read once by the driver and broadcast. A null or empty
    text has the begin and end ids only and decodes to ''. Texts of any length are cut at word starts, which
    no piece crosses. Repeated rows and ids give a row each; other columns are ignored.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_encoder(model), "doc_id long, ids_le binary, decoded string")

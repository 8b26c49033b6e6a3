"""Byte-level BPE with the tokenizers library, called for the units of text that a worker has not met yet.

Texts are cut into units at their bytes, equal units of many texts are found by Arrow's dictionary encoding, and the ids of texts are taken from those of the units.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a Python worker's remembered words may take, about what an entry takes beside its characters, and the longest word to remember.
ROOM, ENTRY, LONGEST = 192 << 20, 190, 64
#: The same room for units of texts, beside which a slice's own are held.
UNIT_ROOM = 128 << 20
#: Bytes of text that are cut and looked up at once (a longer text is alone), and bytes whose kinds are compared at once.
SLICE, STRIDE = 4 << 20, 1 << 18
#: Kinds of bytes: white space, ASCII letters, ASCII signs and digits; others are of kind 0.
BLANK, LETTER, SIGN = 1, 2, 3
KINDS = bytes(BLANK if b in b"\t\n\v\f\r " else LETTER if chr(b).isalpha() and b < 128 else SIGN if 32 < b < 127 else 0 for b in range(256))
#: What a pair of kinds may be: no cut, a cut, or one that depends on the character that ends before it, or on those around a line feed.
CUT, LOOK, FEED = 1, 2, 4
_PAIRS = {LETTER << 2 | BLANK: CUT, SIGN << 2 | BLANK: CUT, LETTER << 2 | SIGN: CUT, BLANK: LOOK, SIGN: LOOK, BLANK << 2: FEED, BLANK << 2 | LETTER: FEED, BLANK << 2 | SIGN: FEED}
PAIRS = bytes(_PAIRS.get(k, 0) for k in range(256))
#: White space beyond ASCII: its bytes as one number, and which bytes it begins with.
BEYOND = [int.from_bytes(c.encode()) for c in ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")]
BEYOND_FIRST = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])


#: Byte-level BPE writes every byte as a letter: printable ones as themselves, the others as letters from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
SPACE_LETTER = chr(BYTE_LETTERS[32])
#: ASCII signs or digits, which are one part for the pre-tokeniser.
SIGNS = re.compile(r"[!-/:-@\[-`{-~]+|[0-9]+")


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units begin in the UTF-8 bytes of texts that begin at starts.

    The pre-tokeniser's parts always end there, and it sees the same parts when both sides stand alone: before white space that follows
    none, between a Latin letter and an ASCII sign or digit, and after a line feed that stands alone. Other bounds are left to the library.
    """
    begin = np.zeros(len(data) + 1, bool)
    fed = []
    for lo in range(0, len(data) - 1, STRIDE):
        kinds = np.frombuffer(data[lo : lo + STRIDE + 1].tobytes().translate(KINDS), np.uint8)
        found = np.frombuffer((kinds[:-1] << 2 | kinds[1:]).tobytes().translate(PAIRS), np.uint8)
        begin[lo + 1 : lo + 1 + len(found)] = found == CUT
        at = np.flatnonzero(found == LOOK) + lo + 1
        white = data[at] <= 32
        three = np.array([data[np.maximum(at - k, 0)] for k in (3, 2, 1)], np.uint32)
        two = three[1] << 8 | three[2]
        # before a sign a letter from U+00C0 to U+00FF but no multiplication or division sign, before white space what is none
        letter = (three[1] == 0xC3) & (two != 0xC397) & (two != 0xC3B7)
        begin[at[np.where(white, (three[2] < 0x80) | ~np.isin(three[0] << 16 | two, BEYOND) & ~np.isin(two, BEYOND), letter)]] = True
        at = np.flatnonzero(found == FEED) + lo + 1
        fed.append(at[(data[at - 1] == 10) & ~BEYOND_FIRST[data[at]]])
    begin[starts] = True
    fed = np.concatenate([*fed, np.zeros(0, np.int64)])
    begin[fed[begin[fed - 1]]] = True
    return np.flatnonzero(begin[:-1])


class Remembered(dict):
    """Words and their encodings: a word that is missing is learned; long ones are not kept. When half of the room is taken, what was met since goes on and what was not is forgotten."""

    def __init__(self, learn, room: int = 0):
        super().__init__()
        self.half = (room or ROOM) // 2
        self.learn, self.room, self.older = learn, self.half, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.learn(word)
        self.keep([word], [found])
        return found

    def keep(self, words: list[str], found: list[bytes]) -> None:
        for word, x in zip(words, found, strict=True):
            if len(word) <= LONGEST:
                self.room -= ENTRY + len(x) + (len(word) if word.isascii() else 4 * len(word))
                if self.room < 0:
                    self.older = dict(self)
                    super().clear()
                    self.room += self.half
                self[word] = x

    def many(self, words: list[str]) -> list[bytes]:
        """The encodings of different words, as a lookup of each gives."""
        found = list(map(self.get, words))
        new = [k for k, x in enumerate(found) if x is None]
        older, learn = self.older.get, self.learn
        for k in new:
            found[k] = older(w := words[k]) or learn(w)
        self.keep([words[k] for k in new], [found[k] for k in new])
        return found

    def clear(self) -> None:
        super().clear()
        self.room, self.older = self.half, {}


class WordEncoder:
    """Ids of texts as little-endian unsigned integers of 16 bits (32 where the vocabulary needs it).

    added: added tokens that a text holds literally get their own ids, as in the library's plain encode(); else special ones are plain text.
    """

    def __init__(self, spec: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = not added
        self.tokenize = self.tokenizer.model.tokenize
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = Remembered(self.learn, UNIT_ROOM)
        self.coded = [self.ids([k]) for k in range(self.tokenizer.get_vocab_size())]
        said = json.loads(spec)
        #: What sends a text to the library whole.
        self.added = [t["content"] for t in said.get("added_tokens") or [] if t["content"] and (added or not t.get("special"))]
        before = said.get("pre_tokenizer") or {}
        #: Byte-level BPE on the usual words: cuts change nothing there, and letters are one unit of the model.
        self.by_word = not said.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        #: A unit may be an added token only if one is written with letters or signs alone.
        self.direct = self.by_word and not any(a.strip(" ").isalpha() or SIGNS.fullmatch(a.strip(" ")) for a in self.added)

    def ids(self, numbers: list[int]) -> bytes:
        return array(self.code, numbers).tobytes()

    def learn(self, unit: str) -> bytes:
        """Latin letters, with a blank before or not, or ASCII signs alone go to the library's model directly, others through the library's whole pipeline."""
        spaced = unit[0] == " "
        core = unit[1:] if spaced else unit
        if self.direct and (core.isalpha() and (core.isascii() or max(core) < "\u0250") or SIGNS.fullmatch(core)):
            letters = core if core.isascii() else core.encode().decode("latin-1").translate(BYTE_LETTERS)
            coded = self.coded
            return b"".join([coded[t.id] for t in self.tokenize(SPACE_LETTER + letters if spaced else letters)])
        return self.ids(self.tokenizer.encode(unit, add_special_tokens=False).ids)

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of texts without nulls, one after the other, and the number of units before the end of each text. A text that the library gets whole is one unit, an empty text has none."""
        ends = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        lo, hi = int(ends[0]), int(ends[-1])
        data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
        ends -= lo
        starts = ends[:-1][ends[:-1] < ends[1:]]
        begin = cuts(data, starts) if self.by_word else starts
        raw = data.tobytes() if self.added else b""
        whole = {int(np.searchsorted(ends, m.start(), "right")) - 1 for a in self.added for m in re.finditer(re.escape(a.encode()), raw)}
        if whole and self.by_word:
            keep = np.ones(len(begin), bool)
            for k in whole:
                keep[np.searchsorted(begin, ends[k], "right") : np.searchsorted(begin, ends[k + 1])] = False
            begin = begin[keep]
        bounds = np.append(begin, len(data)).astype("<i4")
        units = pa.StringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(data))
        return units, np.searchsorted(begin, ends[1:])

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text, with end after them. Null texts count as empty."""
        units, last = self.units(texts.cast(pa.string()).fill_null(""))
        found = units.dictionary_encode()
        coded = pa.array([*self.words.many(found.dictionary.to_numpy(zero_copy_only=False).tolist()), end], pa.binary())
        # the end stands after each text's units as a unit more
        order = np.insert(found.indices.to_numpy(zero_copy_only=False), last, len(coded) - 1)
        taken = coded.take(pa.array(order))
        at = np.frombuffer(taken.buffers()[1], "<i4")[: len(order) + 1][np.concatenate([[0], last + np.arange(1, len(last) + 1)])]
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(at.astype("<i4")), taken.buffers()[2]])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()


def slices(texts: pa.Array):
    """Offsets and numbers of consecutive texts of up to SLICE bytes together, at least one text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE, "right")))
        yield lo, hi - lo
        lo = hi


def id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


_encoders: dict[tuple[int, bool], WordEncoder] = {}


def encoder(spec: str, added: bool = False) -> WordEncoder:
    key = (hash(spec), added)
    return _encoders.get(key) or _encoders.setdefault(key, WordEncoder(spec, added))


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", added: bool = False) -> DataFrame:
    """doc_id, ids (bytes of little-endian unsigned 16-bit integers, or 32-bit for large vocabularies), end_id last. Null texts count as empty. added: see WordEncoder."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches):
        e = encoder(spec.value, added)
        end = e.ids([end_id])
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                part = batch.slice(lo, n)
                coded = pa.RecordBatch.from_arrays([part.column(0), e.encode_array(part.column(1), end)], ["doc_id", "ids"])
                # few rows at once, for which the JVM and the next worker need little memory
                yield from (coded.slice(at, 256) for at in range(0, n, 256))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids binary")

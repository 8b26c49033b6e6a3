"""Words of texts as numpy arrays of 64-bit hashes, computed for many texts at once from their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
_power = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes outside words of letters and digits only; every byte of a longer UTF-8 sequence counts as a letter.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    global _power, _inverse
    if len(_power) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            steps = np.full(n, BASE, np.uint64)
            steps[0] = 1
            _power = np.multiply.accumulate(steps)
            steps[1:] = np.uint64(pow(BASE, -1, 1 << 64))
            _inverse = np.multiply.accumulate(steps)
    return _power[:n], _inverse[:n]


def pieces(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `most` bytes together; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def joined_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each text followed by a newline, and where each text starts (one entry more than texts)."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    raw.append(b"")
    return np.frombuffer(b"\n".join(raw), np.uint8), starts


class Words:
    """All words of some texts with A-Z lowered: 64-bit hashes, and first[i]:first[i + 1] for text i. Words are `[^\\x20\\x09-\\x0D]+`, or what else the table of separating bytes leaves."""

    def __init__(self, texts: list[str | None], separates: np.ndarray = SPACE):
        data, starts = joined_bytes(texts)
        self.data, self.starts = data, starts
        lowered = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
        inside = ~separates[data]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
        self.begin = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        power, inverse = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
            self.hash = mixed((total[self.end] - total[self.begin]) * inverse[self.begin])
        self._total, self._inverse = total, inverse
        self.first = np.searchsorted(self.begin, starts)

    def heads(self, n: int) -> np.ndarray:
        """Hashes of the words' first n bytes."""
        stop = np.minimum(self.begin + n, self.end)
        with np.errstate(over="ignore"):
            return mixed((self._total[stop] - self._total[self.begin]) * self._inverse[self.begin])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and first[i]:first[i + 1] for text i. A text with fewer words has one run of all of them."""
    h, first = words.hash, words.first
    n = np.diff(first)
    runs = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(runs, out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    long = n >= width
    with np.errstate(over="ignore"):
        weights = mixed(np.arange(1, width + 1, dtype=np.uint64))
        if len(h) >= width:
            rolled = sum(h[j : len(h) - width + 1 + j] * (weights[j] | np.uint64(1)) for j in range(width))
            where = np.repeat(first[:-1][long] - at[:-1][long], runs[long]) + np.flatnonzero(np.repeat(long, runs))
            out[np.repeat(long, runs)] = mixed(rolled[where] + np.uint64(width))
        for i in np.flatnonzero((n > 0) & ~long):
            own = h[first[i] : first[i + 1]]
            out[at[i]] = mixed(np.array([np.sum(own * (weights[: len(own)] | np.uint64(1))) + np.uint64(len(own))]))[0]
    return out, at

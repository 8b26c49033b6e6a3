"""Numbers: intervals, rates, steps of a scale, price of a call."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rowwise import one_by_one

Z = 1.96


def wilson(hits: Column, n: Column) -> tuple[Column, Column]:
    """Bounds of the 95 % interval of a share; 0 and 0 without observations."""
    p = F.try_divide(hits, n)
    half = Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))
    low = (p + Z * Z / (2 * n) - half) / (1 + Z * Z / n)
    high = (p + Z * Z / (2 * n) + half) / (1 + Z * Z / n)
    zero = F.lit(0.0)
    return F.when(n == 0, zero).otherwise(F.greatest(zero, low)), F.when(n == 0, zero).otherwise(F.least(F.lit(1.0), high))


def jaccard(a: Column, b: Column) -> Column:
    """Common members among all members; 1 for two empty sets."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


#: Ranges of texts with fewer pairs of characters than this are compared by the standard library.
SMALL = 1 << 16
#: Letters that are counted for themselves in the bound; all others are counted together.
COUNTED = "etaoinsr "
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]))


def _sums(x: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Running sums of characters times powers: the hash of a run is their difference, brought to one power."""
    with np.errstate(over="ignore"):
        scrambled = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum((scrambled ^ (scrambled >> np.uint64(29))) * power[: len(x)])])


def _longest_block(a: np.ndarray, b: np.ndarray, sums: tuple[np.ndarray, np.ndarray], power: np.ndarray, lo: int, hi: int, low: int, high: int) -> tuple[int, int, int]:
    """The longest block that a[lo:hi] and b[low:high] have in common, the first in a and then in b of several.

    Its length is found by bisection: common blocks of a length are runs of one hash, and with a block all shorter ones are common.
    """

    def hashes(side: int, start: int, stop: int, size: int, last: int) -> np.ndarray:
        first = np.arange(start, stop - size + 1)
        with np.errstate(over="ignore"):
            return (sums[side][first + size] - sums[side][first]) * power[last - first]

    def common(size: int) -> tuple[int, int] | None:
        last = max(hi, high)
        x, y = hashes(0, lo, hi, size, last), hashes(1, low, high, size, last)
        order = np.argsort(y, kind="stable")
        at = np.minimum(np.searchsorted(y[order], x), len(y) - 1)
        for i in np.flatnonzero(y[order][at] == x).tolist():
            j = low + int(order[at[i]])
            if np.array_equal(a[lo + i : lo + i + size], b[j : j + size]):
                return lo + i, j
        return None

    best, size, most = (lo, low), 0, min(hi - lo, high - low)
    while size < most:
        middle = (size + most + 1) // 2
        found = common(middle)
        if found:
            best, size = found, middle
        else:
            most = middle - 1
    return (*best, size)


def matching_characters(x: str, y: str) -> int:
    """Characters in the common blocks of two texts: the longest block first, then what is left and right of it in both, and so on. Blocks are the standard library's, without its shortcut for frequent characters.

    Large ranges are searched by hashes of runs, in time about n log n each instead of n squared.
    """
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (x, y))
    power = _powers(max(len(a), len(b), 1))
    sums = _sums(a, power), _sums(b, power)
    waiting, total = [(0, len(x), 0, len(y))], 0
    while waiting:
        lo, hi, low, high = waiting.pop()
        if (hi - lo) * (high - low) <= SMALL:
            if hi > lo and high > low:
                total += sum(m.size for m in SequenceMatcher(None, x[lo:hi], y[low:high], autojunk=False).get_matching_blocks())
            continue
        i, j, size = _longest_block(a, b, sums, power, lo, hi, low, high)
        if size:
            total += size
            waiting += [(lo, i, low, j), (i + size, hi, j + size, high)]
    return total


def _ratio(a: str | None, b: str | None) -> float | None:
    return None if a is None or b is None else 2.0 * matching_characters(a, b) / (len(a) + len(b)) if a or b else 1.0


def ratio_bound(a: Column, b: Column) -> Column:
    """What sequence_ratio can be at most: both texts' counts of some letters, and of all others together. Columns only."""
    counts = lambda t: [F.length(t) - F.length(F.replace(t, F.lit(c), F.lit(""))) for c in COUNTED]
    x, y = counts(a), counts(b)
    rest = [F.length(t) - sum(c[1:], c[0]) for t, c in ((a, x), (b, y))]
    common = F.least(*rest) + sum((F.least(p, q) for p, q in zip(x[1:], y[1:], strict=True)), F.least(x[0], y[0]))
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 1.0).otherwise(2.0 * common / both)


def sequence_ratio(a: Column | str, b: Column | str, least: float | None = None) -> Column:
    """Similarity of two texts by their longest common blocks, as Python's standard library counts it; nulls as empty. With least, 0 where ratio_bound() is below it: these pairs never reach Python."""
    a, b = (F.coalesce(F.col(t) if isinstance(t, str) else t, F.lit("")) for t in (a, b))
    ratio = one_by_one(_ratio, "double", pa.float64())
    if least is None:
        return ratio(a, b)
    return F.coalesce(ratio(F.when(ratio_bound(a, b) >= least, a), b), F.lit(0.0))


def pair_score(headline_a: Column, headline_b: Column, words_a: Column, words_b: Column, least: float | None = None) -> Column:
    """How well two items fit: the better of their headlines' similarity and their excerpts' common words. With least, a headlines' similarity that must be below it counts 0."""
    return F.greatest(sequence_ratio(headline_a, headline_b, least), jaccard(words_a, words_b))


def colour_step(change: Column, full: float = 3.5, steps: int = 10) -> Column:
    """Signed step of a colour scale that grows with the root of the change."""
    t = F.least(F.lit(1.0), F.sqrt(F.abs(change) / full))
    return (F.floor(steps * t + 0.5) * F.signum(change)).cast("int")


def percent_label(now: Column, before: Column) -> Column:
    """`+12%`, `new` where there was nothing, `n/a` where there is nothing at all."""
    pct = F.round(100 * (now - before) / F.nullif(before, F.lit(0)), 0).cast("long")
    return F.when((before == 0) & (now == 0), "n/a").when(before == 0, "new").otherwise(F.concat(F.when(pct >= 0, "+").otherwise(""), pct.cast("string"), F.lit("%")))


def call_cost(tokens_in: Column, tokens_out: Column, written: Column, read: Column, price_in: Column, price_out: Column, stage: Column) -> Column:
    """Dollars of a call: cache writes at 1.25 and reads at 0.1 of the input price, batch stages at half. Null without a price."""
    full = (tokens_in * price_in + written * price_in * 1.25 + read * price_in * 0.1 + tokens_out * price_out) / 1e6
    return full * F.when(stage.endswith("_batch"), 0.5).otherwise(1.0)


def depth_tier(days: Column) -> Column:
    return F.when(days >= 8, "deep").when(days >= 5, "developed").otherwise("concise")

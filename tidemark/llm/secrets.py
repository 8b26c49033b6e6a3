"""Secrets: fixed patterns, and a linear-chain conditional random field that learns from them what else looks like one."""

from __future__ import annotations

import random
import re
import string
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shards
from tidemark.llm.rows import numbered
from tidemark.llm.sampling import carried, drawn, schema
from tidemark.llm.store import fresh_folder, settled
from tidemark.llm.textcore import joined_bytes, mixed, pieces

#: The patterns of the contract (fixed values). Of the last two, only matches of their least length can be found: a shorter one never hides a longer.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}")
KINDS, LEAST_VALUE, LEAST_HEX = ("assign", "access", "hex", "crf"), 6, 24
#: What any match of ASSIGN holds, in lower case.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Documents to learn from, with base spans and drawn from all; windows around spans and elsewhere taken from each; tokens of a window.
MOST, AROUND, ELSEWHERE, WINDOW = 1500, 3, 2, 24
#: Letters and digits that make a word unclear if no pattern finds it.
LONG, DIGIT, LETTER = 16, re.compile("[0-9]"), re.compile("[A-Za-z]")
#: What the secrets of disguised windows are made of.
ALPHABETS = (string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "_-", string.ascii_letters + string.digits + "+/", "0123456789ABCDEF")
#: Passes over the windows, windows of a step, rate of the descent, shares of windows whose neighbouring words, and whose whole neighbourhood, are hidden; log-odds of what can't be.
PASSES, STEP, RATE, HIDDEN, NEVER = 8, 64, 0.5, (0.9, 0.7), -50.0
#: Log-odds that a span must have beyond the best tagging without it, and code points that it must have.
MARGIN, LEAST_ADDED = 0.5, 8
#: Tokens of a block of the vectorised Viterbi search, bytes of texts that are tagged at once.
BLOCK, PIECE = 64, 1 << 18
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

_byte = np.arange(256)
_LOWER, _UPPER, _DIGIT, _HIGH = (_byte >= 97) & (_byte <= 122), (_byte >= 65) & (_byte <= 90), (_byte >= 48) & (_byte <= 57), _byte >= 128
_WORD = _LOWER | _UPPER | _DIGIT | _HIGH | (_byte == 95)
#: 0 for blanks and control bytes, 1 for what words are made of, else the mark itself.
_KIND = np.where(_WORD, 1, np.where((_byte <= 32) | (_byte == 127), 0, _byte)).astype(np.uint8)
_VOWEL, _HEX = np.isin(_byte, list(b"aeiouyAEIOUY")), _DIGIT | np.isin(_byte, list(b"abcdefABCDEF"))
#: Counts of several kinds of bytes are fields of nine bits in one running sum; differences of sums are right for tokens of up to LOOKED_AT bytes.
_FIELDS = (_DIGIT, _LOWER, _UPPER, _HIGH, _VOWEL, _HEX)
LOOKED_AT = 511
_PACKED = sum(kind.astype(np.uint64) << np.uint64(9 * k) for k, kind in enumerate(_FIELDS))
_TURN = np.uint64(1 << 9 * len(_FIELDS))
#: Letter case or digit: a switch between them within a word is a mark of random strings.
_SORT = np.where(_DIGIT, 1, np.where(_UPPER, 2, np.where(_LOWER | _HIGH, 3, 0))).astype(np.uint8)
_LENGTHS = np.searchsorted([2, 3, 4, 5, 6, 7, 8, 9, 11, 13, 16, 20, 24, 32, 40, 64], np.arange(LOOKED_AT + 1), "right").astype(np.int32)
_L, _M, _H = int(_LENGTHS[-1]) + 1, 32, 1 << 12
_HEADS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Values of each feature; _NEAR are those of the neighbourhood, words first.
SIZES = {
    "bias": 1, "shape": _M * _L, "digits": 40 * _L, "hex": 2 * _L, "vowels": 8 * _L, "word": _H, "word_1": _H, "word_2": _H, "word_3": _H, "word_next": _H,
    "shape_1": _M * _L + 1, "shape_next": _M * _L + 1, "gap": 4 * _M, "file": 32 * _M,
}
FIRST = dict(zip(SIZES, np.cumsum([0, *SIZES.values()])[:-1].tolist(), strict=True))
TOTAL = sum(SIZES.values())
_NEAR = np.array([list(SIZES).index(f) for f in ("word_1", "word_2", "word_3", "word_next", "shape_1", "shape_next", "gap")])


class Tokens:
    """Tokens of some texts (runs of letters, digits, _ and all beyond ASCII; runs of one other mark): where they begin and end in the joined bytes, which text they are of, and a code for each feature."""

    def __init__(self, texts: Sequence[str | None]):
        data, starts = joined_bytes(list(texts))
        self.data, self.starts = data, starts
        kind = _KIND[data]
        self.same = kind[1:] == kind[:-1]
        cut = np.concatenate([[0], np.flatnonzero(~self.same) + 1, [len(kind)]])
        own = np.flatnonzero(kind[cut[:-1]] > 0) if len(kind) else np.zeros(0, np.int64)
        self.begin, self.end = cut[own], cut[own + 1]
        self.is_word = kind[self.begin] == 1
        self.of = np.repeat(np.arange(len(starts) - 1), np.diff(np.searchsorted(self.begin, starts)))
        self.is_first = np.diff(self.of, prepend=-1) != 0

    def codes(self) -> np.ndarray:
        """A row of codes for each feature, a column for each token. Of longer tokens the first LOOKED_AT bytes count."""
        data, begin, n = self.data, self.begin, len(self.begin)
        out = np.zeros((len(SIZES), n), np.int32)
        if not n:
            return out
        end = np.minimum(self.end, begin + LOOKED_AT)
        size = (end - begin).astype(np.int32)
        length = _LENGTHS[size]
        each = _PACKED[data]
        sort = _SORT[data]
        each[1:] += (self.same & (sort[1:] != sort[:-1])) * _TURN
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(each, out=total[1:])
        packed = total[end] - total[begin]
        digits, lower, upper, high, vowels, hexes, turns = (((packed >> np.uint64(9 * k)) & np.uint64(511)).astype(np.int32) for k in range(len(_FIELDS) + 1))
        mask = (lower > 0) + 2 * (upper > 0) + 4 * (digits > 0) + 8 * (high > 0) + 16 * (~self.is_word).astype(np.int32)
        shape = mask * np.int32(_L) + length
        # a word by its first eight bytes, A-Z lowered, and its length
        low = np.concatenate([data + ((data >= 65) & (data <= 90)) * np.uint8(32), np.zeros(8, np.uint8)])
        head = np.ndarray(len(data) + 1, "<u8", low, strides=(1,))[begin] & _HEADS[np.minimum(size, 8)]
        head = (head + size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        word = (1 + ((head >> np.uint64(32)) * np.uint64(_H - 1) >> np.uint64(32))).astype(np.int32)
        gap = np.ones(n, bool)
        gap[1:] = self.end[:-1] < begin[1:]
        # the byte before a token that begins a line is the newline
        line = data[np.maximum(begin, 1) - 1] == 10
        line[begin == 0] = True
        texts = len(self.starts) - 1
        tokens = np.maximum(np.bincount(self.of, minlength=texts), 1)
        marks, digit = np.bincount(self.of[~self.is_word], minlength=texts) / tokens, np.bincount(self.of[digits > 0], minlength=texts) / tokens
        of_file = (np.minimum(16 * marks, 7).astype(np.int32) * 4 + np.minimum(16 * digit, 3).astype(np.int32)) * _M

        def moved(row: int, values: np.ndarray, by: int) -> None:
            """Each token's neighbour's value; nothing where the neighbour is of another text."""
            if n > abs(by):
                a, b = (slice(by, None), slice(None, -by)) if by > 0 else (slice(None, by), slice(-by, None))
                np.multiply(values[b], self.of[a] == self.of[b], out=out[row, a])

        rows = {f: k for k, f in enumerate(SIZES)}
        out[rows["shape"]] = shape
        out[rows["digits"]] = ((4 * digits // size) * 8 + np.minimum(turns, 7)) * _L + length
        out[rows["hex"]] = (hexes == size) * np.int32(_L) + length
        out[rows["vowels"]] = (6 * vowels // np.maximum(lower + upper, 1)) * _L + length
        out[rows["word"]] = np.where((size <= 12) & (digits == 0), word, 0)
        for k in (1, 2, 3):
            moved(rows[f"word_{k}"], word, k)
        moved(rows["word_next"], word, -1)
        moved(rows["shape_1"], shape + 1, 1)
        moved(rows["shape_next"], shape + 1, -1)
        out[rows["gap"]] = (2 * gap + line) * _M + mask
        out[rows["file"]] = of_file[self.of] + mask
        return np.add(out, np.array(list(FIRST.values()), np.int32)[:, None], out=out)

    def with_long_words(self) -> np.ndarray:
        """Which texts have a word that is long enough to hold a match of HEX."""
        found = np.zeros(len(self.starts) - 1, bool)
        found[self.of[self.is_word & (self.end - self.begin >= LEAST_HEX)]] = True
        return found


def base_spans(text: str, may_have_hex: bool = True) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in code points, by start and then kind; the kind as a place in KINDS."""
    low = text.lower()
    found = []
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    if may_have_hex:
        found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def viterbi(emit: np.ndarray, is_first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best states of chains that lie one after the other; the first token of each comes after OUTSIDE.

    The search is a scan with max-plus products of 3 x 3 matrices: blocks of tokens are multiplied side by side, the vectors that enter
    the blocks follow one by one, and the blocks are then gone through side by side again, forward and back.
    """
    n = len(emit)
    if not n:
        return np.zeros(0, np.int8)
    blocks = -(-n // BLOCK)
    step = np.full((blocks * BLOCK, 3, 3), -np.inf)
    step[:, [0, 1, 2], [0, 1, 2]] = 0.0
    step[:n] = np.where(is_first[:, None, None], trans[OUTSIDE][None, None, :], trans[None]) + emit[:, None, :]
    step = step.reshape(blocks, BLOCK, 3, 3)
    product = step[:, 0]
    for k in range(1, BLOCK):
        product = (product[:, :, :, None] + step[:, k][:, None]).max(axis=2)
    enter, at = np.zeros((blocks, 3)), [0.0, -np.inf, -np.inf]
    for b, m in enumerate(product.tolist()):
        enter[b] = at
        at = [max(at[0] + m[0][j], at[1] + m[1][j], at[2] + m[2][j]) for j in range(3)]
        top = max(at)
        at = [v - top for v in at]
    back = np.zeros((BLOCK, blocks, 3), np.int8)
    whole = np.tile(np.arange(3, dtype=np.int8), (blocks, 1))
    for k in range(BLOCK):
        paths = enter[:, :, None] + step[:, k]
        back[k] = paths.argmax(axis=1)
        enter = paths.max(axis=1)
        # from which state that entered the block each state is reached
        whole = np.take_along_axis(whole, back[k].astype(np.int64), axis=1)
    last, state = np.zeros(blocks, np.int64), int(np.argmax(at))
    for b, origin in zip(range(blocks - 1, -1, -1), whole[::-1].tolist(), strict=True):
        last[b] = state
        state = origin[state]
    states = np.zeros((blocks, BLOCK), np.int8)
    rows = np.arange(blocks)
    for k in range(BLOCK - 1, -1, -1):
        states[:, k] = last
        last = back[k, rows, last].astype(np.int64)
    return states.reshape(-1)[:n]


def decoded(emit: np.ndarray, is_first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The same states as viterbi(), which only sees the tokens where it matters. emit[:, OUTSIDE] is 0.

    Where a token's emissions are so low that OUTSIDE would beat any other state whatever states lie before and after it, the best path goes through OUTSIDE, and the
    chain falls apart there.
    """
    around = trans[:, OUTSIDE, None] + trans[None, OUTSIDE, :]
    gain = [max((trans[:, s, None] + trans[None, s, :] - around).max(), (trans[:, s] - trans[:, OUTSIDE]).max()) for s in (BEGIN, INSIDE)]
    open_ = (emit[:, BEGIN] + gain[0] >= 0) | (emit[:, INSIDE] + gain[1] >= 0)
    after = np.zeros(len(open_), bool)
    after[1:] = open_[:-1] & ~open_[1:] & ~is_first[1:]
    kept = np.flatnonzero(open_ | after)
    states = np.zeros(len(emit), np.int8)
    own = emit[kept]
    own[after[kept], 1:] = -np.inf
    states[kept] = viterbi(own, is_first[kept] | (np.diff(kept, prepend=-2) > 1) | np.concatenate([[True], after[kept][:-1]])[: len(kept)], trans)
    return states


def _emissions(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    # both states' weights are fetched as one complex number
    both = (weights[:, 0] + 1j * weights[:, 1]).astype(np.complex64)
    total = np.zeros(codes.shape[1], np.complex64)
    for row in codes:
        total += both[row]
    return np.stack([np.zeros(len(total)), total.real, total.imag], axis=1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def gradient(codes: np.ndarray, states: np.ndarray, size: np.ndarray, weights: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The negative log-likelihood of windows' states (windows x tokens; size tokens of each count) and its gradients, by the forward-backward recursion. codes: windows x tokens x features."""
    n, width = states.shape
    emit = np.zeros((n, width, 3))
    emit[:, :, 1:] = weights[codes].sum(axis=2)
    live = np.arange(width)[None, :] < size[:, None]
    ahead, behind = np.zeros((n, width, 3)), np.zeros((n, width, 3))
    ahead[:, 0] = trans[OUTSIDE] + emit[:, 0]
    for t in range(1, width):
        moved = _log_sum(ahead[:, t - 1, :, None] + trans[None], 1) + emit[:, t]
        ahead[:, t] = np.where(live[:, t, None], moved, ahead[:, t - 1])
    for t in range(width - 2, -1, -1):
        moved = _log_sum(trans[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(live[:, t + 1, None], moved, 0.0)
    total = _log_sum(ahead[:, -1], 1)
    share = np.exp(ahead + behind - total[:, None, None]) * live[:, :, None]
    rows = np.arange(n)
    seen = np.zeros((n, width, 3))
    seen[rows[:, None], np.arange(width)[None, :], states] = live
    before = np.concatenate([np.zeros((n, 1), np.int64), states[:, :-1]], axis=1)
    truth = (trans[before, states] * live).sum() + (emit * seen).sum()
    off = (share - seen)[:, :, 1:]
    by_weight = np.stack([np.bincount(codes.reshape(-1), np.repeat(off[:, :, j].reshape(-1), codes.shape[2]), len(weights)) for j in range(2)], axis=1)
    by_trans = np.zeros((3, 3))
    by_trans[OUTSIDE] += (share[:, 0] - seen[:, 0]).sum(axis=0)
    for t in range(1, width):
        pairs = np.exp(ahead[:, t - 1, :, None] + trans[None] + (emit[:, t] + behind[:, t])[:, None, :] - total[:, None, None]) * live[:, t, None, None]
        by_trans += pairs.sum(axis=0)
        np.subtract.at(by_trans, (states[live[:, t], t - 1], states[live[:, t], t]), 1.0)
    return float(total.sum() - truth), by_weight, by_trans


def fit(codes: np.ndarray, states: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features for BEGIN and INSIDE, and of transitions, by AdaGrad.

    In some windows of each step the neighbouring words are hidden, and in some the whole neighbourhood, so that shapes alone must tell. A token after a blank is never INSIDE.
    """
    weights, trans = np.zeros((TOTAL, 2)), np.zeros((3, 3))
    weights[FIRST["bias"]] = -4.0
    weights[FIRST["gap"] + 2 * _M : FIRST["gap"] + 4 * _M, INSIDE - 1] = NEVER
    square_w, square_t = np.full((TOTAL, 2), 1e-3), np.full((3, 3), 1e-3)
    none = np.array(list(FIRST.values()))[_NEAR]
    draw = np.random.default_rng(12)
    for _ in range(PASSES):
        order = draw.permutation(len(states))
        for lo in range(0, len(order), STEP):
            at = order[lo : lo + STEP]
            own = codes[at]
            dice = draw.random(len(at))
            for hidden, some in ((_NEAR[:4], dice < HIDDEN[0]), (_NEAR, dice < HIDDEN[1])):
                own[np.flatnonzero(some)[:, None, None], np.arange(own.shape[1])[None, :, None], hidden[None, None, :]] = none[: len(hidden)]
            _, gw, gt = gradient(own, states[at], size[at], weights, trans)
            gw, gt = gw / len(at), gt / len(at)
            square_w += gw**2
            square_t += gt**2
            weights -= RATE * gw / np.sqrt(square_w)
            trans -= RATE * gt / np.sqrt(square_t)
    return weights, trans


def _offsets(data: np.ndarray) -> np.ndarray:
    """Code points before each byte of a text, and before its end."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def _found(batches):
    """Rows whose texts have base spans."""
    for batch in batches:
        rows, texts = batch.column("row"), batch.column("text")
        has = []
        for lo, hi in pieces(texts, PIECE):
            own = texts.slice(lo, hi - lo).to_pylist()
            has += [bool(t and base_spans(t)) for t in own]
        yield pa.RecordBatch.from_arrays([rows.filter(pa.array(has, pa.bool_()))], ["row"])


def values(text: str) -> list[tuple[int, int]]:
    """What base spans hold as secrets, in code points: the values of assignments and whole keys, joined where they overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((value, end) for _, _, end, value in base_spans(text)):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def disguised(text: str, found: list[tuple[int, int]], row: int) -> tuple[str, list[tuple[int, int]]]:
    """The text with each secret replaced by a random string of another alphabet and length, and where these are: one corpus knows few forms of secrets."""
    draw, out, places, at, size = random.Random(row), [], [], 0, 0
    for start, end in found:
        secret = "".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(16, 48)))
        if draw.random() < 0.4:
            secret = "".join(draw.choices(string.ascii_lowercase, k=draw.randint(2, 4))) + draw.choice("_-") + secret
        out += [text[at:start], secret]
        size += start - at
        places.append((size, size + len(secret)))
        size, at = size + len(secret), end
    return "".join([*out, text[at:]]), places


def tagged(text: str, found: list[tuple[int, int]], row: int) -> list[tuple[int, bytes, bytes]]:
    """Windows of a text's tokens as (place, codes, states): around secrets, around the longest words elsewhere, and at places set by a hash.

    A long word of letters and digits that no pattern finds may be a secret or not: it teaches nothing, and windows that hold one are left out.
    """
    tokens = Tokens([text])
    n = len(tokens.begin)
    if not n:
        return []
    codes, at = tokens.codes(), _offsets(tokens.data)
    begin, end = at[tokens.begin], at[tokens.end]
    states, edges = np.zeros(n, np.int8), []
    for start, stop in found:
        inside = np.flatnonzero((begin < stop) & (end > start))
        states[inside] = INSIDE
        states[inside[:1]] = BEGIN
        edges += inside[:1].tolist()
    spread = mixed(np.arange(n, dtype=np.uint64) + np.uint64(row * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    calm = np.flatnonzero(states == OUTSIDE)
    words = calm[tokens.is_word[calm]]
    mixes = np.zeros(n, bool)
    long = words[(end - begin)[words] >= LONG]
    mixes[long] = [bool(DIGIT.search(w) and LETTER.search(w)) for w in (text[a:b] for a, b in zip(begin[long], end[long], strict=True))]
    words = words[~mixes[words]]
    unclear = np.concatenate([[0], np.cumsum(mixes)])
    centres = [edges[i] for i in sorted(set(np.linspace(0, len(edges) - 1, min(AROUND, len(edges))).astype(int).tolist()))]
    centres += words[np.argsort(-(end - begin)[words], kind="stable")][:ELSEWHERE].tolist()
    centres += calm[np.argsort(spread[calm])][:ELSEWHERE].tolist()
    lows = sorted({max(0, min(c - WINDOW // 2, n - WINDOW)) for c in centres})
    return [(int(spread[lo] >> np.uint64(1)), codes[:, lo : lo + WINDOW].T.tobytes(), states[lo : lo + WINDOW].tobytes()) for lo in lows if unclear[min(lo + WINDOW, n)] == unclear[lo]]


def _windows(batches):
    """Windows of the drawn documents, and of those with secrets once more with these disguised."""
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = values(text or "")
            out = tagged(text or "", found, row)
            if found:
                out += tagged(*disguised(text, found, row), row + 1)
            yield pa.RecordBatch.from_arrays([pa.array([w[k] for w in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["place", "codes", "states"])


def _learner(folder: str):
    """Learns in one task from the stored windows; gives the weights, those of transitions under negative numbers."""

    def learn(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            system, base = shards.opened(folder)
            held = []
            for name, _ in shards.sizes(folder, ".parquet"):
                with system.open_input_file(f"{base}/{name}") as file:
                    held += [(r["place"], r["codes"], r["states"]) for r in pq.read_table(file).to_pylist()]
            held.sort()
            if not any(any(s) for _, _, s in held):
                continue
            codes, states = np.zeros((len(held), WINDOW, len(SIZES)), np.int32), np.zeros((len(held), WINDOW), np.int64)
            size = np.array([len(s) for _, _, s in held])
            for i, (_, c, s) in enumerate(held):
                codes[i, : len(s)], states[i, : len(s)] = np.frombuffer(c, np.int32).reshape(-1, len(SIZES)), np.frombuffer(s, np.int8)
            weights, trans = fit(codes, states, size)
            some = np.flatnonzero(weights.any(axis=1))
            at = np.concatenate([some, [-1, -2, -3]])
            values = np.concatenate([np.concatenate([weights[some], np.zeros((len(some), 1))], axis=1), trans])
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(values[:, j]) for j in range(3))], ["at", "a", "b", "c"])

    return learn


def secret_model(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray] | None:
    """Weights of features and transitions, learned from windows of at most about 1500 documents with base spans and 1500 of all, drawn by hash of the row; None without any base span."""
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession, "secret-windows")
    own = numbered(docs.select(F.col(text).alias("text")), "row")
    hits = settled(own.mapInArrow(_found, "row long"))
    total, found = docs.count(), hits.count()
    if not found:
        return None
    chosen = hits.where(drawn(min(1.0, MOST / found), F.col("row"), 12)).withColumn("hit", F.lit(True))
    sample = own.join(F.broadcast(chosen), "row", "left").where(F.col("hit") | drawn(min(1.0, MOST / total), F.col("row"), 13))
    sample.select("row", "text").mapInArrow(_windows, "place long, codes binary, states binary").write.parquet(folder)
    learned = spark.range(0, 1, 1, 1).mapInArrow(_learner(folder), "at long, a double, b double, c double").toArrow()
    at, values = np.asarray(learned.column("at")), np.stack([np.asarray(learned.column(c)) for c in "abc"], axis=1)
    if not len(at):
        return None
    weights = np.zeros((TOTAL, 2))
    weights[at[at >= 0]] = values[at >= 0, :2]
    return weights, values[np.argsort(-at)][-3:]


def _added(tokens: Tokens, model) -> dict[int, list[tuple[int, int]]]:
    """Spans in code points that the model finds in each text, by the text's place."""
    weights, trans = model
    emit = _emissions(tokens.codes(), weights)
    emit[:, BEGIN] -= MARGIN
    states = decoded(emit, tokens.is_first, trans)
    inside = np.flatnonzero(states)
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(inside):
        return out
    fresh = (states[inside] == BEGIN) | (np.diff(inside, prepend=-2) > 1) | tokens.is_first[inside]
    begin, end = inside[fresh], np.append(inside[np.flatnonzero(fresh)[1:] - 1], inside[-1])
    for i in np.unique(tokens.of[begin]).tolist():
        lo = tokens.starts[i]
        at = _offsets(tokens.data[lo : tokens.starts[i + 1]])
        own = tokens.of[begin] == i
        out[i] = [(int(at[a - lo]), int(at[b - lo])) for a, b in zip(tokens.begin[begin[own]], tokens.end[end[own]], strict=True)]
    return out


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanner(shared, kept: list[str]):
    def scan(batches):
        model = shared.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in pieces(texts, PIECE):
                own = texts.slice(lo, hi - lo).to_pylist()
                tokens = Tokens(own)
                long = tokens.with_long_words()
                added = _added(tokens, model) if model else {}
                spans = []
                for i, t in enumerate(own):
                    base = base_spans(t, bool(long[i])) if t else []
                    more = [(a, 3, b, a) for a, b in added.get(i, ()) if b - a >= LEAST_ADDED and all(b <= s or e <= a for s, _, e, _ in base)]
                    spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b, _ in sorted(base + more)])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(spans, SPAN), *(c.slice(lo, hi - lo) for c in batch.columns[2:])], ["doc_id", "spans", *kept])

    return scan


def secret_spans(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, spans (kind, start and end in code points, by start and then kind) and the columns named in keep, as kept_<name>.

    Kinds: assign (the whole assignment), access, hex, as the fixed patterns find them in whole texts; crf, what a conditional random field adds. It
    tags the tokens of a text as beginning, inside or outside of a secret by their shape, their neighbours and numbers about the whole text, learned in one task from windows around
    base spans, as they are and with other random strings in their places (secret_model). The weights, one for each feature, are broadcast, and each whole text is decoded in a map without a shuffle. What overlaps
    a base span is not added, nor what is shorter than LEAST_ADDED or less likely than MARGIN asks.

    Null and empty texts have no spans; where no row has a base span, nothing is learned or added. Repeated rows, with or without doc_id, are rows of their own, also in the sample.
    Long texts are one chain. An empty table gives no rows. Other columns are ignored but for those in keep.
    """
    shared = docs.sparkSession.sparkContext.broadcast(secret_model(docs, text))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), *carried(docs, keep))
    return rows.mapInArrow(_scanner(shared, [f"kept_{c}" for c in keep]), schema("doc_id long, spans array<struct<kind: string, start: long, end: long>>", rows, keep))

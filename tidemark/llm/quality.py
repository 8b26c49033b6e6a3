"""Quality: a positive-unlabelled classifier with the non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import numbered
from tidemark.llm.sampling import carried, drawn, labelled, remainder, schema
from tidemark.llm.textcore import Words, pieces

#: Trusted positives, and unlabelled documents, to learn from at most; steps and rate of the descent; weight of the squared weights.
MOST, STEPS, RATE, DECAY = 12_000, 600, 0.05, 1e-4
THRESHOLD = 0.7
_UPPER, _LOWER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_MARK[[*b"#$%&*|<>@^=_~`+/\\{}[]"]] = True
_COUNTED = (_UPPER, _LOWER, _DIGIT, _MARK)
_POINTS = b"!?.,:;-\n"
FEATURES = 4 + len(_POINTS) + 12


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def features(texts: list[str | None]) -> np.ndarray:
    """Numbers about each whole text: shares of kinds of characters, lengths and repetition of words and lines. Zeros for an empty text."""
    words = Words(texts)
    data, starts, first = words.data, words.starts, words.first
    chars = np.maximum(np.diff(starts) - 1.0, 1)
    n = words.counts()
    some = np.maximum(n, 1.0)
    out = [_per_text(kind[data], starts) / chars for kind in _COUNTED]
    # the newline that ends each text in the joined bytes is none of its own
    out += [(_per_text(data == p, starts) - (p == 10)) / some for p in _POINTS]
    length = (words.end - words.begin).astype(np.float64)
    out += [np.log1p(n), _per_text(length, first) / some / 10, np.sqrt(np.maximum(_per_text(length**2, first) / some - (_per_text(length, first) / some) ** 2, 0)) / 10]
    head, last = data[words.begin], data[words.end - 1]
    out += [_per_text(_UPPER[head], first) / some, _per_text(_MARK[last], first) / some, _per_text(length == 1, first) / some, _per_text((_UPPER[head] & _UPPER[data[np.minimum(words.begin + 1, words.end - 1)]]), first) / some]
    of = np.repeat(np.arange(len(n)), n)
    for gap in (1, 2):
        again = np.zeros(len(of))
        if len(of) > gap:
            again[gap:] = (words.hash[gap:] == words.hash[:-gap]) & (of[gap:] == of[:-gap])
        out.append(_per_text(again, first) / some)
    order = np.lexsort((words.hash, of))
    h, o = words.hash[order], of[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    kinds = np.bincount(o[fresh], minlength=len(n)) if len(h) else np.zeros(len(n))
    runs = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    most = np.zeros(len(n))
    np.maximum.at(most, o[fresh], runs)
    out += [kinds / some, np.log1p(n) * kinds / some / 10, most / some]
    return np.where((n > 0)[:, None], np.stack(out, axis=1), 0).astype(np.float32)


def _expanded(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Each number scaled by what is usual, and how far it is out of the usual range on either side, with an intercept."""
    z = (x - (low + high) / 2) / (high - low)
    return np.concatenate([np.clip(z, -3, 3), np.log1p(np.maximum(z - 0.5, 0)), np.log1p(np.maximum(-z - 0.5, 0)), np.ones((len(x), 1))], axis=1)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaling and weights that minimise prior * E_p[loss(g)] + max(0, E_u[loss(-g)] - prior * E_p[loss(-g)]) with the logistic loss.

    Where the second part is below zero, the step goes up it instead of down, as in the non-negative estimator.
    """
    low, high = np.quantile(positive, [0.02, 0.98], axis=0)
    high = np.maximum(high, low + 1e-3)
    p, u = _expanded(positive, low, high), _expanded(unlabelled, low, high)
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -35, 35)))
    for step in range(1, STEPS + 1):
        gp, gu = sigmoid(p @ w), sigmoid(u @ w)
        toward = -(p * (1 - gp)[:, None]).mean(axis=0) * prior
        against = (u * gu[:, None]).mean(axis=0) - prior * (p * gp[:, None]).mean(axis=0)
        risk = -np.log1p(-gu + 1e-12).mean() + prior * np.log1p(-gp + 1e-12).mean()
        gradient = (toward + against if risk >= 0 else -against) + DECAY * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return low, high, w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows, from these two samples alone: the least ratio, over thresholds with a fifth of the positives above, of the unlabelled share above to the positive one, by the score of a plain positive-against-unlabelled fit."""
    low, high, w = fit(positive, unlabelled, 0.5)
    p, u = (np.sort(_expanded(x, low, high) @ w)[::-1] for x in (positive, unlabelled))
    above = np.arange(max(1, len(p) // 5), len(p) + 1)
    share = np.searchsorted(-u, -p[above - 1], "right") / len(u)
    return float(np.min(share / (above / len(p))))


def _rows(batches):
    for batch in batches:
        texts = batch.column("text")
        for lo, hi in pieces(texts):
            x = features(texts.slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], ["x"])


def _sample(rows: DataFrame) -> np.ndarray:
    found = sorted(r["x"] for r in rows.select("text").mapInArrow(_rows, "x binary").collect())
    return np.frombuffer(b"".join(found), np.float32).reshape(-1, FEATURES).astype(np.float64)


def _scorer(model, kept: list[str]):
    def score(batches):
        for batch in batches:
            ids, texts, out = batch.column(0), batch.column(1), batch.column(2)
            for lo, hi in pieces(texts):
                part = texts.slice(lo, hi - lo)
                low, high, w = model.value
                p = 1 / (1 + np.exp(-np.clip(_expanded(features(part.to_pylist()), low, high) @ w, -35, 35)))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), out.slice(lo, hi - lo), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), *(c.slice(lo, hi - lo) for c in batch.columns[3:])], ["doc_id", "held_out", "score", "predicted", *kept])

    return score


def quality_model(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaling and weights, learned from at most about 12,000 trusted positives (learning rows that are labelled 1) and as many unlabelled documents.

    Labels of 0 are not looked at: the class prior is estimated_prior(), from positives and unlabelled documents alone. Both are drawn by a hash of the
    row, unlabelled ones from the whole table, so that rows that share a doc_id are drawn each for itself.
    """
    positives, _ = labelled(docs, labels.where(f"{label} = 1"), label, MOST, 4, text)
    own = numbered(docs.select(F.col(text).alias("text")), "row")
    unlabelled = own.where(drawn(min(1.0, MOST / max(docs.count(), 1)), F.col("row"), 5))
    p, u = _sample(positives), _sample(unlabelled)
    if not len(p) or not len(u):
        return np.zeros(FEATURES), np.ones(FEATURES), np.append(np.zeros(3 * FEATURES), 35.0 if len(p) else 0.0)
    return fit(p, u, min(max(estimated_prior(p, u), 0.01), 0.99))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (score >= 0.7) and the columns named in keep, as kept_<name>.

    A bounded sample's feature rows go to the driver (quality_model); some hundred weights come back, and all whole
    texts are scored in a map without a shuffle. Null and empty texts have features of zero and the score that
    these get. Without positive labels every score is 0.5. Repeated rows get a row each. Texts of any length count whole. An empty table gives no rows.
    Other columns of docs are ignored but for those in keep.
    """
    model = docs.sparkSession.sparkContext.broadcast(quality_model(docs, labels, label, text))
    held_out = remainder(F.col("doc_id"), 4) == 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"), *carried(docs, keep))
    return rows.mapInArrow(_scorer(model, [f"kept_{c}" for c in keep]), schema("doc_id long, held_out boolean, score double, predicted int", rows, keep))

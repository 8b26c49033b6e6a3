"""Language: blended-spectrum string kernels with Nyström landmarks and one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import numbered
from tidemark.llm.sampling import carried, drawn, remainder, schema
from tidemark.llm.textcore import pieces

#: Documents to learn from at most, landmarks among them, languages (the most frequent ones), strength of the ridge, steepness of the score.
MOST, LANDMARKS, CLASSES, RIDGE, STEEP = 6000, 256, 256, 1e-2, 4.0
#: Cells of the matrix of texts and landmark grams that is multiplied at once.
CELLS = 1 << 22
#: Letters are numbers below 64: a-z by themselves, all others spread over the rest; 0 is what is no letter.
_BITS = 6
_FIRST = np.array([0, 1 << _BITS, (1 << _BITS) + (1 << 2 * _BITS)])
GRAMS = int(_FIRST[2]) + (1 << 3 * _BITS)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        code = np.arange(0x110000)
        is_letter = np.fromiter((chr(c).isalpha() for c in code), bool, len(code))
        number = 27 + (code * 2654435761 >> 7) % 37
        number[97:123] = np.arange(1, 27)
        _letters = np.where(is_letter, number, 0).astype(np.uint8)
    return _letters


def grams(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The distinct runs of one to three letters (a gap counts as a letter, but not alone) of a whole text. seen: GRAMS zeros, left as they were."""
    if not text:
        return np.zeros(0, np.int32)
    x = _letter_table()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)].astype(np.int32)
    seen[x] = True
    pairs = (x[:-1] << _BITS) | x[1:]
    seen[pairs + _FIRST[1]] = True
    seen[((pairs[:-1] << _BITS) | x[2:]) + _FIRST[2]] = True
    seen[_FIRST] = False
    found = np.flatnonzero(seen).astype(np.int32)
    seen[found] = False
    return found


def _rows(batches):
    seen = np.zeros(GRAMS, bool)
    for batch in batches:
        own = [grams(t, seen).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("lang"), pa.array(own, pa.binary())], ["row", "lang", "grams"])


def fit(examples: list[tuple[np.ndarray, str]], classes: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The landmarks' distinct grams, and a weight for each of them and each class.

    kernel(x, y) = common grams / sqrt(grams of x * grams of y). With landmarks L and K = kernel(L, L), documents
    become kernel(x, L) K^-1/2, on which ridge regression separates each class from the rest. As the kernel
    counts common grams, all of it folds into one weight for each gram, applied to presence / sqrt(grams of x).
    """
    share = max(1, LANDMARKS // len(classes))
    marks = [g for c in classes for g in [g for g, y in examples if y == c][:share]]
    known = np.unique(np.concatenate(marks))
    position = np.full(GRAMS, -1, np.int32)
    position[known] = np.arange(len(known))

    def present(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(known)), np.float32)
        for i, g in enumerate(rows):
            at = position[g]
            out[i, at[at >= 0]] = 1 / np.sqrt(len(g))
        return out

    landmark = present(marks)
    values, axes = np.linalg.eigh((landmark @ landmark.T).astype(np.float64))
    good = values > 1e-8 * values[-1]
    root = axes[:, good] / np.sqrt(values[good])
    to_axes = (landmark.T @ root).astype(np.float32)
    gram, right = np.zeros((good.sum(), good.sum())), np.zeros((good.sum(), len(classes)))
    for lo in range(0, len(examples), 256):
        part = examples[lo : lo + 256]
        x = (present([g for g, _ in part]) @ to_axes).astype(np.float64)
        y = np.array([[1.0 if c == own else -1.0 for c in classes] for _, own in part])
        gram += x.T @ x
        right += x.T @ y
    beta = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), right)
    return known, (to_axes @ beta).astype(np.float32)


def _scorer(model, classes: list[str], kept: list[str]):
    def score(batches):
        known, weights = model.value
        seen, position = np.zeros(GRAMS, bool), np.full(GRAMS, -1, np.int32)
        position[known] = np.arange(len(known))
        names = np.array([*classes, "und"], dtype=object)
        rows = max(1, CELLS // max(len(known), 1))
        for batch in batches:
            ids, texts, out = batch.column(0), batch.column(1), batch.column(2)
            for lo, hi in ((a, min(a + rows, b)) for first, b in pieces(texts, 1 << 18) for a in range(first, b, rows)):
                n = hi - lo
                presence, some = np.zeros((n, len(known)), np.float32), np.zeros(n, bool)
                for i, t in enumerate(texts.slice(lo, n).to_pylist()):
                    g = grams(t, seen)
                    some[i] = len(g) > 0
                    at = position[g]
                    presence[i, at[at >= 0]] = 1 / np.sqrt(max(len(g), 1))
                margins = np.full((n, 2), -1.0)
                values = presence @ weights
                best = values.argmax(axis=1)
                margins[:, : values.shape[1]] = -np.sort(-values, axis=1)[:, :2]
                p = 1 / (1 + np.exp(-STEEP * np.clip(margins[:, 0] - margins[:, 1], 0, 9)))
                best[~some], p[~some] = len(classes), 0.0
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n), out.slice(lo, n), pa.array(names[best].tolist(), pa.string()), pa.array(p.astype(np.float64)), *(c.slice(lo, n) for c in batch.columns[3:])], ["doc_id", "held_out", "lang_pred", "score", *kept])

    return score


def language_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[tuple[np.ndarray, np.ndarray], list[str]]:
    """Grams, weights and classes, learned from at most about 6000 documents, as many of each of the 256 most frequent languages as there are, drawn by a hash of the row among rows with lang and crc32(doc_id) mod 5 != 0.

    Rows that share a doc_id are drawn each for itself, so the bound holds whatever the ids are.
    """
    own = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")), "row")
    usable = own.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(CLASSES).collect()
    if not counts:
        return (np.zeros(0, np.int32), np.zeros((0, 1), np.float32)), []
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, MOST / len(counts) / r["n"]))])
    rows = usable.where(drawn(F.coalesce(share[F.col("lang")], F.lit(-1.0)), F.col("row"), 6)).mapInArrow(_rows, "row long, lang string, grams binary").collect()
    rows.sort(key=lambda r: (r["row"] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, r["grams"]))
    examples = [(np.frombuffer(r["grams"], np.int32), r["lang"]) for r in rows if r["grams"]]
    classes = sorted({y for _, y in examples})
    if not classes:
        return (np.zeros(0, np.int32), np.zeros((0, 1), np.float32)), []
    return fit(examples, classes), classes


def languages(docs: DataFrame, text: str = "text", lang: str = "lang", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score (0 to 1, from the margin between the two best classes) and the columns named in keep, as kept_<name>.

    The bounded sample's sets of grams (each below the number of possible grams, whatever the text's length) go to the
    driver, which solves the regression; a weight for each landmark gram and class is broadcast. Whole texts are
    scored in batches by matrix products, in a map without a shuffle.

    Null texts and texts without a letter are `und` with score 0, and so is everything where nothing can be learned.
    Repeated rows get a row each. Texts of any length count whole. An empty table gives no rows. Other columns are ignored but for those in keep.
    """
    model, classes = language_model(docs, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held_out = remainder(F.col("doc_id"), 5) == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"), *carried(docs, keep))
    if not classes:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), *[f"kept_{c}" for c in keep])
    return rows.mapInArrow(_scorer(shared, classes, [f"kept_{c}" for c in keep]), schema("doc_id long, held_out boolean, lang_pred string, score double", rows, keep))

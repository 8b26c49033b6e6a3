"""What the classifiers see of a text, by plain Python, and whole queries from that on."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language, quality, queries, toxicity
from tidemark.llm.textcore import BASE

SMALL, MASK = "/root/testdata/sf0.001", (1 << 64) - 1
AWKWARD = [None, "", " \n", "a", "A b\tC", "Über-groß, straße! 漢字🙂 x1 ###", "word " * 50, "line one\nline one\nLINE", "\0\x0b", "ONE two Three FOUR5 six" * 3]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def scrambled(x):
    x &= MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def hashed(word):
    return scrambled(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(word)))


def plain_buckets(text):
    """Words, heads of five bytes of longer ones, and pairs of words one to three apart."""
    data = (text or "").encode()
    words, own = [], bytearray()
    for b in [*data, 32]:
        if b >= 128 or chr(b).isalnum():
            own.append(b + 32 if 65 <= b <= 90 else b)
        elif own:
            words.append(bytes(own))
            own = bytearray()
    h = [hashed(w) for w in words]
    out = [*h, *(hashed(w[:5]) ^ 77 for w in words if len(w) > 5)]
    for gap in (1, 2, 3):
        out += [scrambled(a * (2 * gap + 1) + b + gap) for a, b in zip(h, h[gap:], strict=False)]
    return Counter(x % (1 << 22) for x in out)


def test_toxicity_features(documents):
    texts = AWKWARD + [t for _, t, _ in documents[:40]]
    bucket, of = toxicity.features(texts)
    found = [Counter() for _ in texts]
    for b, i in zip(bucket.tolist(), of.tolist(), strict=True):
        found[i][b] += 1
    assert found == [plain_buckets(t) for t in texts]


def plain_numbers(text):
    """The numbers of quality.features(), one after the other."""
    data = (text or "").encode()
    words = [w for w in bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in data).split(b" ") if w]
    if not words:
        return [0.0] * quality.FEATURES
    marks, n, size = b"#$%&*|<>@^=_~`+/\\{}[]", len(words), max(len(data), 1)
    upper, lower, digit = (lambda b: 65 <= b <= 90), (lambda b: 97 <= b <= 122), (lambda b: 48 <= b <= 57)
    out = [sum(map(f, data)) / size for f in (upper, lower, digit, lambda b: b in marks)]
    out += [data.count(bytes([p])) / n for p in b"!?.,:;-\n"]
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    out += [math.log1p(n), mean / 10, math.sqrt(max(sum(x * x for x in lengths) / n - mean * mean, 0)) / 10]
    out += [sum(upper(w[0]) for w in words) / n, sum(w[-1] in marks for w in words) / n, lengths.count(1) / n, sum(upper(w[0]) and upper(w[min(1, len(w) - 1)]) for w in words) / n]
    low = [bytes(b + 32 if upper(b) else b for b in w) for w in words]
    out += [sum(a == b for a, b in zip(low, low[gap:], strict=False)) / n for gap in (1, 2)]
    kinds = Counter(low)
    return [*out, len(kinds) / n, math.log1p(n) * len(kinds) / n / 10, max(kinds.values()) / n]


def test_quality_features(documents):
    texts = AWKWARD + [t for _, t, _ in documents]
    assert np.allclose(quality.features(texts), [plain_numbers(t) for t in texts], atol=1e-5)


def test_quality_query_by_brute_force(spark, documents):
    """Positives and unlabelled rows by plain features, prior and weights from these, and every score."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = {i: np.array(plain_numbers(t), np.float32) for i, t, _ in documents}
    ordered = lambda some: np.array(sorted((x.tobytes(), x.tolist()) for x in some), dtype=object)
    learning = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    p, u = (np.array([x for _, x in ordered(some)], np.float64) for some in ([rows[i] for i in rows if labels.get(i) == 1 and learning(i)], rows.values()))
    low, high, w = quality.fit(p, u, min(max(quality.estimated_prior(p, u), 0.01), 0.99))
    for r in queries.op4_quality(spark, SMALL).collect():
        z = (rows[r.doc_id].astype(np.float64) - (low + high) / 2) / (high - low)
        wide = [*np.clip(z, -3, 3), *np.log1p(np.maximum(z - 0.5, 0)), *np.log1p(np.maximum(-z - 0.5, 0)), 1.0]
        score = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(np.dot(wide, w))))))
        assert abs(r.score - score) < 1e-3 and r.held_out == (not learning(r.doc_id))
        assert r.predicted == (r.score >= 0.7)


def plain_grams(text):
    """Distinct runs of one to three letters of the lowered text; what is no letter is a gap, and no run of its own."""
    low = (text or "").lower()
    code = [0 if not c.isalpha() else ord(c) - 96 if "a" <= c <= "z" else 27 + (ord(c) * 2654435761 >> 7) % 37 for c in low]
    first = (0, 64, 64 + 64 * 64)
    out = set()
    for n in (1, 2, 3):
        for i in range(len(code) - n + 1):
            own = code[i : i + n]
            if any(own):
                out.add(first[n - 1] + sum(c * 64 ** (n - 1 - k) for k, c in enumerate(own)))
    return out


def test_language_grams(documents):
    random.seed(1)
    seen = np.zeros(language.GRAMS, bool)
    for t in AWKWARD + [t for _, t, _ in documents[:60]] + ["Привет, мир", "مرحبا بالعالم", "İstanbul ΑΒΓ ß"]:
        assert set(language.grams(t, seen).tolist()) == plain_grams(t), t
        assert not seen.any()


def test_language_query_by_brute_force(spark, documents):
    """Learned from plain grams of the learning rows in the order of the draw; each text's best class and its score."""
    rows = []
    for k, (i, t, lang) in enumerate(documents):
        g = np.array(sorted(plain_grams(t)), np.int32)
        if lang is not None and zlib.crc32(str(i).encode()) % 5 and len(g):
            # the only file's number, and the row's place in it
            rows.append((((1 << 40) | k) * 0x9E3779B97F4A7C15 & MASK, g.tobytes(), g, lang))
    rows.sort(key=lambda r: r[:2])
    classes = sorted({r[3] for r in rows})
    known, weights = language.fit([(r[2], r[3]) for r in rows], classes)
    place = {int(g): j for j, g in enumerate(known)}
    text_of = {i: t for i, t, _ in documents}
    for r in queries.op6_language_id(spark, SMALL).collect():
        g = plain_grams(text_of[r.doc_id])
        if not g:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        values = sum((weights[place[x]].astype(np.float64) for x in g if x in place), np.zeros(len(classes))) / math.sqrt(len(g))
        best, second = np.sort(values)[::-1][:2]
        assert r.lang_pred == classes[int(values.argmax())] or best - second < 1e-4
        assert abs(r.score - 1 / (1 + math.exp(-language.STEEP * min(max(best - second, 0), 9)))) < 1e-3

"""Vector operators against brute force."""

import random

import numpy as np
import pytest
from conftest import as_rows

from tidemark.llm import queries
from tidemark.llm.graph import components
from tidemark.llm.vectors import Lists, near_duplicate_vectors, no_random_access, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, score double, key string"


@pytest.fixture(scope="module")
def awkward(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        v = rng.normal(size=6)
        rows.append((i, v.tolist(), i % 3))
        if i % 4 == 0:
            rows.append((1000 + i, (v + rng.normal(size=6) * 0.08).tolist(), i % 3 if i % 8 else None))
        if i % 10 == 0:
            rows.append((2000 + i, v.tolist(), i % 3))
            rows.append((3000 + i, (2 * v).tolist(), i % 3))
    rows += [(5000, None, 1), (5050, [float("nan")] * 6, 1), (5100, [float("inf")] + [0.0] * 5, 1), (5150, [0.0] * 6, 1), (5200, [None] + [1.0] * 5, 1), (5250, [], 1), (5300, [1.0, 2.0], 1), (5301, [1.0, 2.0], 1), (None, [1.0] * 6, 1)]
    return spark.createDataFrame([(*r, 3, 0.1, "k") for r in rows], SCHEMA)


def usable(df):
    return [r for r in df.collect() if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]


def test_near_duplicates(spark, awkward):
    for df in (awkward, spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")):
        rows, links, root = usable(df), {}, {}
        for r in rows:
            links[r.vec_id], root[r.vec_id] = 0, r.vec_id
        find = lambda i, root=root: i if root[i] == i else find(root[i], root)
        v = [np.array(r.embedding, np.float32).astype(np.float64) for r in rows]
        for i, a in enumerate(rows):
            for j in range(i):
                b = rows[j]
                if a.label is not None and a.label == b.label and len(v[i]) == len(v[j]) and v[i].any() and v[j].any() and v[i] @ v[j] / np.sqrt((v[i] @ v[i]) * (v[j] @ v[j])) >= 0.98:
                    links[a.vec_id] += 1
                    links[b.vec_id] += 1
                    x, y = find(a.vec_id), find(b.vec_id)
                    root[max(x, y)] = min(x, y)
        found = near_duplicate_vectors(df).collect()
        assert len(found) == df.count()
        for r in found:
            if r.vec_id is not None:
                c = find(r.vec_id) if r.vec_id in root else r.vec_id
                assert (r.n_links, r.component_id, r.kept) == (links.get(r.vec_id, 0), c, c == r.vec_id)
    assert near_duplicate_vectors(awkward.where("vec_id < -1")).count() == 0


def test_top_k(awkward):
    rows = usable(awkward)
    ints = {r.vec_id: np.floor(256 * np.array(r.embedding, np.float32).astype(np.float64)).astype(int) for r in rows}
    wanted = []
    for q in (i for i in ints if i % 50 == 0):
        scored = sorted((-int(ints[q] @ ints[c]), c) for c in ints if c != q and len(ints[c]) == len(ints[q]))[:5]
        wanted += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scored)]
    assert sorted(map(tuple, top_k(awkward).collect())) == sorted(wanted)
    assert top_k(awkward.where("vec_id < -1")).count() == 0


def test_top_k_of_ties_and_repeats(spark):
    rows = [(i, [1.0, 2.0], 0, 0, 0.0, "") for i in (0, 1, 1, 2, 3)]
    got = [(r.rank, r.vec_id) for r in top_k(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 1), (3, 2), (4, 3)]


def test_no_random_access_is_exact():
    rng = np.random.default_rng(3)
    for n in (1, 4, 5, 6, 700):
        c, q = rng.integers(-50, 50, (n, 8)).astype(float), rng.integers(-50, 50, (20, 8)).astype(float)
        at, rows, score, _ = no_random_access(Lists(c, np.arange(n)), q, np.arange(20) - 5, 5)
        for k in range(20):
            s = c @ q[k]
            best = [j for j in np.lexsort((np.arange(n), -s)) if j != k - 5][:5]
            assert rows[at == k].tolist() == best and score[at == k].tolist() == s[best].tolist()


def test_no_random_access_stops_early():
    """With a score to beat, or with candidates far above the rest, lists are read in part."""
    rng = np.random.default_rng(4)
    c, q = rng.integers(-50, 50, (4000, 8)).astype(float), rng.integers(-50, 50, (30, 8)).astype(float)
    c[:300] = q[np.arange(300) % 30] * 4
    lists, ids = Lists(c, np.arange(4000)), np.arange(30) + 10_000
    at, rows, score, read = no_random_access(lists, q, ids, 5)
    assert read < 30 * 8 * 4000 / 2
    best = np.sort(q @ c.T, axis=1)[:, -5:][:, ::-1]
    assert all(score[at == k].tolist() == best[k].tolist() for k in range(30))
    again = no_random_access(lists, q, ids, 5, best[:, 4])
    assert again[3] <= read and sorted(zip(*again[:3])) == sorted(zip(at, rows, score))
    assert len(no_random_access(lists, q, ids, 5, best[:, 0] + 1)[0]) == 0


def test_top_k_of_large_components(spark):
    """Products beyond doubles' and beyond 64-bit integers: exact order, scores within a long."""
    for big in (2.0**26, 2.0**60):
        rows = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0]), (3, [-big, 0.5]), (4, [1.0, 1.0])]
        got = [(r.vec_id, r.score) for r in top_k(spark.createDataFrame([(*r, 0, 0, 0.0, "") for r in rows], SCHEMA)).orderBy("rank").collect()]
        exact = sorted(((-(256 * int(big) * 256 * int(v[0]) + 256 * int(256 * v[1])), i) for i, v in rows[1:]))
        assert got == [(i, max(-(2**63), min(2**63 - 1, -s))) for s, i in exact]


def test_top_k_over_blocks(spark, monkeypatch):
    """Many blocks and tiles, clustered and not."""
    from tidemark.llm import vectors

    monkeypatch.setattr(vectors, "CANDIDATES", 64)
    monkeypatch.setattr(vectors, "TOGETHER", 3)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 8))
    v = np.concatenate([centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 8)) * 0.05, rng.normal(size=(300, 8))]).astype(np.float32)
    found = top_k(spark.createDataFrame([(i, x.tolist(), 0, 0, 0.0, "") for i, x in enumerate(v)], SCHEMA), every=7)
    ints = np.floor(256 * v.astype(np.float64)).astype(int)
    wanted = []
    for q in range(0, 1000, 7):
        scored = sorted((-int(s), c) for c, s in enumerate(ints @ ints[q]) if c != q)[:5]
        wanted += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scored)]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_near_duplicates_over_blocks(spark, monkeypatch):
    """Many blocks, whose boxes leave out most tiles; ids with several vectors."""
    from tidemark.llm import vectors

    monkeypatch.setattr(vectors, "BLOCK", 32)
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(40, 20))
    v = (centres[rng.integers(0, 40, 900)] + rng.normal(size=(900, 20)) * rng.choice([0.02, 0.12, 0.2], (900, 1))).astype(np.float32).astype(np.float64)
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    linked = (u @ u.T >= 0.98) & ~np.eye(900, dtype=bool)
    df = spark.createDataFrame([(i, x.tolist(), 0, 0, 0.0, "") for i, x in enumerate(v)], SCHEMA)
    root = list(range(900))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in zip(*np.nonzero(linked), strict=True):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df).collect()}
    assert got == {i: (int(linked[i].sum()), find(i)) for i in range(900)}
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (3, [0.0, 2.0]), (7, [4.0, 0.0]), (9, [1.0, 1.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_duplicate_vectors(spark.createDataFrame([(*r, 0, 0, 0.0, "") for r in rows], SCHEMA)).collect())
    assert got == [(3, 1, 3), (5, 1, 3), (5, 1, 3), (7, 1, 3), (9, 0, 9)]


def test_top_k_matches_sql(spark, duck):
    df = queries.op7_exact_top_k(spark, "/root/testdata/sf0.001")
    assert as_rows(df.select("query_id", "rank", "score", "vec_id").collect()) == as_rows(duck.sql(queries.SQL["op7_exact_top_k"]).project("query_id, rank, score, vec_id").fetchall())


def test_components(spark):
    random.seed(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(random.randrange(200, 400), random.randrange(200, 400)) for _ in range(150)] + [(7, 7), (None, 3)]
    root = {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_with_one_large_vector_among_many(spark, monkeypatch):
    """A component of 1e6 (and others beyond 64 bits) in one row: the others are searched by their lists as before, over several blocks, and all scores are right."""
    from tidemark.llm import vectors

    monkeypatch.setattr(vectors, "CANDIDATES", 64)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(600)]
    rows += [(1000, [1e6, 0.5, -3.0, 2.0, 1.0]), (1001, [1e6, -1e6, 0.0, 0.0, 7.0]), (1003, [-4e7, 1.0, 1.0, 1.0, 1.0]), (1050, [3e5, 3e5, 3e5, 3e5, 3e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    wanted = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in whole if c != q)[:5]
        wanted |= {(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored)}
    assert {tuple(r) for r in top_k(df).collect()} == wanted

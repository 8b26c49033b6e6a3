"""Vectors: near-duplicates by tiles in the order of principal components, and exact top-k search without random access."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.shards import ShardWriter, read_range
from tidemark.llm.store import fresh_folder, settled, shuffle_width

#: Vectors of a block; leading components that a tile multiplies first, and then at each next step.
BLOCK, LEAD = 1024, 8
#: Room for rounding in the bounds of rotated products; pairs within it are decided on the vectors as given.
SLACK = 1e-6
#: Principal axes that rows are sorted by, axes that a block's box is kept for, and lengths of vectors above which none are computed.
SORTED, BOXED, LONGEST = 4, 16, 2048
#: Numbers that are gathered at once where pairs are decided one by one.
AT_ONCE = 1 << 22


def finite(vector: str = "embedding"):
    """Whether a vector takes part: not null, not empty, and no component null, infinite or not a number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a list column whose lists are all of one length."""
    n = len(column)
    return np.asarray(column.flatten()).astype(dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in two steps, as squares of very large or small components leave the range; zero rows stay zero."""
    most = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(most > 0, most, 1)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _by_length(column: pa.Array):
    """Row numbers and matrix of the vectors of each length."""
    lengths = np.asarray(pc.list_value_length(column))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), at, _matrix(column.take(pa.array(at)))


# --- blocks of neighbouring vectors ------------------------------------------------------------


def _second_moments(dims: set[int]):
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, _, x in _by_length(batch.column(0)):
                if n in dims:
                    u = _unit(x)
                    total[n] = total.get(n, 0) + u.T @ u
        for n, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([x.ravel()], pa.list_(pa.float64()))], ["dim", "moment"])

    return run


def _axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """The principal axes of the unit vectors, strongest first, for each length of vectors (column dim) that fills a block and isn't over LONGEST: length x length numbers, however many rows. Other vectors stay as they are."""
    counted = rows.where(F.col("dim") <= LONGEST).groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") >= BLOCK)
    dims = {r["dim"] for r in counted.collect()}
    if not dims:
        return {}
    parts = rows.select("vector").mapInArrow(_second_moments(dims), "dim int, moment array<double>")
    summed = parts.select("dim", F.posexplode("moment").alias("i", "x")).groupBy("dim", "i").agg(F.sum("x").alias("x")).toArrow()
    dim, i, x = (np.asarray(summed.column(c)) for c in ("dim", "i", "x"))
    out = {}
    for n in dims:
        flat = np.zeros(n * n)
        flat[i[dim == n]] = x[dim == n]
        out[n] = np.linalg.eigh(flat.reshape(n, n))[1][:, ::-1].copy()
    return out


def _turned(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors in the order of the principal axes."""
    u = _unit(x)
    return u @ axes[x.shape[1]] if x.shape[1] in axes else u


def _cells(axes, width: float):
    """Adds each vector's cells on the leading axes: vectors nearer to each other than `width` differ by one cell at most on each."""

    def run(batches):
        for batch in batches:
            cells = np.zeros((SORTED, batch.num_rows), np.int32)
            for _, at, x in _by_length(batch.column("vector")):
                t = np.floor(_turned(x, axes.value)[:, :SORTED] / width).astype(np.int32)
                cells[: t.shape[1], at] = t.T
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, cells)], [*batch.schema.names, *(f"c{k}" for k in range(SORTED))])

    return run


def _sorted_by_cells(rows: DataFrame, axes, width: float, first: list[str], last: list[str]) -> DataFrame:
    """rows, which have a column vector, range-sorted by `first`, then by their cells on the leading axes (columns c0, c1, ...), then by `last`."""
    kept = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    cells = [f"c{k}" for k in range(SORTED)]
    placed = rows.mapInArrow(_cells(axes, width), f"{kept}, " + ", ".join(f"{c} int" for c in cells))
    order = [*first, *cells, *last]
    return placed.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)


def _shards(folder: str):
    """A writer of this task's shard that opens it at the first block: write(bytes) gives where it begins."""
    from pyspark import TaskContext

    number, held = TaskContext.get().partitionId(), []

    def write(raw: bytes) -> tuple[int, int, int]:
        if not held:
            held.extend([ShardWriter(folder, f"vectors-{number:06d}.bin"), 0])
        held[0].write(raw)
        held[1] += len(raw)
        return number, held[1] - len(raw), len(raw)

    return write, lambda: held and held[0].commit()


def _read(folder: str, shard: int, offset: int, size: int) -> bytes:
    return read_range(folder, f"vectors-{shard:06d}.bin", offset, size)


def _runs(batches, keys: list[str], most: int, also: list[str]):
    """Runs of equal keys of a sorted partition as (key, table): at most `most` rows, from a quarter of it on only up to where a column of `also` changes."""
    held: list[pa.RecordBatch] = []
    rows, last, edge = 0, None, None
    for batch in batches:
        columns, edges = ([batch.column(c).to_pylist() for c in names] for names in (keys, also))
        start = 0
        for i in range(batch.num_rows):
            key, here, n = tuple(c[i] for c in columns), tuple(c[i] for c in edges), rows + i - start
            if n and (key != last or n >= most or (here != edge and n >= most // 4)):
                yield last, pa.Table.from_batches([*held, batch.slice(start, i - start)], batch.schema).combine_chunks()
                held, rows, start = [], 0, i
            last, edge = key, here
        held.append(batch.slice(start))
        rows += batch.num_rows - start
    if rows:
        yield last, pa.Table.from_batches(held).combine_chunks()


def _vectors(table: pa.Table) -> np.ndarray:
    return _matrix(table.column("vector").combine_chunks())


# --- near-duplicates ---------------------------------------------------------------------------


def _block_writer(folder: str, axes, label_type: pa.DataType):
    """Writes blocks of sorted vectors: nodes, copies, vectors. A row about each: where it is, its cells' and its box's bounds; the box's last side is the norm of the components after BOXED."""

    def write(batches):
        put, commit = _shards(folder)
        for number, ((label, dim), rows) in enumerate(_runs(batches, ["label", "dim"], BLOCK, ["c0", "c1"])):
            x = _vectors(rows)
            shard, offset, size = put(b"".join(np.asarray(rows.column(c)).astype("<i8").tobytes() for c in ("node", "copies")) + x.tobytes())
            t = _turned(x, axes.value)
            t = np.concatenate([t[:, :BOXED], np.sqrt((t[:, BOXED:] ** 2).sum(axis=1, keepdims=True))], axis=1)
            bounds = [pa.array([int(v)], pa.int32()) for c in ("c0", "c1") for v in (np.min(rows.column(c)), np.max(rows.column(c)))]
            box = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (t.min(axis=0), t.max(axis=0))]
            numbers = [pa.array([v], pa.int64()) for v in (shard << 32 | number, shard, offset, size)]
            yield pa.RecordBatch.from_arrays([pa.array([label], label_type), pa.array([dim], pa.int32()), *numbers, *bounds, *box], [c.split()[0] for c in f"label x, dim int, {_ABOUT}".split(", ")])
        commit()

    return write


_ABOUT = "block long, shard long, offset long, bytes long, c0_lo int, c0_hi int, c1_lo int, c1_hi int, lo array<double>, hi array<double>"


def _near_blocks(about: DataFrame, width: float) -> DataFrame:
    """Pairs of blocks of one label whose boxes come nearer to each other than `width`; a block with itself too.

    They meet by a join on label and the cells of the first two axes that a block covers, the other's widened by one.
    """
    place = ["block", "shard", "offset", "bytes", "lo", "hi"]

    def covered(k: str, more: int) -> DataFrame:
        c0, c1 = (F.explode(F.sequence(F.col(f"{c}_lo") - more, F.col(f"{c}_hi") + more)).alias(c) for c in ("c0", "c1"))
        return about.select("label", "dim", *place, "c1_lo", "c1_hi", c0).select("label", "dim", "c0", c1, *[F.col(c).alias(f"{c}_{k}") for c in place])

    both = covered("a", 0).join(covered("b", 1), ["label", "dim", "c0", "c1"]).where("block_a <= block_b")
    gap = lambda i: F.greatest(F.lit(0.0), F.get("lo_b", i) - F.get("hi_a", i), F.get("lo_a", i) - F.get("hi_b", i))
    apart = F.aggregate(F.sequence(F.lit(0), F.size("lo_a") - 1), F.lit(0.0), lambda s, i: s + gap(i) * gap(i))
    refs = ["block_a", "shard_a", "offset_a", "bytes_a", "block_b", "shard_b", "offset_b", "bytes_b", "dim"]
    return both.where((F.col("block_a") == F.col("block_b")) | (apart <= width * width)).select(*refs).distinct()


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n rows reaches over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _tiles(folder: str, axes, threshold: float):
    """Links within and between the blocks of each pair: a row for each vector that has any, with their number and a vector that it reaches by them."""

    def load(refs, dim):
        raw = _read(folder, *refs)
        n = len(raw) // (16 + 8 * dim)
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, "<f8", n * dim, 16 * n).reshape(n, dim)

    def run(batches):
        for batch in batches:
            for a, *ra, b, rb0, rb1, rb2, dim in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = load(ra, dim)
                ids, copies, given = one
                left = np.arange(len(ids))
                right = left
                if a != b:
                    ids, copies, given = (np.concatenate(x) for x in zip(one, load((rb0, rb1, rb2), dim), strict=True))
                    right = np.arange(len(left), len(ids))
                turned, unit = _turned(given, axes.value), _unit(given)
                i, j = _survivors(turned[left], turned[right], threshold)
                i, j = left[i], right[j]
                i, j = i[i < j], j[i < j]
                step = max(1, AT_ONCE // dim)
                keep = [_cosines(given, unit, i[k : k + step], j[k : k + step]) >= threshold for k in range(0, len(i), step)]
                keep = np.concatenate(keep or [np.zeros(0, bool)])
                i, j = i[keep], j[keep]
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                root, some = _roots(len(ids), i, j), np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[root[some]])], ["node", "links", "root"])

    return run


def _cosines(given: np.ndarray, unit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of given vectors in double precision; of their unit vectors where squares leave the range."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        square = (given * given).sum(axis=1)
        plain = (square > 1e-200) & (square < 1e200)
        x = np.where(plain[:, None], given, unit)
        norm = np.sqrt(np.where(plain, square, (unit * unit).sum(axis=1)))
    return (x[i] * x[j]).sum(axis=1) / (norm[i] * norm[j])


def _survivors(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose product can still reach the threshold when all components are in.

    The products of the leading components come first, for the whole tile; what the others can add is at most
    the product of the two suffixes' norms. Survivors go on by a few components at a time.
    """
    dim = x.shape[1]
    tails = [np.sqrt(np.maximum(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1], 0)) for m in (x, y)]
    suffix = lambda side, k: tails[side][:, k] if k < dim else np.zeros(len(tails[side]))
    k = min(LEAD, dim)
    part = x[:, :k] @ y[:, :k].T
    i, j = np.nonzero(part + np.multiply.outer(suffix(0, k), suffix(1, k)) >= threshold - SLACK)
    got = part[i, j]
    while k < dim and len(i):
        step = min(dim, k + LEAD)
        for lo in range(0, len(i), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            got[s] += (x[i[s], k:step] * y[j[s], k:step]).sum(axis=1)
        k = step
        alive = got + suffix(0, k)[i] * suffix(1, k)[j] >= threshold - SLACK
        i, j, got = i[alive], j[alive], got[alive]
    return i, j


def near_duplicate_vectors(table: DataFrame, threshold: float = 0.98, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id") -> DataFrame:
    """One row per row of table: vec_id, n_links, component_id, kept. Links: equal labels that aren't null, and a cosine in double precision of threshold or more (0 < threshold < 1).

    Equal vectors of a label collapse to a class with a number of copies, so a vector that is there a million times is
    compared once. Classes are range-sorted by label and by cells of a link's width, sqrt(2 - 2 * threshold), on the
    leading principal axes, and cut into blocks of about 1024 neighbours, which are written once to the shared folder. Each
    block's box on 16 axes, with the norms of the rest, goes to a small table; only pairs of blocks whose boxes come within a
    link's width are tiles. A task reads a tile's two blocks, multiplies the leading components of its rotated vectors,
    drops pairs that the suffix norms rule out, goes on with the rest and decides survivors on the vectors as
    given. It returns link counts and a spanning set of links, never all pairs. Only numbers of blocks are shuffled in pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without label, link with nothing: n_links 0, own component, kept.
    Vectors of different lengths don't link. Repeated rows are vectors each. Rows with one vec_id are counted apart in n_links and share a component if any of them is linked.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("key", F.when(ok, F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("vector", lambda x: (x + F.lit(0.0)).cast("string"))), 256)))
    keyed = settled(rows.select("vec_id", "label", "key", F.when(ok, F.col("vector")).alias("vector")))
    classes = keyed.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = settled(classes.select("*", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("node")))
    axes = spark.sparkContext.broadcast(_axes(classes))
    width, folder = math.sqrt(max(2 - 2 * threshold, 0)) + 1e-4, fresh_folder(spark, "blocks")
    placed = _sorted_by_cells(classes.select("label", "dim", "node", "copies", "vector"), axes, width, ["label", "dim"], ["node"])
    label_type = classes.select("label").limit(0).toArrow().schema.field("label").type
    about = settled(placed.mapInArrow(_block_writer(folder, axes, label_type), f"label {dict(classes.dtypes)['label']}, dim int, {_ABOUT}"))
    tiles = settled(_near_blocks(about, width))
    tasks = max(1, min(tiles.count(), 4 * shuffle_width(spark)))
    found = settled(tiles.repartition(tasks).mapInArrow(_tiles(folder, axes, threshold), "node long, links long, root long"))
    known = keyed.where("key is not null").select("vec_id", "key")
    several = known.groupBy("vec_id").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least != most").select("vec_id", "least")
    node = classes.select("key", "node")
    same_id = known.join(several, "vec_id").join(node.toDF("key", "a"), "key").join(node.toDF("least", "b"), "least").select("a", "b")
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(same_id))
    names = parts.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("c"))
    parts = parts.join(names, "component").select("node", "c")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("key", "node", "rep", "copies").join(links, "node", "left").join(parts, "node", "left")
    named = named.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("c", "rep").alias("c"))
    out = keyed.select("vec_id", "key").join(named, "key", "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


# --- exact top-k -------------------------------------------------------------------------------

#: Vectors of a block, blocks that a tile's task reads one after another, queries whose lists are read together, and shares of the lists after which bounds are looked at.
CANDIDATES, TOGETHER, QUERIES, SHARES = 8192, 16, 64, (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)
#: Width of the cells that neighbours are sorted by.
CELL = 0.25
#: Products of doubles are exact below the first, products of 64-bit integers below the second.
EXACT, LARGEST = 2.0**53, 2.0**63 - 1


def scaled(x: np.ndarray, scale: float, kind: str) -> np.ndarray:
    """floor(scale * x) as doubles ("f"), 64-bit integers ("i") or Python's integers ("o"), of any size."""
    if kind == "f":
        return np.floor(x * scale)
    one = lambda v: math.floor(scale * v) if abs(scale * v) < EXACT else math.floor(scale) * int(v) if scale == int(scale) else int(scale * v)
    return np.array([[one(v) for v in row] for row in x.tolist()], np.int64 if kind == "i" else object).reshape(x.shape)


class Lists:
    """A block's candidates with the order of each component, which queries read from the end that is good for them."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, order: np.ndarray | None = None, depth: np.ndarray | None = None):
        self.values, self.ids = values, ids
        n, dim = values.shape
        if order is None:
            order = np.argsort(values, axis=0, kind="stable")
            place = np.empty((n, dim), np.int64)
            np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
            # the depth at which a row first shows in any list, from either end
            depth = np.minimum(place, n - 1 - place).min(axis=1) + 1
        self.order, self.depth = order, depth
        self.by_depth = np.argsort(self.depth, kind="stable")
        self.depths = self.depth[self.by_depth]
        self.low, self.high = values.min(axis=0), values.max(axis=0)

    def at(self, place: int) -> np.ndarray:
        """Each list's value at a place, from its lower end."""
        return np.take_along_axis(self.values, self.order[place].astype(np.int64)[None, :], axis=0)[0]


def no_random_access(lists: Lists, q: np.ndarray, q_ids: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query rows, candidate rows and exact products of each query's best k candidates with another id, ties to the smaller id; and the number of list entries read.

    A query reads component d's list from the top where its own component is positive and from the bottom where it is
    negative. A row seen in a list adds its value there; an unseen entry adds the list's worst value at least and the value at
    the reader's place at most. So every row that was seen has a lower and an upper bound, and rows that no list has shown yet have the
    bound that all readers' places give. `least` are scores that each query has k candidates of elsewhere already: with the k-th best
    lower bound they say who can still qualify. Bounds are updated for rows that can, and for rows newly seen. A query stops when
    no outsider can qualify and few rows are left, whose products are then resolved.
    """
    out, read = [], 0
    c, n = lists.values, len(lists.values)
    floor = np.full(len(q), -np.inf) if least is None else least.astype(np.float64)
    for lo in range(0, len(q), QUERIES):
        waiting = np.arange(lo, min(lo + QUERIES, len(q)))
        alive, shown = np.zeros(0, np.int64), 0
        for share in SHARES:
            depth = max(1, math.ceil(n * share))
            up, down = np.maximum(q[waiting], 0).T, np.minimum(q[waiting], 0).T
            top, bottom = lists.at(n - depth), lists.at(depth - 1)
            stop = int(np.searchsorted(lists.depths, depth, "right"))
            rows = np.concatenate([alive, lists.by_depth[shown:stop]])
            shown, part = stop, c[rows]
            upper = np.maximum(part, top) @ up + np.minimum(part, bottom) @ down
            lower = np.where(part >= top, part, lists.low) @ up + np.where(part <= bottom, part, lists.high) @ down
            own = lists.ids[rows][:, None] == q_ids[waiting][None, :]
            lower[own] = -np.inf
            if len(rows) >= k:
                floor[waiting] = np.maximum(floor[waiting], np.partition(lower, len(rows) - k, axis=0)[len(rows) - k])
            can = (upper >= floor[waiting]) & ~own
            outsiders = (top @ up + bottom @ down < floor[waiting]) | (stop == n)
            done = outsiders & ((can.sum(axis=0) <= max(4 * k, n // 64)) | (depth == n))
            if done.any():
                read += int(done.sum()) * depth * c.shape[1]
                r, w = np.nonzero(can[:, done])
                r, w = rows[r], waiting[done][w]
                step = max(1, AT_ONCE // c.shape[1])
                score = np.concatenate([(c[r[s : s + step]] * q[w[s : s + step]]).sum(axis=1) for s in range(0, len(r), step)] or [np.zeros(0)])
                good = score >= floor[w]
                out.append(_best(w[good], r[good], score[good], lists.ids, k))
            alive, waiting = rows[can[:, ~done].any(axis=1)], waiting[~done]
            if not len(waiting):
                break
    w, r, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return w, r, score, read


def _best(w: np.ndarray, r: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of products (query, row, score) the best k of each query."""
    order = np.lexsort((ids[r], -score, w))
    w, r, score = w[order], r[order], score[order]
    kept = np.arange(len(w)) - np.searchsorted(w, w) < k
    return w[kept], r[kept], score[kept]


def _all_products(values: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Like no_random_access() for integers of any size, from all products."""
    out = []
    for i, own in enumerate(q_ids):
        products = values @ q[i]
        best = sorted((-int(s), int(c)) for s, c in zip(products, ids, strict=True) if c != own)[:k]
        out += [(int(own), c, max(-(2**63), min(2**63 - 1, -s))) for s, c in best]
    return out


class _Searcher:
    """Reads and compares a top_k() job's blocks. A block in a shard: numbers of rows and queries, bounds of the components, queries (ids, best scores, vectors), ids, vectors, depths, orders."""

    def __init__(self, folder: str, k: int, scale: float):
        self.folder, self.k, self.scale = folder, k, scale

    def large(self, x: np.ndarray) -> np.ndarray:
        """Vectors whose products with others like them may not be exact as doubles."""
        return np.abs(x).max(axis=1, initial=0.0) * self.scale + 1 >= math.sqrt(EXACT / x.shape[1])

    def exact(self, x: np.ndarray, ids: np.ndarray, asked: np.ndarray, q_ids: np.ndarray) -> list[tuple[int, int, int]]:
        """The best of all products, as 64-bit integers or, if these may not hold them, Python's."""
        if not len(x) or not len(asked):
            return []
        # in two steps, which can't overflow to nothing
        most = float(np.abs(x).max()) * self.scale + 1
        kind = "i" if most < LARGEST / x.shape[1] / (float(np.abs(asked).max()) * self.scale + 1) else "o"
        return _all_products(scaled(x, self.scale, kind), ids, scaled(asked, self.scale, kind), q_ids, self.k)

    def found(self, x: np.ndarray, lists: Lists, asked: np.ndarray, q_ids: np.ndarray, least: np.ndarray | None) -> list[tuple[int, int, int]]:
        """What queries find in a block of vectors x: by its lists, but for products with a large vector on either side, which are few and taken as whole numbers."""
        big, of_big, ids = self.large(x), self.large(asked), lists.ids
        plain = np.flatnonzero(~of_big)
        if big.any():
            lists = Lists(lists.values[~big], ids[~big]) if not big.all() else None
        out: list[tuple[int, int, int]] = []
        if lists is not None and len(plain):
            w, r, score, _ = no_random_access(lists, scaled(asked[plain], self.scale, "f"), q_ids[plain], self.k, None if least is None else least[plain])
            out += zip(q_ids[plain][w].tolist(), lists.ids[r].tolist(), score.astype(np.int64).tolist(), strict=True)
        return out + self.exact(x[big], ids[big], asked[plain], q_ids[plain]) + self.exact(x, ids, asked[of_big], q_ids[of_big])

    def better(self, held: np.ndarray, q_ids: np.ndarray, found: list[tuple[int, int, int]]) -> np.ndarray:
        """Each query's k best scores so far, falling, with those of a further block. Scores beyond what doubles hold count a little less."""
        more: dict[int, list[float]] = {}
        for i, _, score in found:
            more.setdefault(i, []).append(float(score) if abs(score) < EXACT else math.nextafter(float(score), -math.inf))
        # different queries may have one id: what only one of them has found must not count for the others
        several = {i for i, n in zip(*(a.tolist() for a in np.unique(q_ids, return_counts=True)), strict=True) if n > 1}
        for row, i in enumerate(q_ids.tolist()):
            if i in more and i not in several:
                held[row] = np.sort(np.concatenate([held[row], more[i]]))[::-1][: self.k]
        return held

    def write(self, batches):
        """Writes a partition's blocks and searches each for its own queries. Rows: where blocks are, and what their queries found."""
        put, commit = _shards(self.folder)
        for number, ((dim,), rows) in enumerate(_runs(batches, ["dim"], CANDIDATES, ["c0", "c1"])):
            x, ids = _vectors(rows), np.asarray(rows.column("vec_id")).astype("<i8")
            lists = Lists(scaled(x, self.scale, "f"), ids)
            asked = np.asarray(rows.column("asked"))
            q, q_ids = x[asked], ids[asked]
            found = self.found(x, lists, q, q_ids, None)
            best = self.better(np.full((len(q), self.k), -np.inf), q_ids, found)
            head = np.array([len(ids), len(q)], "<i8").tobytes() + np.stack([x.min(axis=0), x.max(axis=0)]).tobytes()
            head += q_ids.tobytes() + best.astype("<f8").tobytes() + q.tobytes()
            where = put(head + ids.tobytes() + x.tobytes() + lists.depth.astype("<i8").tobytes() + lists.order.astype("<u2").tobytes())
            yield self.rows([(dim, where[0] << 32 | number, *where, len(head), len(q), None, None, None), *((None,) * 7 + f for f in found)])
        commit()

    def rows(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(10)], [c.split()[0] for c in _FOUND.split(", ")])

    def tiles(self, batches):
        """What the queries of a block find in other blocks, each of which is read only if its bounds let it beat what the queries have; what they find is the score to beat in the next ones."""
        for batch in batches:
            for block, dim, shard, offset, head, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = _read(self.folder, shard, offset, head)
                m = int(np.frombuffer(raw, "<i8", 2)[1])
                at = 16 + 16 * dim
                q_ids, best = np.frombuffer(raw, "<i8", m, at), np.frombuffer(raw, "<f8", m * self.k, at + 8 * m).reshape(m, self.k).copy()
                q = np.frombuffer(raw, "<f8", m * dim, at + 8 * m * (1 + self.k)).reshape(m, dim)
                for other in others:
                    if other["block"] == block:
                        continue
                    some = self.reachable(other, dim, q, best[:, -1])
                    if some.any():
                        found = self.found(*self.load(other, dim), q[some], q_ids[some], best[some, -1])
                        best[some] = self.better(best[some], q_ids[some], found)
                        yield self.rows([(None,) * 7 + f for f in found])

    def reachable(self, other, dim: int, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The queries for which the bounds of a block's components allow a product that ties with what they have, or beats it. Large vectors are never left out."""
        bounds = np.frombuffer(_read(self.folder, other["shard"], other["offset"] + 16, 16 * dim), "<f8").reshape(2, dim)
        if self.large(bounds).any():
            return np.ones(len(q), bool)
        low, high = scaled(bounds, self.scale, "f")
        own = scaled(q, self.scale, "f")
        return (np.maximum(own, 0) @ high + np.minimum(own, 0) @ low >= least) | self.large(q)

    def load(self, other, dim: int) -> tuple[np.ndarray, Lists]:
        raw = _read(self.folder, other["shard"], other["offset"] + other["head"], other["bytes"] - other["head"])
        n = len(raw) // (16 + 10 * dim)
        at = 8 * n + 8 * n * dim
        x = np.frombuffer(raw, "<f8", n * dim, 8 * n).reshape(n, dim)
        order, depth = np.frombuffer(raw, "<u2", n * dim, at + 8 * n).reshape(n, dim), np.frombuffer(raw, "<i8", n, at)
        return x, Lists(scaled(x, self.scale, "f"), np.frombuffer(raw, "<i8", n), order, depth)


_FOUND = "dim long, block long, shard long, offset long, bytes long, head long, queries long, query_id long, vec_id long, score long"


def top_k(table: DataFrame, every: int = 50, k: int = 5, scale: int = 256, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row whose vec_id is divisible by `every`, by the integer product of floor(scale * x).

    All rows are range-sorted by cells on their leading principal axes and cut into blocks of at most 8192 neighbours, which are
    written once to the shared folder with the sorted order of every component. Each block's queries are searched in it first,
    by no_random_access(). What they found is the score to beat elsewhere: a task takes one block's queries and reads
    other blocks one after another, if the bounds of their components allow such a score at all, whose lists are read in step until
    outsiders cannot qualify. Each gives k rows a query at most; the best k of those are the result. Only numbers of blocks are shuffled in pairs.

    Products below 2**53 are exact as doubles. Those of a vector with so large components that they might not be are taken one by one, as 64-bit or Python's integers, in each
    block for itself: such vectors don't change how others are searched. Scores beyond 64 bits are then ordered by their true value and given as the largest or smallest long.
    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without vec_id; vectors of different lengths don't meet.
    A row is no candidate of a query with its own vec_id. Repeated rows are candidates each, and one query. Different vectors of one vec_id
    are queries whose results are ranked together. Ties go to the smaller vec_id. Fewer candidates than k give fewer rows; an empty table none. Other columns are ignored.
    """
    spark = table.sparkSession
    taking = table.where(F.col(vec_id).isNotNull() & finite(vector)).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    distinct = taking.groupBy("vec_id", "vector").agg(F.count("*").alias("n"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")
    asked = (F.col("copy") == 1) & (F.pmod("vec_id", F.lit(every)) == 0)
    rows = settled(distinct.select("vec_id", "vector", F.size("vector").alias("dim"), copy).select("vec_id", "vector", "dim", asked.alias("asked")))
    search = _Searcher(fresh_folder(spark, "lists"), k, scale)
    axes = spark.sparkContext.broadcast(_axes(rows))
    found = settled(_sorted_by_cells(rows, axes, CELL, ["dim"], ["vec_id"]).mapInArrow(search.write, _FOUND))
    blocks = found.where("block is not null").drop("query_id", "vec_id", "score")
    groups = blocks.withColumn("part", F.expr(f"row_number() over (partition by dim order by block) div {TOGETHER}"))
    groups = groups.groupBy("dim", "part").agg(F.sort_array(F.collect_list(F.struct("block", "shard", "offset", "bytes", "head"))).alias("others"))
    tiles = settled(blocks.where("queries > 0").join(groups, "dim").select("block", "dim", "shard", "offset", "head", "others"))
    tasks = max(1, min(tiles.count(), 4 * shuffle_width(spark)))
    elsewhere = tiles.repartition(tasks).mapInArrow(search.tiles, _FOUND)
    results = found.where("block is null").union(elsewhere).select("query_id", "vec_id", "score")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return results.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

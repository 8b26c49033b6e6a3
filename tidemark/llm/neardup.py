"""MinHash near-duplicates by an LSH forest: sorted signature orders, neighbours by longest common prefix."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.shards import ShardWriter, read_range
from tidemark.llm.store import fresh_folder, settled, shuffle_width
from tidemark.llm.textcore import Words, mixed, pieces, shingles

#: Orders of the forest, minhashes in each, and the prefix that two documents must share at least in one order.
#: A pair of similarity 0.85 shares it in none of 16 orders with probability (1 - 0.85**3)**16 = 2e-7.
TREES, DEPTH, LEAST = 16, 8, 3
#: Regions (rows that share a prefix) up to this size compare all their rows; larger ones go deeper.
REGION = 16
#: Neighbours in sorted order that are compared in every region, however large.
NEAR = 3
#: Rows of a dense region that go to a task together, and their shingles.
BLOCK, BLOCK_SHINGLES = 1024, 200_000
#: A shingle that this many rows of a block have is counted by matrix products, this many columns at a time; rarer ones pair by pair, this many at a time.
COMMON, COLUMNS, AT_ONCE = 64, 2048, 1 << 21
#: Share of equal minhashes below which a similarity of 0.85 is ruled out (five standard deviations of 128).
LIKELY = 0.69
#: Rows of a dense region that meet its largest component by a join go to this many parts of it.
SALTS = 32


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(1, n + 1, dtype=np.uint64))
    return (x >> np.uint64(32)).astype(np.uint32) | np.uint32(1), x.astype(np.uint32) | np.uint32(1)


def _signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Big-endian minhashes, one row for each text that has shingles."""
    low, high = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), TREES * DEPTH), ">u4")
    if len(starts):
        for k, (p, q) in enumerate(zip(*_multipliers(TREES * DEPTH), strict=True)):
            out[:, k] = np.minimum.reduceat(low * p + high * q, starts)
    return out


def _sketch(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in pieces(texts):
            h, at = shingles(Words(texts.slice(lo, hi - lo).to_pylist()))
            signatures, row = _signatures(h, at), 0
            sizes, keys, sigs = [], [], []
            for i in range(hi - lo):
                own = np.unique(h[at[i] : at[i + 1]])
                sizes.append(len(own))
                keys.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                sigs.append(signatures[row].tobytes() if len(own) else None)
                row += len(own) > 0
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "key", "sig"])


def _sets(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in pieces(texts):
            h, at = shingles(Words(texts.slice(lo, hi - lo).to_pylist()))
            packed = [np.unique(h[at[i] : at[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(packed, pa.binary())], ["doc_id", "shingles"])


def _common(prefixes: np.ndarray) -> np.ndarray:
    """Of each row but the last: the minhashes that it shares with the next row from the start on."""
    same = prefixes[:-1] == prefixes[1:]
    return np.where(same.all(axis=1), DEPTH, np.argmin(same, axis=1)).astype(np.int64)


def _neighbours(tree: np.ndarray, prefixes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of sorted rows.

    Each row goes with its NEAR next rows as long as they share LEAST minhashes, and with all rows of the
    largest region of at most REGION rows, at LEAST minhashes or more, that holds it.
    """
    n = len(ids)
    if n < 2:
        return ids[:0], ids[:0]
    lcp = np.where(tree[:-1] == tree[1:], _common(prefixes), 0)
    left, right = [], []
    reach = np.full(n, DEPTH + 1)
    for gap in range(1, min(REGION, n)):
        reach = np.minimum(reach[:-1], lcp[gap - 1 :])[: n - gap]
        near = reach >= LEAST
        if gap > NEAR and near.any():
            rows = np.flatnonzero(near)
            near = np.zeros(n - gap, bool)
            near[rows] = _small(lcp, rows, rows + gap, reach[rows])
        at = np.flatnonzero(near)
        if not len(at) and gap > NEAR:
            if not (reach >= LEAST).any():
                break
            continue
        left.append(ids[at])
        right.append(ids[at + gap])
    a, b = np.concatenate(left or [ids[:0]]), np.concatenate(right or [ids[:0]])
    return np.minimum(a, b), np.maximum(a, b)


def _small(lcp: np.ndarray, i: np.ndarray, j: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Whether the region of rows that share `depth` minhashes around i..j has REGION rows at most."""
    size = j - i + 1
    going = np.ones(len(i), bool)
    for step in range(1, REGION + 1):
        at = i - step
        going &= (at >= 0) & (lcp[np.maximum(at, 0)] >= depth)
        size = size + going
        if not going.any():
            break
    going = np.ones(len(i), bool)
    for step in range(REGION + 1):
        at = j + step
        going &= (at < len(lcp)) & (lcp[np.minimum(at, len(lcp) - 1)] >= depth)
        size = size + going
        if not going.any():
            break
    return size <= REGION


def _arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prefixes = np.frombuffer(b"".join(rows.column("prefix").to_pylist()), ">u4").reshape(-1, DEPTH)
    return np.asarray(rows.column("tree")), prefixes, np.asarray(rows.column("rep"))


def _regions(tree: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """Numbers of the runs of sorted rows that share LEAST minhashes."""
    cut = (tree[:-1] != tree[1:]) | (prefixes[:-1, :LEAST] != prefixes[1:, :LEAST]).any(axis=1)
    return np.concatenate([[0], np.cumsum(cut)])


def _common_counts(tokens: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    """Exact numbers of common tokens of a block's rows, or of its first rows with the others where `first` is not 0. Rows are sets of tokens, one after another."""
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    _, code, often = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    right_from, left_to = (first, first) if first else (0, n)
    out = np.zeros((left_to, n - right_from), np.float32)
    frequent = np.flatnonzero(often >= COMMON)
    column = np.full(len(often), -1)
    column[frequent] = np.arange(len(frequent))
    for lo in range(0, len(frequent), COLUMNS):
        some = (column[code] >= lo) & (column[code] < lo + COLUMNS)
        present = np.zeros((n, COLUMNS), np.float32)
        present[row[some], column[code[some]] - lo] = 1
        out += present[:left_to] @ present[right_from:].T
    rare = (often > 1) & (often < COMMON)
    kept = rare[code]
    code, row = code[kept], row[kept]
    left, right = (row < left_to, row >= right_from)
    right_code, right_row = code[right], row[right] - right_from
    lo, hi = np.searchsorted(right_code, code[left]), np.searchsorted(right_code, code[left], "right")
    left_row, many = row[left], hi - lo
    done = np.cumsum(many)
    start = 0
    while start < len(left_row):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + AT_ONCE, "right")))
        m = many[start:stop]
        at = np.arange(m.sum()) + np.repeat(lo[start:stop] - (np.cumsum(m) - m), m)
        pairs = np.repeat(left_row[start:stop], m) * out.shape[1] + right_row[at]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape)
        start = stop
    return out


def _block_links(tokens: np.ndarray, sizes: np.ndarray, comps: np.ndarray, first: int, percent: int) -> list[tuple[int, int]]:
    """Links of different components between a block's rows, or between its first rows and the others where `first` is not 0: of all links a spanning set. Exact."""
    both = _common_counts(tokens, sizes, first)
    left, right = (slice(0, first), slice(first, None)) if first else (slice(None), slice(None))
    linked = 100 * both >= percent * (sizes[left, None] + sizes[None, right] - both)
    linked &= comps[left, None] != comps[None, right]
    i, j = np.nonzero(linked if first else np.triu(linked, 1))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    links = []
    for a, b in np.unique(np.stack([comps[left][i], comps[right][j]], 1), axis=0).tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((a, b))
    return links


def _block_writer(folder: str):
    """Writes a partition's blocks, sorted by number, as one shard, and returns a row about each. A block: numbers of rows and tokens, components, sizes, tokens."""

    def write(batches):
        from pyspark import TaskContext

        shard, out, offset, last = TaskContext.get().partitionId(), None, 0, None
        comps, sets = [], []

        def flush():
            nonlocal offset, comps, sets
            sizes = np.array([len(x) // 8 for x in sets], "<i8")
            raw = np.array([len(sizes), sizes.sum()], "<i8").tobytes() + np.array(comps, "<i8").tobytes() + sizes.tobytes() + b"".join(sets)
            out.write(raw)
            row = (*last, int(sizes.min()), int(sizes.max()), min(comps), max(comps), shard, offset, len(raw))
            offset, comps, sets = offset + len(raw), [], []
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary() if k == 2 else pa.int64()) for k, x in enumerate(row)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for block, tree, region, comp, shingle in zip(*(batch.column(c).to_pylist() for c in ("block", "tree", "region", "comp", "shingles")), strict=True):
                out = out or ShardWriter(folder, f"blocks-{shard:06d}.bin")
                if last and block != last[0]:
                    yield flush()
                last = (block, tree, region)
                comps.append(comp)
                sets.append(shingle)
        if sets:
            yield flush()
        if out:
            out.commit()

    return write


_BLOCKS = "block long, tree long, region binary, lo long, hi long, least long, most long, shard long, offset long, bytes long"


def _block(folder: str, shard: int, offset: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(read_range(folder, f"blocks-{shard:06d}.bin", offset, size), "<i8")
    n = int(raw[0])
    return raw[2 : 2 + n], raw[2 + n : 2 + 2 * n], raw[2 + 2 * n :].view("<u8")


def _scan_blocks(folder: str, percent: int):
    """_block_links() of pairs of blocks, which are read from the shared folder; of one block where both are the same."""

    def scan(batches):
        for batch in batches:
            for a, b, *refs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = _block(folder, *refs[:3])
                comps, sizes, tokens = one
                first = 0
                if a != b:
                    comps, sizes, tokens = (np.concatenate(x) for x in zip(one, _block(folder, *refs[3:]), strict=True))
                    first = len(one[0])
                links = _block_links(tokens, sizes, comps, first, percent)
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["ca", "cb"])

    return scan


def _cut(batches):
    """Numbers blocks of sorted rows: BLOCK rows of one region and kind, or BLOCK_SHINGLES shingles, at most. A longer set is a block of its own."""
    from pyspark import TaskContext

    block, last, rows, total = TaskContext.get().partitionId() << 32, None, 0, 0
    for batch in batches:
        numbers = []
        for key, n in zip(zip(*(batch.column(c).to_pylist() for c in ("tree", "region", "main")), strict=True), batch.column("n").to_pylist(), strict=True):
            if key != last or rows >= BLOCK or total + n > BLOCK_SHINGLES:
                block, last, rows, total = block + 1, key, 0, 0
            rows, total = rows + 1, total + n
            numbers.append(block)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *(batch.column(c) for c in ("tree", "region", "rep", "comp"))], ["block", "tree", "region", "rep", "comp"])


_PAIRS = "edge int, tree int, prefix binary, a long, b long"


def _pair_batch(a, b):
    ids = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    n = len(ids)
    return pa.RecordBatch.from_arrays([pa.array([-1] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(ids[:, 0]), pa.array(ids[:, 1])], ["edge", "tree", "prefix", "a", "b"])


def _scan_order(batches):
    """Pairs within a sorted partition, rows of its dense regions (edge -2), and all rows of the regions at its two ends (edge 0), which may go on in any partition."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    tree, prefixes, ids = _arrays(rows)
    yield _pair_batch(*_neighbours(tree, prefixes, ids))
    region = _regions(tree, prefixes)
    ends = (region == 0) | (region == region[-1])
    for k, which in ((0, ends), (-2, ~ends & (np.bincount(region)[region] > REGION))):
        some = rows.filter(pa.array(which)).combine_chunks()
        n = some.num_rows
        yield from pa.table({"edge": pa.array([k] * n, pa.int32()), "tree": some.column("tree"), "prefix": some.column("prefix"), "a": some.column("rep"), "b": pa.nulls(n, pa.int64())}).to_batches()


def _across(rows: pa.Table) -> pa.Table:
    """All pairs of a region of REGION rows at most."""
    ids = np.asarray(rows.column("rep"))
    i, j = np.triu_indices(len(ids), 1)
    return pa.table({"a": pa.array(np.minimum(ids[i], ids[j]), pa.int64()), "b": pa.array(np.maximum(ids[i], ids[j]), pa.int64())})


def _alike(batches):
    """Keeps pairs whose signatures don't rule out the similarity: over five standard deviations of room."""
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            likely = (x == y).mean(axis=1) >= LIKELY
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(likely))


def _confirmed(percent: int):
    def confirm(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                own = [np.frombuffer(one.as_buffer(), "<u8") for one in (x, y)]
                both = len(np.intersect1d(*own, assume_unique=True))
                keep.append(100 * both >= percent * (len(own[0]) + len(own[1]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def near_duplicates(docs: DataFrame, percent: int = 85, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * (common shingles) >= percent * (all shingles of both); shingles are runs
    of five words. Documents with equal sets collapse to one class by an aggregate, so thousands of exact
    copies cost one signature. The classes' signatures (16 orders of 8 minhashes) are sorted, each order
    range-partitioned with the id as the last key, so one hot prefix spreads over partitions; regions at a
    partition's ends are counted over all partitions and compared whole. Neighbours by longest common prefix are candidates: all pairs of a
    region of 16 rows or fewer, whose depth so adapts to how dense it is, and the 3 next rows in larger
    ones. Candidates that the whole signature doesn't rule out are confirmed on the full sets. Rows of larger regions
    that are still in different components after that are compared further: see _joined_in_dense_regions.

    Null and blank texts: no shingles, own component, kept. Rows with one doc_id are one node: different texts under
    one doc_id link what each of them is linked with. A row without doc_id gets no component unless its text has copies
    with one; kept is then false. An empty table gives no rows. Texts of any length are one set of hashes at a time. Columns beyond text and doc_id are ignored.
    """
    spark = docs.sparkSession
    wide = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = settled(wide.mapInArrow(_sketch, "doc_id long, n_shingles long, key binary, sig binary"))
    classes = settled(sketches.where("key is not null and doc_id is not null").groupBy("key").agg(F.min_by(F.struct("doc_id", "sig", "n_shingles"), "doc_id").alias("one")).select("key", F.col("one.doc_id").alias("rep"), F.col("one.sig").alias("sig"), F.col("one.n_shingles").alias("n")))
    prefix = F.array(*[F.expr(f"substring(sig, {4 * DEPTH * t + 1}, {4 * DEPTH})") for t in range(TREES)])
    orders = classes.select("rep", F.posexplode(prefix).alias("tree", "prefix"))
    width = shuffle_width(spark)
    scanned = settled(
        orders.repartitionByRange(width, "tree", "prefix", "rep").sortWithinPartitions("tree", "prefix", "rep")
        .select("tree", "prefix", "rep").mapInArrow(_scan_order, _PAIRS)
    )
    region = F.expr(f"substring(prefix, 1, {4 * LEAST})").alias("region")
    ends = scanned.where("edge = 0").select("tree", region, "prefix", F.col("a").alias("rep"))
    # two regions for each partition at most
    ends = ends.join(F.broadcast(ends.groupBy("tree", "region").agg(F.count("*").alias("size"))), ["tree", "region"])
    across = ends.where(F.col("size") <= REGION).groupBy("tree", "region").applyInArrow(_across, "a long, b long")
    pairs = scanned.where("edge = -1").select("a", "b").union(across).where("a != b").distinct()
    sig = classes.select("rep", "sig")
    # the merge hints keep one way of joining at every size
    pairs = pairs.join(sig.toDF("a", "sig_a").hint("merge"), "a").join(sig.toDF("b", "sig_b").hint("merge"), "b").select("a", "b", "sig_a", "sig_b")
    pairs = settled(pairs.mapInArrow(_alike, "a long, b long"))
    dense = scanned.where("edge = -2").select("tree", region, F.col("a").alias("rep"))
    dense = settled(dense.union(ends.where(F.col("size") > REGION).select("tree", "region", "rep")).distinct())
    members = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(dense.select("rep")).distinct()
    sets = settled(wide.join(members.hint("merge"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "doc_id long, shingles binary"))

    def confirmed(some: DataFrame) -> DataFrame:
        both = some.join(sets.toDF("a", "set_a").hint("merge"), "a").join(sets.toDF("b", "set_b").hint("merge"), "b").select("a", "b", "set_a", "set_b")
        return both.mapInArrow(_confirmed(percent), "a long, b long")

    known = sketches.where("key is not null and doc_id is not null").select("doc_id", "key")
    several = known.groupBy("doc_id").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least != most").select("doc_id")
    same_id = known.join(several, "doc_id").join(classes.select("key", "rep").hint("merge"), "key").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(confirmed(pairs).union(same_id))
    if not dense.isEmpty():
        found = _joined_in_dense_regions(dense, classes, sets, found, width, percent)
    named = classes.select("key", "rep").join(found, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("class_component"))
    out = sketches.select("doc_id", "n_shingles", "key").join(named.hint("merge"), "key", "left")
    component = F.coalesce("class_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _joined_in_dense_regions(dense: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame, width: int, percent: int) -> DataFrame:
    """node, component after the links that neighbours alone may have missed between rows of dense regions.

    A row of a large region meets only some of it as a neighbour. Of regions that still hold several components, all
    rows are compared, on their full sets, with all that are in another component: sorted by size, they are cut into blocks, the
    largest component's apart, each block is written once to the shared folder, and a task reads two of them and counts
    what their rows have in common. Blocks of one component only, or whose sizes rule links out, don't meet. Only numbers of blocks are shuffled in pairs.
    """
    comps = classes.join(found, F.col("rep") == F.col("node"), "left").select("rep", "n", F.coalesce("component", "rep").alias("comp"))
    comps = comps.groupBy("rep", "comp").agg(F.max("n").alias("n"))
    rows = settled(dense.join(comps, "rep").select("tree", "region", "rep", "comp", "n"))
    parts = rows.groupBy("tree", "region", "comp").agg(F.count("*").alias("size"))
    mixed_regions = parts.groupBy("tree", "region").agg(F.max_by("comp", F.struct("size", "comp")).alias("largest"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    # a region may hold a third of all rows: its one row here meets them in SALTS parts
    salted = mixed_regions.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), ["tree", "region", "salt"])
    rows = settled(rows.select("tree", "region", (F.col("comp") == F.col("largest")).alias("main"), "n", "rep", "comp"))
    order = ["tree", "region", "main", "n", "rep"]
    cut = settled(rows.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(_cut, "block long, tree int, region binary, rep long, comp long"))
    full = cut.join(sets.where("octet_length(shingles) > 0").toDF("rep", "shingles").hint("merge"), "rep")
    folder = fresh_folder(comps.sparkSession, "blocks")
    full = full.repartition(width, "block").sortWithinPartitions("block", "rep", "shingles").select("block", "tree", "region", "comp", "shingles")
    about = settled(full.mapInArrow(_block_writer(folder), _BLOCKS))
    a, b = (about.select("tree", "region", *[F.col(c).alias(f"{c}_{k}") for c in ("block", "lo", "hi", "least", "most", "shard", "offset", "bytes")]) for k in "ab")
    apart = "least_a != least_b or most_a != most_b or least_a != most_a"
    fit = f"100 * hi_a >= {percent} * lo_b and 100 * hi_b >= {percent} * lo_a"
    pairs = settled(a.join(b, ["tree", "region"]).where(f"block_a <= block_b and ({apart}) and {fit}").select("block_a", "block_b", *[f"{c}_{k}" for k in "ab" for c in ("shard", "offset", "bytes")]))
    tasks = max(1, min(pairs.count(), 4 * width))
    links = components(pairs.repartition(tasks).mapInArrow(_scan_blocks(folder, percent), "ca long, cb long"), "ca", "cb")
    final = links.select(F.col("node").alias("comp"), F.col("component").alias("final"))
    return comps.join(final, "comp", "left").select(F.col("rep").alias("node"), F.coalesce("final", "comp").alias("component"))

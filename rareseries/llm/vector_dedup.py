"""Operator 10: near-duplicate vectors by dual traversal of cover trees; exact pairs at a cosine threshold.

Unit vectors at cosine c lie sqrt(2 - 2c) apart, so the threshold is a distance. The top level of the tree is a bounded
set of centres (farthest-first on a bounded sample); every vector goes to its nearest one. Cells whose centres are
further apart than the threshold and both covering radii never meet. A cell is dealt out to blocks of bounded size, so
a hot group is many blocks. Each block has a tree of nested levels with halving radii and is written once, to a file that the
tasks read it from, so that disk does not grow with the pairs of blocks; two blocks that must meet are traversed together, level by level: node pairs too far apart are dropped, node pairs wholly within the threshold are
counted at once without touching their members, and what is left is compared in double precision.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from rareseries.llm import textkernel as K
from rareseries.llm.common import components, cut, files, kept_groups, local_components, new_folder, read_group, written

#: Vectors in a block, on average.
BLOCK = 2048
#: Centres at the top at most, and sampled vectors for each (they go to the driver and to every task).
MAX_CENTRES = 512
SAMPLE_PER_CENTRE = 8
#: Blocks of a tile at most: the blocks of two tiles are read once for all their pairs. Tasks that pairs of tiles are dealt to at most.
MAX_TILE = 8
MAX_TASKS = 10_000
#: Radii of the levels inside a block, on unit vectors.
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
#: Bounds are taken with this slack, so single-precision rounding never decides.
SLACK = 1e-4


def _units(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length: (length, numbers of the rows that can link, their unit vectors). These are not null, finite, not zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for d in np.unique(size[size > 0]):
        at = np.flatnonzero(size == d)
        x = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), d)
        top = np.abs(x).max(axis=1)  # no overflow or underflow in the norm
        good = np.isfinite(x).all(axis=1) & (top > 0)
        x = x[good] / top[good, None]
        norm = np.array([math.sqrt(float(v @ v)) for v in x])
        yield int(d), at[good], x / norm[:, None]


def _unit_rows(batches):
    for batch in batches:
        for d, at, x in _units(batch.column("vec")):
            ids = batch.column("id").take(pa.array(at))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(at), d, dtype=np.int32)), pa.array([v.tobytes() for v in x], pa.binary())], ["id", "dim", "unit"])


def _lengths(batches):
    """Numbers of vectors that can link, by length."""
    n = Counter()
    for batch in batches:
        for d, at, _ in _units(batch.column("vec")):
            n[d] += len(at)
    yield pa.RecordBatch.from_arrays([pa.array([*n], pa.int32()), pa.array([*n.values()], pa.int64())], ["dim", "n"])


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Numbers of up to ``n`` rows, each the farthest from those before."""
    chosen = [0]
    far = 1 - x @ x[0]
    while len(chosen) < n and far.max() > 1e-6:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 1 - x @ x[chosen[-1]])
    return np.array(chosen)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T).argmax(axis=1)


def _sizes(batches, centres):
    """Numbers of vectors by length and nearest centre."""
    n = Counter()
    for batch in batches:
        for d, _, x in _units(batch.column("vec")):
            n.update((d, int(c)) for c in _nearest(x, centres.value[d]))
    yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in n], pa.int32()) for i in (0, 1)] + [pa.array([*n.values()], pa.int64())], ["dim", "cell", "n"])


def _deal(batches, centres, first, blocks):
    """Each vector with a block of its nearest centre's; the blocks of a centre follow one another from its first."""
    for batch in batches:
        for d, at, x in _units(batch.column("vec")):
            kept = batch.take(pa.array(at))
            cell = _nearest(x, centres.value[d])
            salt = K.mix(kept.column("id").to_numpy().astype(np.uint64)) % blocks[d][cell].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(first[d][cell] + salt.astype(np.int64)), kept.column("id"), kept.column("vec")], ["block", "id", "vec"])


def nested_levels(x: np.ndarray) -> np.ndarray:
    """For each row, its node's centre (a row number) at each level, root first.

    Level centres are nested and no two of a level lie within its radius; a centre hangs below the nearest centre of
    the level above, and a vector below the nearest centre of the last.
    """
    n = len(x)
    gap = np.sqrt(np.maximum(0, 2 - 2 * (x @ x.T)))
    sets = [np.array([0])]
    near = gap[0].copy()
    for r in RADII:
        have = list(sets[-1])
        while True:
            far = np.flatnonzero(near > r)
            if not len(far):
                break
            have.append(int(far[0]))
            near = np.minimum(near, gap[far[0]])
        sets.append(np.array(have))
    out = np.zeros((n, len(sets)), dtype=np.int32)
    out[:, -1] = sets[-1][gap[:, sets[-1]].argmin(axis=1)]
    for level in range(len(sets) - 2, -1, -1):
        below, above = sets[level + 1], sets[level]
        parent = np.zeros(n, dtype=np.int32)
        parent[below] = above[gap[np.ix_(below, above)].argmin(axis=1)]
        parent[above] = above
        out[:, level] = parent[out[:, level + 1]]
    return out


def _grow(key, group: pa.Table, centres, of) -> tuple[pa.Table, float]:
    """A block's rows with their nodes and, level by level, the covering radius of the node they lie in; the block's radius around its centre."""
    ((d, _, x),) = _units(group.column("vec"))
    levels = nested_levels(x)
    radii = np.zeros(levels.shape)
    for level in range(levels.shape[1]):
        widest = np.zeros(len(x))
        np.maximum.at(widest, levels[:, level], np.linalg.norm(x - x[levels[:, level]], axis=1))
        radii[:, level] = widest[levels[:, level]]
    out = group.select(["id", "vec"]).append_column("nodes", pa.array(levels.tolist(), pa.list_(pa.int32())))
    centre = centres.value[d][of[key[0]][1]]
    return out.append_column("radii", pa.array(radii.tolist(), pa.list_(pa.float64()))), float(np.linalg.norm(x - centre, axis=1).max())


class _Tree:
    def __init__(self, group: pa.Table):
        flat = lambda c: group.column(c).combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        ((_, _, self.x),) = _units(group.column("vec"))
        self.ids = group.column("id").to_numpy()
        self.x32 = self.x.astype(np.float32)
        nodes, radii = flat("nodes"), flat("radii")
        self.levels = []  # (centre rows, node number of each vector, radius, size)
        for level in range(nodes.shape[1]):
            centre, node = np.unique(nodes[:, level], return_inverse=True)
            self.levels.append((centre, node, radii[centre, level], np.bincount(node)))
        every = np.arange(len(self.ids))
        self.levels.append((every, every, np.zeros(len(every)), np.ones(len(every), dtype=np.int64)))

    def parents(self, level: int, above: int) -> np.ndarray:
        """Of each node of a level, its node in a level above."""
        centre, node, _, _ = self.levels[level]
        up = np.zeros(len(centre), dtype=np.int64)
        up[node] = self.levels[above][1]
        return up


def _linked(a: _Tree, b: _Tree, rows: np.ndarray, cols: np.ndarray, alive: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of these vectors that link, in double precision; where few are near the threshold, only those are multiplied so."""
    near = a.x32[rows] @ b.x32[cols].T >= np.float32(threshold - SLACK)
    near &= alive
    busy = np.flatnonzero(near.any(axis=1))
    i, j = np.nonzero(near[busy])
    i = busy[i]
    if 64 * len(i) > near.size:
        i, j = np.nonzero(near & (a.x[rows] @ b.x[cols].T >= threshold))
    else:
        hit = np.einsum("ij,ij->i", a.x[rows[i]], b.x[cols[j]]) >= threshold
        i, j = i[hit], j[hit]
    return rows[i], cols[j]


def traverse(a: _Tree, b: _Tree, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of each row of a, of b, and linking edges as rows of a and of b), with members of bulk pairs as stars.

    Inner levels take centre distances in single precision with SLACK on the safe side; a distance bound g is a
    bound 1 - g^2 / 2 of the dot product. Only single vectors, in double precision, decide near the threshold. Levels with
    more than half as many pairs of nodes as there are pairs of vectors are passed over, as the vectors themselves cost no more.
    """
    limit = math.sqrt(max(0.0, 2 - 2 * threshold))
    links_a, links_b = np.zeros(len(a.ids), dtype=np.int64), np.zeros(len(b.ids), dtype=np.int64)
    u, v = [], []
    rows, cols = np.arange(len(a.levels[0][0])), np.arange(len(b.levels[0][0]))
    alive = np.ones((len(rows), len(cols)), dtype=bool)
    last = len(a.levels) - 1
    above, level = 0, 0
    while True:
        if level:
            up_a, up_b = a.parents(level, above), b.parents(level, above)
            at_a, at_b = np.full(len(a.levels[above][0]), -1), np.full(len(b.levels[above][0]), -1)
            at_a[rows], at_b[cols] = np.arange(len(rows)), np.arange(len(cols))
            rows, cols = np.flatnonzero(at_a[up_a] >= 0), np.flatnonzero(at_b[up_b] >= 0)
            alive = np.ones((len(rows), len(cols)), dtype=bool) if alive.all() else alive[np.ix_(at_a[up_a[rows]], at_b[up_b[cols]])]
        ca, na, ra, sa = a.levels[level]
        cb, nb, rb, sb = b.levels[level]
        if level == last:
            i, j = _linked(a, b, rows, cols, alive, threshold)
            other = a.ids[i] != b.ids[j]  # neither itself nor a row that repeats its id
            i, j = i[other], j[other]
            np.add.at(links_a, i, 1)
            np.add.at(links_b, j, 1)
            u.append(i)
            v.append(j)
            break
        dot = a.x32[ca[rows]] @ b.x32[cb[cols]].T
        bound = np.add.outer(ra[rows].astype(np.float32), (rb[cols] + limit + SLACK).astype(np.float32))
        bound *= bound
        bound *= np.float32(0.5)
        bound += dot
        i, j = np.nonzero(alive & (bound >= np.float32(1 - SLACK)))
        reach = ra[rows[i]] + rb[cols[j]]
        room = limit - reach - SLACK
        whole = (room > 0) & (dot[i, j] >= 1 - room * room / 2 + SLACK)
        if same:
            whole &= rows[i] != cols[j]  # a node with itself goes on, for its own pairs
        if whole.any():
            p, q = rows[i[whole]], cols[j[whole]]
            links_a += np.bincount(p, weights=sb[q], minlength=len(ca)).astype(np.int64)[na]
            links_b += np.bincount(q, weights=sa[p], minlength=len(cb)).astype(np.int64)[nb]
            # the centres' pairs, and one partner for every member, keep the components
            u.append(ca[p])
            v.append(cb[q])
            first = np.full(len(ca), -1)
            first[p] = cb[q]
            hit = np.flatnonzero(first[na] >= 0)
            u.append(hit)
            v.append(first[na[hit]])
            first = np.full(len(cb), -1)
            first[q] = ca[p]
            hit = np.flatnonzero(first[nb] >= 0)
            u.append(first[nb[hit]])
            v.append(hit)
            i, j = i[~whole], j[~whole]
        if not len(i):
            break
        keep_a, keep_b = np.unique(i), np.unique(j)
        alive = np.zeros((len(keep_a), len(keep_b)), dtype=bool)
        alive[np.searchsorted(keep_a, i), np.searchsorted(keep_b, j)] = True
        rows, cols = rows[keep_a], cols[keep_b]
        above, level = level, level + 1
        if 2 * len(a.levels[level][0]) * len(b.levels[level][0]) > len(a.ids) * len(b.ids):
            level = last
    cat = lambda x: np.concatenate([np.zeros(0, dtype=np.int64), *x])
    return links_a, links_b, cat(u), cat(v)


def _meet(a: _Tree, b: _Tree, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links and local components of a pair of blocks: (id, links, root) of each vector that links."""
    links_a, links_b, u, v = traverse(a, b, threshold, same)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    links = links_a if same else np.concatenate([links_a, links_b])
    names, place = np.unique(ids, return_inverse=True)
    label = local_components(place[u], place[v if same else v + len(a.ids)], len(names))
    hit = links > 0
    return ids[hit], links[hit], names[label[place[hit]]]


def _meet_tiles(batches, root: str, tile: int, shared, threshold: float):
    """Of each pair of tiles, one row for each vector that links; a tile is a run of blocks, which are read from their files."""
    fs, folder = files(root)
    places, of, near = shared.value
    trees = {}

    def tree(block: int) -> _Tree:
        trees[block] = found = trees.pop(block, None) or _Tree(read_group(fs, folder, *places[block]))
        if len(trees) > 2 * tile:
            del trees[next(iter(trees))]
        return found

    for batch in batches:
        for s, t in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist(), strict=True):
            met = []
            for left in range(s * tile, min((s + 1) * tile, len(of))):
                for right in range(max(left, t * tile), min((t + 1) * tile, len(of))):
                    if left in places and right in places and (of[left], of[right]) in near:
                        met.append(_meet(tree(left), tree(right), left == right, threshold))
            if met:
                ids, links, roots = (np.concatenate(x) for x in zip(*met, strict=True))
                names, place = np.unique(np.concatenate([ids, roots]), return_inverse=True)
                label = local_components(place[: len(ids)], place[len(ids) :], len(names))
                total = np.bincount(place[: len(ids)], weights=links, minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total), pa.array(names[label])], ["id", "links", "root"])


def vector_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept (the id is its component's smallest).

    Vectors link if their cosine, in double precision, is at least ``threshold``. Vectors that are null, empty or zero, or
    that hold null or non-finite components, link with nothing, nor do vectors of different lengths, or rows with a null
    id (their component_id is null and kept false). Rows that repeat an id are vectors of their own. Other columns are ignored.
    """
    spark = vectors.sparkSession
    # rows are told apart by a key that is written once: those of a repeated id spread over the blocks like others
    vec = F.col(vec_col) if vectors.schema[vec_col].dataType == ArrayType(FloatType()) else F.col(vec_col).cast("array<double>")
    keyed = written(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("name"), vec.alias("vec")))
    rows = keyed.where("name is not null").select(F.col("row").alias("id"), "vec")
    dims = {r["dim"]: r["n"] for r in rows.mapInArrow(_lengths, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    units = rows.mapInArrow(_unit_rows, "id long, dim int, unit binary")
    centres = {}
    for dim, n in dims.items():
        want = min(MAX_CENTRES, math.ceil(n / BLOCK))
        sample = units.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "unit").limit(want * SAMPLE_PER_CENTRE).select("unit").collect()
        x = np.frombuffer(b"".join(bytes(r[0]) for r in sample), dtype=np.float64).reshape(len(sample), -1)
        centres[dim] = x[farthest_first(x, want)]
    shared = spark.sparkContext.broadcast(centres)
    sizes = rows.mapInArrow(partial(_sizes, centres=shared), "dim int, cell int, n long").groupBy("dim", "cell").agg(F.sum("n").alias("n"))
    members = {(r["dim"], r["cell"]): r["n"] for r in sizes.collect()}
    blocks = {d: np.array([max(1, math.ceil(members.get((d, c), 0) / BLOCK)) for c in range(len(x))]) for d, x in centres.items()}
    of = [(d, c) for d in centres for c, m in enumerate(blocks[d]) for _ in range(m)]  # of each block its centre
    ends = np.cumsum([0, *(m for d in centres for m in blocks[d])])[:-1].astype(np.int64)
    first = dict(zip(centres, np.split(ends, np.cumsum([len(b) for b in blocks.values()])[:-1]), strict=True)) if centres else {}
    root = new_folder(spark)
    dealt = rows.mapInArrow(partial(_deal, centres=shared, first=first, blocks=blocks), StructType([StructField("block", LongType()), *rows.schema.fields]))
    places, radius = {}, defaultdict(float)
    for r in kept_groups(dealt, root, "block", made=partial(_grow, centres=shared, of=of)).toLocalIterator():
        places[r["block"]] = r["file"], r["at"], r["size"]
        radius[of[r["block"]]] = max(radius[of[r["block"]]], r["width"])

    # cells that meet, and the pairs of tiles (runs of blocks) that hold blocks of such
    limit = math.sqrt(max(0.0, 2 - 2 * threshold))
    near = set()
    for d, x in centres.items():
        gap = np.sqrt(np.maximum(0, 2 - 2 * (x @ x.T)))
        r = np.array([radius.get((d, c), -np.inf) for c in range(len(x))])
        near.update(((d, int(c)), (d, int(o))) for c, o in zip(*np.nonzero(np.triu(gap - r[:, None] - r <= limit + SLACK)), strict=True))
    tile = min(MAX_TILE, max(1, len(of) // 32))
    spans = {(d, c): (int(first[d][c]) // tile, int(first[d][c] + blocks[d][c] - 1) // tile) for d in centres for c in range(len(blocks[d]))}
    pairs = spark.createDataFrame([(*spans[a], *spans[b]) for a, b in near], "s int, s_end int, t int, t_end int")
    pairs = pairs.select(F.explode(F.sequence("s", "s_end")).alias("s"), "t", "t_end").select("s", F.explode(F.sequence("t", "t_end")).alias("t"))
    pairs = cut(pairs.where("s <= t").distinct())
    tasks = min(MAX_TASKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs.count() / 8)))
    meets = pairs.repartition(tasks, "s", "t").sortWithinPartitions("s", "t")
    known = spark.sparkContext.broadcast((places, of, near))
    found = written(meets.mapInArrow(partial(_meet_tiles, root=root, tile=tile, shared=known, threshold=threshold), "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    groups = cut(groups.withColumnRenamed("component_id", "component"))
    named = keyed.select(F.col("row").alias("id"), "name")
    least = groups.join(named, "id").groupBy("component").agg(F.min("name").alias("least"))
    out = named.join(links, "id", "left").join(groups, "id", "left").join(least, "component", "left")
    out = out.select(F.col("name").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("least", "name").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))

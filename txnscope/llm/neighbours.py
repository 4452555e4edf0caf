"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node of the graph. A tree of random hyperplanes, fitted on a bounded sample and, in larger tables,
cut on level by level at the quantiles of random projections, deals all nodes out to blocks that one task holds. In a block the
nearest pairs of small groups start the graph, then neighbours of neighbours are joined: the members of each node's
neighbourhood (its nearest neighbours and the nearest nodes that point to it) are compared with each other and every node
keeps its nearest, until the block's graph hardly changes. A second tree deals the nodes out anew, with their neighbours, and
the descent goes on in its blocks, which links the blocks of the first. A node's number names its block of the first tree.

A block's vectors and edges then are one row, its shelf. A query starts at its own node and moves along the graph: in each
block that holds nodes of its beam not expanded yet, or neighbours of such nodes, it goes on until nothing nearer turns up
there; the edges that leave the block are followed in the next round, until no query has any left. For some queries a scan
of all nodes tells the recall; they search first, and while it is too low their beam is doubled and expanded again.
All queries then search with that beam. What is passed between blocks are numbers, never other nodes' vectors, so time and
disk follow the table. The nearest nodes of the beam are measured in double precision from the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from txnscope.session import scratch_path

RESULTS = 10
DEGREE = 32  # neighbours kept per node
BEAM = 160  # nodes kept per query, doubled while the measured recall is too low
MEASURED = 128  # queries whose recall is measured
TARGET = 0.93  # a margin over 0.9 for the error of the measured recall
SAMPLE = 8192  # nodes, about, that the hyperplanes are fitted on; all nodes are dealt out
SLABS = 8  # parts that a leaf that is still too large is cut into, at the quantiles of a random projection
LEVELS = 14  # of such cuts, more than any table needs
LEAF_SAMPLE = 32  # fewest sampled nodes of a leaf
BLOCK = 16384  # nodes of a block, about; one task holds its vectors and edges
HELD = 1 << 16  # most nodes whose edges are packed together
GROUP = 1024  # nodes whose nearest pairs start a block's graph, at most
STARTS = 2  # times that a block is cut into groups
QUERIES = 2048  # about the most queries whose distances to the nodes of one block are measured together
WAVES = 2  # parts of the queries that search one after the other, in larger tables
BUCKET = 128  # queries, about, whose beams are merged together
WALKED = 192  # queries that walk through a block at once, 256 at most
FINAL = 2 * RESULTS + 12  # nodes of a beam that are measured in double precision
SETTLED = 0.006  # the descent ends when the summed distances fall by less than this share
ROUNDS = 12  # and after this many rounds at the latest
SHIFT = 20  # a node's number is its block's, shifted, and its place there

NONE = np.uint64((1 << 48) - 1)  # no edge
LOW16, LOW32 = np.uint64(0xFFFF), np.uint64(0xFFFFFFFF)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    spark.sparkContext._jvm.System.gc()  # shuffle files of earlier queries stay until the driver collects its garbage
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _discarded(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for name in {f.rpartition("/")[0] for t in tables for f in t.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def vector_kind(rows: DataFrame, vector_col: str = "embedding") -> type:
    """float32 if the vectors' components are, else float64."""
    kind = rows.schema[vector_col].dataType
    return np.float32 if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else np.float64


def usable_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", kind: type = np.float64) -> DataFrame:
    """vec_id and x (components as bytes) of rows with an id and a finite vector that is not zero, each once."""
    element = "float" if kind is np.float32 else "double"
    v = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast(f"array<{element}>").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype(kind, copy=False)
            good = np.concatenate([[0], np.cumsum(np.isfinite(values))])[ends]
            some = np.concatenate([[0], np.cumsum(values != 0)])[ends]
            whole = (np.diff(good) == np.diff(ends)) & (np.diff(some) > 0)
            sizes = np.diff(ends)[whole].astype(np.int64) * values.itemsize
            if not whole.all():
                values = values[ends[0] : ends[-1]][np.repeat(whole, np.diff(ends))]
            else:
                values = values[ends[0] : ends[-1]]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(whole)), packed], names=["vec_id", "x"])

    return v.where("vec_id IS NOT NULL AND size(v) > 0").mapInArrow(pack, "vec_id long, x binary").distinct()


def _ends(chunk: pa.Array) -> np.ndarray:
    """Where a binary array's values start in its bytes, and the end of the last."""
    wide = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
    return np.frombuffer(chunk.buffers()[1], wide)[chunk.offset : chunk.offset + len(chunk) + 1]


def _bytes(column) -> np.ndarray:
    """The bytes of a binary column's values, one after the other."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            ends = _ends(chunk)
            if ends[-1] > ends[0]:
                parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint8), *parts])


def _matrix(column, kind: type = np.float32, stored: type = np.float64) -> np.ndarray:
    return np.frombuffer(_bytes(column).tobytes(), stored).reshape(len(column), -1).astype(kind, copy=False)


def _rows_of_bytes(values: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix."""
    flat = np.ascontiguousarray(values).reshape(len(values), -1).view(np.uint8)
    offsets = (np.arange(len(flat) + 1, dtype=np.int64) * flat.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _shorter(d: np.ndarray) -> np.ndarray:
    """Distances with 7 bits after the first, enough to tell which neighbours to keep."""
    return np.where(np.isfinite(d), (d.view(np.uint32) >> np.uint32(16)) + np.uint32(1), np.uint32(0x7F80)).astype(np.uint16)


def _longer(short: np.ndarray) -> np.ndarray:
    return (short.astype(np.uint32) << np.uint32(16)).view(np.float32)


def _planes(numbers: np.ndarray) -> np.ndarray:
    """Each row of 64-bit numbers as its bytes, the lowest of all first: those of numbers from few blocks are compressed well."""
    return np.ascontiguousarray(numbers.astype("<i8").reshape(len(numbers), -1, 1).view(np.uint8).transpose(0, 2, 1)).reshape(len(numbers), -1)


def _numbers(column) -> np.ndarray:
    """What _planes() made bytes of."""
    flat = _bytes(column).reshape(len(column), 8, -1)
    return np.ascontiguousarray(flat.transpose(0, 2, 1)).view("<i8")[:, :, 0]


class PlaneTree:
    """Hyperplanes between two random sampled vectors, cut at the sample's median."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        self.depth = depth
        self.normals = np.zeros((2**depth - 1, sample.shape[1]), np.float32)
        self.cuts = np.zeros(2**depth - 1, np.float32)
        held = {0: np.arange(len(sample))}
        for at in range(2**depth - 1):
            rows = held.pop(at)
            if len(rows) > 1:
                a, b = rng.choice(rows, 2, replace=False)
                self.normals[at] = sample[a] - sample[b]
                side = sample[rows] @ self.normals[at]
                self.cuts[at] = np.median(side)
                low, high = rows[side < self.cuts[at]], rows[side >= self.cuts[at]]
            else:
                low, high = rows, rows[:0]
            held[2 * at + 1], held[2 * at + 2] = low, high

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", x, self.normals[at]) >= self.cuts[at]
            at = 2 * at + 1 + side
        return at - (2**self.depth - 1)


def _dealt(nodes: DataFrame, tree: PlaneTree, seed: int, kind: type = np.float64) -> DataFrame:
    """The nodes with a block each: their leaf, cut on along random directions while it is too large."""

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = tree.leaves(_matrix(batch.column(batch.schema.get_field_index("x")), stored=kind))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], names=[*batch.schema.names, "block"])

    placed = nodes.mapInArrow(leaf, _with(nodes.schema, "block long"))
    for level in range(LEVELS):
        large = placed.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > 2 * BLOCK)
        if large.isEmpty():
            break
        placed = _stored(nodes.sparkSession, _cut(placed, large, seed * LEVELS + level, kind), "dealt")
    return placed


def _cut(placed: DataFrame, large: DataFrame, seed: int, kind: type) -> DataFrame:
    """Blocks renumbered, those in ``large`` cut into up to SLABS parts at the quantiles of a projection of their own."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, block = _matrix(batch.column(batch.schema.get_field_index("x")), stored=kind), batch.column("block").to_numpy()
                side = np.empty(len(block))
                for b in np.unique(block):
                    side[block == b] = x[block == b] @ np.random.default_rng([seed, int(b)]).standard_normal(x.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(side)], names=[*batch.schema.names, "side"])

    sided = placed.mapInArrow(project, _with(placed.schema, "side double"))
    cuts = [k / SLABS for k in range(1, SLABS)]
    bounds = sided.join(large, "block").groupBy("block").agg(
        F.percentile_approx("side", cuts).alias("cuts"), F.least(F.lit(SLABS), F.ceil(F.first("n") / F.lit(BLOCK))).alias("parts")
    )
    slab = F.expr(f"coalesce(CAST(floor(size(filter(cuts, c -> c < side)) * parts / {SLABS}) AS BIGINT), 0L)")
    return sided.join(bounds, "block", "left").select(*placed.drop("block").columns, (F.col("block") * SLABS + slab).alias("block"))


def _with(schema, extra: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema), extra])


def _packed(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Edges of a block as numbers that sort by u, d and v. The same pair may be measured with a slightly different
    rounding, so a distance has 13 bits after the first."""
    bits = ((d.astype(np.float32, copy=False).view(np.uint32) + np.uint32(512)) >> np.uint32(10)) << np.uint32(10)
    return (u.astype(np.uint64) << np.uint64(48)) | (bits.astype(np.uint64) << np.uint64(16)) | v.astype(np.uint64)


def _ranks(groups: np.ndarray, count: int) -> np.ndarray:
    """The place of each element within its group; groups are sorted."""
    sizes = np.bincount(groups, minlength=count)
    return np.arange(len(groups)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _lists(keys: np.ndarray, n: int, width: int, spare: int = 8) -> np.ndarray:
    """The ``width`` nearest neighbours of n nodes, each once, as a matrix of packed d and v, from packed edges."""
    keys.sort()
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    ends = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(48) if n < HELD else np.append(np.arange(n, dtype=np.uint64) << np.uint64(48), ~np.uint64(0)))
    at = ends[:-1, None] + np.arange(width + spare)
    rows = np.full(at.shape, NONE)
    held = at < ends[1:, None]
    rows[held] = keys[at[held]] & NONE
    # a neighbour whose distance was rounded in two ways
    by = ((rows & LOW16) << np.uint64(32)) | (rows >> np.uint64(16))
    by.sort(axis=1)
    again = (by[:, 1:] >> np.uint64(32)) == (by[:, :-1] >> np.uint64(32))
    by[:, 1:][again] = (LOW16 << np.uint64(32)) | LOW32
    rows = ((by & LOW32) << np.uint64(16)) | (by >> np.uint64(32))
    rows.sort(axis=1)
    return rows[:, :width]


def _unpacked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, -1 for none, and squared distances, infinite for none."""
    d = (rows >> np.uint64(16)).astype(np.uint32).view(np.float32).copy()
    v = (rows & LOW16).astype(np.int32)
    d[rows == NONE], v[rows == NONE] = np.inf, -1
    return v, d


def _edges_of(rows: np.ndarray) -> np.ndarray:
    u, k = np.nonzero(rows != NONE)
    return (u.astype(np.uint64) << np.uint64(48)) | rows[u, k]


def _groups(x: np.ndarray, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The rows cut in halves between two random ones, again and again, into groups of at most ``size``."""
    found, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            found.append(at)
            continue
        a, b = rng.choice(len(at), 2, replace=False)
        by, half = np.argpartition(x[at] @ (x[at[a]] - x[at[b]]), len(at) // 2), len(at) // 2
        todo += [at[by[:half]], at[by[half:]]]
    return found


def _nearest(x: np.ndarray, at: np.ndarray, square: np.ndarray, degree: int) -> np.ndarray:
    """The edges of the rows ``at`` to about ``degree`` nearest others of them, at least."""
    y, s = x[at], square[at]
    d = y @ y.T
    d *= -2
    d += s[:, None]
    d += s[None, :]
    np.maximum(d, 0, out=d)
    np.fill_diagonal(d, np.inf)
    n, count = len(at), min(degree, len(at) - 1)
    if count <= 0:
        return np.zeros(0, np.uint64)
    if n > 16 * degree:  # a bound from some columns that leaves twice as many as are kept
        some = d[:, :: n // (8 * degree)]
        bound = np.partition(some, degree // 4, axis=1)[:, degree // 4]
        z = np.flatnonzero(d <= bound[:, None])
        few = np.flatnonzero(np.bincount(z // n, minlength=n) < count)
        near = np.argpartition(d[few], count - 1, axis=1)[:, :count]
        z = np.concatenate([z, (few[:, None] * n + near).ravel()])
        return _packed(at[z // n], at[z % n], d.ravel()[z])
    near = np.argpartition(d, count - 1, axis=1)[:, :count]
    return _packed(np.repeat(at, count), at[near].ravel(), np.take_along_axis(d, near, axis=1).ravel())


def _joined(x: np.ndarray, square: np.ndarray, rows: np.ndarray, before: np.ndarray | None, worst: np.ndarray) -> np.ndarray:
    """Edges found by comparing the members of each node's neighbourhood with those that are new in it.

    ``worst`` are the distances that a node's new neighbours must fall below."""
    n, degree = rows.shape
    v, _ = _unpacked(rows)
    new = v >= 0
    if before is not None:
        now, old = (rows & LOW16).astype(np.uint16), (before & LOW16).astype(np.uint16)
        for a in range(0, n, 4096):
            new[a : a + 4096] &= ~(now[a : a + 4096, :, None] == old[a : a + 4096, None, :]).any(axis=2)
    u, k = np.nonzero(v >= 0)
    # the nearest nodes that point to a node: v, d, u and whether the edge is new
    back = (v[u, k].astype(np.uint64) << np.uint64(48)) | ((rows[u, k] >> np.uint64(16)) << np.uint64(17)) | (u.astype(np.uint64) << np.uint64(1)) | new[u, k]
    back.sort()
    w = (back >> np.uint64(48)).astype(np.int64)
    rank = _ranks(w, n)
    keep = np.flatnonzero(rank < degree)
    to, back = w[keep] * degree + rank[keep], back[keep]
    pointing, fresh = np.full(n * degree, -1, np.int32), np.zeros(n * degree, bool)
    pointing[to], fresh[to] = (back >> np.uint64(1)) & LOW16, back & np.uint64(1)
    pointing, fresh = pointing.reshape(n, -1), fresh.reshape(n, -1)
    for a in range(0, n, 4096):  # members once each
        pointing[a : a + 4096][(pointing[a : a + 4096, :, None] == v[a : a + 4096, None, :]).any(axis=2)] = -1
    members = np.concatenate([np.arange(n, dtype=np.int32)[:, None], v, pointing], axis=1)
    rank = np.concatenate([np.ones((n, 1), bool), ~new, ~fresh], axis=1).astype(np.uint8)
    rank[members < 0] = 2
    members = np.take_along_axis(members, np.argsort(rank, axis=1, kind="stable"), axis=1)  # the new ones first
    young, count = (rank == 0).sum(axis=1), (rank < 2).sum(axis=1)
    # place -1: a node that is infinitely far and takes no neighbour
    x, square, worst = np.concatenate([x, x[:1] * 0]), np.append(square, np.float32(np.inf)), np.append(worst, np.float32(-1))
    todo, found = np.lexsort((count, young)), [np.zeros(0, np.uint64)]
    todo = todo[young[todo] > 0]
    for a in range(0, len(todo), 512):
        part = todo[a : a + 512]
        m, y = count[part].max(), young[part[-1]]
        at = members[part, :m]
        g, s = x.take(at, axis=0), square[at]
        d = np.matmul(g[:, :y], g.transpose(0, 2, 1))
        d *= -2
        d += s[:, :y, None]
        d += s[:, None, :]
        limit = worst[at]
        z = np.flatnonzero(d < limit[:, :y, None])
        i, j = z // m, z % m
        one, other, apart = at[:, :y].ravel()[i], at.ravel()[i // y * m + j], d.ravel()[z]
        if y < m:  # and the other way from members that are not new
            rest = np.ascontiguousarray(d[:, :, y:])
            z = np.flatnonzero(rest < limit[:, None, y:])
            i, j = z // (m - y), z % (m - y) + y
            one, other = np.concatenate([one, at.ravel()[i // y * m + j]]), np.concatenate([other, at[:, :y].ravel()[i]])
            apart = np.concatenate([apart, rest.ravel()[z]])
        two = one != other
        found.append(_packed(one[two], other[two], np.maximum(apart[two], 0)))
    return np.concatenate(found)


def _descended(x: np.ndarray, rng: np.random.Generator, given: np.ndarray, far: np.ndarray, degree: int, rounds: int) -> np.ndarray:
    """The neighbour lists in a block: the nearest pairs of groups and ``given`` edges, then neighbours of neighbours.

    ``far`` holds the distances of neighbours that a node has in other blocks already; a list is as long as those
    leave room among the ``degree`` nearest of both."""
    n = len(x)
    x = x - x.mean(axis=0)
    square = np.einsum("ij,ij->i", x, x)
    keys = [_nearest(x, at, square, degree) for _ in range(STARTS if n > GROUP else 1) for at in _groups(x, GROUP, rng)]

    def cut(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, float]]:
        d = _unpacked(rows)[1]
        both = np.sort(np.concatenate([d, far], axis=1), axis=1)[:, :degree]
        rows = np.where(d <= both[:, -1:], rows, NONE)
        held = np.isfinite(both)
        return rows, both[:, -1], (int(held.sum()), float(both[held].sum(dtype=np.float64)))

    rows, worst, total = cut(_lists(np.concatenate([*keys, given]), n, degree))
    before = None
    for _ in range(rounds if n > GROUP else 0):
        found = _joined(x, square, rows, before, worst)
        before, last = rows, total
        rows, worst, total = cut(_lists(np.concatenate([_edges_of(rows), found]), n, degree))
        if last[0] == total[0] and last[1] - total[1] <= SETTLED * last[1]:
            break
    return rows


def _linked(table: pa.Table, kind: type, seed: int, degree: int, rounds: int) -> pa.Table:
    """A block's nodes with their nearest nodes: those in the block and, after the first deal, those known already."""
    first = "node" not in table.column_names
    table = table.sort_by("x" if first else "node")
    block, x = table.column("block")[0].as_py(), _matrix(table.column("x"), stored=kind)
    ids = (block << SHIFT) + np.arange(len(x)) if first else table.column("node").to_numpy()
    near, dist = np.full((len(x), degree), -1, np.int64), np.full((len(x), degree), np.inf, np.float32)
    if not first:
        near[:], dist[:] = _numbers(table.column("near")), _longer(_matrix(table.column("d"), np.uint16, np.uint16))
    for a in range(0, len(x), HELD):  # one part, but for blocks that no projection could cut
        part = slice(a, a + HELD)
        own, v, d = ids[part], near[part], dist[part].copy()
        place = np.minimum(np.searchsorted(own, v), len(own) - 1)
        local = own[place] == v
        u, k = np.nonzero(local)
        d[local] = np.inf
        rows = _descended(x[part], np.random.default_rng([seed, block]), _packed(u, place[u, k], dist[part][u, k]), d, degree, rounds)
        at, here = _unpacked(rows)
        found = np.where(at >= 0, own[at], -1)
        both, v = np.concatenate([here, d], axis=1), np.concatenate([found, np.where(local, -1, v)], axis=1)
        by = np.argsort(both, axis=1, kind="stable")[:, :degree]
        near[part], dist[part] = np.take_along_axis(v, by, axis=1), np.take_along_axis(both, by, axis=1)
    pa.default_memory_pool().release_unused()  # other tasks' workers share the executor's memory
    lists = {"node": pa.array(ids), "x": table.column("x"), "near": _rows_of_bytes(_planes(near))}
    return pa.table(lists | ({"d": _rows_of_bytes(_shorter(dist))} | {c: table.column(c) for c in ("ids", "asked")} if first else {}))


def _best(edges: DataFrame, node: str, other: str, count: int) -> DataFrame:
    order = Window.partitionBy(node).orderBy("d", other)
    return edges.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= count).drop("_n")


def _block(node: str):
    return F.shiftright(node, SHIFT)


def _shelved(table: pa.Table, kind: type, degree: int) -> pa.Table:
    """One row of a block: its vectors by place, for each place the neighbours in the block both ways, and those in others."""
    table = table.sort_by("node")
    near = _numbers(table.column("near"))
    block, n = int(table.column("node")[0].as_py()) >> SHIFT, len(near)
    u, k = np.nonzero(near >= 0)
    v = near[u, k]
    own = (v >> SHIFT) == block
    far_u, far_v = u[~own], v[~own]
    u, v, k = u[own], v[own] & ((1 << SHIFT) - 1), k[own]
    by = np.lexsort((u, k, v))  # the nodes that name it first
    by = by[_ranks(v[by], n) < degree]
    pairs = np.unique(np.concatenate([u * n + v, v[by] * n + u[by]]))
    sizes = [np.cumsum(np.bincount(w, minlength=n)).astype(np.int32).tobytes() for w in (pairs // n, far_u)]
    return pa.table(
        {
            "block": pa.array([block]),
            "x": pa.array([_bytes(table.column("x")).tobytes()], pa.binary()),
            "ends": pa.array([sizes[0]], pa.binary()),
            "to": pa.array([(pairs % n).astype(np.uint16 if n <= HELD else np.int32).tobytes()], pa.binary()),
            "far_ends": pa.array([sizes[1]], pa.binary()),
            "far": pa.array([_planes(far_v[None, :]).tobytes()], pa.binary()),
        }
    )


def vector_classes(rows: DataFrame, every: int) -> DataFrame:
    """x, ids (the smallest RESULTS + 1 vec_ids of the vector) and asked: whether ``every`` divides one of its vec_ids."""
    classes = _best(rows.select("x", "vec_id", F.lit(0).alias("d")), "x", "vec_id", RESULTS + 1)
    classes = classes.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(F.col("vec_id") % every == 0).select("x").distinct().withColumn("asked", F.lit(True))
    return classes.join(asked, "x", "left").withColumn("asked", F.col("asked").isNotNull())


def build_graph(spark: SparkSession, rows: DataFrame, kind: type = np.float64, every: int = 100) -> tuple[DataFrame, DataFrame]:
    """Nodes and shelves of usable rows: see graph_of()."""
    return graph_of(spark, _stored(spark, vector_classes(rows, every), "classes"), kind)


def graph_of(spark: SparkSession, classes: DataFrame, kind: type) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, and the columns of their stored classes) and shelves (a row for each block, see _shelved())."""
    count = classes.count()
    # nodes are distinct, so a bound on their hash samples about SAMPLE of them without a sort
    near = F.pmod(F.xxhash64("x"), F.lit(1 << 40)) <= (1 << 40) * min(1.0, SAMPLE / max(count, 1))
    sample = sorted(bytes(r["x"]) for r in classes.where(near).select("x").collect())
    sample = np.array([np.frombuffer(x, kind) for x in sample], np.float32) if sample else np.zeros((0, 1), np.float32)
    # the depth whose leaves are nearest to BLOCK: the more blocks, the more of them a query has to visit
    depth = round(math.log2(max(1, min(count / BLOCK, len(sample) / LEAF_SAMPLE))))
    degree, rounds = DEGREE, ROUNDS

    def link(table: pa.Table) -> pa.Table:
        return _linked(table, kind, 1, degree, rounds)

    def relink(table: pa.Table) -> pa.Table:
        return _linked(table, kind, 2, degree, rounds)

    def shelve(table: pa.Table) -> pa.Table:
        return _shelved(table, kind, degree)

    linked = "node long, x binary, near binary"
    nodes = _dealt(classes, PlaneTree(sample, depth, 1), 1, kind).groupBy("block").applyInArrow(link, f"{linked}, d binary, ids array<long>, asked boolean")
    nodes = _stored(spark, nodes, "nodes")
    _discarded(spark, classes)
    lists = nodes.select("node", "x", "near", "d")
    if depth:
        lists = _dealt(lists, PlaneTree(sample, depth, 2), 2, kind).groupBy("block").applyInArrow(relink, linked)
    shelves = _stored(spark, lists.withColumn("block", _block("node")).groupBy("block").applyInArrow(shelve, SHELF), "shelves")
    plain = _stored(spark, nodes.select("node", "x", "ids", "asked"), "plain")
    _discarded(spark, nodes)
    return plain, shelves


def _distances(pairs: pa.Table, vectors: pa.Table, kind: type) -> pa.Table:
    if not pairs.num_rows:
        return pa.table({"q": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
    ids = vectors.column("id").to_numpy()
    order = np.argsort(ids)
    ids, raw = ids[order], _matrix(vectors.column("vec"), np.float64, kind)[order]
    q, v = (np.searchsorted(ids, pairs.column(c).to_numpy()) for c in ("q", "v"))
    d = np.empty(len(q))
    for a in range(0, len(q), 1 << 14):
        d[a : a + (1 << 14)] = ((raw[q[a : a + (1 << 14)]] - raw[v[a : a + (1 << 14)]]) ** 2).sum(axis=1)
    return pa.table({"q": pairs.column("q"), "v": pairs.column("v"), "d": pa.array(d)})


def _by_block(pairs: DataFrame, slices: int) -> DataFrame:
    """Pairs (q, v) with the block of v and a slice of the queries, which are measured together."""
    return pairs.select(_block("v").alias("block"), F.pmod(F.xxhash64("q"), F.lit(slices)).alias("slice"), "q", "v")


def _wanted(pairs: DataFrame) -> DataFrame:
    """The nodes x whose vectors each block and slice needs: its own measured ones and the queries."""
    return pairs.select("block", "slice", F.explode(F.array("q", "v")).alias("x")).distinct()


def _measured(nodes: DataFrame, pairs: DataFrame, slices: int = 1, kind: type = np.float64) -> DataFrame:
    """Squared distances, in double precision, of pairs (q, v) of nodes."""
    pairs = _by_block(pairs, slices)
    vectors = _wanted(pairs).join(nodes.select(F.col("node").alias("x"), F.col("x").alias("vec")), "x")
    # new names on one side tell the two sides of the cogroup apart
    vectors = vectors.select("block", "slice", "x", "vec").toDF("to", "part", "id", "vec")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        return _distances(left, right, kind)

    grouped = pairs.groupBy("block", "slice").cogroup(vectors.groupBy("to", "part"))
    return grouped.applyInArrow(measure, "q long, v long, d double")


def _exact(nodes: DataFrame, wanted: list[tuple[int, bytes]], kind: type) -> DataFrame:
    """(q, v, d): the RESULTS nearest other nodes of the few given (node, x), by a scan of all nodes."""
    ids, x = np.array([q for q, _ in wanted], np.int64), np.array([np.frombuffer(v, kind) for _, v in wanted], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            node, y = batch.column(0).to_numpy(), _matrix(batch.column(1), np.float64, kind)
            about = np.einsum("ij,ij->i", y, y)[None, :] - 2 * (x @ y.T)
            few = min(len(node), 3 * RESULTS)
            for j, at in enumerate(np.argpartition(about, few - 1, axis=1)[:, :few]):
                at = at[node[at] != ids[j]]
                v, d = (np.append(*c) for c in zip(best[j], (node[at], ((y[at] - x[j]) ** 2).sum(axis=1)), strict=True))
                near = np.lexsort((v, d))[:RESULTS]
                best[j] = v[near], d[near]
        q = np.repeat(ids, [len(v) for v, _ in best])
        v, d = (np.concatenate([np.zeros(0), *c]) for c in ([v for v, _ in best], [d for _, d in best]))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v.astype(np.int64)), pa.array(d)], names=["q", "v", "d"])

    return _best(nodes.select("node", "x").mapInArrow(run, "q long, v long, d double"), "q", "v", RESULTS)


def _spread(ends: np.ndarray, to: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of ``to`` between the ends of the places ``at``, and which of these each is for."""
    first = np.where(at > 0, ends[at - 1], 0)
    sizes = ends[at] - first
    of = np.repeat(np.arange(len(at)), sizes)
    return of, to[np.arange(len(of)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)]


class Shelf:
    """A block's vectors and edges."""

    def __init__(self, x: bytes, ends: bytes, to: bytes, far_ends: bytes, far: bytes, kind: type):
        self.ends, self.far_ends = (np.frombuffer(b, np.int32).astype(np.int64) for b in (ends, far_ends))
        self.n = len(self.ends)
        self.to, self.far = np.frombuffer(to, np.uint16 if self.n <= HELD else np.int32).astype(np.int64), _ids(far)
        self.x = np.frombuffer(x, kind).reshape(self.n, -1)
        self.middle = None

    def near(self, x: np.ndarray, asked: np.ndarray, bound: np.ndarray, table: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Those of the pairs of a query and a place, q * n + place, that are nearer than the query's bound, as (q, v, d)."""
        if table is not None:  # about the distances, from one product
            asked = asked[table.ravel()[asked] < (bound + self.slack(x))[asked // self.n]]
        q, v = np.divmod(asked, self.n)
        d = np.empty(len(q), self.x.dtype)
        for a in range(0, len(q), 4096):
            apart = self.x.take(v[a : a + 4096], axis=0)
            apart -= x.take(q[a : a + 4096], axis=0)
            np.einsum("ij,ij->i", apart, apart, out=d[a : a + 4096])
        near = d < bound[q]
        return q[near], v[near], d[near]

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.middle is None:
            self.middle = self.x.mean(axis=0, dtype=np.float64).astype(self.x.dtype)
            self.moved = self.x - self.middle
            self.square = np.einsum("ij,ij->i", self.moved, self.moved)
        return self.middle, self.moved, self.square

    def table(self, x: np.ndarray) -> np.ndarray:
        """About the squared distances of queries to all nodes, but for slack()."""
        middle, moved, square = self.centred()
        x = x - middle
        d = x @ moved.T
        d *= -2
        d += np.einsum("ij,ij->i", x, x)[:, None]
        d += square
        return d

    def slack(self, x: np.ndarray) -> np.ndarray:
        """More than what rounding can add to the entries of table()."""
        middle, _, square = self.centred()
        return 64 * np.finfo(self.x.dtype).eps * (((x - middle) ** 2).sum(axis=1) + square.max())

    def walk(self, x: np.ndarray, bound: np.ndarray, room: np.ndarray, places: tuple[np.ndarray, ...], size: int):
        """Nodes near queries x as (q, v, d, state), at most ``size`` of a query, and the nodes (q, number) of other blocks
        that edges lead to. ``places`` are KNOWN, LEFT, OPEN and ASKED nodes, each as q * n + place. The asked are measured,
        then a query goes on along the block's edges as long as there is a node not expanded yet among its ``room``
        nearest. Only nodes nearer than its bound are of use."""
        n, bound = self.n, bound.copy()
        known, left, opened, asked = places
        seen = np.zeros(len(x) * n, bool)
        for at in (known, left, opened):
            seen[at] = True
        fq, fv = np.divmod(opened, n)
        q, v, d, state, table = fq[:0], fv[:0], np.zeros(0, self.x.dtype), np.zeros(0, np.int8), None
        while True:
            of, to = _spread(self.ends, self.to, fv)
            asked = np.concatenate([asked, fq[of] * n + to])
            if 16 * len(asked) > len(seen):
                each = np.zeros(len(seen), bool)
                each[asked] = True
                asked = np.flatnonzero(each & ~seen)
            else:
                asked = np.sort(asked[~seen[asked]])
                asked = asked[np.append(True, asked[1:] != asked[:-1])[: len(asked)]]
            if not len(asked):
                break
            seen[asked] = True
            if table is None and 64 * len(asked) > len(seen):  # a product of all takes less time than so many rows
                table = self.table(x)
            nq, nv, nd = self.near(x, asked, bound, table)
            asked = asked[:0]
            q, v, d = np.concatenate([q, nq]), np.concatenate([v, nv]), np.concatenate([d, nd])
            state = np.concatenate([state, np.full(len(nq), OPEN, np.int8)])
            # by query and distance; at most 256 queries and 2 ** 24 nodes
            by = (q.astype(np.uint64) << np.uint64(56)) | (d.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(24)) | np.arange(len(q), dtype=np.uint64)
            by.sort()
            by = (by & np.uint64((1 << 24) - 1)).astype(np.int64)
            rank = _ranks(q[by], len(x))
            last = by[rank == size - 1]
            bound[q[last]] = np.minimum(bound[q[last]], d[last])
            by, rank = by[rank < size], rank[rank < size]
            q, v, d, state = q[by], v[by], d[by], state[by]
            next_ = np.flatnonzero((rank < room[q]) & (state == OPEN))
            state[next_] = LEFT
            fq, fv = q[next_], v[next_]
        leave = np.flatnonzero((_ranks(q, len(x)) < room[q]) & (state == LEFT))
        state[leave] = KNOWN
        away = np.concatenate([left, opened, q[leave] * n + v[leave]])
        of, far = _spread(self.far_ends, self.far, away % n)
        return q, v, d, state, away[of] // n, far


# A node of a beam: expanded; its edges that leave the block are still to be followed; all its edges are. Or not measured yet.
KNOWN, LEFT, OPEN, ASKED = range(4)

BEAMS = "q long, x binary, v binary, d binary, state binary, ask binary, busy boolean"
LETTERS = "block long, q long, x binary, bound double, room int, places binary, sizes binary"
SHELF = "block long, x binary, ends binary, to binary, far_ends binary, far binary"


def _ids(value: bytes) -> np.ndarray:
    """The numbers that _planes() made bytes of."""
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view("<i8")[:, 0]


def _as_bytes(numbers: np.ndarray) -> bytes:
    return _planes(numbers[None, :]).tobytes()


def _letters(batches: Iterator[pa.RecordBatch], size: int, kind: type) -> Iterator[pa.RecordBatch]:
    """For each busy query and block that it has to visit: the places of its nodes there by their states, and how many of each."""
    names = ["block", "q", "x", "bound", "room", "places", "sizes"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
    for batch in batches:
        rows = []
        for at in range(batch.num_rows):
            q, x, v, d, state, ask = (batch.column(batch.schema.get_field_index(n))[at].as_py() for n in ("q", "x", "v", "d", "state", "ask"))
            v, d, ask = _ids(v), np.frombuffer(d, kind), _ids(ask)
            node, state = np.concatenate([v, ask]), np.concatenate([np.frombuffer(state, np.int8), np.full(len(ask), ASKED, np.int8)])
            by = np.lexsort((state, node >> SHIFT))
            node, state = node[by], state[by]
            block = node >> SHIFT
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            visits = [(a, b) for a, b in zip(starts, [*starts[1:], len(node)], strict=True) if state[b - 1] != KNOWN]
            bound = float(d[size - 1]) if len(d) >= size else math.inf
            room = -(-size // len(visits)) + RESULTS if len(visits) > 1 else size
            for a, b in visits:
                places, sizes = node[a:b] & ((1 << SHIFT) - 1), np.bincount(state[a:b], minlength=4)
                places = places.astype(np.uint16 if places.max() < HELD else np.int32)
                rows.append((int(block[a]), q, x, bound, room, places.tobytes(), sizes.astype(np.int32).tobytes()))
            if len(rows) > 2048 or at == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows = []


def _visits(batches: Iterator[pa.RecordBatch], size: int, kind: type) -> Iterator[pa.RecordBatch]:
    """What queries find in the blocks that they visit; each shelf comes before its block's letters."""
    row, shelf = None, None
    for batch in batches:
        column = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
        shelves = np.flatnonzero(column["q"].is_null().to_numpy(zero_copy_only=False)).tolist()
        for a, b in zip([-1, *shelves], [*shelves, batch.num_rows], strict=True):
            if a >= 0:
                row, shelf = {n: column[n][a].as_py() for n in ("block", "x", "ends", "to", "far_ends", "far")}, None
            if a + 1 < b and shelf is None:
                shelf = Shelf(*(row[n] for n in ("x", "ends", "to", "far_ends", "far")), kind)
            step = WALKED if a + 1 == b else max(1, min(WALKED, (1 << 24) // (shelf.n + size)))
            for start in range(a + 1, b, step):
                count = min(b - start, step)
                letter = {n: column[n].slice(start, count) for n in ("q", "x", "bound", "room", "places", "sizes")}
                sizes = _matrix(letter["sizes"], np.int32, np.int32)
                state = np.repeat(np.tile(np.arange(4), count), sizes.ravel())
                wide = [np.frombuffer(p, np.uint16 if len(p) == 2 * k else np.int32) for p, k in zip(letter["places"].to_pylist(), sizes.sum(axis=1), strict=True)]
                at = np.repeat(np.arange(count), sizes.sum(axis=1)) * shelf.n + np.concatenate(wide)
                places = tuple(at[state == k] for k in (KNOWN, LEFT, OPEN, ASKED))
                q, v, d, state, fq, far = shelf.walk(_matrix(letter["x"], kind, kind), letter["bound"].to_numpy(), letter["room"].to_numpy(), places, size)
                by = np.lexsort((far, fq))
                fq, far = fq[by], far[by]
                once = np.append(True, (fq[1:] != fq[:-1]) | (far[1:] != far[:-1]))[: len(fq)]
                found = [_split(q, c, count) for c in ((row["block"] << SHIFT) + v, d, state)] + [_split(fq[once], far[once], count)]
                columns = [pa.array([f(c) for c in x], pa.binary()) for f, x in zip((_as_bytes, np.ndarray.tobytes, np.ndarray.tobytes, _as_bytes), found, strict=True)]
                yield pa.RecordBatch.from_arrays([letter["q"], *columns], names=["q", "v", "d", "state", "far"])
        pa.default_memory_pool().release_unused()  # other tasks' workers share the executor's memory


def _split(q: np.ndarray, values: np.ndarray, count: int) -> list[np.ndarray]:
    """The values of each q, which are sorted."""
    return np.split(values, np.cumsum(np.bincount(q, minlength=count))[:-1])


def _merged(found: pa.Table, beams: pa.Table, size: int, kind: type) -> pa.Table:
    """Beams with what was found; the nodes that edges lead to are asked for next."""
    rows = {r["q"]: r | {"new": []} for r in beams.drop_columns(["bucket"]).to_pylist()}
    for r in found.select(["q", "v", "d", "state", "far"]).to_pylist():
        rows[r["q"]]["new"].append(r)
    for r in rows.values():
        new = r.pop("new")
        if r["busy"]:
            v = np.concatenate([_ids(c["v"]) for c in (r, *new)])
            d = np.concatenate([np.frombuffer(c["d"], kind) for c in (r, *new)])
            # what was known before has been expanded, and its edges followed, where it was not
            state = np.concatenate([np.zeros(len(r["state"]), np.int8), *(np.frombuffer(c["state"], np.int8) for c in new)])
            ask = np.setdiff1d(np.concatenate([np.zeros(0, np.int64), *(_ids(c["far"]) for c in new)]), v)
            by = np.lexsort((v, d))[:size]
            busy = bool(len(ask) or state[by].any())
            r |= {"v": _as_bytes(v[by]), "d": d[by].tobytes(), "state": state[by].tobytes(), "ask": _as_bytes(ask), "busy": busy}
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    names = ["q", "x", "v", "d", "state", "ask", "busy"]
    return pa.table({n: pa.array([r[n] for r in rows.values()], k) for n, k in zip(names, kinds, strict=True)})


class Search:
    """The beams of some queries, as a stored table: a query's node q, its nearest known nodes v, their distances d and
    states, and the nodes to measure next."""

    def __init__(self, spark: SparkSession, shelves: DataFrame, starts: DataFrame, kind: type):
        """``starts`` names the queries' nodes q and vectors x."""
        self.spark, self.shelves, self.kind = spark, shelves, kind
        self.blocks = max(1, shelves.count())
        self.buckets = -(-max(1, starts.count()) // BUCKET)

        def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = batch.column(0).to_numpy()
                columns = [[f(n) for n in q] for f in (lambda n: _as_bytes(np.array([n])), lambda n: bytes(np.dtype(kind).itemsize), lambda n: bytes([OPEN]), lambda n: b"")]
                columns = [*batch.columns, *(pa.array(c, pa.binary()) for c in columns), pa.array([True] * len(q), pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "x", "v", "d", "state", "ask", "busy"])

        self.beams = _stored(spark, starts.select("q", "x").mapInArrow(begin, BEAMS), "beams")

    def _renewed(self, beams: DataFrame) -> None:
        before, self.beams = self.beams, _stored(self.spark, beams, "beams")
        _discarded(self.spark, before)

    def widen(self) -> None:
        """All nodes of the beams are expanded again."""
        opened = F.expr(f"unhex(repeat('{OPEN:02x}', length(state)))")
        self._renewed(self.beams.withColumn("state", opened).withColumn("busy", F.lit(True)))

    def run(self, size: int) -> None:
        """Move along the edges with beams of ``size`` nodes until none leads anywhere nearer."""
        kind = self.kind

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _letters(batches, size, kind)

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _visits(batches, size, kind)

        def merge(found: pa.Table, beams: pa.Table) -> pa.Table:
            return _merged(found, beams, size, kind)

        bucket = F.pmod(F.xxhash64("q"), F.lit(self.buckets))
        while not self.beams.where("busy").isEmpty():
            letters = self.beams.where("busy").mapInArrow(write, LETTERS)
            both = self.shelves.unionByName(letters, allowMissingColumns=True).repartition(self.blocks, "block").sortWithinPartitions("block", "q")
            found = both.mapInArrow(visit, "q long, v binary, d binary, state binary, far binary").withColumn("into", bucket)
            beams = self.beams.withColumn("bucket", bucket)
            self._renewed(found.groupBy("into").cogroup(beams.groupBy("bucket")).applyInArrow(merge, BEAMS))

    def nodes(self, most: int | None = None) -> DataFrame:
        """(q, v): the ``most`` nearest nodes of each beam, or all."""

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [_ids(v)[:most] for v in batch.column(1).to_pylist()]
                q = np.repeat(batch.column(0).to_numpy(), [len(v) for v in lists])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([np.zeros(0, np.int64), *lists]))], names=["q", "v"])

        return self.beams.select("q", "v").mapInArrow(pairs, "q long, v long")


def search_to_target(spark: SparkSession, nodes: DataFrame, shelves: DataFrame, starts: DataFrame, kind: type) -> DataFrame:
    """(q, v): the FINAL nearest nodes found for each node q of ``starts`` (q, x), q itself included.

    The recall is measured on MEASURED of the queries against a scan of all nodes. They search first, with a beam that
    is doubled until the recall is reached; the others then search with the same.
    """
    some = [(r["q"], bytes(r["x"])) for r in starts.orderBy(F.xxhash64("q"), "q").limit(MEASURED).select("q", "x").collect()]
    chosen = F.col("q").isin([q for q, _ in some])
    exact = _stored(spark, _exact(nodes, some, kind), "exact")
    wanted, size, count, held = exact.count(), BEAM, nodes.count(), 0
    search = Search(spark, shelves, starts.where(chosen), kind)
    while True:
        search.run(size)
        before, held = held, search.nodes().count()
        if exact.join(search.nodes(), ["q", "v"], "left_semi").count() >= TARGET * wanted or size > count:
            break
        if held == before:
            break  # nothing else can be reached along the edges
        size *= 2
        search.widen()
    rest = starts.where(~chosen)
    if rest.isEmpty():
        return search.nodes(FINAL)
    found, waves = search.nodes(FINAL), min(WAVES, -(-rest.count() // QUERIES))
    for wave in range(waves):
        others = Search(spark, shelves, rest.where(F.pmod(F.xxhash64("q"), F.lit(waves)) == wave), kind)
        others.run(size)
        found = found.unionByName(others.nodes(FINAL))
    return found


def nearest(spark: SparkSession, rows: DataFrame, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the RESULTS nearest other vectors of rows whose vec_id ``every`` divides.

    Vectors null, zero, or with null or non-finite components take no part, nor do rows without an id and vectors
    of another length than most have (the smaller of two equally common lengths). A row given twice counts once.
    A query's own vec_id is never its result. Ties go to the smaller vec_id. An empty table gives no rows.
    """
    kind = vector_kind(rows)
    stored = _stored(spark, usable_vectors(rows, kind=kind), "vectors")
    sizes = stored.groupBy(F.length("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    used = stored.where(F.length("x") == (sizes["size"] if sizes else 0))
    queries = _stored(spark, used.where(F.col("vec_id") % every == 0), "queries")
    classes = _stored(spark, vector_classes(used, every), "classes")
    _discarded(spark, stored)
    nodes, shelves = graph_of(spark, classes, kind)
    starts = _stored(spark, nodes.where("asked").select(F.col("node").alias("q"), "x"), "starts")
    queries = queries.join(starts, "x").select(F.col("vec_id").alias("query_id"), "q")
    pairs = _stored(spark, search_to_target(spark, nodes, shelves, starts, kind), "found")
    beam = _measured(nodes, pairs, -(-max(1, starts.count()) // QUERIES), kind)
    members = beam.join(nodes.select(F.col("node").alias("v"), "ids"), "v").select("q", "d", F.explode("ids").alias("vec_id"))
    top = _best(members, "q", "vec_id", RESULTS + 1).groupBy("q")
    top = top.agg(F.sort_array(F.collect_list(F.struct("d", "vec_id"))).alias("found"))
    found = queries.join(top, "q").select("query_id", F.expr(f"slice(filter(found, x -> x.vec_id <> query_id), 1, {RESULTS})").alias("found"))
    return found.select("query_id", F.posexplode("found").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.sqrt("x.d").alias("score")
    )

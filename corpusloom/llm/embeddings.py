"""Operator 7, embedding near-dedup: an epsilon grid order join.

Two unit vectors with cosine c or more lie within e = sqrt(2 - 2 c). Vectors are projected on leading principal directions and
sorted by their grid cells of width e, dimension after dimension; the sequence is cut into blocks with the bounds of their projections.
Sequence intervals are joined recursively: a pair of intervals whose bounds are further apart than e is skipped with all below it, any other
is opened into the pairs of its parts, down to blocks. The pairs of blocks that remain are dealt to tiles of ``TILE`` by ``TILE`` blocks, so that
a block is sent once for each tile it has a partner in, not for each partner. They are compared by a matrix product in
single precision, and in double precision where that is close to the threshold, as far as its rounding can reach.

Equal vectors (by 128 bits of hash) are one node with a count, so copies add to link counts but are not compared. A pair of blocks returns link counts
and a spanning set of its links, never all of them.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different length
do not link; null ids take no part and are their own rows with a null component; rows with the same id are told apart by their vectors; an empty
table gives an empty result; labels and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import connected_components, cut

BLOCK = 2048  # vectors in a block, and
BLOCK_BYTES = 1 << 20  # bytes of them, beyond which it holds fewer
TILE = 8  # blocks on a side of a tile
FAN = 8  # intervals in the interval above
LEADING = 8  # principal directions that are looked at
SLACK = 1e-6  # on distances, for rounding


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    """The rows at length 1. They are brought near 1 by powers of two first, which change no digit, so that no square is too large or too small."""
    if not len(x):
        return x
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.linalg.norm(x, axis=1)[:, None]


def _principal(nodes: DataFrame, dim: int, leading: int) -> np.ndarray:
    """The leading directions of the second moments, from sums of every vector; ``dim`` squared numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = _matrix(batch.column(0)).astype(np.float64)
            if len(x):
                x = np.hstack([_unit(x), np.ones((len(x), 1))])
                total += x.T @ x
        i, j = np.meshgrid(np.arange(dim + 1), np.arange(dim + 1), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((dim + 1, dim + 1))
    for r in nodes.select("embedding").mapInArrow(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v
    n = max(1.0, total[dim, dim])
    mean = total[:dim, dim] / n
    _, vectors = np.linalg.eigh(total[:dim, :dim] / n - np.outer(mean, mean))
    return vectors[:, ::-1][:, :leading]


def _blocks(nodes: DataFrame, directions: np.ndarray, epsilon: float, stored: str) -> DataFrame:
    """Blocks of the grid order: part, nth, bounds of the projections, ids, keys, counts and vectors."""
    dim, k = directions.shape
    most = max(64, min(BLOCK, BLOCK_BYTES // (dim * (8 if stored == "double" else 4))))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(3)).astype(np.float64)
            if len(x):
                p = _unit(x) @ directions
                cells = np.floor(p / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cells.T), *(pa.array(c) for c in p.T)], [*batch.schema.names, *(f"c{i}" for i in range(k)), *(f"p{i}" for i in range(k))])

    names = ", ".join([f"c{i} int" for i in range(k)] + [f"p{i} double" for i in range(k)])
    # the finest order within a cell is that of the first direction
    order = [f"c{i}" for i in range(k)] + ["p0", "key"]
    placed = nodes.select("key", "id", "n", "embedding").mapInArrow(project, f"key long, id long, n long, embedding array<{stored}>, {names}")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    dtype = np.float64 if stored == "double" else np.float32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit(table: pa.Table) -> pa.RecordBatch:
            b = table.combine_chunks().to_batches()[0]
            p = [b.column(4 + k + i).to_numpy() for i in range(k)]
            arrays = [np.array(b.column(i).to_numpy(), np.int64).tobytes() for i in (1, 0, 2)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([nth], pa.int64()), pa.array([[c.min() for c in p]]), pa.array([[c.max() for c in p]]), *(pa.array([a], pa.binary()) for a in arrays), pa.array([_matrix(b.column(3)).astype(dtype).tobytes()], pa.binary())],
                ["part", "nth", "low", "high", "ids", "keys", "counts", "vectors"],
            )

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= most:
                table = pa.Table.from_batches(held)
                yield emit(table.slice(0, most))
                nth, size = nth + 1, size - most
                held = table.slice(most).to_batches()
        if size:
            yield emit(pa.Table.from_batches(held))

    return placed.mapInArrow(pack, "part long, nth long, low array<double>, high array<double>, ids binary, keys binary, counts binary, vectors binary")


def _interval_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """``(a, b)``, a <= b: the pairs of blocks (by ``at``) that recursion over intervals could not skip."""
    count = blocks.count()
    levels = 0
    while FAN**levels < count:
        levels += 1
    dims = len(blocks.select("low").first()[0])
    box = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(dims)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(dims)]
    pairs = blocks.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        here = F.floor(F.col("at") / FAN**level).cast("long").alias("x")
        boxes = cut(blocks.groupBy(here).agg(*box).withColumn("up", F.floor(F.col("x") / FAN).cast("long")))
        one = boxes.select(F.col("up").alias("a"), F.col("x").alias("na"), *(F.col(f"{s}{i}").alias(f"a{s}{i}") for s in "lh" for i in range(dims)))
        two = boxes.select(F.col("up").alias("b"), F.col("x").alias("nb"), *(F.col(f"{s}{i}").alias(f"b{s}{i}") for s in "lh" for i in range(dims)))
        gap = [F.greatest(F.lit(0.0), F.col(f"al{i}") - F.col(f"bh{i}"), F.col(f"bl{i}") - F.col(f"ah{i}")) for i in range(dims)]
        distance = reduce(lambda s, g: s + g * g, gap, F.lit(0.0))
        pairs = pairs.join(one, "a").join(two, "b").where("na <= nb").where(distance <= (epsilon + SLACK) ** 2).select(F.col("na").alias("a"), F.col("nb").alias("b"))
        pairs = cut(pairs)
    return pairs


def _compare(a: tuple, b: tuple, same: bool, dim: int, dtype, threshold: float):
    """Link counts of the nodes of two blocks, and edges to the smallest id of each local component."""
    (ia, ka, ca, va), (ib, kb, cb, vb) = ((np.frombuffer(i, np.int64), np.frombuffer(k, np.int64), np.frombuffer(c, np.int64), np.frombuffer(v, dtype).reshape(-1, dim)) for i, k, c, v in (a, b))
    xa, xb = (_unit(v.astype(np.float64)) for v in (va, vb))
    fa, fb = xa.astype(np.float32), xb.astype(np.float32)
    slack = 1e-5 + 2e-7 * dim  # a sum of products in single precision is off by less than its terms times their rounding
    rows, cols = [], []
    for lo in range(0, len(fa), 512):
        s = fa[lo : lo + 512] @ fb.T
        r, c = np.nonzero(s >= threshold - slack)
        near = s[r, c] < threshold + slack
        good = ~near
        for q in range(0, int(near.sum()), 65536):
            w = np.flatnonzero(near)[q : q + 65536]
            good[w] = np.einsum("ij,ij->i", xa[r[w] + lo], xb[c[w]]) >= threshold
        if same:
            good &= r + lo < c
        rows.append(r[good] + lo)
        cols.append(c[good])
    r, c = np.concatenate(rows), np.concatenate(cols)
    if not len(r):
        return None
    na = np.bincount(r, weights=cb[c], minlength=len(ia)).astype(np.int64)
    nb = np.bincount(c, weights=ca[r], minlength=len(ib)).astype(np.int64)
    la, lb = ia.copy(), ib.copy()
    if same:
        lb = la
    while True:
        before = la.sum() + lb.sum()
        low = np.minimum(la[r], lb[c])
        np.minimum.at(la, r, low)
        np.minimum.at(lb, c, low)
        if la.sum() + lb.sum() == before:
            break
    keys = np.concatenate([ka[na > 0], kb[nb > 0]])
    links = np.concatenate([na[na > 0], nb[nb > 0]])
    ids = np.concatenate([ia[na > 0], ib[nb > 0]])
    roots = np.concatenate([la[na > 0], lb[nb > 0]])
    return keys, links, ids, roots


def _near(nodes: DataFrame, dim: int, stored: str, threshold: float) -> DataFrame:
    """``key, links, id, root`` partial results over the nodes of one dimension."""
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    directions = _principal(nodes, dim, min(LEADING, dim))
    blocks = cut(_blocks(nodes, directions, epsilon, stored))
    first = blocks.groupBy("part").agg(F.count("*").alias("blocks"))
    before = F.coalesce(F.sum("blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.join(first.select("part", before.alias("first")), "part").withColumn("at", F.col("first") + F.col("nth"))
    pairs = _interval_pairs(blocks, epsilon)
    tile = F.floor(F.col("a") / TILE).alias("x"), F.floor(F.col("b") / TILE).alias("y")
    pairs = pairs.select(*tile, "a", "b")
    partners = pairs.groupBy("x", "y", F.col("a").alias("at")).agg(F.collect_list("b").alias("partners"))
    asked = pairs.select("x", "y", F.explode(F.array("a", "b")).alias("at")).distinct().join(partners, ["x", "y", "at"], "left")
    sent = asked.join(blocks.select("at", "ids", "keys", "counts", "vectors"), "at")
    sent = sent.select("x", "y", "at", "partners", "ids", "keys", "counts", "vectors").repartition("x", "y").sortWithinPartitions("x", "y")
    dtype = np.float64 if stored == "double" else np.float32

    def compared(held: dict) -> Iterator[pa.RecordBatch]:
        for a, (partners, *block) in held.items():
            for b in partners or []:
                found = _compare(block, held[b][1:], a == b, dim, dtype, threshold)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["key", "links", "id", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                x, y, at, *rest = (column[i].as_py() for column in batch.columns)
                if (x, y) != tile:
                    yield from compared(held)
                    tile, held = (x, y), {}
                held[at] = rest
        yield from compared(held)

    return sent.mapInArrow(run, "key long, links long, id long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector."""
    stored = "double" if "double" in vectors.schema[vector_col].dataType.simpleString() else "float"
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast(f"array<{stored}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    rows = rows.withColumns({"first": F.when(usable, F.xxhash64("embedding", F.size("embedding"))), "second": F.when(usable, F.xxhash64(F.lit(7), F.reverse("embedding")))})
    nodes = rows.where("first is not null").groupBy("first", "second").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.any_value("embedding").alias("embedding"))
    nodes = cut(nodes.withColumns({"dim": F.size("embedding"), "key": F.monotonically_increasing_id()}))
    dims = [r.dim for r in nodes.select("dim").distinct().collect()]
    parts = [_near(nodes.where(F.col("dim") == dim), dim, stored, threshold) for dim in sorted(dims)]
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = cut(reduce(DataFrame.unionByName, parts))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    label = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = nodes.join(links, "key", "left").join(label, nodes.id == label.node, "left")
    named = named.select("first", "second", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.select("vec_id", "first", "second").join(named, ["first", "second"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))

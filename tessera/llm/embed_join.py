"""Embedding near-dedup by an epsilon grid order join.

Vectors are scaled to length one, so cosine >= c is distance <= eps = sqrt(2 - 2c). They are turned onto
their leading principal directions (fitted on at most ``FIT_ROWS`` rows; the fit only steers pruning),
cut into grid cells of side eps, and sorted by cell: the epsilon grid order. The sorted sequence is cut
into blocks of ``BLOCK`` vectors with bounding boxes; block pairs whose boxes are farther apart than eps are
provably distant and skipped. Each remaining pair is joined by recursion on sequence intervals: distant
intervals are skipped, longer ones halved, short ones compared by a matrix product in double precision.

A joined pair returns, per vector, its number of links and one edge to the smallest id of its local
component, so a large group of near copies gives rows in proportion to its size. Identical vectors are
collapsed first and counted with their multiplicity. Vectors that are null, empty, zero or hold null or
non-finite components link with nothing; vectors of different lengths never link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, written

COSINE = 0.95
DIMS = 8  # leading principal dimensions of the grid
BLOCK = 8192
LEAF = 256
FIT_ROWS = 8192
FIT_VALUES = 1 << 22
SLACK = 1e-9  # boxes may be this much closer than computed


def directions(vectors: DataFrame, dim: int, dims: int) -> np.ndarray:
    """``dim x dims`` leading principal directions of a bounded sample (smallest hashes)."""
    rows = vectors.orderBy(F.xxhash64("v"), "id").limit(max(2, min(FIT_ROWS, FIT_VALUES // dim))).select("v").collect()
    x = np.array([r["v"] for r in rows], float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, u = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(u[:, ::-1][:, :dims])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def box_gap(lo_a, hi_a, lo_b, hi_b) -> float:
    """Least squared distance of two boxes."""
    gap = np.maximum(0.0, np.maximum(lo_b - hi_a, lo_a - hi_b))
    return float(gap @ gap)


class IntervalJoin:
    """Joins two sorted blocks (or one with itself) by recursion on intervals."""

    def __init__(self, xa, ya, ma, xb, yb, mb, same: bool, cosine: float):
        self.xa, self.ya, self.ma, self.xb, self.yb, self.mb = xa, ya, ma, xb, yb, mb
        self.same, self.cosine = same, cosine
        self.reach = 2.0 - 2.0 * cosine + SLACK
        self.links_a, self.links_b = np.zeros(len(xa)), np.zeros(len(xb))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []  # positions in a, in b

    def run(self) -> None:
        todo = [(0, len(self.xa), 0, len(self.xb))]
        while todo:
            a, b, c, d = todo.pop()
            if self.same and d <= a:
                continue  # below the diagonal
            ya, yb = self.ya[a:b], self.yb[c:d]
            if box_gap(ya.min(0), ya.max(0), yb.min(0), yb.max(0)) > self.reach:
                continue
            if b - a <= LEAF and d - c <= LEAF:
                self.leaf(a, b, c, d)
            elif b - a >= d - c:
                m = (a + b) // 2
                todo += [(a, m, c, d), (m, b, c, d)]
            else:
                m = (c + d) // 2
                todo += [(a, b, c, m), (a, b, m, d)]

    def leaf(self, a, b, c, d) -> None:
        near = self.xa[a:b] @ self.xb[c:d].T >= self.cosine
        if self.same:
            near &= np.arange(a, b)[:, None] < np.arange(c, d)[None, :]
        if not near.any():
            return
        self.links_a[a:b] += near @ self.mb[c:d]
        self.links_b[c:d] += self.ma[a:b] @ near
        # smallest row reached, to a fixed point: one edge per column and per row keeps the components
        label = np.arange(b - a)
        none = b - a
        while True:
            col = np.where(near, label[:, None], none).min(0)
            new = np.minimum(label, np.where(near, col[None, :], none).min(1))
            if (new == label).all():
                break
            label = new
        rows = np.flatnonzero(near.any(1))
        cols = np.flatnonzero(col < none)
        first = np.where(near, np.arange(d - c)[None, :], d - c).min(1)  # some column of each component
        self.edges.append((a + col[cols], c + cols))
        self.edges.append((a + rows, c + first[rows]))


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable position for each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, m)
        np.minimum.at(new, v, m)
        np.minimum.at(new, label[u], m)
        np.minimum.at(new, label[v], m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _blocks(vectors: DataFrame, dim: int, cosine: float, dims: int, block: int) -> DataFrame:
    """Blocks of the epsilon grid order: ``(block, ids, m, x, c0, c1, lo, hi)``."""
    side = math.sqrt(2 - 2 * cosine)
    dims = min(dims, dim)
    u = directions(vectors, dim, dims)
    cells = [f"c{i}" for i in range(dims)]

    def project(batches):
        for b in batches:
            if b.num_rows:
                x = unit(np.asarray(b.column(2).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, dim))
                g = np.floor(x @ u / side).astype("i4")
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(g[:, i]) for i in range(dims))], names=["id", "m", "v", *cells])

    grid = vectors.mapInArrow(project, "id bigint, m bigint, v array<double>, " + ", ".join(f"{c} int" for c in cells))
    n = max(1, math.ceil(vectors.count() / block))
    grid = grid.repartitionByRange(n, *cells, "id").sortWithinPartitions(*cells, "id")

    def cut(batches):
        at = TaskContext.get().partitionId() << 24
        held, size = [], 0

        def flush(rows: pa.Table):
            nonlocal at
            x = np.asarray(rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, dim)
            y = unit(x) @ u
            lo, hi = y.min(0), y.max(0)
            as_bytes = lambda name: rows.column(name).to_numpy().astype("<i8").tobytes()
            out = pa.RecordBatch.from_pydict(
                {"block": [at], "ids": [as_bytes("id")], "m": [as_bytes("m")], "x": [x.astype("<f8").tobytes()],
                 "c0": [int(math.floor(lo[0] / side))], "c1": [int(math.floor(hi[0] / side))], "lo": [lo.tolist()], "hi": [hi.tolist()]},
                schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("m", pa.binary()), ("x", pa.binary()), ("c0", pa.int32()), ("c1", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]),
            )
            at += 1
            return out

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= block:
                t = pa.Table.from_batches(held)
                while t.num_rows >= block:
                    yield flush(t.slice(0, block))
                    t = t.slice(block)
                held, size = t.to_batches(), t.num_rows
        if size:
            yield flush(pa.Table.from_batches(held))

    return grid.mapInArrow(cut, "block bigint, ids binary, m binary, x binary, c0 int, c1 int, lo array<double>, hi array<double>")


def _block_pairs(blocks: DataFrame, cosine: float) -> DataFrame:
    """``(a, b)`` with ``a <= b`` whose boxes are within reach; candidates share a cell of the first
    dimension or are neighbours there."""
    side = blocks.select(F.col("block").alias("a"), "lo", "hi", F.explode(F.sequence(F.col("c0") - 1, F.col("c1") + 1)).alias("c"))
    other = blocks.select(F.col("block").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.explode(F.sequence("c0", "c1")).alias("c"))
    gaps = F.transform(F.arrays_zip("lo", "hi", "lo2", "hi2"), lambda g: F.greatest(F.lit(0.0), g["lo2"] - g["hi"], g["lo"] - g["hi2"]))
    gap = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)
    return side.join(other, "c").where("a <= b").where(gap <= 2 - 2 * cosine + SLACK).select("a", "b").distinct()


def _join_pairs(blocks: DataFrame, pairs: DataFrame, dim: int, u: np.ndarray, cosine: float) -> DataFrame:
    """``(id, links, root)``: per joined pair and linked vector its links there and its local root."""
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    rows = sides.join(blocks.select("block", "ids", "m", "x"), "block")
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def join(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        side = {}
        for r in table.select(["block", "ids", "m", "x"]).to_pylist():
            x = unit(np.frombuffer(r["x"], "<f8").reshape(-1, dim))
            side[r["block"]] = (x, x @ u, np.frombuffer(r["m"], "<i8").astype(float), np.frombuffer(r["ids"], "<i8"))
        xa, ya, ma, ia = side[a]
        xb, yb, mb, ib = side[b]
        j = IntervalJoin(xa, ya, ma, xb, yb, mb, a == b, cosine)
        j.run()
        if not j.edges:
            return schema.empty_table()
        shift = 0 if a == b else len(ia)
        ids = ia if a == b else np.concatenate([ia, ib])
        links = j.links_a + j.links_b if a == b else np.concatenate([j.links_a, j.links_b])
        us, vs = (np.concatenate(e) for e in zip(*j.edges))
        rank = np.argsort(ids, kind="stable")  # smallest id of a component leads it
        place = np.empty_like(rank)
        place[rank] = np.arange(len(ids))
        root = ids[rank][local_components(len(ids), place[us], place[vs + shift])][place]
        hit = np.flatnonzero(links > 0)
        return pa.table([ids[hit], links[hit].astype("i8"), root[hit]], schema=schema)

    return rows.groupBy("a", "b").applyInArrow(join, "id bigint, links bigint, root bigint")


def links(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, dims: int = DIMS, block: int = BLOCK) -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per input row; other columns are ignored. Repeated
    rows of an id count as separate vectors of one component."""
    src = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = src.where(F.coalesce(F.col("id").isNotNull() & whole, F.lit(False)))
    same = written(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "embed-distinct")
    member = good.join(same.where("m > 1"), "v").select("id", "rep", "m")
    found = []
    for (dim,) in same.select(F.size("v")).distinct().collect():  # one pass per vector length
        vectors = same.where(F.size("v") == dim).select(F.col("rep").alias("id"), "m", "v")
        blocks = written(_blocks(vectors, dim, cosine, dims, block), "embed-blocks")
        u = directions(vectors, dim, min(dims, dim))
        found.append(_join_pairs(blocks, _block_pairs(blocks, cosine), dim, u, cosine))
    if not found:
        return src.select(F.col("id").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    got = found[0]
    for more in found[1:]:
        got = got.unionByName(more)
    got = written(got, "embed-links")
    edges = got.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(member.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    comp = components(edges)
    count = got.groupBy("id").agg(F.sum("links").alias("links"))
    of_rep = member.select("id", "rep", (F.col("m") - 1).alias("own")).distinct()
    out = src.select("id").join(of_rep, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    out = out.join(count.withColumnRenamed("id", "rep"), "rep", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    n = F.coalesce("links", F.lit(0)) + F.coalesce("own", F.lit(0))
    comp_id = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), n.cast("bigint").alias("n_links"), comp_id.alias("component_id"), (F.col("id") == comp_id).alias("kept"))

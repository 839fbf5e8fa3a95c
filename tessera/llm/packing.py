"""Packing by order-preserving dynamic programming.

Documents keep their order and are laid end to end; window cuts are chosen at document ends (free),
sentence ends (small penalty) or, where neither is near, inside a sentence (large penalty), so that
padding plus truncation penalties are least. A window of ``i..j`` pads ``capacity - (p_j - p_i)``, so
``dp[j] = penalty(j) + capacity - p_j + min(dp[i] + p_i)`` over the cuts at most ``capacity`` back:
the minimum slides along a monotone queue and each cut costs O(1). A window whose length is a power of
two needs no padding and competes with a small fixed cost.

Every scan partition is packed by itself, in row order, with no shuffle: sequence ids carry the
partition number. Long partitions run in blocks of ``block_tokens``; the last, open window of a block
moves on to the next, so only the end of a partition can be short, and it is cut into powers of two.
Null and empty texts hold the end id alone. Every id lies in exactly one piece; a recomputed partition
gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.tokens import encoder, vocabulary

CAPACITY = 4096
END_ID = 2
CACHE = 250_000  # chunks a worker keeps
SENTENCE_PENALTY = 6.0
HARD_PENALTY = 48.0
SHORT_COST = 24.0  # of a full window that is shorter than the capacity
SENTENCE_END = (".", "!", "?", "...", "!!", "?!", ".\"", "!\"", "?\"")


def cuts(n_doc: np.ndarray, ids: np.ndarray, enders: np.ndarray, capacity: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts ``(positions, penalties)`` of a block, from 0 to its end: document ends, sentence ends,
    and hard cuts where the gap between those exceeds a quarter of the capacity."""
    total = len(ids)
    penalty = np.full(total + 1, np.inf)
    penalty[1:][np.isin(ids, enders)] = SENTENCE_PENALTY
    ends = np.cumsum(n_doc)
    penalty[ends] = 0.0
    penalty[0] = penalty[total] = 0.0
    at = np.flatnonzero(np.isfinite(penalty))
    gap = np.diff(at)
    step = max(1, capacity // 4)
    wide = np.flatnonzero(gap > step)
    if len(wide):
        more = np.concatenate([np.arange(at[i] + step, at[i + 1], step) for i in wide])
        penalty[more] = HARD_PENALTY
        at = np.flatnonzero(np.isfinite(penalty))
    return at, penalty[at]


def windows(at: np.ndarray, penalty: np.ndarray, capacity: int) -> list[int]:
    """The cut positions of least total cost, first and last cut included."""
    pos, pen = at.tolist(), penalty.tolist()
    full = [p for p in (1 << k for k in range(6, 31)) if p <= capacity]
    where = {p: i for i, p in enumerate(pos)}
    dp = [0.0] * len(pos)
    key = [0.0] * len(pos)
    back = [0] * len(pos)
    queue = deque([0])
    for j in range(1, len(pos)):
        p = pos[j]
        while p - pos[queue[0]] > capacity:
            queue.popleft()
        i = queue[0]
        best = key[i] + capacity - p
        for f in full:
            k = where.get(p - f)
            if k is not None:
                c = dp[k] + (SHORT_COST if f < capacity else 0.0)
                if c < best:
                    best, i = c, k
        best += pen[j]
        dp[j], back[j] = best, i
        k = key[j] = best + p
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    out, j = [pos[-1]], len(pos) - 1
    while j:
        j = back[j]
        out.append(pos[j])
    return out[::-1]


def powers(n: int) -> list[int]:
    """``n`` as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs a stream of documents; ``add`` and ``close`` return finished pieces
    ``(row, start, length, crc32, sequence, offset)``."""

    def __init__(self, enders: np.ndarray, capacity: int, block_tokens: int):
        self.enders, self.capacity, self.block = enders, capacity, block_tokens
        self.docs: list[tuple[object, int, np.ndarray]] = []  # row, ids before what is kept, ids
        self.held = 0
        self.sequence = 0

    def add(self, row, ids: np.ndarray) -> list[tuple]:
        self.docs.append((row, 0, ids))
        self.held += len(ids)
        return self._pack(False) if self.held >= self.block else []

    def close(self) -> list[tuple]:
        return self._pack(True) if self.docs else []

    def _pack(self, last: bool) -> list[tuple]:
        ids = np.concatenate([d[2] for d in self.docs])
        n_doc = np.array([len(d[2]) for d in self.docs])
        marks = windows(*cuts(n_doc, ids, self.enders, self.capacity), self.capacity)
        if last:
            tail = marks[-1] - marks[-2]
            if tail & (tail - 1):
                marks[-1:] = (marks[-2] + np.cumsum(powers(tail))).tolist()
        elif len(marks) > 2:
            marks.pop()  # the open window moves on
        out, rest = [], []
        w = 0
        at = 0
        raw = ids.astype("<u4").tobytes()
        for row, start, own in self.docs:
            n, done = len(own), 0
            while done < n:
                while w + 1 < len(marks) and marks[w + 1] <= at + done:
                    w += 1
                if w + 1 == len(marks):
                    rest.append((row, start + done, own[done:]))
                    break
                length = min(n - done, marks[w + 1] - at - done)
                piece = raw[4 * (at + done) : 4 * (at + done + length)]
                out.append((row, start + done, length, zlib.crc32(piece), self.sequence + w, at + done - marks[w]))
                done += length
            at += n
        self.sequence += len(marks) - 1
        self.docs, self.held = rest, sum(len(d[2]) for d in rest)
        return out


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID,
         capacity: int = CAPACITY, block_tokens: int = 1 << 20) -> DataFrame:
    """One row per piece: ``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Other input columns are ignored, so their names cannot clash; repeated rows are packed as often as
    they occur; an empty table gives no pieces.
    """
    path = path or vocabulary()
    schema = f"`{key}` {dict(df.dtypes)[key]}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        enc = encoder(path, CACHE)
        enders = np.frombuffer(b"".join(v for v in map(enc.chunk, SENTENCE_END) if len(v) == 4), "<u4")
        packer = Packer(enders, capacity, block_tokens)
        base = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4")
        held: dict[int, tuple] = {}  # key and id count of documents that may still give pieces
        row = 0
        kind = None

        def table(pieces):
            n = len(pieces)
            if not n:
                return None
            c = list(zip(*pieces))
            own = [held[r] for r in c[0]]
            alive = {d[0] for d in packer.docs}
            for r in set(c[0]) - alive:
                del held[r]
            arrays = [pa.array([o[0] for o in own], kind), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64()),
                      pa.array([o[1] for o in own], pa.int64()), pa.array(np.array(c[4], "i8") + base), pa.array(c[5], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            kind = b.column(0).type
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                for k, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    ids = np.concatenate([np.frombuffer(ids, "<u4"), end])
                    held[row] = (k, len(ids))
                    if (t := table(packer.add(row, ids))) is not None:
                        yield t
                    row += 1
        if (t := table(packer.close())) is not None:
            yield t

    # written here, so that a task holds a thousand texts at a time beside its block
    return written(df.select(F.col(key), F.col(text)).mapInArrow(run, schema), "packing")

"""Token-id files: range-coded, checksummed blocks of ids in ascending document order.

A *segment* holds whole documents: a header, the document table (id, number of ids), the coder's table (shares of ids and
habitual followers in this segment) and blocks of equal length. Every block is coded from a fresh model
(``range_coder``) that starts from that table, and has its own checksum, so a damaged block is found and the others still
decode (``unpack_segment`` with a list). Segments of about ``SEGMENT_IDS`` ids are the rows of the
written files; a manifest (one row per segment) gives each its first id position.

Documents are dealt by id ranges (sampled bounds, no single task), sorted within a range, tokenised and
coded in the same task, so ids are never shuffled, only texts. Null and empty texts hold the end id alone;
rows that repeat an id follow each other in order of their text's hash; null ids come first.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import range_coder
from tessera.llm.tokens import encoder, vocabulary
from tessera.operators.ordering import running_sum
from tessera.session import scratch_path

MAGIC = b"TOKSEG2\x00"
HEAD = "<8sIIQII"  # magic, documents, blocks, ids, ids per block, bytes of the coder's table
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u4")])
SEGMENT_IDS = 1 << 22
LANES = 8192  # blocks coded side by side, and of a segment where blocks are neither longest nor shortest
BLOCK_IDS = (256, 8192)  # least and most ids of a block
END_ID = 1
SEGMENT_SCHEMA = "segment bigint, n_docs bigint, n_tokens bigint, data binary"


class Damaged(ValueError):
    """A block or header whose checksum does not hold."""


def pack_segment(keys: list, counts: list[int], ids: np.ndarray) -> bytes:
    """One segment of whole documents."""
    if len(ids) and int(ids.max()) >= range_coder.MAX_ID:
        raise ValueError("ids must be below 65,536")
    least, most = BLOCK_IDS
    length = int(min(most, max(least, -(-len(ids) // LANES))))
    n = -(-len(ids) // length)
    blocks = np.full(n * length, ids[-1] if len(ids) else 0, np.int32)
    blocks[: len(ids)] = ids
    known = range_coder.Table.of(ids)
    coded = [b for at in range(0, n, LANES) for b in range_coder.encode(blocks.reshape(n, length)[at : at + LANES], known)]
    docs = np.zeros(len(keys), DOC)
    docs["id"], docs["null"], docs["n"] = [k or 0 for k in keys], [k is None for k in keys], counts
    model = known.to_bytes() if len(ids) else b""
    head = struct.pack(HEAD, MAGIC, len(keys), n, len(ids), length, len(model)) + docs.tobytes() + model
    head += np.array([(len(b), zlib.crc32(b)) for b in coded], "<u4").reshape(n, 2).tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(coded)


def unpack_segment(data: bytes, damaged: list[int] | None = None) -> tuple[list, np.ndarray, np.ndarray]:
    """``(keys, counts, ids)`` of a segment. A header whose checksum does not hold raises ``Damaged``; so does a block, unless
    ``damaged`` is a list: then the numbers of such blocks are added to it, their ids are -1 and all others are decoded."""
    magic, n_docs, n, total, length, n_model = struct.unpack_from(HEAD, data) if len(data) >= struct.calcsize(HEAD) else (b"",) + (0,) * 5
    at = struct.calcsize(HEAD) + n_docs * DOC.itemsize
    end = at + n_model + 8 * n
    if magic != MAGIC or end + 4 > len(data) or zlib.crc32(data[:end]) != struct.unpack_from("<I", data, end)[0]:
        raise Damaged("header")
    docs = np.frombuffer(data, DOC, n_docs, struct.calcsize(HEAD))
    known = range_coder.Table.from_bytes(data[at : at + n_model]) if n_model else range_coder.Table.flat()
    table = np.frombuffer(data, "<u4", 2 * n, at + n_model).reshape(n, 2)
    stops = end + 4 + np.cumsum(table[:, 0], dtype=np.int64)
    blocks = [data[b - s : b] for b, s in zip(stops.tolist(), table[:, 0].tolist())]
    good = []
    for i, b in enumerate(blocks):
        if zlib.crc32(b) == table[i, 1]:
            good.append(i)
        elif damaged is None:
            raise Damaged(f"block {i}")
        else:
            damaged.append(i)
    ids = np.full((n, length), -1, np.int32)
    for k in range(0, len(good), LANES):
        ids[good[k : k + LANES]] = range_coder.decode([blocks[i] for i in good[k : k + LANES]], length, known)
    return [None if d["null"] else int(d["id"]) for d in docs], docs["n"].astype(np.int64), ids.ravel()[:total]


def segments(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``(segment, n_docs, n_tokens, data)``: the whole table in ascending key order; segment numbers
    ascend with the keys."""
    path = path or vocabulary()
    src = df.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    src = src.repartitionByRange("k").sortWithinPartitions("k", F.xxhash64("t"))

    def run(batches):
        enc = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 32
        keys, parts, size = [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(parts), "<u4")
            data = pack_segment(keys, [len(p) // 4 for p in parts], ids)
            return pa.RecordBatch.from_pydict({"segment": [number], "n_docs": [len(keys)], "n_tokens": [len(ids)], "data": [data]}, schema=schema)

        schema = pa.schema([("segment", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for k, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    keys.append(k)
                    parts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield flush()
                        number, keys, parts, size = number + 1, [], [], 0
        if keys:
            yield flush()

    return src.mapInArrow(run, SEGMENT_SCHEMA)


def save(df: DataFrame, path: str, **how) -> None:
    """Write the segments of ``df`` and their manifest under ``path``."""
    segments(df, **how).write.parquet(f"{path}/segments")
    spark = df.sparkSession
    parts = spark.read.parquet(f"{path}/segments").select("segment", "n_docs", "n_tokens")
    after = running_sum(parts.withColumn("_n", F.col("n_tokens")), "segment", "_n", "_after")
    after.withColumn("start", F.col("_after") - F.col("_n")).drop("_n", "_after").write.parquet(f"{path}/manifest")


def load(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` and, if wanted, ``ids`` of every document, decoded from the
    files under ``path``; ``start`` counts the ids of all documents before."""
    rows = spark.read.parquet(f"{path}/segments").select("segment", "data")
    names = ["segment", key, "inside", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for b in batches:
            for number, data in zip(b.column(0).to_pylist(), b.column(1)):
                keys, n, ids = unpack_segment(data.as_py())
                stop = np.cumsum(n)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (s - c) : 4 * s]) for s, c in zip(stop.tolist(), n.tolist())]
                cols = [pa.array([number] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(stop - n), pa.array(n), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]).astype("i4")), pa.array(ids.astype("i4"))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"segment bigint, `{key}` bigint, inside bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    manifest = spark.read.parquet(f"{path}/manifest").select("segment", "start")
    out = rows.mapInArrow(run, schema).join(manifest, "segment")
    return out.select(key, (F.col("start") + F.col("inside")).alias("start"), *names[3:])


def stored(df: DataFrame, **how) -> str:
    """Save ``df`` in the shared scratch folder; returns the path."""
    path = scratch_path(df.sparkSession, "token-store")
    save(df, path, **how)
    return path

"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring at ``nodes`` places; a row's key hashes to a place and belongs to the next node
clockwise. No shard takes more than its capacity, ``1 + slack`` times the mean load (or just over it where a
single cell of rows is larger than what is left): what a full shard cannot take continues clockwise to the next node
whose shard has room. Loads are bytes, so the law that holds is ``bytes``: sizes near equal. One more shard takes
over the arcs before its nodes and shifts only what the new capacity pushes on.

Rows are not walked one by one. They are counted in at most ``CELLS`` equal cells of the ring (a partial
aggregation); a cell heavier than ``1 / PIECES`` of a shard - one key may hold a third of all rows - is counted
again in ``PARTS`` parts by row number, so that no part is hot. Only this table, whose size is fixed by
these parameters, is walked on the driver and joined back. Slots come from counts per shard and part of
the written table, so no shard meets in one task.

A null text counts one byte, as an empty one does. Null and repeated keys share a place on the ring; rows that
repeat are placed each by itself. An empty table gives no rows. Shards and slots depend on the rows and on how
the scan deals them; they are fixed by a written table, so a lost executor changes nothing.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

SHARDS = 16
NODES = 256  # virtual nodes of a shard
SLACK = 0.002
CELLS = 1 << 16
PIECES = 64  # a cell above this part of a shard is split ...
PARTS = 256  # ... into so many parts
LAW = "bytes"


def place_of(key: Column) -> Column:
    """The cell of the ring that a key hashes to, 0 to CELLS - 1."""
    return F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of all virtual nodes, clockwise. A node's place depends on its shard and number alone,
    so one more shard adds nodes and moves none."""
    import hashlib

    def place(s: int, n: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{s}:{n}".encode(), digest_size=8).digest(), "big") % CELLS

    return sorted((place(s, n), s) for s in range(shards) for n in range(nodes))


def walk(loads: Sequence[tuple[int, int, int]], shards: int, slack: float = SLACK, nodes: int = NODES) -> list[int]:
    """The shard of every ``(cell, part, load)``.

    Heavy cells are placed first (by powers of two, then in ring order), so that light ones even out. A shard
    takes a cell if it stays within the capacity; if none clockwise can, the least loaded takes it."""
    points = ring(shards, nodes)
    places = [p for p, _ in points]
    capacity = (1 + slack) * sum(x for _, _, x in loads) / shards
    held = [0] * shards
    out = [0] * len(loads)
    order = sorted(range(len(loads)), key=lambda i: (-loads[i][2].bit_length(), loads[i][0], loads[i][1]))
    for i in order:
        cell, _, load = loads[i]
        at = bisect.bisect_left(places, cell)
        seen: set[int] = set()
        while len(seen) < shards:
            s = points[at % len(points)][1]
            if s not in seen and held[s] + load <= capacity:
                break
            seen.add(s)
            at += 1
        else:
            s = min(range(shards), key=lambda x: (held[x], x))
        held[s] += load
        out[i] = s
    return out


def cells(rows: DataFrame, load: str, shards: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """``(cell, part, load)`` of all cells (``part`` is -1 for a whole cell), and which cells are in parts. At most ``CELLS``
    whole cells and ``shards * PIECES`` split ones of ``PARTS`` parts come to the driver."""
    per = [tuple(r) for r in rows.groupBy("cell").agg(F.sum(load)).collect()]
    limit = sum(x for _, x in per) / (shards * PIECES)
    hot = sorted(c for c, x in per if x > limit)
    loads = [(c, -1, x) for c, x in per if x <= limit]
    if hot:
        wanted = F.broadcast(rows.sparkSession.createDataFrame([(c,) for c in hot], "cell int"))
        loads += [tuple(r) for r in rows.join(wanted, "cell").groupBy("cell", "part").agg(F.sum(load)).collect()]
    return sorted(loads), hot


def place(
    df: DataFrame, key: str = "doc_id", text: str = "text", columns: Sequence[str] = (), shards: int = SHARDS, slack: float = SLACK, nodes: int = NODES
) -> DataFrame:
    """``(row, size, text_crc32, shard, slot)``: every row of ``df`` with its place; ``row`` is a struct of the key and ``columns``."""
    if not 1 <= shards <= CELLS:
        raise ValueError("shards must be between 1 and the number of cells")
    body = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    keep = list(dict.fromkeys([key, *columns]))
    rows = df.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"), (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        place_of(F.col(key)).alias("cell"), F.monotonically_increasing_id().alias("number"),
    )
    rows = rows.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(PARTS)).cast("int"))
    rows = written(rows, "ring-rows")
    loads, split = cells(rows, "size", shards)
    table = [(c, p, s) for (c, p, _), s in zip(loads, walk(loads, shards, slack, nodes))]
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame(table, "cell int, want int, shard int"))
    hot = F.broadcast(spark.createDataFrame([(c, True) for c in split], "cell int, split boolean"))
    rows = rows.join(hot, "cell", "left").withColumn("want", F.when(F.col("split"), F.col("part")).otherwise(-1))
    placed = rows.join(table, ["cell", "want"]).drop("cell", "want", "part", "split")
    return _slots(written(placed, "ring-shards"))


def _slots(placed: DataFrame) -> DataFrame:
    """Numbers the rows of every shard without a gap: by scan task, then by row number."""
    task = F.shiftright("number", 33)
    here = Window.partitionBy("shard", "task").orderBy("number")
    rows = placed.withColumn("task", task).withColumn("inside", F.row_number().over(here))
    count = placed.groupBy("shard", task.alias("task")).agg(F.count("*").alias("n"))
    # a row per scan task and shard
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = count.select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    out = rows.join(offsets, ["shard", "task"])
    return out.select("row", "size", "text_crc32", "shard", (F.col("offset") + F.col("inside") - 1).alias("slot"))


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``df``; other columns are ignored."""
    out = place(df, key, text, **how)
    grown = F.lit(None).cast("int").alias("grown_shard")  # only a law without loads could tell it
    return out.select(F.col(f"row.{key}").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", grown)


def save(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", rows_per_file: int = 1_000_000, **how) -> None:
    """Write all columns of ``df`` as one folder per shard, rows in slot order within files of ``rows_per_file`` slots."""
    placed = place(df, key, text, columns=df.columns, **how)
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / rows_per_file))
    dealt = placed.repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "slot")
    dealt.select("row", "slot", "chunk", "shard").write.partitionBy("shard", "chunk").parquet(path)


def load(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """``(row, shard, slot)`` of a saved table; with ``shard`` only that folder is read."""
    out = spark.read.parquet(path).select("row", "shard", "slot")
    return out if shard is None else out.where(F.col("shard") == shard)

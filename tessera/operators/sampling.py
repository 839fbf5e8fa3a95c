"""Exact samples per group by cut-off (E2, E3, E7, G1-G3): the rows with the smallest order keys of each group.

The order key is a uniform hex digest. A histogram of its leading digits per group (partial aggregation, a fixed number of
buckets per group) shows the bucket in which the quota falls. Rows of earlier buckets are kept and rows of later ones dropped where
they are read, by a join with one row per group; only the edge bucket's rows are ranked. No group's survivors
meet in one task, and nothing but the edge bucket is shuffled: the cut-offs are written first, so that the optimizer knows
their size when it plans the join (a plan's estimate would shuffle all rows by group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

DIGITS = 4  # leading hex digits: 65,536 buckets per group


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def cut_offs(df: DataFrame, hash_col: str, quota: int | DataFrame, group_cols: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """``(group as _g0.., _before, _edge, _room)``, one row per group with a quota: the edge bucket, the rows before it and the rows it may
    still give. A group with no more rows than its quota has no edge. Null labels are a group."""
    names = [f"_g{i}" for i in range(len(group_cols))]
    hist = df.groupBy(*[F.col(g).alias(n) for g, n in zip(group_cols, names)], F.substring(hash_col, 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*names).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    steps = hist.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if isinstance(quota, int):
        steps = steps.withColumn("_quota", F.lit(quota).cast("long"))
    else:
        asked = quota.select(*[F.col(g).alias(f"_q{i}") for i, g in enumerate(group_cols)], F.col("quota").cast("long").alias("_quota"))
        steps = steps.join(asked, _same(names, [f"_q{i}" for i in range(len(group_cols))]))
    inside = (F.col("_before") < F.col("_quota")) & (F.col("_quota") < F.col("_before") + F.col("_n"))
    full = F.col("_quota") == F.col("_before") + F.col("_n")
    edge = F.min(F.when(inside | full | (F.col("_quota") <= 0), F.struct("_p", F.when(F.col("_quota") > 0, F.col("_quota") - F.col("_before")).otherwise(0).alias("_room"))))
    return steps.groupBy(*names).agg(edge.alias("_e")).select(*names, F.col("_e._p").alias("_edge"), F.col("_e._room").alias("_room"))


def marked(
    df: DataFrame, hash_col: str, quota: int | DataFrame, group_cols: Sequence[str] = ("label",), ties: Sequence[str] = (), digits: int = DIGITS, out_col: str = "_in"
) -> DataFrame:
    """``df`` with a boolean column: whether the row is among its group's ``quota`` smallest by ``(hash_col, ties)``.
    ``quota`` is a number, or a table of the group columns and ``quota``; a group without a quota gives nothing.
    The input is read twice (histogram, rows) and a third time for the edge buckets: write it first if it is dear."""
    path = scratch_path(df.sparkSession, "cuts")
    cut_offs(df, hash_col, quota, group_cols, digits).withColumn("_asked", F.lit(True)).write.parquet(path)
    cuts = df.sparkSession.read.parquet(path)
    names = [f"_g{i}" for i in range(len(group_cols))]
    near = df.join(cuts, _same(group_cols, names), "left").withColumn("_b", F.substring(hash_col, 1, digits))
    asked = F.coalesce(F.col("_asked"), F.lit(False))  # every group of the input, or those with a quota
    edge = F.coalesce(F.col("_b") == F.col("_edge"), F.lit(False))
    clear = near.where(~edge).withColumn(out_col, asked & F.coalesce(F.col("_b") < F.col("_edge"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy(*group_cols).orderBy(hash_col, *ties))
    close = near.where(edge).withColumn(out_col, rank <= F.col("_room"))
    cols = [*df.columns, out_col]
    return clear.select(*cols).unionByName(close.select(*cols))


def smallest(
    df: DataFrame, hash_col: str, quota: int | DataFrame, group_cols: Sequence[str] = ("label",), ties: Sequence[str] = (), digits: int = DIGITS
) -> DataFrame:
    """The rows that ``marked`` marks."""
    return marked(df, hash_col, quota, group_cols, ties, digits).where("_in").drop("_in")


def numbered(df: DataFrame, hash_col: str, group_cols: Sequence[str] = ("label",), ties: Sequence[str] = (), rank_col: str = "seq", digits: int = DIGITS) -> DataFrame:
    """Exact rank of the rows of a sample within their group, bucket by bucket."""
    from tessera.operators.ordering import hash_rank

    return hash_rank(df, hash_col, list(group_cols), list(ties), rank_col, digits)

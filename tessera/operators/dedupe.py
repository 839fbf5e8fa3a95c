"""First-wins de-duplication (E1) and append operators.

All first-wins choices are aggregates (``min_by`` over an explicit order key),
not windows: the aggregate has a map-side partial step, so a key repeated in a
third of the rows is collapsed inside each map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(
    df: DataFrame,
    key: Column,
    order_cols: Sequence[str],
    keep_cols: Sequence[str] | None = None,
    hash_key: bool = True,
) -> DataFrame:
    """Keep the earliest row per ``key`` by ``order_cols``.

    ``hash_key`` groups on ``sha2(key, 256)`` so long texts are not shuffled as
    keys (the payload travels once, inside the ``min_by`` struct)."""
    keep = list(keep_cols or df.columns)
    k = F.sha2(key, 256) if hash_key else key
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in keep])
    agg = df.groupBy(k.alias("_key")).agg(F.min_by(payload, order).alias("_w"))
    return agg.select("_w.*")


def ordered_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """``first + second`` as a table; ``src_rank`` 0/1 records which side wins
    a later first-wins step."""
    return first.withColumn("src_rank", F.lit(0)).unionByName(second.withColumn("src_rank", F.lit(1)))


def append_absent_text(base: DataFrame, curated: DataFrame, text_col: str, order_cols: Sequence[str]) -> DataFrame:
    """Curated rows whose exact (case-sensitive) text is absent from ``base``;
    repeated curated texts keep their first row. Returns the rows to append."""
    first = first_wins(curated, F.col(text_col), order_cols, hash_key=True)
    base_keys = base.select(F.sha2(F.col(text_col), 256).alias("_h")).distinct()
    return first.join(base_keys, F.sha2(first[text_col], 256) == base_keys["_h"], "left_anti")


def row_key(cols: Sequence[str]) -> Column:
    """Null-safe whole-row identity as a fixed-width digest."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def append_if_absent(collected: DataFrame, existing: DataFrame, cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Existing rows whose whole row (``cols``) equals no collected row; repeated
    existing rows collapse to their first occurrence. Returns the rows to append."""
    cols = list(cols)
    firsts = first_wins(existing, F.to_json(F.struct(*cols)), order_cols, hash_key=True)
    seen = collected.select(row_key(cols).alias("_rk")).distinct()
    return firsts.withColumn("_rk", row_key(cols)).join(seen, "_rk", "left_anti").drop("_rk")

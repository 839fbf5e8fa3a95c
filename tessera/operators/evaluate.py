"""Prediction evaluation (D7, D8, D9, D13, C11) over an (expected, got) table.

Everything big is reduced to the confusion table first (one hash aggregate with
partial aggregation); per-class metrics then run on at most k*k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_encoder(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Classes sorted ascending -> 0..k-1 (the window runs on the k distinct labels)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        label_col, (F.dense_rank().over(Window.orderBy(label_col)) - 1).cast("long").alias("label_index"), "n"
    )


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("expected", "got").agg(F.count(F.lit(1)).alias("n"))


def accuracy(pairs: DataFrame) -> DataFrame:
    """Correct / total, plus the reference's ``c/t (p%)`` text (half-even percent)."""
    a = pairs.agg(F.count_if(F.col("expected") == F.col("got")).alias("n_correct"), F.count(F.lit(1)).alias("n_total"))
    pct = F.bround(F.col("n_correct") * 100.0 / F.col("n_total"), 0).cast("long").cast("string")
    return a.select(
        "n_correct",
        "n_total",
        F.round(F.col("n_correct") / F.col("n_total"), 6).alias("accuracy"),
        F.concat_ws("", F.col("n_correct").cast("string"), F.lit("/"), F.col("n_total").cast("string"), F.lit(" ("), pct, F.lit("%)")).alias(
            "summary"
        ),
    )


def classification_report(pairs: DataFrame) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro and
    weighted averages. Zero division gives 0. Classes = labels seen on either side."""
    cm = confusion(pairs)
    per = cm.select(
        F.explode(
            F.array(
                F.struct(F.col("expected").alias("cls"), F.col("n").alias("n_true"), F.lit(0).cast("long").alias("n_pred"),
                         F.when(F.col("expected") == F.col("got"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("got").alias("cls"), F.lit(0).cast("long").alias("n_true"), F.col("n").alias("n_pred"),
                         F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    c = per.groupBy("cls").agg(F.sum("n_true").alias("support"), F.sum("n_pred").alias("pred"), F.sum("tp").alias("tp"))
    p = F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    denom = 2 * F.col("tp") + (F.col("pred") - F.col("tp")) + (F.col("support") - F.col("tp"))
    f1 = F.when(denom > 0, 2 * F.col("tp") / denom).otherwise(F.lit(0.0))
    m = c.select(F.col("cls").alias("class"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), "support", "tp")
    row = lambda name, pr, rc, f, sup: F.struct(
        F.lit(name).alias("class") if isinstance(name, str) else name.alias("class"),
        pr.cast("double").alias("precision"), rc.cast("double").alias("recall"), f.cast("double").alias("f1"),
        sup.cast("long").alias("support"),
    )
    n, tp = F.sum("support"), F.sum("tp")
    # one aggregation over the per-class table (one row per class, so the class
    # list is bounded) gives the class rows and the three summary rows together
    one = m.agg(
        F.collect_list(row(F.col("class"), F.col("precision"), F.col("recall"), F.col("f1"), F.col("support"))).alias("rows"),
        row("accuracy", F.lit(None), F.lit(None), tp / n, n).alias("acc"),
        row("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1"), n).alias("macro"),
        row("weighted avg", F.sum(F.col("precision") * F.col("support")) / n, F.sum(F.col("recall") * F.col("support")) / n,
            F.sum(F.col("f1") * F.col("support")) / n, n).alias("weighted"),
    )
    out = one.select(F.explode(F.concat("rows", F.array("acc", "macro", "weighted"))).alias("x")).select("x.*")
    return out.select(
        "class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long")
    )


def failure_breakdown(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Failures per expected class in a fixed class order; classes without
    failures are omitted (no row)."""
    dim = pairs.sparkSession.createDataFrame([(c, i) for i, c in enumerate(order)], "expected string, ord int")
    f = pairs.where(F.col("expected") != F.col("got")).groupBy("expected", "got").agg(F.count(F.lit(1)).alias("n"))
    return f.join(F.broadcast(dim), "expected", "left").select("expected", F.col("ord").cast("long"), "got", "n")


def failure_list(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    """D9, the details: every failed row with its class's place in ``order`` (null for a class outside it) and how many
    failures that class has. Pairs with a null on either side are no failures."""
    failed = pairs.where(F.col("expected") != F.col("got"))
    places = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i).cast("long"))])
    per = failed.groupBy("expected").agg(F.count(F.lit(1)).alias("n_class"))
    return failed.withColumn("ord", F.try_element_at(places, F.col("expected"))).join(per, "expected")


def known_miss_split(failures: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """C11: a failure is 'accepted' when its key is in the known-miss set, else a
    'regression'. The optimizer sees how large ``known`` is."""
    k = known.select(on).distinct().withColumn("_known", F.lit(True))
    return failures.join(k, on, "left").withColumn(
        "status", F.when(F.col("_known"), "accepted").otherwise("regression")
    ).drop("_known")

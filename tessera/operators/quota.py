"""Quota audits over a call log.

The reference enforces quotas with in-process counters while it calls a remote
service; here the same rules audit a table of calls after the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
SECOND_US = 1_000_000
SLAB_UNITS = 3_600


def call_outcome(status, body, mode: str = "data") -> Column:
    """status/body -> outcome. ``data`` mode: 404 is 'not_found' and any 429
    mentioning quota is 'quota'; ``template`` mode also needs RESOURCE_EXHAUSTED."""
    s, b = F.col(status), F.col(body)
    quota = F.lower(b).contains("quota")
    if mode == "template":
        quota = quota & b.contains("RESOURCE_EXHAUSTED")
    out = F.when(s == 404, "not_found") if mode == "data" else None
    rules = [(s == 429) & quota, "quota"], [s == 429, "rate_limited"], [s >= 500, "server_error"], [s >= 400, "http_error"]
    for cond, name in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise("ok")


def trailing_count(df: DataFrame, key: str, ts_col: str, window_us: int = MINUTE_US, unit_us: int = SECOND_US, out_col: str = "n_window") -> DataFrame:
    """Per key, rows with timestamp in ``(t - window, t]`` (strictly under a
    minute back, peers included).

    A plain ``Window.partitionBy(key)`` would put a hot key in one task, slabs of an hour a hot key's hour. Here a row meets
    only its own unit of time (a second): the count is the sum of (a) rows of that unit up to the row, (b) whole units in
    between, from a table of counts per (key, unit), (c) rows of the unit one window back that are still inside, which
    come as bare times moved on by a window. All three are rows of the same (key, unit) group, so one exchange on it
    serves and a key spreads over all its seconds. The sliding sum (b) runs over pre-aggregated counts in slabs of
    ``SLAB_UNITS`` units with their halo.

    Rows without a time are counted among themselves; a null key is a key. ``window_us`` must be a multiple of ``unit_us``."""
    units, rest = divmod(window_us, unit_us)
    if rest or units < 1:
        raise ValueError("the window must be a whole number of units")
    at, unit = F.col("_us"), F.floor(F.col("_us") / unit_us).cast("long")
    base = df.select(F.col(key).alias("_key"), F.unix_micros(F.col(ts_col)).alias("_us"), F.struct("*").alias("_row"))
    base = base.withColumn("_unit", unit)
    # (b): counts of whole units, summed over the units - 1 units before each
    counts = base.where(at.isNotNull()).groupBy("_key", "_unit").agg(F.count(F.lit(1)).alias("_c"))
    slab = F.floor(F.col("_unit") / SLAB_UNITS).cast("long")
    own_slab = counts.withColumn("_slab", slab).withColumn("_halo", F.lit(False))
    reach = F.floor((F.col("_unit") + units - 1) / SLAB_UNITS).cast("long")
    halo = own_slab.withColumn("_slab", F.explode(F.sequence(slab, reach))).where(F.col("_slab") > slab).withColumn("_halo", F.lit(True))
    behind = Window.partitionBy("_key", "_slab").orderBy("_unit").rangeBetween(-(units - 1), -1)
    between = own_slab.unionByName(halo).withColumn("_between", F.sum("_c").over(behind)).where(~F.col("_halo") & F.col("_between").isNotNull())
    # (c): the same rows' times, one window on
    moved = base.where(at.isNotNull()).select("_key", (at + window_us).alias("_us"), (F.col("_unit") + units).alias("_unit"))
    none = F.lit(None).cast(base.schema["_row"].dataType)
    kind = lambda own, inside, mid: [own.cast("long").alias("_own"), inside.cast("long").alias("_in"), mid.cast("long").alias("_mid")]
    zero, one = F.lit(0), F.lit(1)
    rows = (
        base.select("_key", "_us", "_unit", "_row", *kind(one, zero, zero))
        .unionByName(moved.select("_key", "_us", "_unit", none.alias("_row"), *kind(zero, one, zero)))
        .unionByName(between.select("_key", (F.col("_unit") * unit_us).alias("_us"), "_unit", none.alias("_row"), *kind(zero, zero, F.col("_between"))))
    )
    group = Window.partitionBy("_key", "_unit")
    upto = group.orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_own").over(upto) - F.sum("_in").over(upto) + F.sum(F.col("_in") + F.col("_mid")).over(group)
    return rows.withColumn("_n", total.cast("long")).where("_own = 1").select("_row.*", F.col("_n").alias(out_col))


def daily_counts(df: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Calls per key per UTC day, and the never-reset running total per key
    (the window runs on the aggregated (key, day) rows only)."""
    d = df.groupBy(key, F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n_day"))
    w = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("n_cumulative", F.sum("n_day").over(w).cast("long"))


def priority_pick(daily: DataFrame, days: DataFrame, models: list[tuple[int, str, int]]) -> DataFrame:
    """Per day, the first model in priority order whose calls that day are
    below its daily limit; null when every model is spent.

    ``daily`` has (name, day, n_day); ``models`` is the small priority list
    (priority, name, rpd). Only the spent models of a day are gathered (at most
    len(models) names per day), so no day x model expansion is needed."""
    ordered = [name for _, name, _ in sorted(models)]
    limits = F.create_map(*[x for _, name, rpd in models for x in (F.lit(name), F.lit(rpd))])
    spent = daily.where(F.col("n_day") >= limits[F.col("name")]).groupBy("day").agg(F.collect_set("name").alias("spent"))
    j = days.join(spent, "day", "left")
    free = F.filter(
        F.array(*[F.lit(n) for n in ordered]),
        lambda m: ~F.array_contains(F.coalesce(F.col("spent"), F.array().cast("array<string>")), m),
    )
    return j.select("day", F.try_element_at(free, F.lit(1)).alias("picked"), F.size(F.coalesce("spent", F.array())).cast("long").alias("n_spent"))


def spent_since(calls: DataFrame, outcome: str, models: list[tuple[int, str, int]], ts_col: str = "ts", tie: str = "event_id") -> DataFrame:
    """E11, the exhausted mark: ``(name, day, since)``, the microsecond at which a model is spent for the rest of a UTC
    day: its ``rpd``-th call, or the first call refused for quota (``outcome = 'quota'``), whichever comes first.

    ``calls`` has (name, ``ts_col``, ``tie``, ``outcome``). Calls are numbered by time ranges inside (name, day), so a
    busy model spreads over many tasks; the result has at most one row per model and day. Calls without a time are
    in no day and calls of other models in no list: they count for nothing."""
    from tessera.operators.ordering import range_rank

    limits = F.create_map(*[x for _, name, rpd in models for x in (F.lit(name), F.lit(rpd))])
    c = calls.where(F.col(ts_col).isNotNull()).select(
        "name", F.to_date(ts_col).alias("day"), F.unix_micros(ts_col).alias("us"), F.col(tie).alias("tie"), F.col(outcome).alias("outcome")
    )
    c = range_rank(c, "us", ["name", "day"], ["tie"], rank_col="call_no")
    over = (F.col("call_no") >= F.try_element_at(limits, F.col("name"))) | (F.col("outcome") == "quota")
    return c.where(over).groupBy("name", "day").agg(F.min("us").alias("since"))


def pick_at(calls: DataFrame, spent: DataFrame, models: list[tuple[int, str, int]], ts_col: str = "ts") -> DataFrame:
    """E11 per call: ``picked``, the first model in priority order that is not spent before the call, and ``n_spent``;
    ``picked`` is null when all are spent (or the call has no time). A day's marks travel as one map of at most
    len(models) entries."""
    ordered = [name for _, name, _ in sorted(models)]
    names = F.array(*[F.lit(n) for n in ordered])
    marks = spent.where(F.col("name").isin(ordered)).groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("name", "since"))).alias("_since"))
    day, us = F.to_date(ts_col), F.unix_micros(ts_col)
    j = calls.withColumn("_day", day).join(marks.withColumnRenamed("day", "_day"), "_day", "left")
    since = F.coalesce("_since", F.create_map().cast("map<string,bigint>"))
    free = F.filter(names, lambda m: F.coalesce(F.try_element_at(since, m) >= us, us.isNotNull()))
    j = j.withColumn("picked", F.try_element_at(free, F.lit(1))).withColumn("n_spent", (F.lit(len(ordered)) - F.size(free)).cast("long"))
    return j.drop("_day", "_since")

"""Quality rules with risk-controlled thresholds.

Every rule compares one text measure with a cut-off. Cut-offs are chosen per stratum from labelled
holdout rows so that, with probability ``1 - delta`` over all strata and rules together, the rules
of a stratum reject at most a share ``alpha`` of its good documents between them (each has an equal part of it). Per (stratum, rule) the cut-offs
are tried from the most lenient to the strictest, and one is accepted while the exact binomial tail
``P(Bin(n, alpha / rules) <= rejected good rows)`` is at most its share of ``delta`` (fixed-sequence testing needs
no correction along the sequence; strata x rules are Bonferroni-corrected). Of the accepted cut-offs
the one that pays most is used: rejected bad rows less ``COST`` times rejected good rows, the more
lenient on ties, none if nothing is gained. A stratum without enough good labels accepts no cut-off,
so only the base rule applies there.

DataFrame functions only. Null and empty texts have zero counts and fail the base rule. A null stratum
is a stratum of its own. Windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_once, written

ALPHA = 0.05
DELTA = 0.05
COST = 10  # bad rows that must go for one good row lost
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SPACES = "[\\x20\\x09-\\x0D]+"

# Rules: measure -> cut-offs from lenient to strict; a document is rejected where measure > cut-off.
GRID = {
    "symbol_share": [1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02],
    "mark_share": [1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04],
    "capital_share": [1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2],
    "dup_line_share": [1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "mean_word": [30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0],
}


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space."""
    return F.filter(F.split(text_of(text), SPACES), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """One hash per window of ``WINDOW`` words; none below that many words."""
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    return F.when(n > WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """The input columns and ``_q``: a struct of the text measures. One pass, no shuffle.

    Built in steps (one projection each) so that no expensive array is evaluated twice."""
    t = text_of(F.col(text))
    d = df.withColumn("_t", t).withColumn("_w", words_of(F.col("_t")))
    d = d.withColumn("_h", window_hashes(F.col("_w")))
    # Only where array_distinct drops a hash does a window occur twice: sort (hash, position) there, flag
    # equal neighbours, and let each flagged window add its words up to the next flagged one.
    pairs = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_p", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs))
    d = d.withColumn(
        "_f",
        F.sort_array(
            F.transform(
                F.filter("_p", lambda p, k: (F.get("_p", k - 1)["h"].eqNullSafe(p["h"])) | (F.get("_p", k + 1)["h"].eqNullSafe(p["h"]))),
                lambda p: p["i"],
            )
        ),
    )
    repeat = F.aggregate(
        F.transform("_f", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_f", k + 1) - i, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    d = d.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    n = F.size("_w").cast("bigint")
    chars = F.length(F.array_join("_w", "")).cast("bigint")
    d = d.withColumn(
        "_c",
        F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            F.regexp_count("_t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
            F.coalesce(repeat, F.lit(0)).alias("n_repeat_words"),
            F.size("_l").alias("n_lines"),
            F.regexp_count("_t", F.lit("[!?=~^_+{}\\[\\]\\\\@]")).alias("n_marks"),
            F.regexp_count("_t", F.lit("\\p{Lu}")).alias("n_capitals"),
        ),
    )
    c = F.col("_c")
    per_char = lambda x: F.coalesce(F.try_divide(x, c["word_chars"]), F.lit(0.0))
    q = F.struct(
        *[c[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        per_char(c["n_symbols"]).alias("symbol_share"),
        per_char(c["n_marks"]).alias("mark_share"),
        per_char(c["n_capitals"]).alias("capital_share"),
        F.coalesce(F.try_divide(c["n_dup_lines"], c["n_lines"]), F.lit(0.0)).alias("dup_line_share"),
        F.coalesce(F.try_divide(c["word_chars"], c["n_words"]), F.lit(0.0)).alias("mean_word"),
        ((c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])).alias("base_failed"),
    )
    return d.select(*df.columns, q.alias("_q"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """``P(Bin(n, p) <= k)`` for ``k <= n * p`` by summing log terms (nulls and larger k: 1)."""
    ratio = F.log(F.lit(p / (1 - p)))
    first = n.cast("double") * F.log(F.lit(1 - p))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + ratio
        top = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))).alias("sum"))

    terms = F.filter(F.sequence(F.lit(0), k.cast("int")), lambda i: i > 0)
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), step, lambda a: F.exp(a["sum"]))
    return F.when((n > 0) & (k <= n * p), total).otherwise(F.lit(1.0))


def thresholds(measured: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", good: str = "quality",
               alpha: float = ALPHA, delta: float = DELTA, grid: dict[str, list[float]] = GRID) -> DataFrame:
    """``(stratum, rule, cutoff)`` for every stratum with labelled rows; ``cutoff`` is null where none is
    certified. ``measured`` needs ``key``, ``stratum`` and ``_q``. One partial aggregation: what is
    shuffled is one row per task and stratum."""
    held = measured.select(F.col(key).alias("_k"), F.col(stratum).alias("_s"), "_q").join(
        labelled_once(labels.select(F.col(key).alias("_k"), F.col(good).alias("_good")), "_k", "_good"), "_k"
    )

    def over(wanted: int) -> list[Column]:
        return [
            F.array(*[F.count(F.when((F.col("_good") == wanted) & (F.col(f"_q.{rule}") > c), 1)) for c in cuts])
            for rule, cuts in grid.items()
        ]

    counts = held.groupBy("_s").agg(
        F.count(F.when(F.col("_good") == 1, 1)).alias("n"), F.array(*over(1)).alias("good"), F.array(*over(0)).alias("bad")
    )
    n_strata = counts.agg(F.count("*").alias("n_strata"))
    known = F.array(*[F.struct(F.lit(rule).alias("rule"), F.array(*map(F.lit, cuts)).alias("cuts")) for rule, cuts in grid.items()])
    rules = counts.join(F.broadcast(n_strata)).select("_s", "n", "n_strata", F.inline(F.arrays_zip(known.alias("known"), "good", "bad")))
    tested = rules.select(
        "_s", "known.rule", "known.cuts", "good", "bad",
        (F.lit(delta / len(grid)) / F.col("n_strata")).alias("level"),
        # the rules of a stratum share its allowance, so all of them together stay within it
        F.transform("good", lambda k: binomial_tail(k, F.col("n"), alpha / len(grid))).alias("tails"),
    )
    # the first failure ends the sequence
    failed = F.array_position(F.transform("tails", lambda t: t <= F.col("level")), F.lit(False)).cast("int")
    accepted = F.when(failed == 0, F.size("tails")).otherwise(failed - 1)
    gains = F.transform(
        F.sequence(F.lit(0), F.size("cuts") - 1),
        lambda i: F.struct(
            F.when(i < accepted, F.get("bad", i) - COST * F.get("good", i)).otherwise(0).alias("gain"), (-i).alias("i")
        ),
    )
    best = F.array_max(gains)
    cutoff = F.when(best["gain"] > 0, F.get("cuts", -best["i"]))
    return tested.select(F.col("_s").alias("stratum"), "rule", cutoff.alias("cutoff"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", grid: dict[str, list[float]] = GRID) -> DataFrame:
    """``measured`` and ``_kept``: false where the base rule or a certified cut-off rejects. One row per
    stratum is joined; the optimizer decides by its size how."""
    wide = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    over = F.lit(False)
    for rule in grid:
        over = over | F.coalesce(F.col(f"_q.{rule}") > F.element_at("_cut", F.lit(rule)), F.lit(False))
    out = measured.join(wide, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
    return out.select(*measured.columns, (~F.col("_q.base_failed") & ~over).alias("_kept"))


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
         columns: list[str] | None = None, **how) -> DataFrame:
    """All rows of ``docs`` (``columns`` of them, by default all) with ``_q`` and ``_kept``.

    Every text is measured once, into a written table; cut-offs come from its labelled rows, joined
    without their texts."""
    measured = written(measures(docs, text).select(*(columns or docs.columns), "_q"), "quality")
    # written, so that the size of the cut-offs is known before the rows would be shuffled by stratum
    cutoffs = written(thresholds(measured, labels, key, stratum, **how), "quality-cutoffs")
    return judge(measured, cutoffs, stratum)

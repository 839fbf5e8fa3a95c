"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

DataFrame functions and Spark ML only. The model is fitted on a small labelled URL table (bounded by
``max_labelled`` rows; one row per URL) and applied to every URL in the same scan: no shuffle on the
main path. A null URL, or one without ``://``, has an empty host and path and is judged by the model
from its bias alone.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (verdict, host, path prefix); a rule holds for the host and its subdomains.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
FEATURES = 1 << 13
GRAMS = (3, 4, 5)
THRESHOLD = 0.5

# The labelled URL table: words of hosts and paths that mark wanted (0) and unwanted (1) pages.
WANTED = (["news", "docs", "wiki", "library", "research", "journal", "school", "museum", "weather", "science", "blog", "m"],
          ["article", "guide", "reference", "history", "report", "tutorial", "en", "fr", "de", "es"])
UNWANTED = (["spam-farm", "casino", "cheap-pills", "free-bonus", "adult-cams", "click-bait", "lottery-win", "payday-loan",
             "torrent-hub", "fake-watches", "seo-links", "ad-server"],
            ["win", "bonus", "buy-now", "xxx", "click", "offer", "jackpot", "viagra", "download-free", "promo"])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table ``(url, label)``: every host word with every path word."""
    tlds = ["example.com", "example.net", "example.org"]
    rows = [
        (f"https://{h}.{tlds[(i + j) % 3]}/{p}/{100 * i + j}", float(label))
        for label, (hosts, paths) in enumerate([WANTED, UNWANTED])
        for i, h in enumerate(hosts)
        for j, p in enumerate(paths)
    ]
    return spark.createDataFrame(rows, "url string, label double")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, null where none fits."""
    fits = None
    rule = verdict = F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, action).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of ``^host`` and of ``path$``, tagged by where they are from."""

    def of(s: Column, tag: str, n: int) -> Column:
        last = F.length(s) - n + 1
        return F.when(
            last >= 1,
            F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.concat(F.lit(tag), F.substr(s, i, F.lit(n)))),
        ).otherwise(F.array().cast("array<string>"))

    h, p = F.concat(F.lit("^"), host), F.concat(path, F.lit("$"))
    return F.concat(*[of(h, "h", n) for n in GRAMS], *[of(p, "p", n) for n in GRAMS])


def _features(df: DataFrame, host: Column, path: Column, features: int) -> DataFrame:
    return HashingTF(inputCol="_grams", outputCol="_vec", numFeatures=features, binary=True).transform(df.withColumn("_grams", grams(host, path)))


def fit(labelled: DataFrame, features: int = FEATURES, max_labelled: int = 100_000):
    """Logistic regression from ``(url, label)`` with label 1 for unwanted; rows without a url or label
    are left out, at most ``max_labelled`` urls (the smallest by hash) are used."""
    rows = labelled.where("url is not null and label is not null").groupBy("url").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(max_labelled)
    rows = _features(rows, host_of(F.col("url")), path_of(F.col("url")), features)
    return LogisticRegression(featuresCol="_vec", labelCol="label", regParam=0.01, maxIter=50).fit(rows)


def judge(df: DataFrame, model, key: str = "page_id", url: str = "url", rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, host, path, rule, verdict, score)``, one row per input row; other columns are ignored."""
    out = df.select(F.col(key), F.col(url).alias("_url")).select(key, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = _features(out, F.col("host"), F.col("path"), model.numFeatures)
    model = model.copy().setFeaturesCol("_vec").setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    score = vector_to_array("_p")[1]
    return model.transform(scored).select(
        key, "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"),
    )


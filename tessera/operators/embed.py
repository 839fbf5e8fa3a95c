"""Text -> unit vector (F1).

Default: a built-in, distributed vectoriser (word tokens -> hashed term counts
-> IDF -> L2 normaliser), fitted with one aggregation pass. A pretrained sentence
encoder can be plugged in with ``encoder_udf``: an iterator pandas UDF that loads
the model once per Python worker and encodes Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

NUM_FEATURES = 1 << 16


def _counting(text_col: str, num_features: int) -> list:
    return [
        RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[\p{L}\p{N}_]+", gaps=False, toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
    ]


def _weighting(out_col: str) -> list:
    return [IDF(inputCol="_tf", outputCol="_tfidf"), Normalizer(inputCol="_tfidf", outputCol=out_col, p=2.0)]


def vectoriser(text_col: str = "text", out_col: str = "embedding", num_features: int = NUM_FEATURES) -> Pipeline:
    return Pipeline(stages=[*_counting(text_col, num_features), *_weighting(out_col)])


def fit_vectoriser(df: DataFrame, text_col: str = "text", out_col: str = "embedding", num_features: int = NUM_FEATURES) -> PipelineModel:
    return vectoriser(text_col, out_col, num_features).fit(df)


def fit_embed(
    df: DataFrame, text_col: str = "text", as_array: bool = True, out_col: str = "embedding", num_features: int = NUM_FEATURES
) -> tuple[PipelineModel, DataFrame]:
    """The vectoriser fitted on ``df``, and ``df`` embedded with it, without its text. Words are counted in one pass
    and the counts written, so that neither the fit nor what is trained on the vectors reads the texts again."""
    counting = PipelineModel(_counting(text_col, num_features))
    path = scratch_path(df.sparkSession, "word-counts")
    counting.transform(df).drop(text_col, "_tokens").write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    weighting = Pipeline(stages=_weighting(out_col)).fit(counts)
    return PipelineModel([*counting.stages, *weighting.stages]), embed(weighting, counts, as_array, out_col)


def embed(model: PipelineModel, df: DataFrame, as_array: bool = True, out_col: str = "embedding") -> DataFrame:
    out = model.transform(df).drop("_tokens", "_tf", "_tfidf")
    if as_array:
        out = out.withColumn(out_col, vector_to_array(out_col, "float32"))
    return out


def encoder_udf(load: Callable[[], Callable[[list[str]], list[list[float]]]], dim: int):
    """Plug-in point for any sentence encoder: ``load()`` runs once per worker
    and returns ``encode(texts) -> vectors`` (expected unit-normalised)."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = load()
        for s in batches:
            yield pd.Series([list(map(float, v)) for v in enc(s.fillna("").tolist())])

    return encode

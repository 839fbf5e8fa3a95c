"""Paths and helpers that tests import (a module of its own: several folders have a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def one_col(spark, values, expr, schema="x string"):
    """Evaluate a Column expression over a list of single values, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col(schema.split()[0]))).collect()]

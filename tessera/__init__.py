"""tessera: Spark-native dataset curation, contract checking, retrieval and routing.

Sub-packages
------------
functions  Column -> Column expressions (text rules, contracts, rendering, routing tags).
operators  DataFrame -> DataFrame operators (dedupe, sampling, evaluation, vectors, quotas).
sources    readers and writers (parquet fixtures, JSONL, catalogue trees, archives, logs).
plans      end-to-end jobs and the registered query set with its DuckDB oracle SQL.
streaming  Structured Streaming forms of the batch operators.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in tasks travel by value: workers need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

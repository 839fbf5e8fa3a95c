"""Small helpers added for scale: strict JSON, text rules off the fixtures, shared scratch folder."""

from pyspark.sql import functions as F

from tessera.plans.responses import strict_json_valid, strict_parse_json


def test_strict_json_validity_matches_parse(spark):
    vals = ['{"a": 1}', "[1, 2]", '"s"', "1", '{"a": 1} junk', "[1] [2]", "[1], [2]", "", "  {}  ", '{"a": }', "null"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string")
    rows = df.orderBy("i").select(strict_json_valid(F.col("x")).alias("v"), strict_parse_json(F.col("x")).isNotNull().alias("p")).collect()
    assert [r.v for r in rows] == [True, True, True, True, False, False, False, False, True, False, True]
    # the parse form agrees except for JSON null (valid, but no value)
    assert [r.p for r in rows][:-1] == [r.v for r in rows][:-1]


def test_strict_json_rejects_what_python_rejects(spark):
    bad = ['{"a":1}] junk', "1], [2", "['a']", '["a\nb"]', '["a\tb"]', '["a"]], [["b"]', '1,"v":2', "{'a':1}"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(bad)], "i int, x string")
    assert not any(r[0] for r in df.select(strict_json_valid(F.col("x"))).collect())
    assert all(r[0] is None for r in df.select(strict_parse_json(F.col("x"))).collect())


def test_long_documents_and_quotes(spark):
    from tessera.functions import routing as R
    from tessera.functions import text as T

    df = spark.createDataFrame([("a" * 50_000,)], "x string")
    assert df.select(T.validate_text("x", 3, None)).first()[0] and not df.select(T.validate_text("x")).first()[0]
    q = spark.createDataFrame([('"abc"\n',), ("'\"x'",)], "x string").select(T.strip_quote_chars("x")).collect()
    assert [r[0] for r in q] == ['abc"\n', "x"]
    cmds = ["rm\u00a0-rf /x", "rm\x1f-rf *", "git push a\r--force", "git push\u2028--force", "dd a\r of=/dev/sda", "ls -la"]
    tagged = spark.createDataFrame([(i, c) for i, c in enumerate(cmds)], "i int, c string").orderBy("i").select(R.danger_reason("c")).collect()
    assert [r[0] is not None for r in tagged] == [True] * 5 + [False]


def test_corrupt_meta_is_an_error(spark):
    from tessera.functions import contracts as K

    metas = ["{broken", "[1]", '{"id":"a","name":"n","category":"c","placeholders":"zzz"}']
    df = spark.createDataFrame([(m,) for m in metas], "m string").select(K.template_error("m", F.lit("<p></p>"), F.lit("")))
    assert [r[0] for r in df.collect()] == [K.MSG_BAD_META] * 3


def test_scratch_needs_a_shared_folder_off_local():
    import pytest

    from tessera.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_vector_search_without_queries(spark):
    from tessera.operators.vectors import top1, topk

    index = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    none = spark.createDataFrame([], "query_id long, embedding array<double>")
    assert topk(index, none, 3).count() == 0
    assert [tuple(r) for r in top1(index, none, 0.4).collect()] == [(1, None, None)]

"""The pipeline on small tables: each stage's decisions take effect and nothing clean is lost."""

import corpus_pipeline
from tessera.llm import secret_scan, toxicity
from test_llm_operators import brute_classes, check_pieces, docs, empty, rows, whole_ids  # noqa: F401


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "jaccard_join", "secret_scan", "packing"]


def test_stages(spark, docs, rows, tmp_path):  # noqa: F811
    toxic = [(5000, "you idiot " + " ".join(f"u{i}q" for i in range(40)) + " you moron and stupid scum", "en", "s", 9)]
    table = docs.unionByName(spark.createDataFrame(toxic, docs.schema))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns, name
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        steps.append({r.doc_id: r.text for r in at.collect()})
    good = {r[0]: r[1] for r in rows if r[1] and len(r[1].split()) >= 10}
    assert steps[0] == good | {5000: toxic[0][1]}
    assert steps[1] == good
    assert set(steps[2]) == {c for _, c in brute_classes(list(good.items())).values()}
    assert steps[3] == {k: secret_scan.redacted(t) for k, t in steps[2].items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_pieces(pieces, whole_ids(list(steps[3].items()), 2), 4096)
    assert toxicity.CUT == 0.3


def test_stages_with_clashing_columns_null_ids_and_empty_tables(spark, docs, tmp_path):  # noqa: F811
    from pyspark.sql import functions as F

    clash = ["stratum", "score", "_x", "_scan", "_t", "_q", "_kept", "row", "_row"]
    table = docs.unionByName(spark.createDataFrame([(None, "a text without an id " * 9, "en", "s", 9)], docs.schema))
    for c in clash:
        table = table.withColumn(c, F.lit(f"own {c}"))
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for at in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = spark.createDataFrame(stage(spark, at, str(tmp_path)).collect(), table.schema)
            assert at.columns == table.columns, name
            assert {tuple(r) for r in at.select(*clash).distinct().collect()} <= {tuple(f"own {c}" for c in clash)}
        assert at.where("doc_id is null").count() in (0, 1)
        assert corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).count() >= at.count()

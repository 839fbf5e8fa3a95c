"""Invariants and brute-force checks of the distributed operators."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import SF_SMALL
from tessera.operators import ordering as O
from tessera.operators import quota as Q
from tessera.operators import vectors as V
from tessera.operators.dedupe import first_wins


def test_hash_rank_equals_window(spark):
    rows = [(i % 3, f"k{i % 50}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, k string, i int").withColumn("h", O.seeded_key(42, "k"))
    got = O.hash_rank(df, "h", ["g"], ["i"], "r", bucket_digits=2)
    ref = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy("h", "i")))
    j = got.join(ref, ["g", "k", "i"])
    assert j.count() == 600 and j.where("r <> r2").count() == 0


def test_range_rank_and_running_sum(spark):
    df = spark.createDataFrame([(i * 7 % 1000, 1 + i % 5) for i in range(1000)], "pos long, v long").dropDuplicates(["pos"])
    r = O.range_rank(df, "pos", rank_col="r", buckets=16, total_col="t").collect()
    by = sorted(r, key=lambda x: x.pos)
    assert [x.r for x in by] == list(range(1, len(by) + 1)) and {x.t for x in by} == {len(by)}
    s = O.running_sum(df, "pos", "v", "run", buckets=16).collect()
    acc, ok = 0, True
    for x in sorted(s, key=lambda x: x.pos):
        acc += x.v
        ok &= x.run == acc
    assert ok


def test_first_wins_partition_invariant_and_idempotent(spark):
    rows = [(f" Key{i % 40} ", i, i % 7) for i in range(400)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "t string, seq int, lab int")
    res = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        out = first_wins(df.repartition(n), F.lower(F.trim("t")), ["seq"])
        res.append(sorted(map(tuple, out.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1] and len(res[0]) == 40 and all(r[1] < 40 for r in res[0])
    again = first_wins(spark.createDataFrame(res[0], df.schema), F.lower(F.trim("t")), ["seq"])
    assert sorted(map(tuple, again.collect())) == res[0]


def test_stratified_split_exact(spark):
    from tessera.plans.dataset import examples, stratified_split_df

    ex = examples(spark, SF_SMALL).select("seq", "label")
    s = stratified_split_df(ex, 15, 42)
    n = ex.count()
    counts = {r.split: r.c for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert counts["val"] == -(-n * 15 // 100) and counts["val"] + counts["train"] == n
    assert s.select("seq").distinct().count() == n  # disjoint and complete


def test_balance_never_grows(spark):
    from tessera.plans.dataset import BALANCE_LABEL, BALANCE_TARGET, balance_downsample, examples

    before = {r.label: r.c for r in examples(spark, SF_SMALL).groupBy("label").agg(F.count(F.lit(1)).alias("c")).collect()}
    after = {r.label: r.c for r in balance_downsample(spark, SF_SMALL).groupBy("label").agg(F.count(F.lit(1)).alias("c")).collect()}
    for k, v in after.items():
        assert v <= before[k]
    assert after[BALANCE_LABEL] == min(BALANCE_TARGET, before[BALANCE_LABEL])


def test_trailing_minute_brute_force(spark):
    base = dt.datetime(2024, 1, 1, 0, 59, 0)
    secs = [0, 30, 59.999999, 60, 60, 119.5, 3600, 3659, 3660.000001]
    rows = [(i, "u" if i % 4 else "v", base + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp")
    got = {r.id: r.n_window for r in Q.trailing_count(df, "k", "ts").collect()}
    for i, k, t in rows:
        exp = sum(1 for _, k2, t2 in rows if k2 == k and dt.timedelta(0) <= t - t2 < dt.timedelta(seconds=60))
        assert got[i] == exp, (i, got[i], exp)


def test_call_outcomes_modes(spark):
    df = spark.createDataFrame(
        [(404, ""), (429, "quota exceeded"), (429, "RESOURCE_EXHAUSTED quota"), (429, "slow down"), (503, ""), (400, ""), (200, "")],
        "s int, b string",
    )
    data = [r[0] for r in df.select(Q.call_outcome("s", "b", "data")).collect()]
    tmpl = [r[0] for r in df.select(Q.call_outcome("s", "b", "template")).collect()]
    assert data == ["not_found", "quota", "quota", "rate_limited", "server_error", "http_error", "ok"]
    assert tmpl == ["http_error", "rate_limited", "quota", "rate_limited", "server_error", "http_error", "ok"]


def _vec_tables(spark, n=300, m=7, d=16, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d)).astype(np.float32)
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    Qm = rng.normal(size=(m, d))
    Qm /= np.linalg.norm(Qm, axis=1, keepdims=True)
    X[5] = X[4]  # an exact tie
    idx = spark.createDataFrame([(i, X[i].tolist()) for i in range(n)], "vec_id long, embedding array<float>").repartition(5)
    qs = spark.createDataFrame([(j, Qm[j].tolist()) for j in range(m)], "query_id long, embedding array<double>")
    return X.astype(np.float64), Qm, idx, qs


@pytest.mark.parametrize("block", [V.SLICE_ROWS, 3])
def test_topk_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(V, "SLICE_ROWS", block)
    X, Qm, idx, qs = _vec_tables(spark)
    got = V.topk(idx, qs, 4).collect()
    S = X @ Qm.T
    for j in range(Qm.shape[0]):
        order = sorted(range(len(X)), key=lambda i: (-round(S[i, j], 6), i))[:4]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == j), key=lambda r: r.rank)] == order


def test_top1_threshold_edges(spark):
    X, Qm, idx, qs = _vec_tables(spark)
    got = {r.vec_id: r for r in V.top1(idx, qs, 0.4).collect()}
    S = X @ Qm.T
    for i in range(len(X)):
        b = int(np.argmax(S[i]))
        exp = b if S[i, b] >= 0.4 else None
        assert got[i].query_id == exp
    # exactly at the threshold matches
    one = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(7, [0.4, 0.9165151389911680])], "query_id long, embedding array<double>")
    assert V.top1(one, q, 0.4).first().query_id == 7


def test_vector_search_ties_ragged_and_null_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(90, None), (91, [None, 1.0]), (92, [float("nan"), 0.0]), (93, [1.0, 0.0, 0.0]), (94, []), (95, [0.0, 1.0])]
    idx = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    qs = spark.createDataFrame([(5, [0.4, 0.9]), (6, None), (7, [0.0, 0.0, 2.0])], "query_id long, embedding array<double>")
    got = sorted(tuple(r) for r in V.topk(idx, qs, 3, rows=4).collect())
    assert got == [(5, 1, 95, 0.9), (5, 2, 0, 0.4), (5, 3, 1, 0.4), (7, 1, 93, 0.0)]
    one = {r.vec_id: (r.query_id, r.score) for r in V.top1(idx, qs, 0.4, rows=4).collect()}
    assert one[0] == (5, 0.4) and one[95] == (5, 0.9) and one[93] == (None, 0.0)
    assert all(one[i] == (None, None) for i in (90, 91, 92, 94)) and len(one) == len(rows)
    assert V.topk(idx.limit(0), qs, 3).count() == 0 and V.topk(idx, qs.limit(0), 3).count() == 0


def test_cell_scores_hold_no_driver_matrix(spark):
    """Both sides are dealt by the shuffle: the plan co-groups cells and ships no array in a closure."""
    from pyspark import cloudpickle

    _, _, idx, qs = _vec_tables(spark)
    plan = V.cell_winners(idx, qs, 3, "vec_id", "query_id", "embedding", "embedding", 8)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert len(cloudpickle.dumps(V.best_of_cell)) < 20_000


def test_cell_scores_are_held_by_tiles(monkeypatch):
    """Memory of a cell does not grow with queries times index rows, and tiles of any size give the same winners."""
    import tracemalloc

    rng = np.random.default_rng(2)
    Q, X = rng.normal(size=(8000, 4)), rng.normal(size=(1100, 4))
    tracemalloc.start()
    row, ids, score = V.best_of_cell(Q, X, np.arange(1100), 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6  # 8,000 x 1,024 scores alone are 66 MB, and several such arrays were held
    assert list(row[:4]) == [0, 0, 1, 1] and row[-1] == 7999
    monkeypatch.setattr(V, "TILE", 37)
    again = V.best_of_cell(Q[:100], X, np.arange(1100), 2)
    assert (again[0] == row[:200]).all() and (again[1] == ids[:200]).all() and np.allclose(again[2], score[:200])
    assert [len(a) for a in V.best_of_cell(Q, X[:1], np.arange(1), 2)] == [8000] * 3


def _sample_rows():
    rng = np.random.default_rng(11)
    rows = [(i, "big" if i % 3 else ["a", "b", None][i % 2 + (i % 9 == 0)], str(i)) for i in range(3000)]
    rng.shuffle(rows)
    return [(int(a), None if b == "None" else b, c) for a, b, c in rows]


@pytest.mark.parametrize("digits", [1, 4])
def test_cut_off_samples_equal_a_full_sort(spark, digits):
    import hashlib
    from collections import defaultdict

    from tessera.operators import sampling as SA

    df = spark.createDataFrame(_sample_rows(), "seq long, label string, x string").withColumn("_h", F.md5("x")).repartition(6)
    by = defaultdict(list)
    for i, lab, x in _sample_rows():
        by[lab].append((hashlib.md5(x.encode()).hexdigest(), i))
    for n in (0, 1, 17, 400, 5000):
        got = defaultdict(set)
        for r in SA.smallest(df, "_h", n, ties=["seq"], digits=digits).collect():
            got[r.label].add(r.seq)
        assert got == {k: {i for _, i in sorted(v)[:n]} for k, v in by.items() if n}
    quota = spark.createDataFrame([("big", 700), ("a", 0), (None, 3)], "label string, quota long")
    got = SA.marked(df, "_h", quota, ties=["seq"], digits=digits).where("_in").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {"big": 700, None: 3}
    ranks = {(r.label, r.seq): r.place for r in SA.numbered(SA.smallest(df, "_h", 40, digits=digits), "_h", rank_col="place").collect() if r.label}
    assert ranks == {(k, i): n + 1 for k, v in by.items() if k for n, (_, i) in enumerate(sorted(v)[:40])}
    # equal keys: the quota still holds
    same = df.withColumn("_h", F.lit("ab" * 16))
    assert SA.smallest(same.where("label = 'big'"), "_h", 5, ties=["seq"]).count() == 5
    assert SA.smallest(df.limit(0), "_h", 5).count() == 0


def test_samples_shuffle_the_edge_bucket_alone(spark):
    """No window over a whole label: the only ranked rows are those of the edge bucket."""
    from tessera.operators import sampling as SA

    df = spark.range(200_000).select(F.col("id").alias("seq"), F.lit("hot").alias("label"), F.md5(F.col("id").cast("string")).alias("_h"))
    plan = SA.smallest(df, "_h", 50_000, ties=["seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == 1
    edge = SA.cut_offs(df, "_h", 50_000, ["label"]).first()
    close = df.where(F.substring("_h", 1, SA.DIGITS) == edge["_edge"]).count()
    assert 0 < edge["_room"] <= close < 40


def test_samples_of_large_inputs_do_not_shuffle_rows_by_label(spark):
    """The cut-offs are read back with their real size, so the rows are joined where they are read."""
    from tessera.operators import sampling as SA

    df = spark.range(4_000_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 10 > 0, "hot").otherwise("b").alias("label"), F.md5(F.col("id").cast("string")).alias("_h"))
    plan = SA.marked(df, "_h", 50_000, ties=["seq"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_text_index_saved_reloaded_and_searched(spark, tmp_path, monkeypatch):
    import math
    import re
    from collections import Counter

    from tessera.operators import textindex as TI

    monkeypatch.setattr(TI, "SLICE_ROWS", 7)
    texts = {f"t{i}": f"the {w} site number {i % 4} the" for i, w in enumerate(["yoga", "law", "photo", "coffee", "yoga", "été", "yoga studio", "studio"] * 4)}
    texts |= {"empty": "", "null": None}
    df = spark.createDataFrame([(k, v, k.upper()) for k, v in texts.items()] + [(None, "yoga", "x")], "id string, body string, name string")
    TI.TextIndex.build(df, f"{tmp_path}/index", "id", "body")
    index = TI.TextIndex.load(spark, f"{tmp_path}/index")
    assert "body" not in index.records.columns and index.vectoriser.n_docs == len(texts)
    asked = {"q1": "a yoga studio", "q2": "nothing known", "q3": "law the site", "q4": "Été number 1", **{f"self:{k}": v for k, v in texts.items()}}
    queries = spark.createDataFrame(list(asked.items()), "query string, body string")

    words = lambda t: Counter(re.findall(r"\w+", (t or "").lower()))
    df_of = Counter(w for t in texts.values() for w in words(t))
    n = len(texts)

    def vec(t):
        raw = {w: c * math.log((n + 1) / (df_of[w] + 1)) for w, c in words(t).items() if w in df_of and df_of[w] < n}
        size = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / size for w, x in raw.items()}

    vecs = {k: vec(t) for k, t in texts.items()}
    for threshold in (None, 0.4):
        got = {}
        for r in index.search(queries, "query", "body", 3, threshold).collect():
            got.setdefault(r.query, []).append((r.rank, r.id, r.score))
        for q, t in asked.items():
            v = vec(t)
            scored = [(-round(sum(x * d.get(w, 0) for w, x in v.items()), 6), k) for k, d in vecs.items() if set(v) & set(d)]
            best = [(i + 1, k, -s) for i, (s, k) in enumerate(sorted(scored)[:3]) if threshold is None or -s >= threshold]
            assert sorted(got.get(q, [])) == best, q
    assert all(got[f"self:t{i}"][0][2] == 1.0 for i in range(8))
    # any id type
    numbers = TI.TextIndex.build(df.select(F.hash("id").alias("k"), "body"), f"{tmp_path}/other", "k", "body")
    assert numbers.search(queries, "query", "body", 1).where("query = 'q1'").count() == 1
    assert TI.TextIndex.build(df.limit(0), f"{tmp_path}/none", "id", "body").search(queries, "query", "body").count() == 0


def test_equal_texts_are_searched_once(spark, tmp_path):
    """Copies on either side are one vector in the index and in the join, and come back one by one."""
    from tessera.operators import textindex as TI

    rows = [(i, ["red fox runs", "blue fox", "green tree"][i % 3]) for i in range(60)] + [(3, "red fox runs"), (5, "blue sea"), (None, "red")]
    df = spark.createDataFrame(rows, "id long, body string")
    index = TI.TextIndex.build(df, f"{tmp_path}/index", "id", "body")
    # 3 has its text twice and 5 has two texts: both stand for themselves
    assert {r.id for r in index.postings.select("id").distinct().collect()} == {0, 1, 2, 3, 5}
    assert {r.id: r.rep for r in index.members.collect()} == {i: i if i in (3, 5) else i % 3 for i in range(60)}
    got = {}
    for r in index.search(df.withColumnRenamed("id", "asked"), "asked", "body", 3, 0.4).collect():
        got.setdefault(r.asked, []).append((r.rank, r.id, r.score))
    assert sorted(got) == list(range(60)) and {i for i, v in got.items() if len(v) != 3} == {5}
    assert all(sorted(got[i]) == [(1, 0, 1.0), (2, 3, 1.0), (3, 6, 1.0)] for i in range(0, 60, 3))
    assert sorted(got[4]) == [(1, 1, 1.0), (2, 4, 1.0), (3, 7, 1.0)] and got[5] == [(1, 5, 1.0)]


def test_search_shuffles_vectors_not_pairs(spark, tmp_path):
    """Every text shares a word with 59 others above the threshold: 18,000 pairs, which only the cells hold."""
    from tessera.operators import textindex as TI

    df = spark.createDataFrame([(i, f"common{i % 5} own{i} own{i}b") for i in range(300)], "id long, body string")
    index = TI.TextIndex.build(df, f"{tmp_path}/index", "id", "body")
    out = index.search(df.withColumnRenamed("id", "asked"), "asked", "body", 3, 0.04)
    got = {}
    for r in out.collect():
        got.setdefault(r.asked, {})[r.rank] = (r.id, r.score)
    assert len(got) == 300 and {i: [v[1], v[2][0], v[3][0]] for i, v in got.items()} == {i: [(i, 1.0), *[j for j in range(i % 5, 300, 5) if j != i][:2]] for i in range(300)}

    def shuffled(node):
        name = node.nodeName()
        below = [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if name == "Exchange" else []
        return own + [n for x in below for n in shuffled(x)]

    counts = shuffled(out._jdf.queryExecution().executedPlan())
    assert counts and max(counts) < 5_000, counts


@pytest.mark.parametrize("hits, cells", [(1_000_000, 1_000_000), (10, 100)])
def test_best_of_a_cell(monkeypatch, hits, cells):
    """Any number of pairs at once gives the best by (score, id); words that a slice doesn't have still lengthen a query."""
    import random

    import pyarrow as pa

    from tessera.operators import textindex as TI

    monkeypatch.setattr(TI, "HITS", hits)
    monkeypatch.setattr(TI, "CELLS", cells)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    df_of = {w: i // 2 + 1 for i, w in enumerate(words)} | {"elsewhere": 3}

    def unit(ws):
        raw = {w: 1 / df_of[w] for w in sorted(set(ws), key=lambda w: (-df_of[w], w))}
        return {w: x / sum(y * y for y in raw.values()) ** 0.5 for w, x in raw.items()}

    some = lambda n, most, of: [unit(rng.choices(of, k=rng.randint(1, most))) for _ in range(n)]
    docs, asked = some(90, 8, words) + [unit(words[:30])], some(60, 15, [*words, "elsewhere"]) + [unit(["elsewhere"])]
    terms = lambda vs: pa.array([list(v) for v in vs], pa.list_(pa.string()))
    weights = lambda vs: pa.array([list(v.values()) for v in vs], pa.list_(pa.float64()))
    ids = [f"d{i:02d}" for i in range(len(docs))]
    index = pa.table({"id": ids, "term": terms(docs), "df": [[df_of[w] for w in v] for v in docs], "weight": weights(docs), "place": range(1, len(docs) + 1)})
    index = index.take(rng.sample(range(len(docs)), len(docs)))
    queries = pa.table({"query": range(len(asked)), "terms": terms(asked), "weights": weights(asked)})
    for k, threshold in ((3, 0.4), (1, 0.9), (3, None), (2, 0.0)):
        row, doc, score, own = TI._best(queries, index, k, threshold)
        got = {}
        for q, d, s in zip(row.tolist(), own.ids.take(pa.array(doc)).to_pylist(), score.tolist(), strict=True):
            got.setdefault(q, []).append((d, round(s, 6)))
        for q, v in enumerate(asked):
            scored = sorted((-round(sum(x * d.get(w, 0) for w, x in v.items()), 6), i) for i, d in zip(ids, docs, strict=True) if set(v) & set(d))
            assert got.get(q, []) == [(i, -s) for s, i in scored[:k] if threshold is None or -s >= threshold], (k, threshold, q)


def test_words_are_not_shuffled_by_document(spark):
    """Texts go to their part once; the vectors' plan has no exchange by id and term, nor by term and a salt."""
    from tessera.operators import textindex as TI

    df = spark.createDataFrame([(i, f"w{i % 7} common w{i % 3}") for i in range(500)], "id long, body string")
    plan = TI.Vectoriser.fit(df, "id", "body").transform(df, "id", "body")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert not [x for x in plan.split("\n") if "hashpartitioning(id#" in x] and "SortMergeJoin [part" not in plan


@pytest.mark.parametrize(
    "name", ["clean_dedupe_documents", "union_new_first", "stratified_split", "seeded_shuffle_rank", "topk_vectors", "rate_minute", "build_training_set"]
)
def test_query_partition_invariance(spark, name):
    import sys, os

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    import __spark_entry__ as E
    from oracle_check import digest

    hashes = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = E.queries()[name](spark, SF_SMALL)
        hashes.append(digest(df.columns, [tuple(r) for r in df.collect()])[2])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert hashes[0] == hashes[1]


def test_exhausted_models(spark):
    """Spent by count or by a refusal, from the next moment on, for that day only; null times, other models, no rows."""
    from tessera.operators import quota as Q

    models = [(1, "a", 2), (2, "b", 9)]
    rows = [
        (1, "a", "2024-01-01 00:00:01", "ok"), (2, "a", "2024-01-01 00:00:02", "ok"), (3, "b", "2024-01-01 00:00:03", "quota"),
        (4, "b", "2024-01-01 00:00:03", "ok"), (5, "b", "2024-01-01 00:00:04", "ok"), (6, "a", "2024-01-02 00:00:01", "ok"),
        (7, "a", None, "quota"), (8, "other", "2024-01-02 00:00:00", "quota"), (9, None, "2024-01-02 00:00:00", None),
    ]
    c = spark.createDataFrame(rows, "event_id long, name string, ts string, outcome string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.event_id: (r.picked, r.n_spent) for r in Q.pick_at(c, Q.spent_since(c, "outcome", models), models).collect()}
    assert got == {1: ("a", 0), 2: ("a", 0), 3: ("b", 1), 4: ("b", 1), 5: (None, 2), 6: ("a", 0), 7: (None, 2), 8: ("a", 0), 9: ("a", 0)}
    none = c.limit(0)
    assert Q.pick_at(none, Q.spent_since(none, "outcome", models), models).count() == 0


def test_failure_list(spark):
    from tessera.operators import evaluate as E

    df = spark.createDataFrame([(1, "x", "y"), (2, "x", "x"), (3, "x", "z"), (4, "q", "x"), (5, None, "x"), (6, "x", None)], "id int, expected string, got string")
    got = {r.id: (r.ord, r.n_class) for r in E.failure_list(df, ["y", "x"]).collect()}
    assert got == {1: (1, 2), 3: (1, 2), 4: (None, 1)}


@pytest.mark.parametrize("text,want", [
    ('{"choices": [{"message": {"content": "a \\"b\\"\\n"}, "finish_reason": "stop"}]}', ('a "b"\n', "stop")),
    ('{"choices": [{"message": {"content": "x"}}, {"message": {"content": "y"}}]}', ("x", "unknown")),
    ('{"choices": []}', (None, "unknown")), ("{broken", (None, "unknown")), ("", (None, "unknown")), (None, (None, "unknown")),
])
def test_chat_message(spark, text, want):
    from tessera.functions import text as T

    assert tuple(spark.createDataFrame([(text,)], "x string").select(T.chat_message("x")).first()[0]) == want


def test_text_head_reads_texts_once(spark, monkeypatch):
    """Fitting the vectoriser and the head takes one pass over the texts, and gives the model of the plain chain."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    from tessera.operators import embed as EM
    from tessera.plans import models as M

    words = {"de": "der hund und die katze", "en": "the dog and the cat", "fr": "le chien et le chat"}
    rows = [(f"{words[k]} {k}{i % 7} w{i % 5} Straße_{i}" if i % 20 else "", k) for i, k in enumerate(["de", "en", "fr"] * 20)]
    docs = spark.createDataFrame([*rows, *rows[:4]], "text string, lang string").repartition(3).localCheckpoint()
    seen = spark.sparkContext.accumulator(0)

    def read(x):
        seen.add(1)
        return x

    watched = docs.withColumn("text", F.udf(read, "string").asNondeterministic()("text"))
    monkeypatch.setattr(M, "table", lambda *_: watched)
    vec, idx, lr = M.text_head(spark, "")
    assert seen.value == 64

    plain = EM.fit_vectoriser(docs, "text", "features")
    data = idx.transform(EM.embed(plain, docs.withColumnRenamed("lang", "label"), as_array=False, out_col="features"))
    want = LogisticRegression(featuresCol="features", labelCol="y", maxIter=50, regParam=0.01).fit(data)
    assert np.allclose(lr.coefficientMatrix.toArray(), want.coefficientMatrix.toArray(), atol=1e-6)
    asked = spark.createDataFrame([("The cat", "en"), ("", "de"), ("nothing known", "fr")], "text string, lang string").union(docs)
    both = [
        [(r.text, r.got, r.v) for r in M.predict(idx, m, EM.embed(v, asked, as_array=False, out_col="features")).select("text", "got", vector_to_array("features").alias("v")).collect()]
        for v, m in ((vec, lr), (plain, want))
    ]
    assert both[0] == both[1]
    got, emb = EM.fit_embed(docs, as_array=True)
    norms = {round(float(np.linalg.norm(r.embedding)), 5) for r in emb.collect()}
    assert norms == {0.0, 1.0} and emb.columns == ["lang", "embedding"] and len(got.stages) == 4

"""Sparse TF-IDF vectors, a saved index of them, and search over it.

A text's terms are its lower-cased word runs; a term's weight is its count times ``ln((n + 1) / (df + 1))``, over the
vector's length. Vectors are rows ``(id, term, weight)``, so nothing is as wide as the vocabulary and no model is
held by the driver: the vectoriser is a table of document frequencies and one number. Ids may have any type that
can be joined; rows without an id are not indexed, rows that repeat an id are one document.

Documents are dealt into parts of about ``PART_ROWS`` rows by hash. Texts are sent to their part once and counted there; what travels
between parts is one row per part and term, with its document frequency, so words are not shuffled document by document.

Search deals documents into slices of at most about ``SLICE_ROWS`` rows and ``SLICE_TERMS`` terms, queries into groups of about
``GROUP_TERMS`` terms. A group and a slice are one cell: a shuffle brings both to one task, which keeps the best ``k`` documents of
each query, so pairs exist only there, some at a time, and what is shuffled or written is each side once per part of the other
side. Equal texts are vectors of one representative, on both sides; its members come back at the end. With a threshold, a pair is a
candidate if it shares a term from which on (towards the more frequent ones) the two vectors' lengths multiply to the threshold or
more: the rarest term that a matching pair shares is such a term. Candidates are scored exactly on all terms.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

WORD_RUN = "[\\p{L}\\p{N}_]+"
SLICE_ROWS = 100_000  # documents of one slice
SLICE_TERMS = 1_000_000  # their terms
GROUP_TERMS = 2_000_000  # terms of one group of queries
PART_ROWS = 4_096  # rows of one part
HITS = 250_000  # pairs of a cell at once
CELLS = 1_000_000  # numbers of a table in a cell
EPS = 1e-6  # covers the scores' rounding and the errors of lengths


def _part_count(df: DataFrame) -> int:
    """Parts of a table: enough for every core, or ``PART_ROWS`` rows each."""
    rows = df.count()
    return max(1, math.ceil(rows / PART_ROWS), min(rows // 64, 2 * df.sparkSession.sparkContext.defaultParallelism))


def term_counts(df: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """``(part, id, term, n)``, all rows of a part in one partition."""
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.pmod(F.xxhash64(id_col), F.lit(parts)).alias("part"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    terms = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD_RUN), F.lit(0)))
    words = rows.repartition(max(1, parts // 2), "part").select("part", "id", terms.alias("term"))
    return words.groupBy("part", "id", "term").agg(F.count(F.lit(1)).alias("n"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, rep)``: every id once, with the smallest id of an equal text; an id with several texts stands for itself."""
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("h"))
    own = rows.groupBy("id").agg(F.min("h").alias("h"), (F.min("h") == F.max("h")).alias("one"), F.count(F.lit(1)).alias("n"))
    first = own.where("one").groupBy("h", "n").agg(F.min("id").alias("first")).withColumn("one", F.lit(True))
    return own.join(first, ["h", "n", "one"], "left").select("id", F.coalesce("first", "id").alias("rep"))


def _weights(left: pa.Table, right: pa.Table, n_docs: int) -> tuple[pa.Table, np.ndarray]:
    """Terms of one part's documents with their weights, and the documents' numbers of terms; a document's terms stand together,
    the most frequent first (equally frequent ones in byte order)."""
    order = pc.sort_indices(right, sort_keys=[("df", "descending"), ("word", "ascending")])
    right = right.take(order)
    at = pc.index_in(left.column("term"), value_set=right.column("word").combine_chunks())
    left = left.append_column("at", at).filter(at.is_valid())
    ids = left.column("id").combine_chunks()
    if pa.types.is_nested(ids.type):
        ids = pa.array([str(x) for x in ids.to_pylist()], pa.string())
    doc = ids.dictionary_encode().indices.to_numpy()
    place = left.column("at").to_numpy()
    df = right.column("df").to_numpy()[place]
    raw = left.column("n").to_numpy() * np.log((n_docs + 1) / (df + 1))
    weight = raw / np.sqrt(np.bincount(doc, raw * raw))[doc]
    row = np.lexsort((place, doc))
    at = pa.array(row)
    return pa.table({"id": left.column("id").take(at), "term": left.column("term").take(at), "df": pa.array(df[row], pa.int64()), "weight": weight[row]}), np.bincount(doc)


def _lists(flat: pa.ChunkedArray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat.combine_chunks())


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All values of lists, and the lists' sizes."""
    whole = lists.combine_chunks()
    return whole.flatten(), pc.list_value_length(whole).to_numpy().astype(np.int64)


def _rests(weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The length of every weight and those of all more frequent terms of its vector; vectors follow one another."""
    upto = np.cumsum(weight * weight)
    before = np.concatenate([[0.0], upto])[np.cumsum(sizes) - sizes]
    return np.sqrt(np.maximum(upto - np.repeat(before, sizes), 0))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``start`` to ``start + n - 1`` of all ranges."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


class _Slice:
    """Vectors of the documents of one slice, which are numbered by id, and their terms, numbered from the most frequent one."""

    def __init__(self, docs: pa.Table):
        docs = docs.take(pc.sort_indices(docs.column("place")))
        self.ids = docs.column("id")
        terms, sizes = _flat(docs.column("term"))
        coded = terms.dictionary_encode()
        code, df = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
        df[code] = _flat(docs.column("df"))[0].to_numpy()
        order = pc.sort_indices(pa.table({"df": df, "word": coded.dictionary}), sort_keys=[("df", "descending"), ("word", "ascending")])
        self.words = coded.dictionary.take(order)
        number = np.empty(len(df), np.int64)
        number[order.to_numpy()] = np.arange(len(df))
        term, doc = number[code], np.repeat(np.arange(len(sizes)), sizes)
        row = np.lexsort((term, doc))
        term, weight = term[row], _flat(docs.column("weight"))[0].to_numpy()[row]
        # postings by term, the longest rests first: one search finds how many of a term's postings reach a length
        by = 2 * term + (1 - _rests(weight, sizes))
        order = np.argsort(by)
        self.by, self.doc = by[order], doc[order]
        self.first = np.searchsorted(term[order], np.arange(len(df)))
        # vectors of about one size are a table
        self.kind = np.ceil(np.log2(np.maximum(sizes, 8))).astype(np.int8)
        self.at, self.tables, start = np.zeros(len(sizes), np.int64), {}, np.cumsum(sizes) - sizes
        for kind in np.unique(self.kind).tolist():
            own = np.flatnonzero(self.kind == kind)
            self.at[own] = np.arange(len(own))
            held, from_ = np.arange(1 << kind) < sizes[own][:, None], _ranges(start[own], sizes[own])
            terms_of, weights_of = np.zeros(held.shape, np.int32), np.zeros(held.shape)
            terms_of[held], weights_of[held] = term[from_], weight[from_]
            self.tables[kind] = terms_of, weights_of

    def reaching(self, term: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first posting of each term, and how many follow from it whose rest is ``rest`` or more."""
        first = self.first[term]
        return first, np.maximum(np.searchsorted(self.by, 2 * term + (1 - np.clip(rest, 0, 2)) + 1e-8, "right") - first, 0)

    def scores(self, asked: np.ndarray, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Products of rows of ``asked`` (weights by term) and documents, in millionths as whole numbers."""
        out, flat, kinds = np.empty(len(row)), asked.reshape(-1), self.kind[doc]
        for kind, (terms, weights) in self.tables.items():
            own = np.flatnonzero(kinds == kind)
            step = (CELLS >> kind) + 1
            for some in (own[i : i + step] for i in range(0, len(own), step)):
                at = self.at[doc[some]]
                out[some] = np.einsum("ij,ij->i", flat.take(terms[at] + (row[some] * asked.shape[1])[:, None]), weights[at])
        return np.floor(out * 1e6 + 0.5)


def _best(queries: pa.Table, docs: pa.Table, k: int, threshold: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Slice]:
    """``(query row, document, score)``: the best ``k`` documents of a slice for every query by (score, id)."""
    own = _Slice(docs)
    words, sizes = _flat(queries.column("terms"))
    weight = _flat(queries.column("weights"))[0].to_numpy()
    rest = _rests(weight, sizes)
    term = pc.index_in(words, value_set=own.words).fill_null(-1).to_numpy().astype(np.int64)
    known = term >= 0
    of, term, weight, rest = np.repeat(np.arange(len(sizes)), sizes)[known], term[known], weight[known], rest[known]
    far = 0.0 if threshold is None else threshold - EPS
    first, n = own.reaching(term, far / np.maximum(rest, 1e-9))
    hits = np.bincount(of, n, len(sizes)).astype(np.int64)
    use = (hits > 0)[of]
    of, term, weight, first, n = of[use], term[use], weight[use], first[use], n[use]
    rows, start = np.unique(of, return_index=True)
    start, upto = np.append(start, len(of)), np.concatenate([[0], np.cumsum(hits[rows])])
    width, bits = len(own.words), max(len(own.ids), 2).bit_length()
    asked = np.zeros((max(1, min(CELLS // max(width, 1), len(rows))), width))
    found, a = [], 0
    while a < len(rows):
        b = max(a + 1, min(a + len(asked), int(np.searchsorted(upto, upto[a] + HITS, "right")) - 1))
        some = slice(start[a], start[b])
        row = np.repeat(np.arange(b - a), np.diff(start[a : b + 1]))
        asked[row, term[some]] = weight[some]
        pairs = np.sort(np.repeat(row << bits, n[some]) | own.doc[_ranges(first[some], n[some])])
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
        query, doc = pairs >> bits, pairs & ((1 << bits) - 1)
        score = own.scores(asked, query, doc)
        asked[row, term[some]] = 0
        if threshold is not None:
            keep = score / 1e6 >= threshold
            query, doc, score = query[keep], doc[keep], score[keep]
        order = np.lexsort((doc, -score, query))
        query = query[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        found.append((rows[query[best] + a], doc[order][best], score[order][best] / 1e6))
        a = b
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return *(np.concatenate(x) for x in zip(none, *found, strict=True)), own


@dataclass
class Vectoriser:
    """Document frequencies of terms over ``n_docs`` documents."""

    terms: DataFrame  # (term, df)
    n_docs: int

    @classmethod
    def fit(cls, df: DataFrame, id_col: str, text_col: str) -> Vectoriser:
        """Frequencies over all texts; null and empty texts count as documents without terms."""
        n = df.where(F.col(id_col).isNotNull()).select(id_col).distinct().count()
        counts = term_counts(df, id_col, text_col, _part_count(df))
        return cls(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), n)

    def save(self, path: str) -> None:
        self.terms.withColumn("n_docs", F.lit(self.n_docs).cast("long")).write.mode("overwrite").parquet(f"{path}/terms")
        self.terms.sparkSession.range(1).select(F.lit(self.n_docs).cast("long").alias("n_docs")).write.mode("overwrite").parquet(f"{path}/size")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Vectoriser:
        return cls(spark.read.parquet(f"{path}/terms").select("term", "df"), spark.read.parquet(f"{path}/size").first()[0])

    def transform(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Unit vectors ``(id, term, df, weight)``; terms unknown to the fit and terms of every document have no weight
        and no row."""
        return self._vectors(df, id_col, text_col, lambda rows, sizes: rows, T.StructType().add("term", "string").add("df", "long").add("weight", "double"))

    def whole(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """The same in one row per text: ``(id, terms, weights)``, in the order of ``_weights``."""

        def pack(rows: pa.Table, sizes: np.ndarray) -> pa.Table:
            first = pa.array(np.cumsum(sizes) - sizes)
            return pa.table({"id": rows.column("id").take(first), "terms": _lists(rows.column("term"), sizes), "weights": _lists(rows.column("weight"), sizes)})

        return self._vectors(df, id_col, text_col, pack, T.StructType().add("terms", T.ArrayType(T.StringType())).add("weights", T.ArrayType(T.DoubleType())))

    def _vectors(self, df: DataFrame, id_col: str, text_col: str, shape, columns: T.StructType) -> DataFrame:
        counts = term_counts(df, id_col, text_col, _part_count(df))
        known = counts.select("part", "term").distinct().join(self.terms.where(F.col("df") < self.n_docs), "term")
        known = known.select(F.col("part").alias("to"), F.col("term").alias("word"), "df")  # names apart from those of the counts
        n_docs, schema = self.n_docs, T.StructType([T.StructField("id", counts.schema["id"].dataType), *columns.fields])
        weigh = lambda left, right: shape(*_weights(left, right, n_docs))
        return counts.groupBy("part").cogroup(known.groupBy("to")).applyInArrow(weigh, schema)


@dataclass
class TextIndex:
    """A saved index: records (metadata by id), representatives of equal texts, their postings and the vectoriser."""

    records: DataFrame
    members: DataFrame  # (id, rep)
    postings: DataFrame  # (id, term, df, weight) of representatives
    vectoriser: Vectoriser

    @classmethod
    def build(cls, df: DataFrame, path: str, id_col: str, text_col: str) -> TextIndex:
        """Fit, vectorise and write; the indexed text is dropped from the records. Returns the index as read back."""
        spark = df.sparkSession
        Vectoriser.fit(df, id_col, text_col).save(f"{path}/vectoriser")
        vectoriser = Vectoriser.load(spark, f"{path}/vectoriser")
        classes(df, id_col, text_col).write.mode("overwrite").parquet(f"{path}/members")
        heads = spark.read.parquet(f"{path}/members").where("id = rep").select(F.col("id").alias(id_col))
        rows = vectoriser.transform(df.select(id_col, text_col).join(heads, id_col, "left_semi"), id_col, text_col)
        rows.repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{path}/postings")
        df.drop(text_col).write.mode("overwrite").parquet(f"{path}/records")
        return cls.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextIndex:
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        return cls(read("records"), read("members"), read("postings"), Vectoriser.load(spark, f"{path}/vectoriser"))

    def search(self, queries: DataFrame, query_id: str, text_col: str, k: int = 3, threshold: float | None = None) -> DataFrame:
        """``(query_id, rank, id, score)``: for every query the ``k`` documents of the largest dot product, ties by id.

        Scores are rounded to six decimals. Documents below ``threshold`` are no match (the threshold itself is one); without a
        threshold only documents that share a weighted term appear. Queries without a match have no row. Query classes and
        vectors are written when the search is planned."""
        asking = _written(classes(queries, query_id, text_col), "query-classes")
        heads = asking.where("id = rep").select(F.col("id").alias(query_id))
        q = self.vectoriser.whole(queries.select(query_id, text_col).join(heads, query_id, "left_semi"), query_id, text_col)
        scored = self._scored(_written(q.withColumnRenamed("id", "query"), "query-vectors"), k, threshold)
        # the k best texts by their smallest id hold the k best documents, which are among the k smallest ids of each
        best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        texts = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", F.col("id").alias("rep"), "score")
        nth = Window.partitionBy("rep").orderBy("id")
        named = self.members.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k).select("rep", "id")
        out = texts.join(named, "rep").withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)
        each = asking.select(F.col("id").alias("query_id"), F.col("rep").alias("query"))
        return out.join(each, "query").select(F.col("query_id").alias(query_id), "rank", "id", "score")

    def _scored(self, q: DataFrame, k: int, threshold: float | None) -> DataFrame:
        """``(query, id, score)``: the best ``k`` representatives of every query in each slice of the index."""
        n, terms = q.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
        groups = max(1, math.ceil(terms / GROUP_TERMS), min(n // 64, 4 * q.sparkSession.sparkContext.defaultParallelism))
        slices = max(1, math.ceil(self.members.where("id = rep").count() / SLICE_ROWS), math.ceil(self.postings.count() / SLICE_TERMS))
        across = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        docs = self.postings.groupBy("id").agg(F.collect_list(F.struct("term", "df", "weight")).alias("of"))
        docs = docs.select(F.pmod(F.xxhash64("id"), F.lit(slices)).alias("xs"), "id", "of.term", "of.df", "of.weight")
        docs = docs.withColumn("place", F.row_number().over(Window.partitionBy("xs").orderBy("id"))).repartition("id").withColumn("qs", across(groups))
        q = q.withColumn("qs", F.pmod(F.xxhash64("query"), F.lit(groups))).withColumn("xs", across(slices))

        def best(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return pa.table({"query": left.column("query").slice(0, 0), "id": right.column("id").slice(0, 0), "score": pa.array([], pa.float64())})
            row, doc, score, own = _best(left, right, k, threshold)
            return pa.table({"query": left.column("query").take(pa.array(row)), "id": own.ids.take(pa.array(doc)), "score": score})

        schema = T.StructType().add("query", q.schema["query"].dataType).add("id", docs.schema["id"].dataType).add("score", "double")
        dealt = lambda x: x.repartition(4 * groups * slices, "qs", "xs").groupBy("qs", "xs")
        return dealt(q).cogroup(dealt(docs)).applyInArrow(best, schema)


def sql_vectors(source: str, id_expr: str, text_expr: str) -> str:
    """DuckDB twin of ``fit`` and ``transform`` over a relation: ``(id, term, df, w)``."""
    return f"""(WITH src AS (SELECT {id_expr} AS id, {text_expr} AS body FROM {source}),
  cnt AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(body), '{WORD_RUN}')) AS term FROM src WHERE id IS NOT NULL) GROUP BY id, term),
  nd AS (SELECT count(DISTINCT id) AS docs FROM src),
  dfs AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
  raw AS (SELECT id, term, df, n * ln((docs + 1) / (df + 1)) AS r FROM cnt JOIN dfs USING (term), nd WHERE df < docs)
  SELECT id, term, df, r / sqrt(sum(r * r) OVER (PARTITION BY id)) AS w FROM raw)"""


def sql_query_vectors(index_source: str, index_id: str, index_text: str, source: str, id_expr: str, text_expr: str) -> str:
    """DuckDB twin of ``transform`` of other texts by the frequencies of an index relation: ``(id, term, w)``."""
    return f"""(WITH isrc AS (SELECT {index_id} AS id, {index_text} AS body FROM {index_source}),
  dfs AS (SELECT term, count(DISTINCT id) AS df FROM (SELECT id, unnest(regexp_extract_all(lower(body), '{WORD_RUN}')) AS term FROM isrc WHERE id IS NOT NULL) GROUP BY term),
  nd AS (SELECT count(DISTINCT id) AS docs FROM isrc),
  src AS (SELECT {id_expr} AS id, {text_expr} AS body FROM {source}),
  cnt AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(body), '{WORD_RUN}')) AS term FROM src WHERE id IS NOT NULL) GROUP BY id, term),
  raw AS (SELECT id, term, n * ln((docs + 1) / (df + 1)) AS r FROM cnt JOIN dfs USING (term), nd WHERE df < docs)
  SELECT id, term, r / sqrt(sum(r * r) OVER (PARTITION BY id)) AS w FROM raw)"""

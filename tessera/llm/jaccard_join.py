"""N-gram Jaccard join in the metric space of shingle sets.

Two documents link when their sets have similarity >= ``t`` (distance <= ``1 - t``). Exact steps:

1. *Sieve.* Of the hash universe a fixed share ``SIEVE`` is looked at. A linked document has at most
   ``(1 - t) n`` shingles of its own, so fewer of its sieved shingles than that are unshared. Counting
   shingles (partial aggregation) and counting shared ones per document drops all others.
2. *Prefixes.* The remaining sets (identical sets collapsed to their smallest id) are ordered by document
   frequency; linked sets share a shingle among their first ``n - ceil(t n) + 1``. Those postings, with the
   shingle's place in the set, say which documents can be near which pivots.
3. *Pivots and regions, recursively.* In every posting group a pivot is chosen (from the largest component,
   then the most connected document, by a partial aggregation) and the documents of other components measure
   their distance to it. Documents within ``1 - t`` of a pivot join its component; every document belongs to
   the Voronoi region of the nearest pivot it has met. Then each group recurses on what is left: pivots
   retire, documents leave a group whose sizes leave no room for a link, groups whose members all belong to one
   component are closed, and the number of pivots grows fourfold.
   A pair is measured once, and only if

   * the places of the shared shingle leave room for the needed intersection (were it their first shared one;
     a linked pair meets in the group of its first shared shingle), and
   * the windows around a common region pivot allow it: by the triangle inequality the two distances to
     that pivot differ by ``1 - t`` at most. Pairs of different regions (the boundary) are always measured.

   It ends when no open group is left, so every linked pair is measured or already connected. From the second
   round on the documents of a group are counted by size and place, those of its largest component (which need
   not meet each other) by themselves; once the counts bound all the pairs with room by ``LAST_PAIRS`` per posting of the start,
   these pairs are made at once and no further round follows.

A group of copies costs one comparison per copy, not one per pair; no list of a group is ever gathered, and a
large group's members meet its pivots in parts of ``PART_ROWS``. A round starts from the components of the round
before; its tables are deleted when the next ones are written. Distances come from the exact hash sets (64-bit
hashes of whole shingles). Null and empty texts have an empty set and link with nothing; a null id gets a null
component. Repeated rows of an id are one document: the row with the most shingles (ties: the least signature).
"""

from __future__ import annotations

from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, forget, written
from tessera.llm.shingles import Shingler

SIMILARITY = Fraction(3, 4)
SIEVE = 0.4
BATCH_ROWS = 1 << 15  # hashes handed over at once
LAST_PAIRS = 4  # pairs per posting of the start that a last round may make
PART_ROWS = 1000  # members of a posting group that meet its pivots in one part
BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}  # for texts of any size
ABSENT, PLAIN = 0, -1  # marks of a sieved row: a set without sieved hashes, any hash; a set's first hash: their number


def _sieved(docs: DataFrame, key: str, text: str, share: float) -> DataFrame:
    """``(id, n, h, mark)``: the hashes of every set below the sieve limit; a set without any gives one
    row marked ``ABSENT``, so that every document is there."""
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))

    def run(batches):
        shingler = Shingler()
        def rows(ids, n, low):
            first = np.array([len(x) or ABSENT for x in low], "i4")
            low = [x if len(x) else np.array([(i or 0) * 0x9E3779B97F4A7C15 % 2**64], np.uint64) for i, x in zip(ids, low)]
            times = np.array([len(x) for x in low])
            mark = np.full(times.sum(), PLAIN, "i4")
            mark[np.cumsum(times) - times] = first
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(ids)), times))),
                    pa.array(np.repeat(n, times).astype("i4")),
                    pa.array(np.concatenate(low).view("i8")),
                    pa.array(mark),
                ],
                names=["id", "n", "h", "mark"],
            )

        for b in batches:
            ids, n, low, size = [], [], [], 0
            for k, t in zip(b.column(0), b.column(1)):
                own = shingler(t.as_py())
                ids.append(k.as_py())
                n.append(len(own))
                low.append(own[: np.searchsorted(own, limit)].copy())
                size += len(low[-1])
                if size >= BATCH_ROWS:
                    yield rows(ids, n, low)
                    ids, n, low, size = [], [], [], 0
            if ids:
                yield rows(ids, n, low)

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text)).mapInArrow(run, "id bigint, n int, h bigint, mark int")


def _full(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, n, sig, hs)``: whole sets with a 128-bit signature."""

    def run(batches):
        import hashlib

        shingler = Shingler()
        for b in batches:
            for at in range(0, b.num_rows, 32):
                part = b.slice(at, 32)
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([s.view("i8") for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["id", "n", "sig", "hs"],
                )

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text)).mapInArrow(run, "id bigint, n int, sig binary, hs array<bigint>")


def _allowed(n: Column, t: Fraction) -> Column:
    """Most shingles of an ``n``-set that a linked partner can lack."""
    return F.floor(n * (t.denominator - t.numerator) / F.lit(t.denominator))


def sieve(docs: DataFrame, key: str, text: str, t: Fraction, share: float) -> DataFrame:
    """``(id, n, maybe)`` for every document; only documents with ``maybe`` can have a link."""
    rows = _sieved(docs, key, text, share)
    real = F.col("mark") != ABSENT
    twice = rows.where(real).groupBy("h").agg(F.count("*").alias("f")).where("f > 1").select("h", F.lit(1).alias("shared"))
    # a document's rows lie in all partitions: only those that count for it move on
    per = rows.join(twice, "h", "left").where((F.col("mark") != PLAIN) | F.col("shared").isNotNull()).groupBy("id").agg(
        F.max("n").alias("n"),
        F.count(F.when(F.col("mark") != PLAIN, 1)).alias("rows"),
        F.sum(F.when(F.col("mark") != PLAIN, F.col("mark"))).alias("seen"),
        F.count(F.when(real, F.col("shared"))).alias("shared"),
    )
    # the counts of an id with several rows are sums over different sets and prove nothing
    near = (F.col("rows") > 1) | (F.col("shared") >= F.col("seen") - _allowed(F.col("n"), t))
    maybe = (F.col("n") > 0) & F.col("id").isNotNull() & near
    return written(per.select("id", "n", maybe.alias("maybe")), "jaccard-sieve")


def prefixes(sets: DataFrame, t: Fraction) -> DataFrame:
    """``(h, id, n, place, rank)``: the shared shingles in the frequency-ordered prefix of every set, how many
    of the set's shingles come before, and how many postings the set has."""
    tokens = sets.select("id", "n", F.explode("hs").alias("h"))
    f = tokens.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    shared = tokens.join(f, "h").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("own"))
    # shingles of one document alone come first in the order and need no posting
    alone = F.col("n") - F.size("own")
    shared = shared.withColumn("alone", alone).withColumn("take", (_allowed(F.col("n"), t) + 1 - alone).cast("int")).where("take > 0")
    shared = shared.withColumn("rank", F.least(F.size("own"), F.col("take")))
    posting = F.posexplode(F.slice("own", F.lit(1), F.col("take"))).alias("i", "x")
    return shared.select(posting, "id", "n", "alone", "rank").select("x.h", "id", "n", (F.col("alone") + F.col("i")).cast("int").alias("place"), "rank")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with ``common``, the exact intersection size, and both set sizes, written.

    Only the sets of these pairs move: the pairs are written first, their ids meet the sets where those lie."""
    pairs = written(pairs, "jaccard-asked")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    used = written(sets.join(ids, "id", "left_semi"), "jaccard-used")
    a = used.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("hs").alias("ha"))
    b = used.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("hs").alias("hb"))
    out = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("ha", "hb")))
    out = written(out.drop("ha", "hb"), "jaccard-pairs")
    forget(pairs, used)
    return out


def _edges(comp: DataFrame) -> DataFrame:
    """``(a, b)``: every node with the head of its component."""
    return comp.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _with_components(open_: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``open_`` with each document's component so far and the component's size."""
    if comp is None:
        return open_.withColumn("comp", F.col("id")).withColumn("weight", F.lit(1).cast("bigint"))
    size = comp.groupBy("component").agg(F.count("*").alias("weight"))
    own = comp.join(size, "component").select(F.col("node").alias("id"), F.col("component").alias("comp"), "weight")
    own = open_.join(own, "id", "left")
    return own.withColumn("comp", F.coalesce("comp", "id")).withColumn("weight", F.coalesce("weight", F.lit(1).cast("bigint")))


def _candidates(at: DataFrame, pivots: DataFrame, t: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` of a group's documents and its pivots that can link and are not connected yet."""
    num, den = t.numerator, t.denominator
    spread = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int")))).drop("parts")
    at = at.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    room = f"{num + den} * least(n - place, nb - place_b) >= {num} * (n + nb)"
    pairs = at.join(spread, ["h", "part"]).where(f"comp <> cb and {room}")
    return pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def _with_buckets(live: DataFrame) -> DataFrame:
    """``live`` with every posting's bucket in its group: steps of 6 % in size and of 1/32 of it in place; odd
    buckets hold the group's largest component."""
    step = F.floor(F.log("n") * 16) * 32 + F.floor(F.col("place") * 32 / F.col("n"))
    return live.withColumn("bucket", (2 * step).cast("int") + (F.col("comp") == F.col("major")).cast("int"))


def _rooms(at: DataFrame, t: Fraction) -> DataFrame:
    """``(h, bucket, bucket_b, made)``: the buckets of a group between which a link has room, and their pairs."""
    num, den = t.numerator, t.denominator
    one = at.groupBy("h", "bucket").agg(F.count("*").alias("rows"), F.min("n").alias("n"), F.max(F.col("n") - F.col("place")).alias("rest"))
    two = one.select("h", *[F.col(c).alias(f"{c}_b") for c in ("bucket", "rows", "n", "rest")])
    room = f"bucket <= bucket_b and bucket % 2 + bucket_b % 2 < 2 and {num + den} * least(rest, rest_b) >= {num} * (n + n_b)"
    return one.join(two, "h").where(room).select("h", "bucket", "bucket_b", (F.col("rows") * F.col("rows_b")).alias("made"))


def _last_candidates(at: DataFrame, rooms: DataFrame, t: Fraction) -> DataFrame:
    """All pairs ``(a, b)`` of a group's documents that can link and are not connected yet."""
    num, den = t.numerator, t.denominator
    two = at.select("h", F.col("bucket").alias("bucket_b"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("place").alias("place_b"), F.col("comp").alias("cb"))
    room = f"{num + den} * least(n - place, nb - place_b) >= {num} * (n + nb)"
    pairs = at.join(rooms, ["h", "bucket"]).join(two, ["h", "bucket_b"]).where(f"comp <> cb and {room}")
    return pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def _in_windows(pairs: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """Pairs without those that the triangle inequality around a common region pivot rules out."""
    one = cells.select(F.col("id").alias("a"), F.col("cell").alias("ca"), F.col("d").alias("da"))
    two = cells.select(F.col("id").alias("b"), F.col("cell").alias("cb"), F.col("d").alias("db"))
    apart = (F.col("ca") == F.col("cb")) & (F.abs(F.col("da") - F.col("db")) > reach + 1e-9)
    return pairs.join(one, "a", "left").join(two, "b", "left").where(~F.coalesce(apart, F.lit(False))).select("a", "b")


def _linked(t: Fraction) -> Column:
    """Whether a measured pair links."""
    return t.denominator * F.col("common") >= t.numerator * (F.col("na") + F.col("nb") - F.col("common"))


def _regions(got: DataFrame, pivots: DataFrame, cells: DataFrame | None) -> DataFrame:
    """``(id, cell, d)``: every document's nearest pivot so far, pivots being their own."""
    d = (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("d")
    heads = pivots.select(F.col("b").alias("cell")).distinct()
    ends = got.select(F.col("a").alias("id"), F.col("b").alias("cell"), d).unionByName(got.select(F.col("b").alias("id"), F.col("a").alias("cell"), d))
    ends = ends.join(heads, "cell", "left_semi").unionByName(heads.select(F.col("cell").alias("id"), "cell", F.lit(0.0).alias("d")))
    if cells is not None:
        ends = ends.unionByName(cells)
    return ends.groupBy("id").agg(F.min(F.struct("d", "cell")).alias("x")).select("id", "x.cell", "x.d")


def region_components(postings: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame | None:
    """``(node, component)`` of the linked documents, by rounds of pivots; None without any open group."""
    num, den = t.numerator, t.denominator
    open_ = written(postings, "jaccard-open")
    bound = LAST_PAIRS * open_.count()
    comp = cells = met = None  # components, regions, pairs measured without a link
    for r in count():
        at = _with_components(open_, comp)
        group = [F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows")]
        group = at.groupBy("h").agg(*group, F.min("n").alias("least_n"), F.max(F.col("n") - F.col("place")).alias("rest"), F.max(F.struct("weight", "comp")).alias("top")).where("lo < hi")
        group = group.select("h", F.ceil(F.col("rows") / PART_ROWS).alias("parts"), "least_n", "rest", F.col("top.comp").alias("major"))
        live = at.join(group, "h").where(f"{num + den} * least(n - place, rest) >= {num} * (n + least_n)").drop("least_n", "rest")
        live = written(live, "jaccard-open")
        if r:
            at = _with_buckets(live)
            rooms = written(_rooms(at, t), "jaccard-rooms")
            made = rooms.agg(F.sum("made")).first()[0] or 0
            if made <= bound:
                if made:
                    pairs = _in_windows(_last_candidates(at, rooms, t).join(met, ["a", "b"], "left_anti"), cells, float(1 - t))
                    got = measured(pairs, sets)
                    links = got.where(_linked(t)).select("a", "b")
                    if links.take(1):
                        comp, old = written(components(links.unionByName(_edges(comp))), "jaccard-comp"), comp
                        forget(old)
                    forget(got)
                forget(open_, live, rooms, cells, met)
                return comp
            forget(rooms)
        best = F.max(F.struct("weight", "rank", (-F.col("id")).alias("m"), "n", "place", "comp", "parts")).alias("p")
        pivots = live.groupBy("h", F.pmod(F.xxhash64("id"), F.lit(1 << min(2 * r, 40))).alias("class")).agg(best)
        pivots = pivots.select("h", (-F.col("p.m")).alias("b"), F.col("p.n").alias("nb"), F.col("p.place").alias("place_b"), F.col("p.comp").alias("cb"), "p.parts")
        pivots = written(pivots, "jaccard-pivots")
        forget(open_)
        if not pivots.take(1):
            forget(live, pivots, cells, met)
            return comp
        pairs = _candidates(live, pivots, t)
        if met is not None:
            pairs = _in_windows(pairs.join(met, ["a", "b"], "left_anti"), cells, float(1 - t))
        got = measured(pairs, sets)
        linked = _linked(t)
        near = written(_regions(got, pivots, cells), "jaccard-cells")
        apart = got.where(~linked).select("a", "b")
        apart = written(apart if met is None else apart.unionByName(met), "jaccard-met")
        links = got.where(linked).select("a", "b")
        merged = comp
        if comp is None or links.take(1):
            merged = written(components(links if comp is None else links.unionByName(_edges(comp))), "jaccard-comp")
        # a retired pivot has met its whole group
        left = live.select("h", "id", "n", "place", "rank").join(pivots.select("h", F.col("b").alias("id")), ["h", "id"], "left_anti")
        open_ = written(left, "jaccard-open")
        forget(live, pivots, got, cells, met, None if merged is comp else comp)
        cells, met, comp = near, apart, merged


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", t: Fraction = SIMILARITY, share: float = SIEVE) -> DataFrame:
    """``(key, n_shingles, component_id)``, one row per document; other columns are ignored."""
    base = sieve(docs, key, text, t, share)
    # a comparison (true of all of them) lets Spark drop other texts by a Bloom filter before they are shuffled
    ids = base.where("maybe and n > 0").select("id")
    mine = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    full = written(_full(mine, "id", "text"), "jaccard-full", conf=BLOOM)
    member = full.groupBy("id").agg(F.max("n").alias("n")).join(full.select("id", "n", "sig"), ["id", "n"]).groupBy("id").agg(F.min("sig").alias("sig"))
    member = written(member, "jaccard-member")
    same = member.groupBy("sig").agg(F.min("id").alias("rep"))
    sets = full.join(same.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi").select("id", "n", "hs").dropDuplicates(["id"])
    sets = written(sets, "jaccard-sets", by="id")
    forget(full)
    comp = region_components(prefixes(sets, t), sets, t)
    edges = member.join(same, "sig").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    if comp is not None:
        edges = edges.unionByName(_edges(comp))
    comp = components(edges)
    forget(sets)
    out = base.join(comp, F.col("id") == F.col("node"), "left")
    return out.select(F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents that lead their class (smallest id); rows with a null id stay."""
    lead = written(classes(docs, key, text, **how).where(F.col(key) == F.col("component_id")).select(key).distinct(), "jaccard-kept")
    return docs.join(lead, key, "left_semi").unionByName(docs.where(F.col(key).isNull()))

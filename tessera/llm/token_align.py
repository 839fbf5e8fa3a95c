"""Cross-tokenizer alignment by lockstep vectorised merging.

Tokenizer A (byte-level BPE) sees a space and the text, tokenizer B (pieces) sees the text and adds the space
itself; both then spell the same bytes. Byte offsets where tokens of both end cut the tokens into groups, and
every A token of a group is linked with every B token of it.

*Lockstep.* The tokens of many documents lie in two arrays. One state vector holds an A and a B pointer per
lane (a document; a long one is several lanes, parted where both tokenizers end a token). Each step compares
the ends of all lanes at once, moves on the pointer that is behind (both, where they agree: a cut), emits the
finished groups and drops finished lanes.

*Corpus counts.* A block is what one step vector covers (about ``BLOCK_TOKENS`` A tokens, whole documents). It
is written as one row: document figures, each document's distinct id pairs, and the block's distinct id pairs
with the number of documents that hold them. Only those pre-aggregated pairs are shuffled: summed over blocks,
compared with the best count of their A id, and sent back to their blocks. A pair that every document holds
costs one row per block, not one per document; no table is broadcast or gathered.

Null and empty texts and texts whose tokens do not spell them (characters that B rewrites) have no tokens: zeros
and an empty digest. Every row is a document of its own, repeated rows and null keys included. Other
input columns are ignored, so their names cannot clash. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import worker_cache, written

BLOCK_TOKENS = 1 << 19  # A tokens of a block; a longer document is a block of its own
LANE_TOKENS = 256  # A tokens of a lane, about
LOOK = 32  # A tokens looked at for a common end to part lanes at
PROBE = (" The Straße, don't 12  x\n\ny\t z ", "日本語 😀 <|endoftext|>", "aaaaaaaaaaaaaaaaaa", " \u00a0é́\r\n")
SPACE_PIECE = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
NO_IDS = np.empty(0, np.int32)
PAIR_BITS = 20  # a pair is a_id << PAIR_BITS | b_id; both ids stay below 2^20


def default_paths() -> tuple[str, str]:
    """The vocabulary files of A and B."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def letter_bytes() -> dict[str, int]:
    """Bytes of the letters that byte-level vocabularies are written in: printable Latin-1 stands for itself, all
    other bytes are the code points from 256 on, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """The bytes that a piece of B stands for."""
    m = BYTE_PIECE.fullmatch(piece)
    return bytes([int(m[1], 16)]) if m else piece.replace(SPACE_PIECE, " ").encode()


class PairEncoder:
    """Whole texts to the ids of both tokenizers. A runs on the merge ranks of its file where those are in the order of the ids, else in
    the file's own library."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        letters = letter_bytes()
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a_bytes, self.a_encode = self._entries(a_path, letters)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)

    def _entries(self, path: str, letters: dict[str, int]):
        """Bytes of A's entries, and the function from a text to its ids."""
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        spelled = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if [x + y for x, y in pairs] == entries[256 : 256 + len(pairs)] and all(len(e) == 1 for e in entries[:256]):
            import public_tokenizers
            import tiktoken

            ranks = {e: i for i, e in enumerate(spelled[: 256 + len(pairs)])}
            bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            if all(bpe.encode_ordinary(t) == self.a.encode(t, add_special_tokens=False).ids for t in PROBE):
                return spelled, bpe.encode_ordinary
        return spelled, lambda t: self.a.encode(t, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``(a ids, b ids)`` of every text; none where they do not spell it."""
        out = []
        for t, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = self.a_encode(" " + t) if t else []
            raw = (" " + t).encode("utf-8", "surrogatepass") if t else b""
            ok = b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b])
            out.append((np.array(a, np.int32), np.array(b, np.int32)) if ok else (NO_IDS, NO_IDS))
        return out


def pair_encoder(a_path: str, b_path: str) -> PairEncoder:
    return worker_cache(f"pairs:{a_path}:{b_path}", lambda: PairEncoder(a_path, b_path))


def lanes(end_a: np.ndarray, at_a: np.ndarray, end_b: np.ndarray, at_b: np.ndarray, size: int = LANE_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """First A and B token of every lane, for documents that start at ``at_a``/``at_b``: documents of more than
    ``size`` A tokens are parted after the first common end behind every ``size`` tokens. Ends are global byte offsets."""
    ask = np.arange(size, len(end_a) - LOOK, size)
    if not len(ask):
        return at_a, at_b
    near = ask[:, None] + np.arange(LOOK)
    there = np.searchsorted(end_b, end_a[near])
    common = end_b[np.minimum(there, len(end_b) - 1)] == end_a[near]
    first = common.argmax(1)
    ok = common[np.arange(len(ask)), first]
    a = (ask + first + 1)[ok]
    b = there[np.arange(len(ask)), first][ok] + 1
    a, where = np.unique(np.concatenate([at_a, a]), return_index=True)
    b = np.concatenate([at_b, b])[where]
    inside = a < len(end_a)
    return a[inside], b[inside]


def lockstep(end_a: np.ndarray, from_a: np.ndarray, end_b: np.ndarray, from_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cuts ``(A tokens before, B tokens before)`` in order, from lanes that start at ``from_a``/``from_b`` and
    end where the next one starts."""
    i, j = from_a.copy(), from_b.copy()
    stop = np.append(from_a[1:], len(end_a))
    b_at = np.empty(len(end_a) + 1, np.int64)  # B tokens before a cut, by the A tokens before it
    is_cut = np.zeros(len(end_a) + 1, bool)
    while len(i):
        a, b = end_a[i], end_b[j]
        i += a <= b
        j += b <= a
        cut = np.flatnonzero(a == b)
        at = i[cut]
        is_cut[at] = True
        b_at[at] = j[cut]
        done = cut[at == stop[cut]]
        if len(done):
            alive = np.ones(len(i), bool)
            alive[done] = False
            i, j, stop = i[alive], j[alive], stop[alive]
    a_cut = np.flatnonzero(is_cut)
    return a_cut, b_at[a_cut]


def spelled_groups(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents in one byte array and the offset after each document; ``last`` marks the last group of
    each document, which has no separator behind it."""
    a0, b0 = np.concatenate([[0], a_cut[:-1]]), np.concatenate([[0], b_cut[:-1]])
    ids = np.empty(len(a) + len(b), np.int32)
    ids[np.arange(len(a)) + np.repeat(b0, a_cut - a0)] = a
    ids[np.arange(len(b)) + np.repeat(a_cut, b_cut - b0)] = b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[a_cut + b0 - 1] = ord("|")
    end = a_cut + b_cut - 1
    mark[end] = np.where(last, 0, ord(";"))
    digits = np.zeros((len(ids), 8), np.uint8)
    for k in range(6, -1, -1):
        digits[:, k] = np.where((ids > 0) | (k == 6), ids % 10 + 48, 0)
        ids //= 10
    digits[:, 7] = mark
    size = np.cumsum(np.count_nonzero(digits, axis=1))
    flat = digits.ravel()
    return flat[flat > 0], size[end[last]]


def rectangles(a: np.ndarray, b: np.ndarray, doc: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(document, pair)`` of all groups, sorted, and how many links each has."""
    a0, b0 = np.concatenate([[0], a_cut[:-1]]), np.concatenate([[0], b_cut[:-1]])
    na, nb = a_cut - a0, b_cut - b0
    pair = lambda x, y: x.astype(np.int64) << PAIR_BITS | y
    one = (na == 1) & (nb == 1)
    docs, pairs, times = [doc[one]], [pair(a[a0[one]], b[b0[one]])], [np.ones(int(one.sum()), np.int64)]
    small = ~one & (na * nb <= 4096)
    if small.any():
        x0, y0, n, m = a0[small], b0[small], na[small], nb[small]
        area = n * m
        k = np.arange(area.sum()) - np.repeat(np.cumsum(area) - area, area)
        m = np.repeat(m, area)
        pairs.append(pair(a[np.repeat(x0, area) + k // m], b[np.repeat(y0, area) + k % m]))
        docs.append(np.repeat(doc[small], area))
        times.append(np.ones(len(k), np.int64))
    for g in np.flatnonzero(~one & ~small):  # repeated ids of a wide group count before they are paired
        x, nx = np.unique(a[a0[g] : a_cut[g]], return_counts=True)
        y, ny = np.unique(b[b0[g] : b_cut[g]], return_counts=True)
        pairs.append(pair(x[:, None], y[None, :]).ravel())
        times.append((nx[:, None] * ny[None, :]).ravel())
        docs.append(np.full(len(x) * len(y), doc[g]))
    docs, pairs, times = np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((pairs, docs)) if len(docs) >> (63 - 2 * PAIR_BITS) else np.argsort(docs << 2 * PAIR_BITS | pairs, kind="stable")
    docs, pairs, times = docs[order], pairs[order], times[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])
    first = np.flatnonzero(new)
    return docs[first], pairs[first], np.add.reduceat(times, first) if len(first) else times


def aligned(encoded: list[tuple[np.ndarray, np.ndarray]], a_len: np.ndarray, b_len: np.ndarray) -> dict[str, np.ndarray | list[str]]:
    """Alignment of a block of documents: figures per document (``n_a n_b n_groups n_links sha``), and their
    distinct pairs (``doc pair times``)."""
    n_a = np.array([len(x) for x, _ in encoded], np.int64)
    n_b = np.array([len(y) for _, y in encoded], np.int64)
    full = np.flatnonzero(n_a)
    a = np.concatenate([np.empty(0, np.int32), *[x for x, _ in encoded]])
    b = np.concatenate([np.empty(0, np.int32), *[y for _, y in encoded]])
    out = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros_like(n_a), "n_links": np.zeros_like(n_a), "sha": [""] * len(encoded)}
    if not len(full):
        return out | {"doc": np.empty(0, np.int64), "pair": np.empty(0, np.int64), "times": np.empty(0, np.int64)}
    end_a, end_b = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    to_a, to_b = np.cumsum(n_a[full]), np.cumsum(n_b[full])
    starts = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
    from_a, from_b = lanes(end_a, starts[0], end_b, starts[1])
    a_cut, b_cut = lockstep(end_a, from_a, end_b, from_b)
    at = np.searchsorted(to_a, a_cut - 1, "right")  # the group's document among the full ones
    last = np.append(at[1:] != at[:-1], True)
    raw, stop = spelled_groups(a, b, a_cut, b_cut, last)
    begin = 0
    for d, s in zip(full.tolist(), stop.tolist()):
        out["sha"][d] = hashlib.sha256(raw[begin:s].tobytes()).hexdigest()
        begin = s
    area = np.diff(a_cut, prepend=0) * np.diff(b_cut, prepend=0)
    out["n_groups"][full] = np.bincount(at, minlength=len(full))
    sums = np.concatenate([[0], np.cumsum(area)])
    edge = np.concatenate([[0], np.flatnonzero(last) + 1])
    out["n_links"][full] = np.diff(sums[edge])
    doc, pair, times = rectangles(a, b, full[at], a_cut, b_cut)
    return out | {"doc": doc, "pair": pair, "times": times}


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
LISTS = "keys array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, sha array<string>"


def _batched(batches: Iterator[pa.RecordBatch], enc: PairEncoder, block_tokens: int):
    """Keys and ids of whole documents, about ``block_tokens`` A tokens at a time."""
    keys, coded, size = [], [], 0
    for b in batches:
        for at in range(0, b.num_rows, 64):
            part = b.slice(at, 64)
            for k, x in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                if coded and size + len(x[0]) > block_tokens:
                    yield keys, coded
                    keys, coded, size = [], [], 0
                keys.append(k)
                coded.append(x)
                size += len(x[0])
    if coded:
        yield keys, coded


def blocks(df: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block of documents: figures per document; ``own`` (per document the number of its distinct pairs), ``at`` and
    ``times`` (those pairs as places in ``pairs``, and their links); ``pairs`` and ``n_docs`` (the block's distinct pairs)."""
    a_path, b_path = paths or default_paths()
    kind = dict(df.dtypes)[key]
    schema = f"block bigint, {LISTS.format(kind=kind)}, own binary, at binary, times binary, pairs array<bigint>, n_docs array<int>"

    def run(batches):
        enc = pair_encoder(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        key_type = first.column(0).type

        def chained():
            yield first
            yield from batches

        for keys, coded in _batched(chained(), enc, block_tokens):
            got = aligned(coded, enc.a_len, enc.b_len)
            pairs, at, n_docs = np.unique(got["pair"], return_inverse=True, return_counts=True)
            own = np.bincount(got["doc"], minlength=len(keys)).astype("<u4")
            cells = [
                pa.array([number], pa.int64()), pa.array([keys], pa.list_(key_type)), *[pa.array([got[f]], pa.list_(pa.int64())) for f in FIGURES],
                pa.array([got["sha"]], pa.list_(pa.string())), pa.array([own.tobytes()]), pa.array([at.astype("<u4").tobytes()]),
                pa.array([got["times"].astype("<u4").tobytes()]), pa.array([pairs], pa.list_(pa.int64())), pa.array([n_docs.astype(np.int32)], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(cells, names=["block", "keys", *FIGURES, "sha", "own", "at", "times", "pairs", "n_docs"])
            number += 1

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def _a_of(pair: Column) -> Column:
    return F.shiftright(pair, PAIR_BITS)


def counted(blocked: DataFrame) -> DataFrame:
    """``(pair, n_docs, best)``: the documents that hold a pair linked, and whether no pair of its A id has more."""
    rows = blocked.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.n_docs").alias("n"))
    total = rows.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a", _a_of(F.col("pair")))
    top = total.groupBy("a").agg(F.max("n_docs").alias("top"))
    return total.join(top, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def dictionary(df: DataFrame, **how) -> DataFrame:
    """``(a_id, b_id, n_docs, best)``: the corpus-wide table of linked ids."""
    got = counted(written(blocks(df, **how), "align-blocks"))
    return got.select(_a_of(F.col("pair")).alias("a_id"), F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("b_id"), "n_docs", "best")


def align(df: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row."""
    blocked = written(blocks(df, key, text, **how), "align-blocks")
    counts = written(counted(blocked), "align-counts")
    asked = blocked.select("block", F.posexplode("pairs").alias("at", "pair"))
    # a block's pairs are bounded by its own tokens
    found = asked.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("at", "n_docs", "best")).alias("found"))
    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    names = [key, *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                col = dict(zip(b.schema.names, [b.column(i).slice(r, 1) for i in range(b.num_columns)]))
                keys = col["keys"].flatten()
                own, at, times = (np.frombuffer(col[c][0].as_py(), "<u4").astype(np.int64) for c in ("own", "at", "times"))
                got = col["found"].flatten()
                n_docs, best = np.zeros(len(got), np.int64), np.zeros(len(got), np.int64)
                if len(got):
                    place = got.field("at").to_numpy()
                    n_docs[place] = got.field("n_docs").to_numpy()
                    best[place] = got.field("best").to_numpy(zero_copy_only=False)
                edge = np.concatenate([[0], np.cumsum(own)])
                sums = [pa.array(np.diff(np.concatenate([[0], np.cumsum(times * w[at])])[edge])) for w in (best, n_docs)]
                yield pa.RecordBatch.from_arrays([keys, *[col[f].flatten() for f in FIGURES], *sums, col["sha"].flatten()], names=names)

    parts = blocked.drop("pairs", "n_docs").join(found, "block", "left")
    return parts.select("keys", *FIGURES, "sha", "own", "at", "times", "found").mapInArrow(run, schema)

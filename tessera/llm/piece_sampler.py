"""SentencePiece encoding and decoding with sampled segmentations.

A text's segmentation is drawn from the distribution over its piece lattice in which a segmentation weighs
``exp(alpha * sum of piece scores)``: forward filtering sums the weights of all ways to reach each position,
backward sampling walks from the end and picks each incoming piece with its exact probability. The draw at
a text position comes from a counter generator keyed by the seed and the row key, so a row is cut alike in
every run, on any cluster. ``alpha`` near 0 samples widely, a large one nears the best segmentation.

No piece spans a blank (as its inner part) or a newline, so the lattice falls apart into units there; all distinct
units of a batch are filtered together as arrays, and all units of the batch are sampled together.
Encoding is lossless: no normalisation, blanks are pieces' blank marks, and characters without a piece
(a literal blank mark too) become byte pieces. Null texts have null ids, empty texts none.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import worker_cache

ALPHA = 2e-4
BYTE_SCORE = -40_000.0  # of one byte piece
# Units: Latin runs and ASCII punctuation runs with the blank before them, other chunks whole; if some
# piece spans such a border, all blank-separated chunks whole.
LATIN, MARKS = r"[0-9A-Za-z\u00c0-\u024f]", r"[!-/:-@\[-`{-~]"
FINE = re.compile(rf"\n| ?{LATIN}+(?=[!-/:-@\[-`{{-~ \n]|$)| ?{MARKS}+(?=[0-9A-Za-z\u00c0-\u024f \n]|$)| ?[^ \n]+| ")
COARSE = re.compile(r"\n| ?[^ \n]+| ")
BORDER = re.compile(f"{LATIN}{MARKS}|{MARKS}{LATIN}")
LONG = 256  # characters; a longer unit is filtered by itself
GROUP_CHARS = 1 << 19


def vocabulary() -> str:
    """The default piece file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces with weights, as text with real blanks; byte pieces; a trie of the pieces."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.raw: list[bytes] = [b""] * self.size
        self.byte_id = [0] * 256
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value], self.raw[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain = piece.replace("▁", " ")
                self.raw[i] = plain.encode()
                if " " not in plain[1:] and "\n" not in plain:
                    self.pieces[plain] = (i, alpha * sp.get_score(i))
        self.longest = max(map(len, self.pieces))
        self.unit = COARSE if any(map(BORDER.search, self.pieces)) else FINE
        self.byte_weight = alpha * BYTE_SCORE
        self._trie()

    def _trie(self) -> None:
        """The pieces as a trie in arrays: sorted ``node << 21 | code point`` with the node it leads to, and
        per node its piece (-1: none) and the piece's weight."""
        node: dict[str, int] = {"": 0}
        links = []
        for piece in self.pieces:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in node:
                    node[piece[:k]] = len(node)
                    links.append((node[piece[: k - 1]] << 21 | ord(piece[k - 1]), node[piece[:k]]))
        self.link, self.child = map(np.array, zip(*sorted(links)))
        self.piece, self.weight = np.full(len(node), -1, "i4"), np.zeros(len(node))
        for piece, (i, w) in self.pieces.items():
            self.piece[node[piece]], self.weight[node[piece]] = i, w

    def lattice(self, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward filter of one unit, position by position: per position its number of incoming pieces, and
        per piece the cumulative probability, start position and id (``size + code point``: byte pieces)."""
        get, longest, exp = self.pieces.get, self.longest, math.exp
        total = [0.0]
        count, cum, start, ids = array("i"), array("d"), array("i"), array("i")
        for j in range(1, len(unit) + 1):
            last = None
            weights = []
            for i in range(j - longest if j > longest else 0, j):
                last = get(unit[i:j])
                if last:
                    weights.append(total[i] + last[1])
                    start.append(i)
                    ids.append(last[0])
            if not last:
                c = unit[j - 1]
                weights.append(total[j - 1] + len(c.encode("utf-8", "surrogatepass")) * self.byte_weight)
                start.append(j - 1)
                ids.append(self.size + ord(c))
            top = max(weights)
            weights = [exp(w - top) for w in weights]
            s = sum(weights)
            total.append(top + math.log(s))
            acc = 0.0
            for w in weights:
                acc += w / s
                cum.append(acc)
            cum[-1] = 1.0
            count.append(len(weights))
        return tuple(np.frombuffer(x, d) for x, d in ((count, "i4"), (cum, "f8"), (start, "i4"), (ids, "i4")))

    def lattices(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward filter of many units at once: the place of every position (unit by unit) among the rows of
        ``count``, and ``count``, ``cum``, ``start`` and ``ids`` as ``lattice`` gives them.

        Rows are ordered by position within the unit, so that a position of all units is one slice."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        first = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(units), np.int64)
        rank[order] = np.arange(len(units))
        level = np.searchsorted(-size[order], -np.arange(int(size.max())), side="left")  # units longer than a position
        level = np.concatenate([[0], np.cumsum(level)])
        within = np.arange(len(codes)) - np.repeat(first, size)
        place = level[within] + np.repeat(rank, size)
        rest = np.repeat(size, size) - within  # characters from a position to the unit's end
        ends, starts, ids, weights = [], [], [], []
        node, at = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for d in range(1, self.longest + 1):
            on = np.flatnonzero(rest[at] >= d)
            node, at = node[on], at[on]
            key = node << 21 | codes[at + d - 1]
            k = np.minimum(np.searchsorted(self.link, key), len(self.link) - 1)
            found = self.link[k] == key
            node = self.child[k[found]]
            if d == 1:
                bare = np.concatenate([at[~found], at[found][self.piece[node] < 0]])
                c = codes[bare]
                width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                ends.append(bare), starts.append(bare), ids.append(self.size + c), weights.append(width * self.byte_weight)
            at = at[found]
            is_piece = np.flatnonzero(self.piece[node] >= 0)
            got = node[is_piece]
            starts.append(at[is_piece]), ends.append(at[is_piece] + d - 1), ids.append(self.piece[got]), weights.append(self.weight[got])
            if not len(at):
                break
        count = np.zeros(len(codes), np.int64)
        for e in ends:
            count[place[e]] += 1  # a position ends one piece of each length at most
        row = np.cumsum(count) - count
        free, slot = row.copy(), []
        for e in reversed(ends):  # long pieces, those that start first, come first
            slot.append(free[place[e]])
            free[place[e]] += 1
        slot = np.concatenate(slot[::-1])
        start_at, weight, out_ids = np.empty(len(slot), np.int64), np.empty(len(slot)), np.empty(len(slot), "i4")
        start_at[slot], weight[slot], out_ids[slot] = np.concatenate(starts), np.concatenate(weights), np.concatenate(ids)
        start = within[start_at]
        before = np.where(start > 0, place[start_at - 1], len(codes))
        total, share = np.zeros(len(codes) + 1), np.empty(len(slot))
        edge = np.append(row, len(slot))
        for a, b in zip(level[:-1], level[1:]):
            e, f = edge[a], edge[b]
            w = total[before[e:f]] + weight[e:f]
            cuts, times = row[a:b] - e, count[a:b]
            top = np.maximum.reduceat(w, cuts)
            w = np.exp(w - np.repeat(top, times))
            s = np.add.reduceat(w, cuts)
            total[a:b] = top + np.log(s)
            share[e:f] = w / np.repeat(s, times)
        cum, acc = np.empty(len(slot)), np.zeros(len(codes))
        on = np.arange(len(codes))
        for k in range(int(count.max())):
            on = on[count[on] > k]
            acc[on] += share[row[on] + k]
            cum[row[on] + k] = acc[on]
        cum[row + count - 1] = 1.0
        return place, count, cum, start, out_ids

    def sample(self, texts: list[str], keys: list, seed: int) -> list[np.ndarray]:
        """Ids of a sampled segmentation per text."""
        local: dict[str, int] = {}
        which, lengths = [], np.array([len(t) for t in texts])
        for t in texts:
            which += [local.setdefault(u, len(local)) for u in self.unit.findall(t)]
        if not which:
            return [np.empty(0, "i4") for _ in texts]
        size = np.fromiter(map(len, local), np.int64, len(local))
        base = np.cumsum(size) - size  # node before a unit's first position
        place = np.empty(size.sum(), np.int64)
        short = [(i, u) for i, u in enumerate(local) if len(u) <= LONG]
        parts, nodes = [], 0
        if short:
            row, *got = self.lattices([u for _, u in short])
            place[np.repeat(size <= LONG, size)] = row
            parts, nodes = [got], len(row)
        for i, u in enumerate(local):
            if len(u) > LONG:
                parts.append(self.lattice(u))
                place[base[i] : base[i] + len(u)] = np.arange(nodes, nodes + len(u))
                nodes += len(u)
        count, cum, start, ids = (np.concatenate(x) for x in zip(*parts))
        goal = np.repeat(np.arange(len(count)), count) + cum
        final = np.cumsum(count) - 1
        which = np.array(which)
        draws = np.concatenate([self.draws(seed, k, n) for k, n in zip(keys, lengths)])
        first = np.cumsum(size[which]) - size[which]  # text position before a unit
        out = np.full(len(draws), -1, "i4")
        at, unit_base, unit_first = size[which], base[which], first
        while len(at):
            p = unit_first + at - 1
            node = place[unit_base + at - 1]
            # a draw next to 1 may round up to the next node
            edge = np.minimum(np.searchsorted(goal, node + draws[p], side="right"), final[node])
            out[p] = ids[edge]
            at = start[edge]
            on = np.flatnonzero(at)
            at, unit_base, unit_first = at[on].astype(np.int64), unit_base[on], unit_first[on]
        ends = np.cumsum(lengths)
        return [self.expand(o[o >= 0]) for o in np.split(out, ends[:-1])]

    def draws(self, seed: int, key, n: int) -> np.ndarray:
        """One uniform number per text position, keyed by the seed and the row key."""
        k = int.from_bytes(hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=16).digest(), "little")
        return np.random.Generator(np.random.Philox(key=k)).random(n)

    def expand(self, ids: np.ndarray) -> np.ndarray:
        """Byte pieces in the place of characters without a piece."""
        wide = np.flatnonzero(ids >= self.size)
        if not len(wide):
            return ids
        out, last = [], 0
        for i in wide.tolist():
            out += [ids[last:i], np.array([self.byte_id[b] for b in chr(ids[i] - self.size).encode("utf-8", "surrogatepass")], "i4")]
            last = i + 1
        return np.concatenate([*out, ids[last:]])

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "surrogatepass")


def model(path: str, alpha: float) -> PieceModel:
    return worker_cache(f"pieces:{path}:{alpha}", lambda: PieceModel(path, alpha))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, alpha: float = ALPHA, seed: int = 1) -> DataFrame:
    """``(key, ids)``, one row per input row; other columns are ignored. Rows alike are cut alike."""
    path = path or vocabulary()
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        m = model(path, alpha)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < GROUP_CHARS):
                    chars += len(texts[to] or "")
                    to += 1
                ids = m.sample([t or "" for t in texts[at:to]], keys[at:to], seed)
                offsets = np.cumsum([0, *map(len, ids)]).astype("i4")
                gone = pa.array([t is None for t in texts[at:to]])
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype("i4")), mask=gone)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), values], names=[key, "ids"])
                at = to

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, keep: list[str], ids: str = "ids", path: str | None = None) -> DataFrame:
    """The ``keep`` columns and ``decoded``, the text that the ids were made from (null for null ids)."""
    path = path or vocabulary()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", decoded string"

    def run(batches):
        m = model(path, ALPHA)
        for b in batches:
            lists = b.column(len(keep))
            at = lists.offsets.to_numpy()
            ids, gone = lists.values.to_numpy(zero_copy_only=False), lists.is_null().to_pylist()
            texts = [None if x else m.decode(ids[i:j].tolist()) for x, i, j in zip(gone, at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return df.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, schema)

"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block of ids is coded by itself. Its model starts from a ``Table``: how often each id occurs (order 0) and, for
ids with a habitual follower, that follower. Per id the order-2 and the order-1 context of the block name the id
that they expect, each with an adaptive confidence; an order-1 context not yet seen in the block takes the table's follower. Whether the
expected id comes is coded with the logistic mix of three predictions, of order 2, 1 and 0, the first two from adaptive
probabilities, with weights learned on the way; any other id is coded by its order-0 share. All arithmetic is on
integers, so every machine decodes alike. Blocks run side by side as lanes of arrays: one step codes one id of every block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SLOTS = 128  # contexts kept per block and order
MAX_ID = 1 << 16
SHARE_BITS = 16  # order-0 shares sum to 2 ** SHARE_BITS
FOLLOWS = 4  # times an id must follow another to stand in the table
TOP_BITS = 62  # of the coder's interval; words of 32 bits leave it from above
KEEP_BITS = TOP_BITS - 32
LOW = (1 << KEEP_BITS) - 1
WORD = (1 << 32) - 1

_x = np.arange(-2047, 2048)
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-_x / 256.0))), 8, 4088).astype(np.int32)
STRETCH = np.clip(np.round(256 * np.log((np.arange(4096) + 0.5) / (4096 - np.arange(4096) - 0.5))), -2047, 2047).astype(np.int32)
# First probabilities (of 65,536) that the expected id comes, by confidence 0-3 of the context and whether order 1 agrees.
START = np.array([[2000, 9000, 10000, 16000, 18000, 30000, 36000, 52000], [2000, 9000, 14000, 26000, 28000, 44000, 44000, 58000]], np.int32)
WEIGHTS = (14000, 34000, 22000)  # of order 0, 1 and 2 at a block's start, of 65,536


class Table:
    """Order-0 shares and habitual followers that blocks start from."""

    def __init__(self, share: np.ndarray, follower: np.ndarray):
        self.share, self.follower = share.astype(np.int64), follower.astype(np.int32)
        self.start = np.cumsum(self.share) - self.share
        self.by_share = np.repeat(np.arange(MAX_ID, dtype=np.int32), self.share)
        self.stretch = np.take(STRETCH, np.minimum(self.share >> (SHARE_BITS - 12), 4095))
        self.stretch16 = np.repeat(STRETCH, 16)
        # slots of order 1, and of order 2 as a combination of the last id and the one before
        ids = np.arange(MAX_ID, dtype=np.int64)
        self.near, self.near2, self.far2 = (ids * 20011 >> 3) & (SLOTS - 1), (ids * 15013 >> 4) & (SLOTS - 1), (ids * 26357 >> 4) & (SLOTS - 1)

    @classmethod
    def flat(cls) -> Table:
        """Nothing known."""
        return cls(np.ones(MAX_ID), np.full(MAX_ID, -1))

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        """Of all ``ids`` (below 65,536), in their order."""
        ids = np.asarray(ids, np.uint32)
        if not len(ids):
            return cls.flat()
        count = np.bincount(ids, minlength=MAX_ID)
        room = (1 << SHARE_BITS) - np.count_nonzero(count)
        share = np.where(count > 0, 1 + count * room // len(ids), 0)
        share[np.argmax(count)] += (1 << SHARE_BITS) - share.sum()
        pairs = np.sort(ids[:-1] << 16 | ids[1:])
        first = np.flatnonzero(np.concatenate([np.ones(min(len(pairs), 1), bool), pairs[1:] != pairs[:-1]]))
        often = np.diff(first, append=len(pairs))
        first, often = first[often >= FOLLOWS], often[often >= FOLLOWS]
        order = np.argsort(often, kind="stable")  # the most frequent one is written last
        follower = np.full(MAX_ID, -1)
        follower[pairs[first[order]] >> 16] = pairs[first[order]] & 0xFFFF
        return cls(share, follower)

    def to_bytes(self) -> bytes:
        known, led = np.flatnonzero(self.share), np.flatnonzero(self.follower >= 0)
        lists = [np.diff(known, prepend=0), self.share[known] - 1, np.diff(led, prepend=0), self.follower[led]]
        body = b"".join(part.tobytes() for x in lists for part in (x.astype("<u2").view("u1").reshape(-1, 2).T.copy(),))
        return struct.pack("<II", len(known), len(led)) + zlib.compress(body, 6)

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        n, m = struct.unpack_from("<II", data)
        body, at, lists = np.frombuffer(zlib.decompress(data[8:]), "u1"), 0, []
        for size in (n, n, m, m):
            lists.append(body[at : at + 2 * size].reshape(2, size).T.copy().view("<u2").ravel().astype(np.int64))
            at += 2 * size
        share, follower = np.zeros(MAX_ID, np.int64), np.full(MAX_ID, -1)
        share[np.cumsum(lists[0])] = lists[1] + 1
        follower[np.cumsum(lists[2])] = lists[3]
        return cls(share, follower)


class Lanes:
    """The model of ``n`` blocks, each in its own state; rows of arrays are orders, columns blocks."""

    def __init__(self, n: int, table: Table):
        lane = np.arange(n, dtype=np.int64)
        self.table = table
        self.slots = np.stack([lane, n + lane]) * SLOTS
        self.chances = np.stack([lane, n + lane]) * 8
        # an expected id and, in the low two bits, its confidence; 0: none yet
        self.known = np.zeros(2 * n * SLOTS, np.int32)
        self.prob = np.tile(START.ravel(), (n, 1)).reshape(n, 2, 8).transpose(1, 0, 2).reshape(-1).copy()
        self.weight = np.repeat(np.array(WEIGHTS, np.int32)[:, None], n, 1)
        self.base = (table.follower.clip(0) << 2).astype(np.int32)
        self.s = np.empty((2, n), np.int64)
        self.x = np.empty((3, n), np.int32)
        self.one = np.zeros(n, np.int64)
        self.before = np.zeros(n, np.int64)  # hash of the id before that

    def predict(self):
        """The expected id of every lane and its probability, of 4,096."""
        one, s, x = self.one, self.s, self.x
        np.add(self.slots[0], self.table.near.take(one), out=s[0])
        np.add(self.slots[1], self.table.near2.take(one) ^ self.before, out=s[1])
        e = self.known.take(s)
        e[0] = np.where(e[0] & 3, e[0], self.base.take(one))
        c, g = e & 3, e >> 2
        first = np.where(c[1], g[1], g[0])
        self.i = self.chances + (c * 2 + (g[0] == first))
        self.seen = self.prob.take(self.i)
        x[0] = self.table.stretch.take(first)
        x[1:] = self.table.stretch16.take(self.seen)
        dot = (self.weight * x).sum(0, dtype=np.int32) >> 16
        dot += 2047
        self.p = SQUASH.take(dot, mode="clip")
        self.e, self.c, self.g = e, c, g
        return first, self.p

    def learn(self, hit, ids):
        """Move probabilities, weights and expected ids towards what was seen."""
        err = (hit * np.int32(4096) - self.p) * np.int32(5)
        self.weight += self.x * err >> 10
        np.clip(self.weight, -(1 << 17), 1 << 17, out=self.weight)
        self.prob[self.i] = self.seen + ((hit * np.int32(65535) - self.seen) >> 4)
        e, c = self.e, self.c
        self.known[self.s] = np.where(self.g == ids, e + (c < 3), np.where(c <= 1, (ids << 2) + 1, e - 1))
        self.before = self.table.far2.take(self.one)
        self.one = ids.astype(np.int64)


def encode(ids: np.ndarray, table: Table | None = None) -> list[bytes]:
    """One payload per row of ``ids`` (blocks x ids, all with a share in ``table``); a block that does not shrink is
    stored as it is, marked by its first byte."""
    table = table or Table.flat()
    n, steps = ids.shape
    model = Lanes(n, table)
    low, size = np.zeros(n, np.int64), np.full(n, 1 << TOP_BITS)
    # words by lane, a carry in a word's 33rd bit until the end; blocks that need more words are stored as they are
    out = np.zeros((steps // 2 + 4, n), np.int64)
    flat, used = out.reshape(-1), np.arange(n)
    bound = out.size - 3 * n
    cols = np.ascontiguousarray(ids.T).astype(np.int32)
    for t in range(steps):
        s = cols[t]
        first, p = model.predict()
        hit = first == s
        part = (size >> 12) * p
        size = np.where(hit, part, size - part)
        missed = np.flatnonzero(~hit)
        v = s[missed]
        r = size[missed] >> SHARE_BITS
        low[missed] += part[missed] + table.start.take(v) * r
        size[missed] = table.share.take(v) * r
        full = np.flatnonzero(size < 1 << KEEP_BITS)
        rest = low[full]
        at = used[full]
        flat[at] = rest >> KEEP_BITS
        used[full] = np.where(at < bound, at + n, at)
        low[full] = (rest & LOW) << 32
        size[full] <<= 32
        model.learn(hit, s)
    lanes = np.arange(n)
    flat[used] = low >> KEEP_BITS
    flat[used + n] = (low & LOW) << 2
    for j in range(len(out) - 1, 0, -1):
        out[j - 1] += out[j] >> 32
    out &= WORD
    words, lengths = np.ascontiguousarray(out.astype("<u4").T), (used - lanes) // n + 2
    return [b"\x01" + words[i, :k].tobytes() if 4 * k < 2 * steps else b"\x00" + ids[i].astype("<u2").tobytes() for i, k in enumerate(lengths.tolist())]


def decode(payloads: list[bytes], steps: int, table: Table | None = None) -> np.ndarray:
    """The ids (blocks x ``steps``) of payloads made by ``encode`` with the same table."""
    table = table or Table.flat()
    result = np.zeros((len(payloads), steps), np.int32)
    coded = [i for i, b in enumerate(payloads) if b[0] == 1]
    for i, b in enumerate(payloads):
        if b[0] == 0:
            result[i] = np.frombuffer(b, "<u2", offset=1)
    if not coded:
        return result
    n = len(coded)
    words = np.zeros((n, max(len(payloads[i]) // 4 for i in coded) + 3), np.int64)
    for k, i in enumerate(coded):
        w = np.frombuffer(payloads[i], "<u4", offset=1)
        words[k, : len(w)] = w
    model = Lanes(n, table)
    code, size = (words[:, 0] << KEEP_BITS) | (words[:, 1] >> 2), np.full(n, 1 << TOP_BITS)
    # the interval ends two bits before a word does: words as they enter it
    entering = np.ascontiguousarray((((words[:, :-1] & 3) << KEEP_BITS) | (words[:, 1:] >> 2)).T)
    last = len(entering) - 1
    flat, at = entering.reshape(-1), np.arange(n) + n
    out = np.zeros((steps, n), np.int32)
    for t in range(steps):
        first, p = model.predict()
        part = (size >> 12) * p
        hit = code < part
        size = np.where(hit, part, size - part)
        missed = np.flatnonzero(~hit)
        rest = code[missed] - part[missed]
        r = size[missed] >> SHARE_BITS
        v = table.by_share.take(rest // r, mode="clip")
        code[missed] = rest - table.start.take(v) * r
        size[missed] = table.share.take(v) * r
        s = first.copy()
        s[missed] = v
        full = np.flatnonzero(size < 1 << KEEP_BITS)
        code[full] = (code[full] << 32) | flat[np.minimum(at[full], last * n + full)]
        at[full] += n
        size[full] <<= 32
        model.learn(hit, s)
        out[t] = s
    result[coded] = out.T
    return result

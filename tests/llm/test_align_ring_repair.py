"""Token alignment, the hash ring and conversation repair against brute force on small tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import conversation_repair as C
from tessera.llm import hash_ring, token_align

DOCS = "doc_id bigint, text string, n_a string, row string"
TEXTS = [
    "The quick brown fox, doesn't jump. 12345 naïve façade", "", None, "a", "  two  blanks", "line\nbreak\n\nmore \t tabs ", "日本語 テスト 😀😀", "<|endoftext|> <s> </s> x",
    "piece ▁ mark", "ﬁ ½ é", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "same words here", "same words here", "\nstarts", "ends\n", "nb sp　x", "0" * 300, "é" * 50, "hypothetical antidisestablishmentarianism " * 40,
]


# ---- 11 token alignment


def plain_alignment(texts):
    """Groups and links by sets of offsets, from whole texts through both libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = token_align.default_paths()
    tok = Tokenizer.from_file(a_path)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = token_align.letter_bytes()
    docs = []
    for t in texts:
        groups = []
        if t:
            a = tok.encode(" " + t, add_special_tokens=False).ids
            b = sp.encode(t)
            ab = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
            bb = []
            for i in b:
                p = sp.id_to_piece(i)
                m = re.fullmatch("<0x(..)>", p)
                bb.append(bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode())
            if b"".join(ab) == b"".join(bb) == (" " + t).encode():
                ea, eb = list(itertools.accumulate(map(len, ab))), list(itertools.accumulate(map(len, bb)))
                i = j = 0
                for cut in sorted(set(ea) & set(eb)):
                    k, m = ea.index(cut, i) + 1, eb.index(cut, j) + 1
                    groups.append((a[i:k], b[j:m]))
                    i, j = k, m
        docs.append(groups)
    held = collections.Counter(p for g in docs for p in {(x, y) for xs, ys in g for x in xs for y in ys})
    top = collections.defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for g in docs:
        links = [(x, y) for xs, ys in g for x in xs for y in ys]
        spelled = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        sha = hashlib.sha256(spelled.encode()).hexdigest() if g else ""
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha))
    return out, held, top


def fuzzed(n=60):
    rng = random.Random(3)
    parts = ["the", " ", "  ", "\n", "\t", "é", "'s", "12", "...", "日", "😀", "Word", "▁", " ", "ing", "x" * 9, "\r\n", " ", "-"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("size", [1 << 20, 40])
def test_alignment_equals_plain_sets(spark, size):
    texts = TEXTS + fuzzed()
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], DOCS).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in token_align.align(df, block_tokens=size).collect()}
    want, held, top = plain_alignment(texts)
    assert [got[i] for i in range(len(texts))] == want
    pairs = {(r.a_id, r.b_id): (r.n_docs, r.best) for r in token_align.dictionary(df, block_tokens=size).collect()}
    assert pairs == {p: (n, n == top[p[0]]) for p, n in held.items()}


def test_alignment_of_long_texts_null_keys_and_empty_tables(spark):
    long = " ".join(random.Random(8).choice(["wonderful", "zyzzyva", "naïve", "12", "x,y"]) for _ in range(20_000))
    df = spark.createDataFrame([(None, long), (None, "x"), (7, "x"), (7, "x")], "doc_id bigint, text string")
    got = sorted(tuple(r)[1:] for r in token_align.align(df).collect())
    assert got == sorted(plain_alignment([long, "x", "x", "x"])[0])
    assert token_align.align(df.limit(0)).count() == 0


def test_wide_groups_count_repeated_ids_first():
    import numpy as np

    a, b = np.tile(np.array([5, 9], np.int32), 60), np.tile(np.array([1, 2, 3], np.int32), 40)
    doc, pair, times = token_align.rectangles(a, b, np.array([4]), np.array([120]), np.array([120]))
    assert doc.tolist() == [4] * 6 and times.tolist() == [60 * 40] * 6
    assert sorted(pair.tolist()) == sorted(x << token_align.PAIR_BITS | y for x in (5, 9) for y in (1, 2, 3))


# ---- 12 hash ring


def check_places(rows, texts, shards=16):
    """Figures, gapless slots; returns bytes per shard."""
    size = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    return [size[s] for s in range(shards)]


def test_ring_evens_out_sizes(spark):
    rng = random.Random(1)
    texts = ["é" * rng.choice([0, 3, 20, 200, 2000]) for _ in range(3000)] + [None, ""]
    # one key holds a third of all rows
    df = spark.createDataFrame([(i if i % 3 else None, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(5)
    got = hash_ring.assign(df).collect()
    size = check_places(got, texts)
    assert max(size) - min(size) <= 0.03 * sum(size) / 16 + 4001
    assert hash_ring.assign(df.limit(0)).count() == 0
    one = hash_ring.assign(df.where("doc_id = 1")).collect()
    check_places(one, [texts[1]])


def test_ring_walk_is_the_clockwise_rule():
    rng = random.Random(2)
    loads = [(c, -1, rng.randrange(1, 90)) for c in rng.sample(range(hash_ring.CELLS), 5000)]
    points = hash_ring.ring(16)
    got = hash_ring.walk(loads, 16)
    capacity, held = 1.002 * sum(x for *_, x in loads) / 16, [0] * 16
    for i in sorted(range(5000), key=lambda i: (-loads[i][2].bit_length(), loads[i][0])):
        c, _, x = loads[i]
        turn = [s for p, s in points if p >= c] + [s for p, s in points if p < c]
        want = next((s for s in turn if held[s] + x <= capacity), None)
        assert got[i] == (min(range(16), key=lambda s: (held[s], s)) if want is None else want)
        held[got[i]] += x
    # with room to spare one more shard takes rows only into itself; with little, few others move
    loose = [hash_ring.walk(loads, n, slack=9.0) for n in (16, 17)]
    assert all(a == b or b == 16 for a, b in zip(*loose))
    tight = [hash_ring.walk(loads, n) for n in (16, 17)]
    assert sum(x for (*_, x), a, b in zip(loads, *tight) if a != b) < 0.3 * sum(x for *_, x in loads)


def test_saved_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "t" * (i % 50), "a", "b") for i in range(500)], DOCS)
    hash_ring.save(df, f"{tmp_path}/shards", rows_per_file=10, shards=4)
    back = hash_ring.load(spark, f"{tmp_path}/shards")
    assert sorted(tuple(r.row) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    got = hash_ring.load(spark, f"{tmp_path}/shards", 2).collect()
    assert sorted(r.slot for r in got) == list(range(len(got))) and {r.shard for r in got} == {2}


# ---- 13 conversation repair


def cheapest(letters):
    """Least (cost, edits) by a forward pass that keeps the best string of every place, inserts included."""
    at = {C.START: (0, "")}

    def inserted(best):
        for _ in range(4):
            for s, (c, e) in list(best.items()):
                t = C.NEXT[s][1]
                if t not in best or (c + 5, e + "I") < best[t]:
                    best[t] = (c + 5, e + "I")
        return best

    at = inserted(at)
    for x in letters:
        new = {}
        for s, (c, e) in at.items():
            options = [(s, c + 2, e + "D")]
            if x != "-":
                extra = 5 * x.isupper()
                want, then = C.NEXT[s]
                options.append((then, c + 1 + extra, e + "R"))
                if x.lower() == want:
                    options.append((then, c + extra, e + "K"))
                elif x.lower() == "s" and s == C.START:
                    options.append((C.SYSTEM, c + extra, e + "K"))
            for t, d, f in options:
                if t not in new or (d, f) < new[t]:
                    new[t] = (d, f)
        at = inserted(new)
    return min(at[s] for s in C.ACCEPTS if s in at)


def all_paths(letters):
    """Every edit string up to a length, by plain enumeration."""
    best = None
    n = len(letters)
    for k in range(3):
        for places in itertools.combinations_with_replacement(range(n + 1), k):
            for edits in itertools.product("DKR", repeat=n):
                s, cost, text, ok = C.START, 0, "", True
                for i in range(n + 1):
                    for _ in range(places.count(i)):
                        s, cost, text = C.NEXT[s][1], cost + 5, text + "I"
                    if i == n:
                        break
                    x, e = letters[i], edits[i]
                    text += e
                    if e == "D":
                        cost += 2
                        continue
                    if x == "-":
                        ok = False
                        break
                    cost += 5 * x.isupper()
                    want, then = C.NEXT[s]
                    if e == "R":
                        s, cost = then, cost + 1
                    elif x.lower() == want:
                        s = then
                    elif x.lower() == "s" and s == C.START:
                        s = C.SYSTEM
                    else:
                        ok = False
                        break
                if ok and s in C.ACCEPTS and (best is None or (cost, text) < best):
                    best = (cost, text)
    return best


def test_search_against_enumeration():
    for n in range(4):
        for x in itertools.product("suaxUA-S", repeat=n):
            assert C.search("".join(x)) == all_paths(x) == cheapest(x), x
    rng = random.Random(4)
    for _ in range(1500):
        x = "".join(rng.choice("suauauauaxSUA-") for _ in range(rng.randrange(30)))
        assert C.search(x) == cheapest(x), x


def test_search_time_grows_with_the_rows():
    import time

    rng = random.Random(6)
    x = "".join(rng.choice("suauauaxUA-") for _ in range(200_000))
    t = time.time()
    cost, edits = C.search(x)
    assert time.time() - t < 30 and sum(map(edits.count, "DKR")) == len(x) and cost > 0


def whole(rows):
    """The contract, conversation by conversation."""
    out = {}
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    for conv, own in by.items():
        after = []
        for turn, role, text in own:
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if k == 0:
                continue
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            after += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        n, seen, letters = collections.Counter(), set(), ""
        for _, role, text in after:
            body = text.strip(" \t\n\x0b\x0c\r")
            f = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            n[f] += 1
            seen.add((role, text))
            x = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "-" if f in ("blank", "duplicate") else x.upper() if f else x
        turns = [t for t, *_ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, edits = cheapest(letters)
        final, i, prev = [], 0, ""
        for e in edits:
            want = "assistant" if prev == "u" else "user"
            if e == "I":
                final.append(f"{want}:")
                prev = want[0]
                continue
            _, role, text = after[i]
            i += 1
            if e != "D":
                role = want if e == "R" else role
                final.append(f"{role}:{text}")
                prev = role[0]
        sha = hashlib.sha256("\n".join(final).encode()).hexdigest()
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, sha)
    return out


ROWS = "conv_id bigint, turn bigint, role string, text string, cost string, conv string"


@pytest.mark.parametrize("held", [C.HELD_BYTES, 300])
def test_repair_against_the_plain_rule(spark, held):
    rng = random.Random(9)
    rows = []
    for c in [*range(300), None]:
        for t in [*range(rng.randrange(1, 9)), *([None] if c is None or c % 50 == 0 else [])]:
            role = rng.choice(["system", "user", "assistant", None, "tool", ""]) if rng.random() < 0.2 else ("user", "assistant")[(t or 0) % 2]
            text = rng.choice(["Done.", "Why?\n", "No!  ", " \t", "", "open end", "é ü."]) + (str(rng.random()) + "." if rng.random() < 0.5 else "")  if rng.random() < 0.9 else None
            rows.append((c, t, role, text))
    rows += [(900, t % 7, "user" if t % 2 else "assistant", f"{t % 40} x.") for t in range(400)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows if True], ROWS).repartition(4)
    got = C.repair(C.damaged(C.turns(df)), held).collect()
    assert {r.conv: tuple(r)[1:] for r in got} == whole(rows) and len(got) == 302
    assert C.digests(df.limit(0)).count() == 0

"""Conversation structure repair by iterative-deepening A*.

A repaired conversation's role initials are ``(s?(ua)+)?``: perhaps one system turn, then user and assistant
in turn. Edits: Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and repeated rows),
Insert an empty user or assistant turn (5); a truncated row that stays costs 5 more. The cheapest edits win,
of those the ASCII-least string of their initials.

*Search.* Depth first over (next row, where the pattern stands), edits in ASCII order ``D I K R``, under a bound
on cost so far plus estimate; the bound rises to the least value that exceeded it. States that failed are kept
with the budget they failed under and not entered again with as much or less. The first accepting path is the
answer: a cheaper one would have been found under a lower bound, an ASCII-lesser one earlier.
The estimate is the exact rest cost in a pattern that also accepts a lone system turn, one backward pass over the
rows; it never exceeds the true rest, and one or two bounds are enough, so time grows with the rows.

*Rows.* One shuffle by conversation, then rows stream in turn order (null turns first; equal turns by role and text)
through sorted partitions; a conversation's rows are never gathered by Spark. The search needs a few numbers a row. The
digest of the repaired rows is taken at once where texts held stay within ``HELD_BYTES``, and by a second sorted pass,
in which the edits come before their rows, for longer conversations. Solutions are kept per worker for letter sequences met again.

Null role, text, turn or id count as one space (an id or turn only in its spelling); a row whose role starts with
no known letter can be reroled or deleted. All rows with a null id are one conversation. Empty tables give no rows. Columns beside the
four named ones are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import worker_cache, written

WHITE = "\\x20\\x09-\\x0D"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
HELD_BYTES = 32 << 20  # texts of one conversation held until its edits are known
KEPT = 200_000  # letter sequences whose solution a worker keeps
KEPT_ROWS = 64  # longer sequences are not kept
ROLE = {"u": "user", "a": "assistant"}
FAULTS = ("blank", "duplicate", "truncated")

# Where the pattern stands: nothing yet, behind the system turn, behind an assistant, behind a user.
START, SYSTEM, REPLIED, ASKED = range(4)
ACCEPTS = (START, REPLIED)
# The letter that may come next (a system turn only by Keep, at the start) and where it leads.
NEXT = {START: ("u", ASKED), SYSTEM: ("u", ASKED), REPLIED: ("u", ASKED), ASKED: ("a", REPLIED)}

# A row's letter: its role initial (``x`` if unknown), upper case if truncated; ``-`` if it must go.
GONE = "-"


def _moves(letter: str, at: int) -> list[tuple[str, int, int, int]]:
    """Edits ``(initial, cost, rows used, where the pattern stands then)`` before or at a row, in ASCII order; an empty
    letter stands for the end."""
    want, then = NEXT[at]
    out = [("I", INSERT, 0, then)]
    if letter:
        out.append(("D", DELETE, 1, at))
    if letter and letter != GONE:
        role, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
        if role == want:
            out.append(("K", extra, 1, then))
        elif role == "s" and at == START:
            out.append(("K", extra, 1, SYSTEM))
        out.append(("R", REROLE + extra, 1, then))
    return sorted(out)


MOVES = {letter: [_moves(letter, at) for at in range(4)] for letter in ("", GONE, *"suaxSUAX")}


def estimate(letters: str) -> array:
    """Least cost of the rows from each place on, per place of the pattern (four numbers a row), if a lone system
    turn were a whole conversation."""
    out = array("q", bytes(32 * (len(letters) + 1)))
    rest = [0, 0, 0, INSERT]
    out[-4:] = array("q", rest)
    for i in range(len(letters) - 1, -1, -1):
        own = MOVES[letters[i]]
        here = [min(cost + rest[then] for _, cost, used, then in own[at] if used) for at in range(4)]
        for _ in range(2):  # inserted turns may come before the row
            here = [min(x, INSERT + here[NEXT[at][1]]) for at, x in enumerate(here)]
        out[4 * i : 4 * i + 4] = array("q", here)
        rest = here
    return out


def search(letters: str) -> tuple[int, str]:
    """``(cost, edits)`` of the cheapest, then ASCII-least repair of a sequence of row letters."""
    n = len(letters)
    left = estimate(letters)
    bound = left[START]
    while True:
        beyond = None
        failed: dict[int, int] = {}  # 4 * row + place: the budget it failed under
        path = bytearray()
        # the states on the path: 4 * row + place, cost so far, edits tried
        states, costs, tried = array("q", [START]), array("q", [0]), bytearray([0])
        while states:
            state, cost, k = states[-1], costs[-1], tried[-1]
            i, at = state >> 2, state & 3
            if i == n and at in ACCEPTS:
                return cost, path.decode()
            own = MOVES[letters[i] if i < n else ""][at]
            while k < len(own):
                edit, price, used, then = own[k]
                k += 1
                g, to = cost + price, state - at + 4 * used + then
                f = g + left[to]
                if f > bound:
                    beyond = f if beyond is None else min(beyond, f)
                elif failed.get(to, -1) < bound - g:
                    tried[-1] = k
                    path += edit.encode()
                    states.append(to)
                    costs.append(g)
                    tried.append(0)
                    break
            else:
                failed[state] = max(failed.get(state, -1), bound - cost)
                states.pop()
                costs.pop()
                tried.pop()
                if path:
                    path.pop()
        bound = beyond


def solved(letters: str) -> tuple[int, str]:
    """``search`` with the worker's memory of short sequences."""
    kept = worker_cache("conversation-repairs", dict)
    got = kept.get(letters)
    if got is None:
        got = search(letters)
        if len(letters) <= KEPT_ROWS and len(kept) < KEPT:
            kept[letters] = got
    return got


def repaired(edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The rows ``(role, text)`` after the edits."""
    at = START
    for e in edits:
        want, then = NEXT[at]
        if e == "I":
            yield ROLE[want], ""
            at = then
            continue
        role, text = next(rows)
        if e == "K":
            yield role, text
            at = SYSTEM if role[:1] == "s" and at == START else then
        elif e == "R":
            yield ROLE[want], text
            at = then


def digest(rows: Iterator[tuple[str, str]]) -> str:
    """Lower-case sha256 of ``role:text``, newline-joined, fed row by row."""
    h = hashlib.sha256()
    for k, (role, text) in enumerate(rows):
        h.update(f"{chr(10) * (k > 0)}{role}:{text}".encode("utf-8", "surrogatepass"))
    return h.hexdigest()


def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, there)`` with nulls of role and text as one space."""
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), _spaced(role).alias("role"), _spaced(text).alias("text"), F.lit(True).alias("there"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``turns`` with faults put in by ``crc32(conv:turn) % 20``: 0 drops the row (it stays, as not ``there``),
    1 empties the text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user."""
    k = F.crc32(F.concat(_spaced("conv"), F.lit(":"), _spaced("turn"))) % 20
    text = F.when(k <= 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(k == 3, 2).otherwise(1).cast("int")))
    out = rows.select("conv", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (k != 0).alias("there"), times.alias("copy"))
    return out.drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, with ``fault`` (blank, duplicate, truncated; the first that holds, else null)."""
    dealt = rows.repartition("conv")
    earlier = Window.partitionBy("conv", "there", "role", F.md5(F.encode("text", "UTF-8"))).orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(f"[^{WHITE}]"), "blank")
        .when(F.row_number().over(earlier) > 1, "duplicate")
        .when(~F.col("text").rlike(f"[.!?][{WHITE}]*\\z"), "truncated")
    )
    return dealt.withColumn("fault", F.when(F.col("there"), fault))


class Conversation:
    """One conversation's rows in order: figures and letters, and the rows while they are short enough to hold."""

    def __init__(self, conv, held_bytes: int):
        self.conv, self.held_bytes = conv, held_bytes
        self.letters = bytearray()
        self.n = dict.fromkeys(FAULTS, 0)
        self.illegal = self.distinct = 0
        self.least = self.most = self.initial = None
        self.rows: list[tuple[str, str]] | None = []
        self.size = 0

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.n[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.most:  # turns ascend
            self.distinct += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        letter = initial if initial in ("s", "u", "a") else "x"
        self.letters += (GONE if fault in ("blank", "duplicate") else letter.upper() if fault else letter).encode()
        if self.rows is not None:
            self.rows.append((role, text))
            self.size += len(text) + 64
            if self.size > self.held_bytes:
                self.rows = None

    def result(self) -> tuple:
        cost, edits = solved(self.letters.decode())
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        sha = None if self.rows is None else digest(repaired(edits, iter(self.rows)))
        return (self.conv, gaps, *(self.n[f] for f in FAULTS), self.illegal, cost, edits, sha)


COUNTS = ("gaps", *FAULTS, "illegal", "cost")


def repair(rows: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation in
    rows of ``turns`` (damaged or not)."""
    kind = dict(rows.dtypes)["conv"]
    judged_rows = judged(rows)
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    names = ["conv", *COUNTS, "audit", "repaired_sha256"]
    schema = f"conv {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string"

    def run(batches):
        now, out, conv_type = None, [], None

        def table():
            cols = list(zip(*out))
            types = [conv_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            conv_type = b.column(0).type
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                for conv, turn, role, text, there, fault in zip(*(c.to_pylist() for c in part.columns)):
                    if now is None or conv != now.conv:
                        if now is not None:
                            out.append(now.result())
                        now = Conversation(conv, held_bytes)
                    if there:
                        now.add(turn, role, text, fault)
                if len(out) >= 4096:
                    yield table()
                    out = []
        if now is not None:
            out.append(now.result())
            yield table()

    streamed = judged_rows.sortWithinPartitions(*order).select("conv", "turn", "role", "text", "there", "fault")
    done = written(streamed.mapInArrow(run, schema), "repairs")
    open_ = done.where("repaired_sha256 is null")
    if not open_.take(1):
        return done
    return done.where("repaired_sha256 is not null").unionByName(_long(rows, open_, order))


def _long(rows: DataFrame, open_: DataFrame, order: list[Column]) -> DataFrame:
    """The digests of conversations too long to hold: their edits, then their rows, stream through one sorted pass."""
    names = open_.columns
    longs = open_.select(F.col("conv").alias("c"))
    mine = rows.where("there").join(longs, F.col("conv").eqNullSafe(F.col("c")), "left_semi").select("conv", "turn", "role", "text")
    none = F.lit(None)
    head = open_.select("conv", none.cast("bigint").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.struct(*names).alias("head"))
    tail = mine.select("conv", F.col("turn").cast("bigint").alias("turn"), "role", "text", none.cast(head.schema["head"].dataType).alias("head"))
    dealt = head.unionByName(tail).repartition("conv").sortWithinPartitions(order[0], F.col("head").isNull(), *order[1:])

    def run(batches):
        state = iter((head, (role, text)) for b in batches for head, role, text in zip(*(b.column(k).to_pylist() for k in (4, 2, 3))))
        held = next(state, None)
        while held is not None:
            head = held[0]

            def own():
                nonlocal held
                for held in state:
                    if held[0] is not None:
                        return
                    yield held[1]
                held = None

            rest = own()
            sha = digest(repaired(head["audit"], rest))
            for _ in rest:  # rows behind the last edit: none
                pass
            yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": sha}], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(open_.schema)
    return dealt.select("conv", "turn", "role", "text", "head").mapInArrow(run, open_.schema)


def digests(df: DataFrame, conv: str = "conv_id", **names) -> DataFrame:
    """Damage, then repair: one row per conversation of ``df``."""
    return repair(damaged(turns(df, conv, **names))).withColumnRenamed("conv", conv)

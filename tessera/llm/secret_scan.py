"""Secret scans by assignment-aware lexing.

Source and configuration text is read as name-literal pairs (``name = "literal"``, ``name: literal``,
``"name" => 'a' + b``; a declared type between name and ``=`` is stepped over); constants are propagated through names assigned earlier in the text, and a
literal is a secret when the score of its target name and of the literal itself is high enough.
Three plain patterns (`assign`, `access`, `hex`) are always reported; the lexer adds `literal` spans.

Spans are code points, end exclusive. Null and empty texts have no spans. Every text is read whole.
Row-local: no shuffle; texts that cannot hold a span never reach Python.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
MASK = "<SECRET>"

ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
# A text without these holds no plain span and no name-literal pair.
CANDIDATE = "[:=]|AKIA|[0-9a-f]{16}"

# Parts of a target name that make its literal sensitive, and parts that say it is something about a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0,
    "authkey": 0.9, "signingkey": 1.0, "encryptionkey": 1.0, "clientsecret": 1.0, "connectionstring": 0.8,
}
ABOUT = {"count", "length", "len", "limit", "max", "min", "type", "name", "url", "uri", "path", "file", "id", "ttl", "expiry",
         "expires", "policy", "field", "hint", "label", "prompt", "regex", "pattern", "format", "enabled", "required"}
PLACEHOLDER = re.compile(r"(?i)^(?:x{4,}|\*{3,}|\.{3,}|changeme|change_me|example.*|your[-_ ]?.*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|none|null|true|false|todo.*|test|dummy.*|sample.*|placeholder.*|redacted)$")

OPERATOR = re.compile(r":=|=>|[=!<>]=+|::|=|:")
NAME = re.compile(r"[A-Za-z_$][\w$.\-]*")
NAME_PART = re.compile(r"[\w$.\-]")
DECLARE = {"var", "let", "const", "val"}
# A type of a declaration: names with dots, blanks only inside brackets or around | and &.
TYPE_PART = re.compile(r"[\w$.?!*&|]")
OPENS = {"]": "[", ")": "(", ">": "<", "}": "{"}
STRING = re.compile(r'''"""(.*?)"""|\'\'\'(.*?)\'\'\'|[bruf]?"((?:[^"\\\n]|\\.)*)"|[bruf]?'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`''', re.S)
BARE = re.compile(r"""[^\s"'`,;{}\[\]()<>#]+""")
JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)\s*")
BLANK = re.compile(r"[ \t]*")
THRESHOLD = 0.5
ENDS = 64  # characters of a constant's beginning and end that are kept


def name_score(name: str) -> float:
    """How surely a literal assigned to this name is a secret, 0 to 1."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    best = max([best, *(SENSITIVE.get(a + b, 0.0) for a, b in zip(parts, parts[1:]))])
    return best * 0.3 if parts and parts[-1] in ABOUT else best


class Literal:
    """What is known of a constant: a leaf is one literal of the text, any other a concatenation. Only a bounded description is
    kept (length, letter counts, both ends), so that a constant costs the same however long its value grows."""

    __slots__ = ("n", "counts", "head", "tail", "url", "at_sign", "span", "parts", "score")

    def __init__(self, value: str = "", span: tuple[int, int] | None = None, parts: tuple[Literal, ...] = ()):
        self.span, self.parts, self.score = span, parts, 0.0
        if parts:
            a, b = parts
            self.n, self.counts = a.n + b.n, a.counts + b.counts
            self.head = (a.head + b.head)[:ENDS] if a.n == len(a.head) else a.head
            self.tail = (a.tail + b.tail)[-ENDS:] if b.n == len(b.tail) else b.tail
            self.url, self.at_sign = a.url or b.url or "://" in a.tail[-2:] + b.head[:2], a.at_sign or b.at_sign
        else:
            self.n, self.counts, self.head, self.tail = len(value), Counter(value), value[:ENDS], value[-ENDS:]
            self.url, self.at_sign = "://" in value, "@" in value

    def placeholder(self) -> bool:
        if self.n <= ENDS:
            return bool(PLACEHOLDER.match(self.head))
        return bool(PLACEHOLDER.match(self.head + self.tail)) and (self.head[0] not in "xX*." or len(self.counts) == 1)

    def secrecy(self) -> float:
        """How much it looks like key material, 0 to 1: length, entropy, character classes."""
        if self.n < 8 or self.placeholder() or self.url and not self.at_sign:
            return 0.0
        if any(c.isspace() for c in self.counts):
            return 0.2
        entropy = -sum(c / self.n * math.log2(c / self.n) for c in self.counts.values())
        letters = "".join(self.counts)
        classes = sum(bool(re.search(p, letters)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
        return min(1.0, 0.35 * min(entropy / 3.0, 1.0) + 0.35 * min(self.n, 12) / 12 + 0.15 * classes)

    def report(self, score: float) -> list[tuple[int, int]]:
        """Spans of its literals that no score as high has reached before; every constant is entered once per rise."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.score >= score:
                continue
            x.score = score
            if x.span:
                out.append(x.span)
            todo += x.parts
        return out


def literal_score(value: str) -> float:
    """How much a literal looks like key material, 0 to 1."""
    return Literal(value).secrecy()


def _operand(text: str, at: int, env: dict[str, Literal]) -> tuple[Literal, int, str] | None:
    """One operand at ``at``: (literal, end, the name it was read from, if any) or None."""
    m = STRING.match(text, at)
    if m:
        g = m.lastindex
        return Literal(m[g], m.span(g)), m.end(), ""
    m = BARE.match(text, at)
    if not m:
        return None
    word = m[0].rstrip(".:")
    end = at + len(word)
    if word in env:
        return env[word], end, word
    return (Literal(word, (at, end)), end, "") if word else None


def _back(text: str, at: int, chars: str = " \t") -> int:
    """Where the run of ``chars`` that ends at ``at`` starts."""
    while at and text[at - 1] in chars:
        at -= 1
    return at


def _name_before(text: str, end: int) -> tuple[str, int] | None:
    """The name that ends at ``end``, blanks, a bracket and a quote aside, and where it starts."""
    at = _back(text, end)
    if at and text[at - 1] == "]":
        at = _back(text, at - 1, " \t\r\n")
    elif (line := _back(text, end, " \t\r\n")) and text[line - 1] == "]":
        at = _back(text, line - 1, " \t\r\n")
    if at and text[at - 1] in "\"'`":
        at -= 1
    start = at
    while start and NAME_PART.match(text, start - 1):
        start -= 1
    m = NAME.search(text, start, at)
    return (m[0], m.start()) if m else None


def _type_start(text: str, end: int) -> int | None:
    """Where the type that ends at ``end`` starts: on one line, brackets balanced."""
    at, closed = _back(text, end), []
    stop = at
    while at:
        c = text[at - 1]
        if c in "\n=;":
            break
        if c in OPENS:
            closed.append(OPENS[c])
        elif closed and c == closed[-1]:
            closed.pop()
        elif not closed and not TYPE_PART.match(c) and text[max(0, at - 2) : at] != "&'":
            before = word = _back(text, at)
            while word and text[word - 1].isalnum():
                word -= 1
            borrowed = text[max(0, word - 2) : word] == "&'" or text[max(0, word - 1) : before] == "&mut"
            if before == at or not before or not (borrowed or text[before - 1] in "|&" or at < stop and text[at] in "|&"):
                break
            at = before
            continue
        at -= 1
    return at if at < stop and not closed else None


def _declared(text: str, end: int) -> tuple[str, int] | None:
    """The name of ``name : type`` or, after var, let, const or val, ``name type`` that ends at ``end``, and where
    the colon or the type stands."""
    at = _type_start(text, end)
    if at is None:
        return None
    colon = _back(text, at)
    if colon and text[colon - 1] == ":" and text[colon - 2 : colon - 1] != ":":
        left = _name_before(text, colon - 1 - (text[colon - 2 : colon - 1] in ("?", "!")))
        return (left[0], colon - 1) if left else None
    left = _name_before(text, at) if colon < at else None
    if left and left[0] not in DECLARE:
        word = _name_before(text, left[1])
        if word and word[0] in DECLARE and _back(text, left[1]) < left[1]:
            return left[0], at
    return None


def literal_spans(text: str) -> list[tuple[int, int, float]]:
    """Spans of literals that reach a sensitive name, with their scores; constants are propagated."""
    env: dict[str, Literal] = {}
    found: dict[tuple[int, int], float] = {}
    after: dict[int, list] = {}  # bare words found behind a colon
    for op in OPERATOR.finditer(text):
        if op[0] not in (":=", "=>", "=", ":"):
            continue
        at = BLANK.match(text, op.end()).end()
        if op[0] == ":" and text.startswith("//", op.end()):
            continue
        left, typed = _name_before(text, op.start()), _declared(text, op.start()) if op[0] == "=" else None
        names = [n[0] for n in (left, typed) if n]  # ``auth: token=...`` may be read either way
        if not names:
            continue
        got = _operand(text, at, env)
        if not got:
            continue
        value, end, read = got
        used = {read}
        while (j := JOIN.match(text, end)) and j.end() < len(text):
            more = _operand(text, j.end(), env)
            if not more:
                break
            value, end = Literal(parts=(value, more[0])), more[1]
            used.add(more[2])
        if text.startswith("(", end):  # a call: its result is not a literal
            continue
        for n in names:  # a name in its own right side is no constant
            if n in used:
                env.pop(n, None)
            else:
                env[n] = value
        for s in after.pop(typed[1], ()) if typed else ():
            if s[1] <= op.start():
                found.pop(s, None)  # a type, no literal
        score = max(map(name_score, names)) * value.secrecy()
        if score >= THRESHOLD:
            spans = value.report(score)
            if op[0] == ":":
                after[op.start()] = [s for s in spans if s[0] >= at and s not in found and text[s[0] - 1] not in "\"'`"]
            for s in spans:
                found[s] = max(score, found.get(s, 0.0))
    return sorted((a, b, s) for (a, b), s in found.items() if b > a)


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans ``(kind, start, end, score)`` of a whole text by start, then kind."""
    if not text:
        return []
    out = [("assign", m.start(), m.end(), 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [("access", m.start(), m.end(), 1.0) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), 1.0) for m in HEX.finditer(text)]
    base = out[:]
    out += [("literal", a, b, s) for a, b, s in literal_spans(text) if not any(x <= a and b <= y for _, x, y, _ in base)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_digest(spans: list) -> str:
    """Lower-case sha256 of the plain spans as ``kind:start:end``, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans if k != "literal").encode()).hexdigest()


def redacted(text: str | None) -> str | None:
    """The text with every span (overlaps merged) replaced by ``MASK``."""
    spans = spans_of(text)
    if not spans:
        return text
    out, last, stop = [], 0, 0
    for _, a, b, _ in spans:
        if a >= stop:
            out += [text[last:a], MASK]
        stop = max(stop, b)
        last = stop
    return "".join(out) + text[last:]


def _may_hold(text: Column) -> Column:
    return F.when(text.rlike(CANDIDATE), text)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, base_sha256, spans, secrets)``, one row per input row.

    ``secrets`` is the list of (kind, start, end, score). Other input columns are ignored, so their
    names cannot clash. Repeated rows give repeated results.
    """
    src = df.select(F.col(key), _may_hold(F.col(text)).alias("_text"))
    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, secrets array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for b in batches:
            found = [spans_of(t) for t in b.column(1).to_pylist()]
            n = [Counter(s[0] for s in f) for f in found]
            cols = [pa.array([c[k] for c in n], pa.int64()) for k in KINDS[:3]]
            cols.append(pa.array([base_digest(f) if f else empty for f in found]))
            cols.append(pa.array([",".join(f"{k}:{x}:{y}" for k, x, y, _ in f) for f in found]))
            cols.append(pa.array([[{"kind": k, "start": x, "end": y, "score": s} for k, x, y, s in f] for f in found], pa.list_(item)))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "secrets"])

    return src.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked; ``n_chars`` (if present) follows the new text."""
    cols = df.columns
    mark = "_scan"
    while mark in cols:
        mark += "_"
    src = df.select(*[F.col(f"`{c}`") for c in cols], F.when(F.col(text).rlike(CANDIDATE), F.lit(True)).alias(mark))
    out = src.drop(mark)
    flag = len(cols)
    at = cols.index(text)

    def run(batches):
        for b in batches:
            arrays = [b.column(i) for i in range(flag)]
            hot = b.column(flag).to_pylist()
            if any(hot):
                texts = arrays[at].to_pylist()
                arrays[at] = pa.array([redacted(t) if h else t for t, h in zip(texts, hot)], arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    out = src.mapInArrow(run, out.schema)
    return out.withColumn(n_chars, F.length(text).cast(dict(df.dtypes)[n_chars])) if n_chars in cols else out

"""Toxicity by a weighted finite-state pattern grammar.

Words become labels (insult, threat, target, negation, report, other); small transducers are composed
over each clause: the negation transducers turn an insult within their scope into a negated one and drop a
threat, the reported-speech transducer marks what follows a verb of saying up to the clause end, and the
target transducers, one reading each way, mark insults and threats close to a person. Threat verbs count in
their inflected forms (English, German, French, Spanish), with the target before, behind or joined to them. What the composition accepts is a matched clause
of one kind (plain, targeted, negated, reported, threat); a text's score is a logistic function of its
matched clauses, never of isolated words.

Learned from labelled rows: the insult patterns (whole words and word beginnings that hold for toxic
texts, by the likelihood ratio) and the weight of each clause kind. At most ``max_labelled`` labelled
rows (those with the smallest hash) are used, near copies of one text count once, and rows with
``crc32(id) % 4 = 2`` are never learned from. Only the text enters a score.

Null and empty texts match nothing and get the base score. Long texts are read whole. Row-local: no
shuffle beyond the bounded fit.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_once, written
from tessera.llm.quality import window_hashes, words_of

MAX_LABELLED = 20_000
MAX_PATTERNS = 3_000
CUT = 0.3
KINDS = ("plain", "targeted", "negated", "reported", "threat")

# Seed words, per class; the labels add to the insults.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "worthless", "pathetic", "disgusting", "imbecile",
           "dumbass", "bastard", "asshole", "bitch", "retard", "vermin", "dummkopf", "arschloch", "abschaum", "connard", "salaud",
           "imbécile", "ordure", "estúpido", "imbécil", "basura", "gilipollas", "cabrón"]
THREATS = ["kill", "kills", "killed", "killing", "murder", "murders", "murdered", "murdering", "strangle", "strangles", "strangled", "strangling",
           "stab", "stabs", "stabbed", "stabbing", "massacre", "massacres", "massacred", "massacring", "massacrer", "massacrerai",
           "umbringen", "umbringe", "umbringst", "umbringt", "umzubringen", "umgebracht", "umbrachte", "umbrachten",
           "töten", "töte", "tötest", "tötet", "tötete", "töteten", "getötet", "tuer", "tue", "tues", "tuons", "tuez", "tuent", "tué",
           "tuée", "tués", "tuées", "tuant", "tuerai", "tueras", "tuera", "tuerons", "tuerez", "tueront", "tuerais", "tuerait", "tuait",
           "matar", "mato", "matas", "mata", "matamos", "matan", "maté", "mataste", "mató", "mataron", "matado", "matando", "mataré",
           "matarás", "matará", "mataremos", "matarán", "mataría"]
# Spanish verb and target in one word; German verbs whose particle "um" ends the clause.
JOINED = [v + t for v in ("matar", "matándo") for t in ("te", "os", "lo", "la", "los", "las", "le", "les")]
PARTED = ["bringe", "bringst", "bringt", "bringen", "brachte", "brachten"]
TARGETS = ["you", "your", "he", "she", "him", "her", "they", "them", "these", "those", "people", "du", "dich", "ihr", "sie", "tu", "toi", "vous", "ils", "usted", "ustedes", "ellos", "tú", "te", "euch"]
NEGATIONS = ["not", "never", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "tampoco"]
CLOSING = ["nicht", "pas"]  # these negate from the clause end too
# Words that deny a threat behind them, up to the next speaker ("no, I will ..." denies nothing).
DENIALS = ["no", "ne", "won't", "wouldn't", "didn't", "doesn't", "can't", "couldn't", "cannot"]
SPEAKERS = ["i", "i'll", "i'm", "we", "we'll", "ich", "wir", "je", "nous", "yo", "nosotros"]
REPORTS = ["said", "says", "called", "wrote", "claimed", "reported", "quoted", "sagte", "nannte", "dit", "déclaré", "écrit", "dijo", "llamó"]

SEED_WEIGHT = 4.0
PRIOR = {"bias": -3.5, "plain": 5.0, "targeted": 5.5, "negated": 2.0, "reported": 3.0, "threat": 4.0}
CLAUSE_END = re.compile(r"[.!?;\n]")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
NEGATION_SCOPE = 3
TARGET_SCOPE = 4


class Transducer:
    """A deterministic weighted transducer over labels: ``arcs[state, label] = (next, output, weight)``;
    a missing arc copies the label and falls back to ``arcs[state, None]``."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def run(self, labels: list[tuple[str, float]]) -> list[tuple[str, float]]:
        state, out = 0, []
        for label, w in labels:
            to, made, factor = self.arcs.get((state, label)) or self.arcs.get((state, None)) or (state, None, 1.0)
            out.append((made or label, w * factor))
            state = to
        return out


def closing() -> Transducer:
    """Reads right to left: the last word of a clause, a parted verb's particle or a negation of every threat."""
    return Transducer({(0, "U"): (1, "F", 1.0), (0, "C"): (2, "C", 1.0), (0, None): (1, None, 1.0), (2, "T"): (2, "o", 0.0), (2, "TY"): (2, "o", 0.0)})


def parted() -> Transducer:
    """A parted verb is a threat at its particle."""
    return Transducer({(0, "B"): (1, "B", 1.0), (1, "F"): (0, "T", 1.0)})


def denied() -> Transducer:
    arcs = {}
    for s in range(TARGET_SCOPE + 1):
        arcs[s, "D"] = (TARGET_SCOPE, "D", 1.0)
        if s:
            arcs[s, "S"] = (0, "S", 1.0)
            arcs[s, "T"] = arcs[s, "TY"] = (0, "o", 0.0)
            arcs[s, None] = (s - 1, None, 1.0)
    return Transducer(arcs)


def negation() -> Transducer:
    arcs = {}
    for s in range(NEGATION_SCOPE + 1):
        arcs[s, "N"] = arcs[s, "C"] = (NEGATION_SCOPE, "N", 1.0)
        if s:
            arcs[s, "I"] = (0, "negated", 1.0)
            arcs[s, "T"] = arcs[s, "TY"] = (0, "o", 0.0)
            arcs[s, None] = (s - 1, None, 1.0)
    return Transducer(arcs)


def reported() -> Transducer:
    return Transducer({(0, "R"): (1, "R", 1.0), (1, "I"): (1, "reported", 1.0), (1, "T"): (1, "o", 0.0), (1, "TY"): (1, "o", 0.0)})


def target() -> Transducer:
    """An insult or threat at most ``TARGET_SCOPE`` words after a target, in the direction read; what has
    none stays plain or a bare threat, which the other direction may still mark."""
    arcs = {}
    for s in range(TARGET_SCOPE + 1):
        arcs[s, "Y"] = (TARGET_SCOPE, "Y", 1.0)
        arcs[s, "I"] = arcs[s, "plain"] = (max(s - 1, 0), "targeted" if s else "plain", 1.0)
        arcs[s, "T"] = (max(s - 1, 0), "threat" if s else "T", 1.0)
        arcs[s, "TY"] = (max(s - 1, 0), "threat", 1.0)
        if s:
            arcs[s, None] = (s - 1, None, 1.0)
    return Transducer(arcs)


@dataclass
class Grammar:
    """Insult patterns (``=word`` or ``begin*``) with weights, and the clause-kind weights."""

    patterns: dict[str, float] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=lambda: dict(PRIOR))


class Matcher:
    """Finds the clauses of a text that the composed grammar accepts."""

    def __init__(self, patterns: dict[str, float]):
        import ahocorasick

        self.words = {p[1:]: w for p, w in patterns.items() if p[0] == "="}
        self.begins = {p[:-1]: w for p, w in patterns.items() if p[-1] == "*"}
        self.lengths = sorted({len(p) for p in self.begins})
        self.machine = ahocorasick.Automaton()
        for k in {*self.words, *self.begins, *THREATS, *JOINED, *PARTED}:
            self.machine.add_word(k, len(k))
        self.machine.make_automaton()
        self.fixed = {w: c for c, ws in (
            ("S", SPEAKERS), ("T", THREATS), ("TY", JOINED), ("B", PARTED), ("U", ["um"]), ("Y", TARGETS), ("N", NEGATIONS), ("C", CLOSING), ("D", DENIALS), ("R", REPORTS),
        ) for w in ws}
        # transducer and the direction it reads in
        self.chain = ((closing(), -1), (parted(), 1), (denied(), 1), (negation(), 1), (reported(), 1), (target(), 1), (target(), -1))

    def insult(self, word: str) -> float:
        """Weight of the pattern that a whole word matches; 0 for none."""
        w = self.words.get(word, 0.0)
        for n in self.lengths:
            if n > len(word):
                break
            w = max(w, self.begins.get(word[:n], 0.0))
        return w

    def label(self, word: str) -> tuple[str, float]:
        w = self.insult(word)
        return ("I", w) if w else (self.fixed.get(word, "o"), SEED_WEIGHT)

    def clause(self, text: str) -> list[tuple[str, float]]:
        out = [self.label(m) for m in WORD.findall(text)]
        for t, way in self.chain:
            out = t.run(out[::way])[::way]
        return [(k, w) for k, w in out if k in KINDS]

    def features(self, text: str | None) -> list[float]:
        """Per clause kind the damped sum of the weights of its matched clauses."""
        total = dict.fromkeys(KINDS, 0.0)
        if text:
            low = text.lower()
            done = -1
            for end, n in self.machine.iter(low):
                at = end - n + 1
                if at <= done or at and low[at - 1].isalnum():
                    continue
                floor = done + 1  # no clause starts before the last one's end
                start = max(floor, *(low.rfind(c, floor, at) + 1 for c in ".!?;\n"))
                stop = CLAUSE_END.search(low, at)
                done = stop.start() if stop else len(low)
                for kind, w in self.clause(low[start:done]):
                    total[kind] += min(w, 6.0) / 6.0
        return [math.log1p(2.0 * total[k]) for k in KINDS]


def held_out(key: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_labelled: int) -> DataFrame:
    """``(_text, _label)`` of at most ``max_labelled`` labelled rows that are not held out; of near copies
    (same smallest or largest window hash) one stays."""
    own = labelled_once(labels.select(F.col(key).alias("_k"), F.col(label).alias("_label")).where(~held_out(F.col("_k"))), "_k", "_label")
    own = own.orderBy(F.xxhash64("_k"), "_k").limit(max_labelled)
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_text")).where(~held_out(F.col("_k"))).join(F.broadcast(own), "_k")
    # step by step, so that the lambdas read finished arrays
    rows = rows.withColumn("_w", words_of(F.col("_text"))).withColumn("_h", window_hashes(F.col("_w")))
    whole = F.xxhash64("_text")
    rows = rows.select("_k", "_text", "_label", F.coalesce(F.array_min("_h"), whole).alias("_a"), F.coalesce(F.array_max("_h"), whole).alias("_b"))
    # of each group the row of the least (text hash, key), whatever order the rows arrive in
    for group in ("_a", "_b"):
        least = F.min_by(F.struct("_k", "_text", "_label", "_a", "_b"), F.struct(F.xxhash64("_text"), F.col("_k").cast("string"), "_label"))
        rows = rows.groupBy(F.col(group).alias("_g")).agg(least.alias("_r")).select("_r.*")
    return rows.select("_text", "_label")


def learn_patterns(rows: DataFrame, max_patterns: int = MAX_PATTERNS) -> dict[str, float]:
    """Whole words and word beginnings that tell toxic texts: likelihood ratio against the share of toxic
    texts, at least 60 % of their texts toxic; the strongest ``max_patterns`` come to the driver."""
    n, n_tox = rows.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    found = {f"={w}": SEED_WEIGHT for w in INSULTS}
    if not n_tox or n_tox == n:
        return found
    # distinct per text, so that no text counts twice for a beginning
    words = rows.select("_label", F.array_distinct(F.split(F.lower("_text"), "[^\\p{L}\\p{N}]+")).alias("w"))
    words = words.withColumn("w", F.filter("w", lambda w: F.length(w).between(3, 40)))
    begins = [F.transform(F.filter("w", lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.substr(w, F.lit(1), F.lit(k)), F.lit("*"))) for k in range(4, 9)]
    marks = F.array_distinct(F.concat(F.transform("w", lambda w: F.concat(F.lit("="), w)), *begins))
    patterns = words.select(F.explode(marks).alias("p"), "_label").groupBy("p").agg(F.sum("_label").alias("tox"), F.count("*").alias("n"))
    base = n_tox / n
    a, b = F.col("tox"), F.col("n") - F.col("tox")
    g2 = 2 * (a * F.log(a / F.col("n") / base) + F.when(b > 0, b * F.log(b / F.col("n") / (1 - base))).otherwise(0.0))
    strong = patterns.where((a >= 3) & (a >= 0.6 * F.col("n"))).withColumn("g2", g2).where("g2 >= 22")
    rows = strong.orderBy(F.desc("g2"), "p").limit(max_patterns).collect()
    weight = {r["p"]: math.log((r["tox"] + 0.5) / n_tox) - math.log((r["n"] - r["tox"] + 0.5) / (n - n_tox)) for r in rows}
    for p in sorted(weight, key=lambda p: (len(p), p)):
        shorter = [f"{p[1 : k + 1] if p[0] == '=' else p[:k]}*" for k in range(4, len(p) - 1)]
        if weight[p] > max([1.0, *(found.get(q, 0.0) + 0.5 for q in shorter)]):
            found[p] = weight[p]
    return found


def feature_frame(df: DataFrame, patterns: dict[str, float], keep: list[str], text: str) -> DataFrame:
    """The ``keep`` columns and ``_x``, the clause-kind features of ``text``."""
    src = df.select(*keep, F.col(text).alias("_in"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", _x array<double>"

    def run(batches):
        matcher = Matcher(patterns)
        for b in batches:
            x = [matcher.features(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(x, pa.list_(pa.float64()))], names=[*keep, "_x"])

    return src.mapInArrow(run, schema)


def fit_weights(x: np.ndarray, y: np.ndarray, strength: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, with a Gaussian prior around the odds that ``PRIOR`` gives no clause
    and one clause of each kind: a kind that no labelled text holds keeps its odds when the bias moves."""
    prior = np.array([PRIOR["bias"], *(PRIOR[k] for k in KINDS)])
    tie = np.eye(len(prior))
    tie[1:, 0] = 1 / math.log1p(2.0 * SEED_WEIGHT / 6.0)
    pull = strength * tie.T @ tie
    x = np.hstack([np.ones((len(x), 1)), x])
    w = prior.copy()
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull @ (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:1], np.maximum(w[1:], 0.0)])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_labelled: int = MAX_LABELLED) -> Grammar:
    """The grammar learned from the labelled rows that are not held out."""
    rows = written(training_rows(docs, labels, key, text, label, max_labelled), "toxic-rows")
    patterns = learn_patterns(rows)
    got = feature_frame(rows, patterns, ["_label"], "_text").collect()  # at most max_labelled rows
    x = np.array([r["_x"] for r in got], float).reshape(len(got), len(KINDS))
    w = fit_weights(x, np.array([r["_label"] for r in got], float))
    return Grammar(patterns, dict(zip(("bias", *KINDS), map(float, w))))


def score(df: DataFrame, grammar: Grammar, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``score`` (0 to 1), one row per input row; other columns are ignored."""
    x = feature_frame(df, grammar.patterns, keep, text)
    z = F.lit(grammar.weights["bias"])
    for i, k in enumerate(KINDS):
        z = z + grammar.weights[k] * F.get("_x", F.lit(i))
    return x.select(*keep, (1 / (1 + F.exp(-z))).alias("score"))

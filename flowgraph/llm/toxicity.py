"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses at sentence and clause marks and line feeds. A lexicon maps each word of a clause to the symbols it
may stand for, with a weight. Five small transducers (`Transducer`: states, arcs with input, output and weight) read these
symbols one after the other and are composed into one machine (`compose`):

  negation   marks the insults and threats after a negation,
  report     marks the unmarked ones after a reporting word,
  target     marks the unmarked insults after a target,
  threat     turns a threat word into a threat when a target follows, or an object form stands before it ('te voy a matar'),
  choice     picks one match of the clause and ends in a state of its pattern.

The final weight of a pattern's state is how toxic clauses of this pattern are. A clause weighs as much as its best accepting
path (a product of weights), the score of a text is 1 - product of (1 - weight)
over its matched clauses; without a match it is the share of toxic texts among training texts without a match. Words that are
insults only when aimed at someone ('clown', 'dumb') have a symbol of their own.

What is learned, from a bounded sample of labelled training rows (`sample` rows in the order of a hash of the id): insults, as
words or word beginnings of 4 and 5 letters ('lexicon'), if they occur in toxic texts far more often than chance allows for
so many candidates (at most `candidates` are looked at, the most frequent ones); the toxicity of every pattern. A short fixed
list of insults, threats, targets, negations and reporting words comes on top. Only texts and their labels of the training
rows are read for that; ids, languages and sources are never inputs.

Defined cases: a null or empty text has no match; a null label or a label without a text is not used; of several labels of one
id the largest counts; without toxic labels the fixed lists and priors remain; repeated rows are scored one by one; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
CANDIDATES = 50_000
LEAST = 3
THRESHOLD = 0.3

INSULTS = frozenset("idiot moron stupid loser scum worthless pathetic disgusting imbecile filthy vermin bastard jerk".split())
#: Words with a harmless meaning as well; an insult when a target stands before them.
DOUBTFUL = frozenset("clown dumb fool trash".split())
THREATS = frozenset("kill hurt destroy beat stab shoot murder strangle crush burn töten umbringen schlagen tuer frapper detruire matar golpear destruir".split())
TARGETS = frozenset("you your yours yourself u he she him her they them du dich dir dein ihr euch sie tu toi te vous ton tú ti usted ustedes ellos".split())
#: Targets that can only be the object of a verb; they may stand before a threat.
OBJECTS = frozenset("dich dir euch te vous".split())
NEGATIONS = frozenset("not never no neither nor isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais nunca jamás".split())
REPORTS = frozenset("said says say called calls wrote writes quoted claims claimed reported sagte schrieb nannte dit écrit appelle dijo escribió llamó".split())

#: How toxic a clause of each pattern is before anything is learned, and how many clauses that belief is worth.
PRIORS = {"insult": 0.8, "target insult": 0.95, "negated insult": 0.3, "reported insult": 0.4, "doubtful insult": 0.2, "threat": 0.6, "negated threat": 0.1, "reported threat": 0.2}
BELIEF = 5.0
SURE = 0.9

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.,;:!?\n()\"«»“”]+")


@dataclass(frozen=True)
class Transducer:
    """arcs[state][symbol] = [(output, weight, next state)]. A symbol without an arc passes unchanged with weight 1."""

    start: object
    arcs: dict
    final: frozenset

    def step(self, state, symbol) -> list[tuple]:
        return self.arcs.get(state, {}).get(symbol) or [(symbol, 1.0, state)]


def compose(first: Transducer, second: Transducer, symbols) -> Transducer:
    """The transducer that gives what `second` makes of the outputs of `first`, over the inputs `symbols`. Only states that can
    be reached are made; their number does not depend on any text."""
    start = (first.start, second.start)
    arcs: dict = {}
    todo = [start]
    while todo:
        state = todo.pop()
        if state in arcs:
            continue
        arcs[state] = {}
        for symbol in symbols:
            arcs[state][symbol] = [
                (out, v * w, (p, q)) for mid, v, p in first.step(state[0], symbol) for out, w, q in second.step(state[1], mid)
            ]
            todo += [to for _, _, to in arcs[state][symbol]]
    return Transducer(start, arcs, frozenset(s for s in arcs if s[0] in first.final and s[1] in second.final))


#: What the lexicon may say of a word; every other word changes no state and is left out.
SYMBOLS = ("insult", "doubt", "target", "object", "negation", "report", "threat word")


def negation() -> Transducer:
    marked = {"insult": [("negated insult", 1.0, "plain")], "doubt": [("negated insult", 1.0, "plain")], "threat word": [("negated threat word", 1.0, "plain")]}
    return Transducer("plain", {"plain": {"negation": [("other", 1.0, "negated")]}, "negated": {**marked, "negation": [("other", 1.0, "negated")]}}, frozenset({"plain", "negated"}))


def report() -> Transducer:
    marked = {"insult": [("reported insult", 1.0, "reported")], "doubt": [("reported insult", 1.0, "reported")], "threat word": [("reported threat word", 1.0, "reported")]}
    heard = {"report": [("other", 1.0, "reported")]}
    return Transducer("plain", {"plain": heard, "reported": {**marked, **heard}}, frozenset({"plain", "reported"}))


def target() -> Transducer:
    seen = {c: [(c, 1.0, "aimed")] for c in ("target", "object")}
    aimed = {**seen, "insult": [("target insult", 1.0, "aimed")], "doubt": [("target insult", 1.0, "aimed")]}
    return Transducer("plain", {"plain": {**seen, "doubt": [("doubtful insult", 1.0, "plain")]}, "aimed": aimed}, frozenset({"plain", "aimed"}))


def threat() -> Transducer:
    """A threat word waits for a target; after an object form it is a threat at once."""
    kinds = ("", "negated ", "reported ")
    waiting = {f"{k}threat word": [("other", 1.0, f"{k}threat")] for k in kinds}
    arcs = {
        "plain": {**waiting, "object": [("other", 1.0, "object")], "target": [("other", 1.0, "plain")]},
        "object": {**{f"{k}threat word": [(f"{k}threat", 1.0, "object")] for k in kinds}, "object": [("other", 1.0, "object")], "target": [("other", 1.0, "object")]},
    }
    for k in kinds:
        arcs[f"{k}threat"] = {**waiting, "target": [(f"{k}threat", 1.0, "plain")], "object": [(f"{k}threat", 1.0, "object")]}
    return Transducer("plain", arcs, frozenset(arcs))


def choice() -> Transducer:
    """Picks one match of the clause and remembers its pattern; all others are skipped at no cost. A threat is as sure as SURE."""
    kinds = tuple(PRIORS)
    pick = {k: [(k, SURE if k.endswith("threat") else 1.0, k), ("other", 1.0, "open")] for k in kinds}
    picked = {k: {other: [("other", 1.0, k)] for other in kinds} for k in kinds}
    return Transducer("open", {"open": pick, **picked}, frozenset(kinds))


def cascade() -> list[Transducer]:
    return [negation(), report(), target(), threat(), choice()]


@cache
def machine() -> Transducer:
    """The composed grammar; the second part of a final state names the pattern."""
    whole, *rest = cascade()
    for part in rest:
        whole = compose(whole, part, SYMBOLS)
    return whole


@dataclass
class Grammar:
    """Insults with their certainty, beginnings of insults, how toxic patterns are, and the score without a match."""

    insults: dict[str, float] = field(default_factory=lambda: {w: SURE for w in INSULTS})
    stems: dict[str, float] = field(default_factory=dict)
    patterns: dict[str, float] = field(default_factory=lambda: dict(PRIORS))
    base: float = 0.02
    known: dict[str, tuple] = field(default_factory=dict)

    def insult(self, word: str) -> float:
        """Certainty that a word is an insult, 0 if it is none."""
        long4 = self.stems.get(word[:4], 0.0) if len(word) >= 4 else 0.0
        long5 = self.stems.get(word[:5], 0.0) if len(word) >= 5 else 0.0
        return max(self.insults.get(word, 0.0), long4, long5)

    def readings(self, word: str) -> tuple[tuple[str, float], ...]:
        """What a word may stand for: (symbol, weight). A word in several lists has several readings."""
        found = self.known.get(word)
        if found is None:
            sure = self.insult(word)
            reads = [("insult", sure)] if sure else [("doubt", SURE)] if word in DOUBTFUL else []
            if word in THREATS:
                reads.append(("threat word", 1.0))
            if word in OBJECTS:
                reads.append(("object", 1.0))
            elif word in TARGETS:
                reads.append(("target", 1.0))
            if word in NEGATIONS:
                reads.append(("negation", 1.0))
            if word in REPORTS:
                reads.append(("report", 1.0))
            found = tuple(reads)
            if len(self.known) < 500_000:
                self.known[word] = found
        return found

    def clause(self, tokens: list[str]) -> list[tuple[str, float]]:
        """The patterns (pattern, certainty) of one clause, each by its best path."""
        whole = machine()
        best: dict[tuple, float] = {whole.start: 1.0}
        for word in tokens:
            reads = self.readings(word)
            if not reads:
                continue
            ahead: dict[tuple, float] = {}
            for state, weight in best.items():
                for symbol, sure in reads:
                    for out, w, to in whole.arcs[state][symbol]:
                        # The certainty of a word counts on the path that picks its match.
                        value = weight * w * (sure if out in PRIORS else 1.0)
                        if value > ahead.get(to, 0.0):
                            ahead[to] = value
            best = ahead
        found: dict[str, float] = {}
        for state, weight in best.items():
            if state in whole.final:
                found[state[1]] = max(weight, found.get(state[1], 0.0))
        return sorted(found.items())

    def matches(self, text: str) -> list[list[tuple[str, float]]]:
        """The matches of every clause that has some."""
        lowered = text.lower()
        if not any(s in _MATCHABLE for word in set(_WORD.findall(lowered)) for s, _ in self.readings(word)):
            return []
        found = []
        for part in _CLAUSE.split(lowered):
            tokens = [word for word in _WORD.findall(part) if self.readings(word)]
            if any(s in _MATCHABLE for word in tokens for s, _ in self.readings(word)):
                found.append(self.clause(tokens))
        return [m for m in found if m]

    def rated(self, text: str | None) -> tuple[float, int]:
        """Score of a text, and how many of its clauses match."""
        clean = 1.0
        found = self.matches(text or "")
        for clause in found:
            clean *= 1 - max(self.patterns[kind] * sure for kind, sure in clause)
        return (max(self.base, 1 - clean) if found else self.base), len(found)

    def score(self, text: str | None) -> float:
        return self.rated(text)[0]


_MATCHABLE = frozenset({"insult", "doubt", "threat word"})


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic: the texts of at most `sample` labelled ids."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic").where("text is not null")


def _units(text: str) -> set[str]:
    """Words and word beginnings ('abcd*') of a text."""
    found = set(_WORD.findall(text.lower()))
    return found | {w[:4] + "*" for w in found if len(w) >= 4} | {w[:5] + "*" for w in found if len(w) >= 5}


def _counted(texts: DataFrame, wanted: set[str] | None) -> DataFrame:
    """unit, n: in how many texts it occurs."""

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                units = _units(text)
                for unit in units if wanted is None else units & wanted:
                    counts[unit] = counts.get(unit, 0) + 1
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["unit", "n"])

    return texts.select("text").mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, candidates: int = CANDIDATES) -> Grammar:
    """A grammar fitted on labelled rows."""
    texts = _labelled(docs, labels, sample).persist()
    try:
        return _fitted(texts, candidates)
    finally:
        texts.unpersist()


def _fitted(texts: DataFrame, candidates: int) -> Grammar:
    grammar = Grammar()
    totals = dict(texts.groupBy("toxic").count().collect())
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return grammar
    toxic, clean = texts.where("toxic = 1"), texts.where("toxic = 0")
    frequent = _counted(toxic, None).where(F.col("n") >= LEAST).orderBy(F.desc("n"), "unit").limit(candidates)
    in_toxic = dict(frequent.collect())  # at most `candidates` rows
    in_clean = dict(_counted(clean, set(in_toxic)).collect())
    rate = math.log((n_toxic + n_clean) / n_toxic)
    for unit, n in in_toxic.items():
        m = in_clean.get(unit, 0)
        # chance: n of the n + m texts with this unit are toxic ones
        if n >= 9 * m and (n - 4 * m) * rate > math.log(len(in_toxic)) + 1:
            sure = (n + 0.5) / (n + m + 1)
            if unit.endswith("*"):
                grammar.stems[unit[:-1]] = sure
            else:
                grammar.insults[unit] = max(sure, grammar.insults.get(unit, 0.0))

    def run(batches):
        counts: dict[tuple[str, int], int] = {}
        for batch in batches:
            for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {kind for clause in grammar.matches(text) for kind, _ in clause} or {""}
                for kind in found:
                    counts[kind, mark] = counts.get((kind, mark), 0) + 1
        for (kind, mark), n in counts.items():
            yield pa.RecordBatch.from_pydict({"kind": [kind], "toxic": pa.array([mark], pa.int32()), "n": [n]})

    seen = {(r.kind, r.toxic): r.n for r in texts.mapInArrow(run, "kind string, toxic int, n long").groupBy("kind", "toxic").agg(F.sum("n").alias("n")).collect()}
    for kind, prior in PRIORS.items():
        bad, good = seen.get((kind, 1), 0), seen.get((kind, 0), 0)
        grammar.patterns[kind] = (bad + BELIEF * prior) / (bad + good + BELIEF)
    bad, good = seen.get(("", 1), 0), seen.get(("", 0), 0)
    grammar.base = min(0.25, (bad + 0.5) / (bad + good + 1))
    grammar.known.clear()
    return grammar


def toxicity(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, n_clauses (matched clauses)."""

    def run(batches):
        for batch in batches:
            rated = [grammar.rated(t) for t in batch.column(1).to_pylist()]
            scores, clauses = [s for s, _ in rated], [n for _, n in rated]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(clauses, pa.int32())],
                ["doc_id", "score", "predicted", "n_clauses"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int, n_clauses int"
    )


def scored(docs: DataFrame, labels: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, score, predicted: the labels of held-out rows are not read. `held` reads column doc_id."""
    grammar = learned(docs, labels.where(~held))
    found = toxicity(docs, grammar)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted", "n_clauses")

"""Toxicity by a weighted finite-state pattern grammar.

A clause (text between . ! ? ; : and line ends) is a string of word classes: insult, threat,
target, negation, reporting verb, other.  Three deterministic transducers read it in turn:
``TARGET`` marks insults and threats close behind a target, ``NEGATION`` those in
the scope of a negation, ``REPORT`` those behind a reporting verb.  They are composed into one
machine; each insult or threat leaves it as a pattern (plain, targeted, negated, reported), and a
clause scores the weights of its patterns.  A document's probability combines its matched
clauses: their total and largest scores, their number, whether more than one insult is there, and the
sums of each pattern.

The word lists of threats, targets, negations and reporting verbs are fixed; insults (words and
stems, with weights) and the pattern weights are learned from a bounded sample of labelled rows.  For a
stem it is learned too whether one word of a text that starts with it is evidence, or only two.
Scoring runs in Spark tasks over whole texts: an Aho-Corasick automaton finds the lexicon's
words, and only clauses that hold one are read by the machine.  Nothing is shuffled.

Defined results: null, empty and matchless texts get the score of a text without matches; repeated
rows are scored alike; without labels of both kinds the insult lexicon is empty and the score is
the share of label 1 (0.5 with no label at all).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.fit_sample import labelled_sample, small_batches

#: Closed word classes in English, German, French and Spanish.
THREATS = ["kill", "hurt", "destroy", "beat", "shoot", "hang", "töten", "umbringen", "tuer", "frapper",
           "matar", "golpear"]
TARGETS = ["you", "your", "he", "she", "they", "them", "him", "du", "ihr", "dich", "euch", "tu", "vous",
           "toi", "ils", "tú", "usted", "ustedes", "ellos"]
NEGATIONS = ["not", "never", "no", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "ne", "pas",
             "jamais", "nunca", "jamás"]
REPORTS = ["said", "says", "reported", "claimed", "quoted", "wrote", "sagte", "behauptete", "dit", "affirma",
           "dijo", "afirmó"]
CLAUSE_END = re.compile(r"[.!?;:\n]")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
STEMS = range(3, 9)


class Transducer:
    """Deterministic: ``arcs[state, symbol] = (state, output, weight)``; start state 0."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def then(self, other: Transducer) -> Transducer:
        """The composition: this machine's output is the other's input, weights add up."""
        arcs, todo, ids = {}, [(0, 0)], {(0, 0): 0}
        while todo:
            a, b = todo.pop()
            for (s, x), (na, out, w) in self.arcs.items():
                if s == a and (b, out) in other.arcs:
                    nb, out2, w2 = other.arcs[b, out]
                    if (na, nb) not in ids:
                        ids[na, nb] = len(ids)
                        todo.append((na, nb))
                    arcs[ids[a, b], x] = (ids[na, nb], out2, w + w2)
        return Transducer(arcs)

    def read(self, symbols: list[str]) -> Iterator[tuple[str, float]]:
        state = 0
        for x in symbols:
            state, out, w = self.arcs[state, x]
            yield out, w


def _scope(opener: str, mark: str, weight: float, reach: int | None, inputs: list[str]) -> Transducer:
    """Mark insults and threats within ``reach`` words (or to the clause's end) of ``opener``."""
    far = 1 if reach is None else reach
    arcs = {}
    for s in range(far + 1):
        rest = s if reach is None else max(0, s - 1)
        for x in inputs:
            if x == opener:
                arcs[s, x] = (far, "o", 0.0)
            elif x[0] in "IH" and s:
                arcs[s, x] = (rest, x + mark, weight)
            else:
                arcs[s, x] = (rest, x, 0.0)
    return Transducer(arcs)


_BARE = ["I", "H"]
_TARGETED = _BARE + [x + "t" for x in _BARE]
_NEGATED = _TARGETED + [x + "n" for x in _TARGETED]
TARGET = _scope("T", "t", 0.5, 3, [*_BARE, "T", "N", "R", "o"])
NEGATION = _scope("N", "n", -0.5, 3, [*_TARGETED, "N", "R", "o"])
REPORT = _scope("R", "r", -0.3, None, [*_NEGATED, "R", "o"])
GRAMMAR = TARGET.then(NEGATION).then(REPORT)
N_FEATURES = 10
#: Words of a text that must start with a stem.
TWICE = 2


class Lexicon:
    """Insult words and stems with weights, and the closed classes."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], twice: Iterable[str] = ()):
        self.words, self.stems, self.twice = words, stems, frozenset(twice)
        self.closed = {w: c for c, ws in (("H", THREATS), ("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in ws}
        self.find = ahocorasick.Automaton()
        for w in {*words, *stems, *THREATS}:
            self.find.add_word(w, len(w))
        self.find.make_automaton()

    def entry(self, word: str) -> str | None:
        """The word itself or its longest stem in the lexicon."""
        if word in self.words:
            return word
        return next((word[:n] for n in reversed(STEMS) if len(word) > n and word[:n] in self.stems), None)

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold a word or stem of the lexicon, each once, in order."""
        done = -1
        for end, n in self.find.iter(text):
            start = end - n + 1
            if start < done or (start and text[start - 1].isalnum()):
                continue
            # boundaries: the last end before the word and the first behind it
            left = max(text.rfind(c, 0, start) for c in ".!?;:\n") + 1
            right = CLAUSE_END.search(text, end)
            done = right.start() if right else len(text)
            yield text[max(left, 0):done]

    def features(self, text: str | None) -> list[float]:
        """Counts and weights of the text's matched clauses.

        A stem of ``twice`` is evidence where ``TWICE`` words of the text start with it: short stems start a word
        of many plain texts by chance.
        """
        t = (text or "").lower()
        clauses = [WORD.findall(c) for c in self.clauses(t)]
        entries = [[self.entry(w) for w in c] for c in clauses]
        often = Counter(e for c in entries for e in c if e is not None)
        own_weight = lambda e: (self.words[e] if e in self.words else
                                self.stems[e] if e not in self.twice or often[e] >= TWICE else None)
        sums, n, hits, top, total = Counter(), 0, 0, 0.0, 0.0
        for words, found in zip(clauses, entries, strict=True):
            weights = [own_weight(e) if e is not None else None for e in found]
            marks = ["I" if v is not None else self.closed.get(w, "o") for w, v in zip(words, weights, strict=True)]
            score = 0.0
            for (out, w), v in zip(GRAMMAR.read(marks), weights, strict=True):
                if out[0] in "IH":
                    own = (v if v is not None else 1.0) * (1 + w)
                    score += own
                    hits += out[0] == "I"
                    sums["r" if "r" in out else "n" if "n" in out else "t" if "t" in out else out[0]] += own
            if score:
                n, top, total = n + 1, max(top, score), total + score
        return [math.log1p(max(0.0, total)), max(0.0, top), math.log1p(n), float(n > 0), float(hits > 1),
                *[math.log1p(max(0.0, sums[k])) for k in "ItnrH"]]


def learn_lexicon(sample: list[tuple[str, int]], least: int = 5, log_odds: float = 1.5) -> Lexicon:
    """Words and stems that tell toxic texts: greedy, the surest first, the longest among equals.

    Sure is the log odds of a toxic text less two standard errors, ``log_odds`` at least.  A kept
    entry is in ``least`` toxic texts that no entry before it is in; or it is surer still, stands
    between ``4 * least`` different pairs of words, and is no longer or shorter form of a kept entry.  So
    words that merely come along with an insult (in copies of a text, say) stay out.  Equal texts count once.
    """
    sample = sorted(set((t or "", y) for t, y in sample))
    def forms(t: str) -> set:
        own = Counter(WORD.findall(t.lower()))
        stems = Counter()
        for w, k in own.items():
            for n in STEMS:
                if len(w) > n:
                    stems[w[:n]] += k
        return {(w, 0) for w in own} | {(x, 1) for x in stems} | {(x, TWICE) for x, k in stems.items() if k >= TWICE}

    # counts first, so that texts are only listed for forms that enough of them have
    n, often, plain = Counter(y for _, y in sample), Counter(), Counter()
    for t, y in sample:
        if y:
            often.update(forms(t))
    toxic: dict = {f: set() for f, k in often.items() if k >= least}
    del often
    for i, (t, y) in enumerate(sample):
        own = forms(t) & toxic.keys()
        if y:
            for f in own:
                toxic[f].add(i)
        else:
            plain.update(own)
    sure = []
    for f, d in toxic.items():
        a, b = len(d), plain[f]
        odds = math.log((a + 0.5) / (n[1] - a + 0.5)) - math.log((b + 0.5) / (n[0] - b + 0.5))
        low = odds - 2 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if low >= log_odds:
            sure.append((-round(low, 6), -len(f[0]), f))
    around: dict = {}
    names = {f for _, _, f in sure}
    for t, y in sample:
        if y:
            words = WORD.findall(t.lower())
            for before, w, after in zip([""] + words, words, words[1:] + [""], strict=False):
                for f in {(w, 0)} | {(w[:k], need) for k in STEMS if len(w) > k for need in (1, TWICE)}:
                    if f in names:
                        around.setdefault(f, set()).add((before, after))
    kept, seen = {0: {}, 1: {}, TWICE: {}}, set()
    for low, _, f in sorted(sure):
        if any(f[0] in k for k in kept.values()):
            continue
        apart = not any(f[0].startswith(w) or w.startswith(f[0]) for k in kept.values() for w in k)
        if len(toxic[f] - seen) >= least or (
                apart and -low >= log_odds + 1 and len(around[f]) >= 4 * least):
            seen |= toxic[f]
            kept[f[1]][f[0]] = -low / 3
    return Lexicon(kept[0], kept[1] | kept[TWICE], kept[TWICE])


class Model:
    def __init__(self, lexicon: Lexicon, w: np.ndarray, b: float):
        self.lexicon, self.w, self.b = lexicon, w, b

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.lexicon.features(t) for t in texts]).reshape(len(texts), N_FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.w + self.b, -30, 30)))


def fit(sample: list[tuple[str, int]], steps: int = 400, ridge: float = 0.02) -> Model:
    y = np.array([v for _, v in sample], float)
    if not len(sample) or y.min() == y.max():
        return Model(Lexicon({}, {}), np.zeros(N_FEATURES), 0.0 if not len(sample) else (3.0 if y[0] else -3.0))
    # half of the sample names the insults, the other half weighs the patterns; then all name them
    half = learn_lexicon(sample[::2])
    x = np.array([half.features(t) for t, _ in sample[1::2]]).reshape(-1, N_FEATURES)
    z, w, b = y[1::2], np.zeros(N_FEATURES), 0.0
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        rate = 1.0 / (1 + k / 100)
        w -= rate * (x.T @ (p - z) / len(z) + ridge * w / 10)
        b -= rate * (p - z).mean()
    return Model(learn_lexicon(sample), w, b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, folds: int = 3, held_out: int = 1,
          key: str = "doc_id", text: str = "text", max_rows: int = 4000) -> Model:
    return fit(labelled_sample(docs, labels, label, folds=folds, held_out=held_out, key=key, text=text,
                               max_rows=max_rows))


def score_toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row of ``docs``, whole texts."""
    small_batches(docs.sparkSession)
    words, stems, twice, w, b = model.lexicon.words, model.lexicon.stems, model.lexicon.twice, model.w, model.b

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Lexicon(words, stems, twice), w, b)
        for x in batches:
            yield pa.RecordBatch.from_arrays(
                [x.column(0), pa.array(own.scores(x.column(1).to_pylist()), pa.float64())], names=["key", "score"])

    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return d.mapInArrow(score, f"key {kind}, score double").withColumnRenamed("key", key)

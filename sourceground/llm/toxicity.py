"""Toxicity scores from a learnt lexicon, matched through Levenshtein automata.

1. The lexicon (whole words and word stems) is learnt from a bounded sample of labelled
   documents: terms far more frequent in toxic documents than in others.
2. Whole words form a trie. The automaton of a term accepts every spelling within one
   edit (two for long terms). Intersecting the automata with the trie gives one
   deterministic automaton, whose states are sets of (trie node, edits used); it is
   built lazily, and most words die in it after a few letters.
3. A hit is judged by its window of words: quotation marks and words of reporting make
   it a quotation, address and further hits make it abuse.
4. A logistic model on these sums, drawn towards prior weights, gives the score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_sample

#: Stems are word beginnings of these lengths.
STEMS = (4, 5, 6)
WINDOW = 8
LEET = str.maketrans("013457@$!", "oieastasi")
EDGE = " \t\r\n.,;:!?\"'`()[]{}<>*#$%&|/\\-_=+~«»“”„‘’‚…¡¿—–"
#: Edge marks that do not look like letters.
EDGE_ALONE = EDGE.replace("$", "").replace("!", "")
QUOTES = "\"«»“”„‘’"
REPORTING = frozenset("said says say quote quoted quotes wrote writes called calls word words term phrase reported insult slur dit mot terme dijo dice palabra llamó sagte wort schrieb zitat".split())
ADDRESS = frozenset("you your you're ur yourself u du dein dich tu te usted vous toi tú".split())

FEATURES = ("exact", "fuzzy", "stem", "quoted", "addressed", "crowded", "density")
#: The model is drawn towards these weights; evidence moves it away.
PRIOR = np.array([-3.0, 2.0, 1.2, 1.2, -1.0, 0.5, 0.5, 0.5])


class Automaton:
    """Levenshtein automata of all terms, intersected with their trie and determinised lazily.

    ``whole`` allows an edit at any letter and in terms of any length, as the model does;
    without it the first letter must match and terms under five letters allow none.
    """

    def __init__(self, terms: list[str], whole: bool = False):
        self.whole = whole
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.reach: list[int] = [0]  # most edits that a term below may use
        for term in sorted(terms):
            node, k = 0, self.edits(term)
            self.reach[0] = max(self.reach[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], k)
            self.ends[node] = term
        self._restart()

    def _restart(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = self._state(frozenset({(0, 0)}), close=self.whole)

    @staticmethod
    def allowed(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 9 else 2

    def edits(self, term: str) -> int:
        return max(1, self.allowed(term)) if self.whole else self.allowed(term)

    def _state(self, items: frozenset, close: bool = True) -> int:
        best: dict[int, int] = {}
        stack = list(items)
        while stack:
            node, e = stack.pop()
            if best.get(node, 99) <= e or e > self.reach[node]:
                continue
            best[node] = e
            if close:
                stack += [(child, e + 1) for child in self.children[node].values()]  # a letter left out
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            hits = [(e, self.ends[n]) for n, e in best.items() if self.ends[n] and e <= self.edits(self.ends[n])]
            self.accepts.append(min(hits)[::-1] if hits else None)
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        items = set()
        for node, e in self.sets[state]:
            if node == 0 and not self.whole:
                items |= {(child, e) for x, child in self.children[0].items() if x == c}
                continue
            items.add((node, e + 1))  # a letter too many
            items |= {(child, e + (x != c)) for x, child in self.children[node].items()}
        self.moves[state][c] = to = self._state(frozenset(items))
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, ties to the first in order; None if none is near enough."""
        if len(self.sets) > 200_000:  # bounded memory; states are built again as needed
            self._restart()
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            if to is None:
                to = self._step(state, c)
            if not self.sets[to]:
                return None
            state = to
        return self.accepts[state]


def tidy(token: str) -> str:
    """Lower case without punctuation at the edges; digits and signs inside stand for the letters they look like."""
    word = token.strip(EDGE).lower()
    return word if word.isalpha() else word.translate(LEET)


def readings(token: str) -> list[str]:
    """``tidy``, and the word that leading or trailing signs stand for as letters ($tupid) if there are any."""
    word, kept = tidy(token), token.strip(EDGE_ALONE).lower()
    spelled = kept.translate(LEET)
    return [word, spelled] if word and kept and (kept[0] in "$!" or kept[-1] in "$!") else [word]


@dataclass
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    clean: frozenset = frozenset()
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def __post_init__(self):
        self.automaton, self.known = Automaton(list(self.words), whole=True), {}

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "clean": self.clean, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _lookup(self, token: str) -> tuple[int, float] | None:
        """(kind, weight) of a token: kind 0 exact, 1 fuzzy, 2 stem."""
        words = readings(token)
        for word in words:
            if word in self.words:
                return 0, self.words[word]
            for k in STEMS:
                if word[:k] in self.stems and len(word) >= k:
                    return 2, self.stems[word[:k]]
        for word in words:
            if word in self.clean:
                return None
            if len(word) >= 2 and (hit := self.automaton.match(word)):
                return 1, self.words[hit[0]] / (1 + hit[1])
        return None

    def features(self, text: str | None) -> np.ndarray:
        tokens = (text or "").split()
        known, hits = self.known, []
        for i, token in enumerate(tokens):
            try:
                hit = known[token]
            except KeyError:
                if len(known) > 500_000:  # bounded memory; misses are looked up again
                    known.clear()
                hit = known[token] = self._lookup(token)
            if hit is not None:
                hits.append((i, *hit))
        f = np.zeros(len(FEATURES))
        places, quoted = [h[0] for h in hits], 0
        for n, (i, kind, weight) in enumerate(hits):
            around = tokens[max(0, i - WINDOW) : i + WINDOW + 1]
            left, right = tokens[max(0, i - WINDOW) : i + 1], tokens[i : i + WINDOW + 1]
            quote = 0.5 * (any(t[0] in QUOTES for t in left) and any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in right))
            quote += 0.5 * any(tidy(t) in REPORTING for t in around)
            f[3] += weight * quote
            if quote == 1.0:  # in quotation marks and reported: hardly abuse
                f[kind] += 0.1 * weight
                quoted += 1
                continue
            f[kind] += weight
            f[4] += any(tidy(t) in ADDRESS for t in around)
            f[5] += n > 0 and i - places[n - 1] <= WINDOW
        f = np.log1p(f)
        f[6] = math.log1p(100 * (len(hits) - quoted) / (len(tokens) + 10))
        return f

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, float(self.weights[0] + self.weights[1:] @ self.features(text))))))


def _stems(words: Column, k: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def learn_terms(rows: DataFrame, least_docs: int = 3, least_evidence: float = 15.0, least_odds: float = 2.3, stem_evidence: float = 40.0):
    """(words, stems, clean words) from (text, y): document counts by class, combined before the shuffle.

    Evidence of a term is its toxic documents times the log ratio of its shares. A stem
    needs more of it, and must tell more than the whole words below it. All terms with
    the evidence are taken: the sample of documents bounds them.
    """
    words = F.array_distinct(F.filter(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= 2))
    stems = [_stems(words, k) for k in STEMS]
    terms = F.explode(F.array_distinct(F.concat(words, *stems)))
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n1, n0 = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counts = rows.select("y", terms.alias("term")).groupBy("term").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    odds = F.log((F.col("a") / n1) / ((F.col("b") + 0.5) / n0))
    found = counts.withColumn("odds", odds).withColumn("evidence", F.col("a") * odds)
    found = found.where((F.length("term") >= 3) & (F.col("a") >= least_docs) & (F.col("odds") >= least_odds) & (F.col("evidence") >= F.when(F.col("term").endswith("*"), stem_evidence).otherwise(least_evidence)))
    best = found.orderBy(F.col("evidence").desc(), "term").collect()  # terms of a bounded sample
    whole = {r.term: r for r in best if not r.term.endswith("*")}
    prefix = {r.term[:-1]: r for r in best if r.term.endswith("*")}
    for stem in sorted(prefix, key=len, reverse=True):
        below = [w for w in (*whole, *prefix) if w != stem and w.startswith(stem)]
        strongest = max((whole[w].evidence if w in whole else prefix[w].evidence for w in below), default=0.0)
        if prefix[stem].evidence <= 1.05 * strongest:
            del prefix[stem]  # the longer form tells as much
        else:
            for w in below:
                (whole if w in whole else prefix).pop(w, None)
    weight = lambda r: min(1.5, r.odds / 5)
    words_ = {w: weight(r) for w, r in whole.items()}
    automaton = Automaton(list(words_), whole=True)
    near = F.col("b") > 0
    if words_:
        near &= F.length("term").between(min(map(len, words_)) - 2, max(map(len, words_)) + 2)

    def close(batches):
        for batch in batches:
            yield batch.filter(pa.array([automaton.match(t) is not None for t in batch.column("term").to_pylist()], pa.bool_()))

    clean = counts.where(near & ~F.col("term").endswith("*")).select("term").mapInArrow(close, "term string")
    clean = clean.collect() if words_ else []  # spellings near the lexicon, of a bounded sample
    return words_, {s: weight(r) for s, r in prefix.items()}, frozenset(r.term for r in clean) - set(words_)


def fit_weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: float = 2.0, steps: int = 60) -> np.ndarray:
    """Newton steps on the logistic loss with a Gaussian prior around PRIOR; no weight of evidence turns negative."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + pull * (w - PRIOR)
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    w[1:4] = np.maximum(w[1:4], 0.0)
    return w


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> ToxicityModel:
    """Learn from at most ``per_class`` labelled documents of each class outside the held-out fold (crc32 mod 5 = 0)."""
    rows, sizes = training_sample(docs.select("doc_id", "text"), labels, "toxic", 5, 0, per_class)
    model = ToxicityModel(*learn_terms(rows.select(F.coalesce("text", F.lit("")).alias("text"), "y")))

    def run(batches):
        for batch in batches:
            xs = [model.features(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(xs, pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.select("y", "text").mapInArrow(run, "y int, x array<double>").toArrow()  # at most 2 * per_class short rows
    if got.num_rows:
        order = sorted(zip(got.column("y").to_pylist(), got.column("x").to_pylist(), strict=True))
        y, x = np.array([o[0] for o in order], float), np.array([o[1] for o in order])
        share = {k: max(1, sizes[k]) / max(1, int((y == k).sum())) for k in (0, 1)}
        model.weights = fit_weights(x, y, np.where(y == 1, share[1], share[0]) / max(share.values()))
    return model


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) for every row, from its whole text; a null or empty text has the score of no hits."""

    def run(batches):
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, score double")


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; predicted is 1 from 0.5.

    Only the text is an input of a score. Without labels the lexicon is empty and every
    score is that of no hits. An empty table gives an empty result.
    """
    scored = score_documents(docs, train(docs, labels, per_class))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Toxicity: a learnt lexicon, found in spite of misspellings, weighed by its context.

The lexicon's trie is intersected with Levenshtein automata: one automaton walks the trie
with all terms at once, and its states are made once and kept, so that a word costs a look-up
a letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.langid import held_out
from millrace.llm.simhash import simhash_groups
from millrace.llm.storage import dropped, stored

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
QUOTES = re.compile("[\"“”„«»]")
# Words that report what others say: context of a quotation.
REPORTING = frozenset("""said says wrote writes quote quoted quotes called calls word term phrase insult slur
dit écrit cité appelé mot terme insulte sagte schrieb zitat zitierte nannte wort begriff beleidigung
dijo escribió citó llamó palabra término insulto""".split())
WINDOW = 6
FEATURES = 5
THRESHOLD = 0.3
DOCS_PER_CLASS = 10_000
LEAST_DOCS = 3
# Chance gives a word this log-likelihood once in ten thousand times.
LEAST_LIKELIHOOD = 15.13
LEAST_RATIO = 20.0
MAX_STATES = 200_000
MAX_WORDS = 400_000


def allowed_edits(term: str) -> int:
    """Edits within which a word counts as the term misspelt."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class LexiconAutomaton:
    """Levenshtein automata, with transpositions, of all terms on their common trie.

    A state is a set of (trie node, edits so far, letter that a transposition still owes).
    """

    def __init__(self, terms: list[str], max_states: int = MAX_STATES):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.edits = [0]
        for term in terms:
            node, allowed = 0, allowed_edits(term)
            for letter in term:
                self.edits[node] = max(self.edits[node], allowed)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.edits.append(0)
                node = self.children[node][letter]
            self.edits[node] = max(self.edits[node], allowed)
            self.term[node] = term
        self.max_states = max_states
        # Longer words are more edits away from every term than any allows.
        self.longest = max((len(term) + allowed_edits(term) for term in terms), default=0)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.dead = self._number(frozenset())
        self.start = self._number(self._closed({(0, ""): 0}))

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            ends = sorted((edits, self.term[node]) for node, edits, owed in state
                          if not owed and self.term[node] and edits <= allowed_edits(self.term[node]))
            self.found.append((ends[0][1], ends[0][0]) if ends else None)
        return self.numbers[state]

    def _closed(self, best: dict[tuple[int, str], int]) -> frozenset:
        """With the states reached by leaving letters of a term out."""
        todo = list(best.items())
        while todo:
            (node, owed), edits = todo.pop()
            if owed or best[node, owed] < edits:
                continue
            for child in self.children[node].values():
                if edits < self.edits[child] and best.get((child, ""), 99) > edits + 1:
                    best[child, ""] = edits + 1
                    todo.append(((child, ""), edits + 1))
        return frozenset((node, edits, owed) for (node, owed), edits in best.items())

    def _move(self, state: int, letter: str) -> int:
        best: dict[tuple[int, str], int] = {}

        def reach(node: int, edits: int, owed: str = "") -> None:
            if edits <= self.edits[node] and best.get((node, owed), 99) > edits:
                best[node, owed] = edits

        for node, edits, owed in self.states[state]:
            if owed:
                if owed == letter:
                    reach(node, edits)
                continue
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
                if own != letter and letter in self.children[child]:
                    reach(self.children[child][letter], edits + 1, own)
            reach(node, edits + 1)
        number = self._number(self._closed(best))
        self.moves[state][letter] = number
        return number

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term within its allowed edits, and the edits; None if there is none."""
        if len(self.states) > self.max_states:
            self._reset()
        state = self.start
        for letter in word:
            state = self.moves[state].get(letter, -1) if self.moves[state] else -1
            if state < 0:
                break
            if state == self.dead:
                return None
        else:
            return self.found[state]
        return self._walk(word)

    def _walk(self, word: str) -> tuple[str, int] | None:
        state = self.start
        for letter in word:
            after = self.moves[state].get(letter)
            state = self._move(state, letter) if after is None else after
            if state == self.dead:
                return None
        return self.found[state]


@dataclass
class ToxicityModel:
    """Lexicon terms, clean words near them that are no misspellings, and the score's weights."""

    terms: list[str] = field(default_factory=list)
    innocent: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    def __post_init__(self) -> None:
        self._prepare()

    def _prepare(self) -> None:
        self.automaton = LexiconAutomaton(self.terms)
        self.known: dict[str, tuple[str, int] | None] = {}

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "innocent": self.innocent, "weights": self.weights}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def match(self, word: str) -> tuple[str, int] | None:
        if len(word) > self.automaton.longest:
            return None
        if word not in self.known:
            found = self.automaton.match(word)
            if found and found[1] and word in self.innocent:
                found = None
            if len(self.known) >= MAX_WORDS:
                self.known.clear()
            self.known[word] = found
        return self.known[word]

    def hits(self, text: str | None) -> list[tuple[int, str, int, bool]]:
        """(word number, term, edits, whether the context marks a quotation) of each place."""
        lowered = (text or "").lower()
        words = WORD.findall(lowered)
        match = self.match
        places = [(i, found) for i, word in enumerate(words) if (found := match(word))]
        if not places:
            return []
        spans = [m.start() for m in WORD.finditer(lowered)] + [len(lowered)]
        marks = [m.start() for m in QUOTES.finditer(lowered)]
        return [(i, term, edits, self._quoted(i, words, spans, marks)) for i, (term, edits) in places]

    @staticmethod
    def _quoted(at: int, words: list[str], spans: list[int], marks: list[int]) -> bool:
        """Quotation marks on both sides within the window, or a reporting word before the place."""
        low, high = spans[at - WINDOW] if at >= WINDOW else 0, spans[min(len(words), at + WINDOW)]
        before = np.searchsorted(marks, spans[at]) - np.searchsorted(marks, low)
        after = np.searchsorted(marks, high, "right") - np.searchsorted(marks, spans[at])
        return bool(before and after) or any(w in REPORTING for w in words[max(0, at - WINDOW):at])

    @staticmethod
    def features(hits: list[tuple[int, str, int, bool]]) -> list[float]:
        """Terms in plain context with no, one and more edits, terms in quotations, and any exact plain term at all."""
        counts = [0, 0, 0, 0]
        for _, _, edits, quoted in hits:
            counts[3 if quoted else min(edits, 2)] += 1
        return [*np.log1p(counts).tolist(), float(counts[0] > 0)]

    def score(self, hits: list[tuple[int, str, int, bool]]) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], self.features(hits)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


#: What the weights are drawn to where the sample does not tell: a single edit counts nearly as much as the term,
#: a quotation for little.
PRIOR = np.array([0.0, 1.5, 4.0, 1.0, 0.5, 2.5])


def fit_weights(features: np.ndarray, labels: np.ndarray, pull: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to PRIOR."""
    x = np.column_stack([np.ones(len(features)), features])
    rate = np.clip(labels.mean(), 0.001, 0.999)
    prior = PRIOR.copy()
    prior[0] = np.log(rate / (1 - rate)) - 1.0
    w, strength = prior.copy(), np.full(len(prior), pull)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + strength * (w - prior)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(strength), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def log_likelihood(bad: Column, good: Column, bad_docs: int, good_docs: int) -> Column:
    """G squared of a word's documents by label against no connection of the two (one degree of freedom)."""
    every, met = float(bad_docs + good_docs), bad + good
    cells = ((bad, met * bad_docs), (good, met * good_docs),
             (bad_docs - bad, (every - met) * bad_docs), (good_docs - good, (every - met) * good_docs))
    return 2 * sum(F.when(seen > 0, seen * F.log(seen * every / F.nullif(expected, F.lit(0.0)))).otherwise(0.0)
                   for seen, expected in cells)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", docs_per_class: int = DOCS_PER_CLASS) -> ToxicityModel:
    """A model from the labelled rows that are not held out.

    The sample is bounded: about ``docs_per_class`` documents of each label, chosen by a hash
    of the id, equal texts once. The lexicon holds all words that are found in at least
    ``LEAST_DOCS`` toxic documents, ``LEAST_RATIO`` times as often as in others, where chance
    would hardly do that (``LEAST_LIKELIHOOD``). Documents count on both sides, near copies as one.
    """
    marked = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    sizes = {row["toxic"]: row["n"] for row in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel(weights=np.array([0.0 if not sizes else 4.0 * (toxic > 0) - 2.0] + [0.0] * FEATURES))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    share = F.when(F.col("toxic") == 1, docs_per_class / toxic).otherwise(docs_per_class / clean)
    chosen = marked.where(F.col("toxic").isin(0, 1) & (chance < share))
    # About two times docs_per_class ids, however many documents and labels there are.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    once = texts.join(F.broadcast(chosen), "id").groupBy("toxic", F.xxhash64("text").alias("same"))
    sample = stored(once.agg(F.min("text").alias("text")), "labelled-texts")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("toxic", "family"))
            for label, family, text in zip(*columns, batch.column("text")):
                found = set(WORD.findall((text.as_py() or "").lower()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([family] * len(found), pa.int64()),
                     pa.array([label] * len(found), pa.int32())], ["word", "family", "toxic"])

    # Near copies, as op1 finds them, count once a label.
    distinct = sample.select("same", "text").dropDuplicates(["same"])
    families = simhash_groups(distinct, "same").select("same", F.col("component_id").alias("family"))
    grouped = stored(sample.join(families, "same").select("toxic", "family", "text"), "labelled-families")
    dropped(sample)
    sample = grouped
    met = sample.mapInArrow(words, "word string, family long, toxic int").distinct() \
        .groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    used = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.countDistinct("family").alias("n")).collect()}
    bad_docs, good_docs = used.get(1, 0), used.get(0, 0)
    ratio = ((F.col("bad") + 0.5) / (bad_docs + 1)) / ((F.col("good") + 0.5) / (good_docs + 1))
    sure = log_likelihood(F.col("bad"), F.col("good"), bad_docs, good_docs) >= LEAST_LIKELIHOOD
    terms = met.where((F.col("bad") >= LEAST_DOCS) & (ratio >= LEAST_RATIO) & sure)
    model = ToxicityModel(sorted(row["word"] for row in terms.select("word").collect()))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, near, texts = [], [], batch.column("text").to_pylist()
            for label, text in zip(batch.column("toxic").to_pylist(), texts):
                rows.append(model.features(model.hits(text)))
                known = set(WORD.findall((text or "").lower())) if not label else ()
                near.append([w for w in known if (found := model.match(w)) and found[1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.float64())), pa.array(near, pa.list_(pa.string()))],
                ["toxic", "features", "near"])

    clean_only = sample.where("toxic = 0")
    kind = "toxic int, features array<double>, near array<string>"
    near = clean_only.mapInArrow(measured, kind).select(F.explode("near").alias("word")).distinct()
    model.innocent = frozenset(row["word"] for row in near.collect())
    model._prepare()
    rows = sample.mapInArrow(measured, kind).groupBy("toxic", "features").agg(F.count("*").alias("n")).collect()
    if rows:
        features = np.repeat(np.array([row["features"] for row in rows]), [row["n"] for row in rows], axis=0)
        model.weights = fit_weights(features, np.repeat([row["toxic"] for row in rows], [row["n"] for row in rows]))
    dropped(sample)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, score, predicted, hits.

    score is the probability of the toxic label; hits are (first_word, term, edits, quoted).
    Null and empty texts get the score of a text without terms. Without labels of both kinds
    every score is the same: 0.5 with none, else near the only label. Rows repeated under one
    id keep a row each, a null id counts as not held out, other columns are not read.
    """
    model = learn(docs, labels, id_col, text_col)
    kind = pa.struct([("word", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.hits(text.as_py()) for text in batch.column("text")]
            scores = [model.score(hits) for hits in found]
            hits = [[dict(zip(("word", "term", "edits", "quoted"), hit)) for hit in hits] for hits in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(hits, pa.list_(kind))],
                [id_col, "held_out", "score", "predicted", "hits"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"`{id_col}` long, held_out boolean, score double, predicted int, "
                                 "hits array<struct<word: long, term: string, edits: int, quoted: boolean>>")

from __future__ import annotations

import random

import pytest
from llm_helpers import documents, workers_find_the_package, SMALL  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm.toxicity import LexiconAutomaton, ToxicityModel, allowed_edits, fit_weights, learn, toxicity

TERMS = ["idiot", "stupid", "worthless", "scum", "stupidity", "idol"]


def distance(a: str, b: str) -> int:
    """Edits with transpositions of neighbours."""
    rows = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def test_the_automaton_finds_what_edit_distances_allow():
    rnd = random.Random(1)
    automaton = LexiconAutomaton(TERMS, max_states=300)
    for _ in range(4000):
        word = list(rnd.choice(TERMS))
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(word)) if word else 0
            change = rnd.choice("dist")
            if change == "d" and word:
                del word[at]
            elif change == "i":
                word.insert(at, rnd.choice("abst1"))
            elif change == "s" and word:
                word[at] = rnd.choice("abst1")
            elif at + 1 < len(word):
                word[at:at + 2] = word[at + 1], word[at]
        text = "".join(word)
        near = sorted((distance(text, term), term) for term in TERMS if distance(text, term) <= allowed_edits(term))
        assert automaton.match(text) == ((near[0][1], near[0][0]) if near else None)


@pytest.mark.parametrize("text,quoted", [
    ("you are an idiot today", [False]),
    ('they said "idiot" was the word', [True]),
    ("the insult idiot is old", [True]),
    ("«idiot» here and far away from any other mark", [True]),
    ("idiot idiot", [False, False]),
])
def test_context(text, quoted):
    model = ToxicityModel(TERMS)
    assert [hit[3] for hit in model.hits(text)] == quoted


def test_a_quotation_scores_below_abuse():
    model = ToxicityModel(TERMS)
    import numpy as np
    texts = ["you idiot", "a plain text", "you stupid scum", "other words"]
    rows = np.array([model.features(model.hits(t)) for t in texts])
    model.weights = fit_weights(rows, np.array([1.0, 0.0, 1.0, 0.0]))
    score = lambda t: model.score(model.hits(t))
    assert score("an idoit") > 0.3 > score("nothing here")
    assert score("you idiot") > score('he wrote "idiot" in quotes') > score("nothing here") - 0.05


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity(docs, labels)
    assert found.count() == docs.count()
    seen = found.join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    right = sum(row["predicted"] == row["toxic"] for row in seen)
    assert right >= 0.93 * len(seen)
    assert sum(row["predicted"] and not row["toxic"] for row in seen) <= 0.03 * len(seen)


def test_edges(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("id", F.lit("x"))
    table = [(1, None), (2, ""), (2, "two"), (None, "three"), (4, "x" * 200000), (5, "idiot " * 50000)]
    rows = toxicity(documents(table), labels).collect()
    assert len(rows) == len(table) and all(0 <= row["score"] <= 1 for row in rows)
    empty = labels.where("false")
    assert {row["score"] for row in toxicity(documents(table), empty).collect()} == {0.5}
    one_kind = labels.withColumn("toxic", F.lit(0))
    assert all(row["predicted"] == 0 for row in toxicity(documents(table), one_kind).collect())
    assert toxicity(documents([]), labels).count() == 0


def test_rare_terms_of_a_large_sample_are_learnt(spark):
    """Nine of 1200 toxic texts, always in one phrase; near copies of one text teach nothing."""
    rnd = random.Random(3)
    plain = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(400)]
    rows, marks = [], []
    for i in range(3600):
        words = rnd.choices(plain, k=40)
        if i % 3 == 0:
            words.insert(20, "moron")
        if i % 400 == 0:
            words[5:5] = ["what", "a", "zorkulon", "here"]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0 or i % 400 == 0)))
    long = rnd.choices(plain, k=300) + ["copiedword"]
    for i in range(5000, 5012):
        rows.append((i, " ".join([*long, f"end{i}"])))
        marks.append((i, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    terms = learn(docs, labels).terms
    assert "moron" in terms and "zorkulon" in terms and "copiedword" not in terms

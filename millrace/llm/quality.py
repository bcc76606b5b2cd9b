"""Quality scores by co-training: a text view and a metadata view teach each other."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.langid import held_out
from millrace.llm.storage import dropped, stored

THRESHOLD = 0.5
SEED_DOCS = 20_000
ROUNDS = 3
CONFIDENCE = 0.95
TAUGHT_WEIGHT = 0.3
PULL = 1.0
EXCHANGE = (("text_x", "meta_x"), ("meta_x", "text_x"))
BUCKETS = 32
SYMBOLS = re.compile(r"[^\w\s.,;:'’\"()\-]")


def text_features(text: str | None) -> list[float]:
    """Proportions of a whole text that tell prose from noise."""
    text = text or ""
    words = text.split()
    letters = sum(map(str.isalpha, text))
    n_words, n_chars = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    lowered = [word.lower() for word in words]
    return [
        np.log1p(len(words)) / 10,
        letters / n_chars,
        sum(map(str.isupper, text)) / max(1, letters),
        len(SYMBOLS.findall(text)) / n_chars,
        sum(map(str.isdigit, text)) / n_chars,
        sum(1 for word in words if not any(map(str.isalnum, word))) / n_words,
        sum(1 for word in words if len(word) > 2 and not word[-2:].isalnum() and word[-1] == word[-2]) / n_words,
        len(set(lowered)) / n_words,
        sum(1 for a, b in zip(lowered, lowered[1:]) if a == b) / n_words,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(word[-1] in ".!?" for word in words) / n_words,
        len("".join(words)) / n_words / 20,
        float(not words),
    ]


def metadata_features(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """Source, language and length, the first two in hashed buckets of their own."""
    row = [0.0] * (2 * BUCKETS + 2)
    if source is not None:
        row[zlib.crc32(source.encode()) % BUCKETS] = 1.0
    if lang is not None:
        row[BUCKETS + zlib.crc32(lang.encode()) % BUCKETS] = 1.0
    row[-2] = float(np.log1p(max(0, n_chars or 0)) / 10)
    row[-1] = float(n_chars is None)
    return row


@dataclass
class View:
    """A logistic classifier over one view's standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 30) -> View:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        view = cls(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(x.shape[1] + 1))
        for _ in range(steps):
            if view.step(view.newton(x, y)) < 1e-7:
                break
        return view

    def newton(self, x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
        """How many rows, and the gradient and Hessian of their loss: one array, to be added up over rows."""
        design = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
        return np.concatenate([[len(x)], design.T @ (p - y), ((design.T * (p * (1 - p))) @ design).ravel()])

    def step(self, sums: np.ndarray) -> float:
        """Moves the weights by one Newton step from the sums over all rows; the step's largest part."""
        width = len(self.weights)
        pull = np.full(width, PULL)
        pull[0] = 1e-3
        gradient = sums[1:width + 1] + pull * self.weights
        step = np.linalg.solve(sums[width + 1:].reshape(width, width) + np.diag(pull), gradient)
        self.weights = self.weights - np.clip(step, -4, 4)
        return float(np.abs(step).max())

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + (x - self.mean) / self.scale @ self.weights[1:], -30, 30)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    values = np.asarray(column.flatten(), float)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def views(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, held_out, label, same, text_x, meta_x); the label only where it may be learnt from, same for equal texts."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    own = {name: F.col(name) if name in docs.columns else F.lit(None) for name in ("source", "lang", "n_chars")}
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"), own["source"].cast("string").alias("source"),
                       own["lang"].cast("string").alias("lang"), own["n_chars"].try_cast("long").alias("n_chars")) \
        .withColumn("same", F.xxhash64("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_x = [text_features(text.as_py()) for text in batch.column("text")]
            meta = zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), batch.column("same"), pa.array(text_x, kind),
                 pa.array([metadata_features(*m) for m in meta], kind)],
                ["id", "held_out", "same", "text_x", "meta_x"])

    found = rows.mapInArrow(work, "id long, held_out boolean, same long, text_x array<double>, meta_x array<double>")
    return found.join(marked, "id", "left") \
        .select("id", "held_out", F.when(~F.col("held_out"), F.col("label")).alias("label"), "same", "text_x", "meta_x")


def _taught(pool: DataFrame, teachers: dict[str, View], sureness: dict[str, View],
            train: dict[str, tuple[np.ndarray, np.ndarray]], confidence: float, steps: int = 30) -> dict[str, View]:
    """Each view fitted to its seed rows and to all rows of the pool that the other view is sure of.

    Newton's method: tasks sum gradients and Hessians over the pool, a row a task comes back.
    The taught rows of a label weigh ``TAUGHT_WEIGHT`` each, all of them at most what the seed
    rows of the label do, so that a large pool does not drown the given labels.
    """
    pupils = {c: View(view.mean, view.scale, view.weights.copy()) for c, view in teachers.items()}
    bar = float(np.log(confidence / (1 - confidence)))
    sizes = {c: 1 + len(view.weights) * (1 + len(view.weights)) for c, view in pupils.items()}
    shift = sum(sizes.values())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {c: np.zeros((2, size)) for c, size in sizes.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {c: matrix(batch.column(c)) for c in pupils}
            for teacher, pupil in EXCHANGE:
                logits = sureness[teacher].logits(teachers[teacher].logits(x[teacher])[:, None])
                for label, sure in enumerate((logits <= -bar, logits >= bar)):
                    if sure.any():
                        total[pupil][label] += pupils[pupil].newton(x[pupil][sure], label)
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate([total[c] for c in sizes], axis=1).tobytes()], pa.binary())], ["sums"])

    for _ in range(steps):
        found = np.zeros((2, shift))
        for row in pool.select(*pupils).mapInArrow(work, "sums binary").collect():
            found += np.frombuffer(row["sums"], float).reshape(2, shift)
        largest, at = 0.0, 0
        for c, view in pupils.items():
            x, y = train[c]
            sums = view.newton(x, y)
            for label, taught in enumerate(found[:, at:at + sizes[c]]):
                sums += min(TAUGHT_WEIGHT, (y == label).sum() / max(1.0, taught[0])) * taught
            at += sizes[c]
            largest = max(largest, view.step(sums))
        if largest < 1e-5:
            break
    return pupils


def co_train(table: DataFrame, rounds: int = ROUNDS, seed_docs: int = SEED_DOCS,
             confidence: float = CONFIDENCE) -> tuple[View, View, View] | None:
    """Both views and the weights that combine their logits; None unless both labels are known.

    The seed is bounded: about ``seed_docs`` labelled rows chosen by a hash of the id; every
    fifth calibrates and combines the views, the others train them. In each round either view
    scores all unlabelled rows, those with equal text and metadata once, and hands every one whose
    calibrated probability of a label is at least ``confidence`` to the other view, which is
    fitted anew to its seed rows and these. A view that is sure of nothing hands nothing over.
    """
    known = table.where("label is not null")
    size = known.count()
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    seed = known.where(chance < seed_docs / max(1, size)).select("id", "label", "text_x", "meta_x").orderBy("id").collect()
    labels = np.array([row["label"] for row in seed], float)
    if len(set(labels.tolist())) < 2:
        return None
    data = {c: np.array([row[c] for row in seed]) for c in ("text_x", "meta_x")}
    kept = np.array([zlib.crc32(str(row["id"]).encode()) // 4 % 5 == 0 for row in seed])
    if any(len(set(labels[part].tolist())) < 2 for part in (kept, ~kept)):
        kept[:] = False
    part = kept if kept.any() else ~kept
    train = {c: (data[c][~kept], labels[~kept]) for c in data}
    fitted = {c: View.fit(*train[c]) for c in train}
    # Copies tell no more than one of them, however many there are.
    unlabelled = table.where(F.col("label").isNull() & ~F.col("held_out") & F.col("id").isNotNull())
    pool = stored(unlabelled.select("same", "text_x", "meta_x").distinct(), "quality-pool")
    for _ in range(rounds):
        sureness = {c: View.fit(view.logits(data[c][part])[:, None], labels[part]) for c, view in fitted.items()}
        fitted = _taught(pool, fitted, sureness, train, confidence)
    dropped(pool)
    logits = np.column_stack([fitted[c].logits(data[c][part]) for c in ("text_x", "meta_x")])
    return fitted["text_x"], fitted["meta_x"], View.fit(logits, labels[part])


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, score, predicted, text_score, metadata_score.

    score is the combined probability of label 1 from both calibrated views. Null and empty
    texts are scored by their (empty) features. Without labels of both kinds all scores are
    0.5. The metadata are source, lang and n_chars where ``docs`` has them. Rows repeated
    under one id keep a row each, a null id counts as not held out, other columns are not read.
    """
    table = stored(views(docs, labels, id_col, text_col, label_col), "quality-views")
    model = co_train(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.zeros((batch.num_rows, 2))
            score = np.full(batch.num_rows, 0.5)
            if model is not None and batch.num_rows:
                text_view, meta_view, combined = model
                both = np.column_stack([text_view.logits(matrix(batch.column("text_x"))),
                                        meta_view.logits(matrix(batch.column("meta_x")))])
                score = 1 / (1 + np.exp(-combined.logits(both)))
            each = 1 / (1 + np.exp(-both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32)), pa.array(each[:, 0]), pa.array(each[:, 1])],
                [id_col, "held_out", "score", "predicted", "text_score", "metadata_score"])

    return table.select("id", "held_out", "text_x", "meta_x").mapInArrow(
        work, f"`{id_col}` long, held_out boolean, score double, predicted int, text_score double, metadata_score double")

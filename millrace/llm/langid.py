"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.storage import small_batches, stored, unused_name

UNKNOWN = "und"
GRAMS = (1, 2, 3)
PROFILE_SIZE = 400
DOCS_PER_LANGUAGE = 2000
# So many rows of two short columns may go to every task.
BROADCAST_LANGUAGES = 10_000
HELD_OUT = 2
CODE_BITS = 21
EDGE = 0x20


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for code in range(0x32400):
        table[code] = unicodedata.category(chr(code))[0] == "L"
    return table


_tables: dict[str, np.ndarray] = {}


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text's words, each run of other characters one space."""
    if "letters" not in _tables:
        _tables["letters"] = _letters()
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = np.where(_tables["letters"][codes], codes, np.uint64(EDGE))
    codes = np.concatenate([[np.uint64(EDGE)], codes, [np.uint64(EDGE)]])
    repeated = (codes[1:] == EDGE) & (codes[:-1] == EDGE)
    return codes[np.concatenate([[True], ~repeated])]


def grams(codes: np.ndarray) -> np.ndarray:
    """One number per n-gram, lengths 1 to 3; none spans two words."""
    shift = np.uint64(CODE_BITS)
    two = codes[:-1] << shift | codes[1:]
    three = two[:-1] << shift | codes[2:]
    inner = codes[1:-1] != EDGE
    return np.concatenate([codes[codes != EDGE], two, three[inner]])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the whole text in ascending order, and how often each occurs."""
    found = np.sort(grams(letter_codes(text or "")))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, int)
    return found[first], np.diff(first, append=len(found))


def most_frequent(names: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by number."""
    return names[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranked n-grams of each language, as one list in order of the n-grams."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.languages = sorted(ranked)
        self.size = size
        names = np.array([gram for name in self.languages for gram in ranked[name]], np.uint64)
        order = np.argsort(names, kind="stable")
        self.language = np.repeat(np.arange(len(self.languages)), [len(ranked[name]) for name in self.languages])[order]
        self.rank = np.array([rank for name in self.languages for rank in range(len(ranked[name]))], np.int64)[order]
        self.names, self.starts = np.unique(names[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(names))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, 1 - its distance as a share of the largest one possible, whether the text has a letter)."""
        names, counts = gram_counts(text)
        if not self.languages or not len(names):
            return UNKNOWN, 0.0, bool(len(names))
        top = most_frequent(names, counts, self.size)
        at = np.minimum(np.searchsorted(self.names, top), max(0, len(self.names) - 1))
        mine = np.flatnonzero(self.names[at] == top) if len(self.names) else np.zeros(0, np.int64)
        begin, many = self.starts[at[mine]], self.ends[at[mine]] - self.starts[at[mine]]
        entry = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        # An n-gram that both have is out of place by less than the size, one that a profile lacks by the size.
        nearer = self.size - np.abs(self.rank[entry] - np.repeat(mine, many))
        distance = self.size * len(top) - np.bincount(self.language[entry], nearer, len(self.languages)).astype(np.int64)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.size * len(top))), True


def held_out(id_col: str) -> Column:
    """Whether a row may not be learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def learn_profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   size: int = PROFILE_SIZE, docs_per_language: int = DOCS_PER_LANGUAGE) -> Profiles:
    """The ``size`` most frequent n-grams of every language in the rows not held out.

    Every non-null value of ``lang`` with a lettered text is a language, however few documents it has. Counts come from
    about ``docs_per_language`` documents of each, the documented bound of the sample, chosen
    by a hash of the id. Returns ``size`` numbers a language to the driver.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                F.col(lang_col).cast("string").alias("lang"))
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("docs")), "languages")
    shares = sizes.select("lang", (F.lit(docs_per_language) / F.col("docs")).alias("share"))
    if sizes.count() <= BROADCAST_LANGUAGES:
        # Else every text would move to its language's task.
        shares = F.broadcast(shares)
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    sample = rows.join(shares, "lang").where(chance < F.col("share")).select("lang", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for language, text in zip(batch.column("lang"), batch.column("text")):
                names, counts = gram_counts(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language.as_py()] * len(names), pa.string()), pa.array(names.astype(np.int64)),
                     pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.mapInArrow(work, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    ranked: dict[str, list[int]] = {}
    for row in best.select("lang", "gram", "rank").collect():
        ranked.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return Profiles({language: [gram for _, gram in sorted(found)] for language, found in ranked.items()}, size)


def language(profiles: Profiles, text: Column) -> Column:
    """A struct (lang_pred, score, lettered) of the whole text."""

    @F.pandas_udf("lang_pred string, score double, lettered boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score", "lettered"])

    # Else a filter on the result would run it a second time, below the projection.
    return predict.asNondeterministic()(text.cast("string"))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, lang_pred, score.

    lang_pred is a learnt language, or ``und`` with score 0 for texts that are null or have no
    letter and where no language was learnt (an empty table, no ``lang`` at all). Ties go to
    the language that sorts first. Rows repeated under one id keep a row each; a null id
    counts as not held out; other columns are not read.
    """
    profiles = learn_profiles(docs, id_col, text_col, lang_col)
    found = docs.select(F.col(id_col), held_out(id_col).alias("held_out"),
                        language(profiles, F.col(text_col)).alias("found"))
    return found.select(id_col, "held_out", "found.lang_pred", "found.score")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a letter, their language filled in where ``lang_col`` has none.

    Rows stay by their letters, whatever language is predicted: ``und`` may be a learnt label, and nothing may be
    learnt at all (then null languages stay null).
    """
    profiles = learn_profiles(docs, id_col, text_col, lang_col)
    found, row = unused_name(), unused_name()
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    kept = docs.select(whole.alias(row), language(profiles, F.col(text_col)).alias(found)).where(F.col(found)["lettered"])
    columns = {name: F.col(row).getField(name) for name in docs.columns}
    if profiles.languages:
        kind = docs.schema[lang_col].dataType
        columns[lang_col] = F.coalesce(columns[lang_col], F.col(found)["lang_pred"].try_cast(kind))
    return kept.select(*[column.alias(name) for name, column in columns.items()])

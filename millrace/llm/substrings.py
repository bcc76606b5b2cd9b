"""Removal of long passages that occur more than once, by recompression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.recompression import anchored_windows, window_fingerprints, word_fingerprints
from millrace.llm.storage import dropped, stored

WINDOW = 35
GROUP_BYTES = 1 << 21
WINDOWS_AT_ONCE = 1 << 16
# A stretch of windows as one number: the first window times STRETCH plus how many.
STRETCH = 1 << 16
ANCHOR_FIELDS = "key long, content long, id long, mark long, first int, count int"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart: the id, and a hash of the text for rows repeated under one id.

    Null ids are told apart by 128 bits: another hash of the text stands in for the id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    other = F.xxhash64(F.lit("no id"), text)
    return [F.coalesce(F.col(id_col).cast("long"), other).alias("id"), F.xxhash64(text).alias("mark"),
            text.alias("text")]


def anchors(rows: DataFrame, window: int) -> DataFrame:
    """The anchored stretches of windows of every text; documents are taken together up to a bounded size."""

    def group(ids: list, marks: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(words) for words in texts])
        starts = np.cumsum(sizes) - sizes
        words = np.concatenate(texts)
        apart = np.zeros(len(words), bool)
        apart[starts] = True
        found = anchored_windows(words, apart, window)
        doc = np.searchsorted(starts, found.first, "right") - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys.view(np.int64)), pa.array(found.content.view(np.int64)),
             pa.array(np.array(ids, np.int64)[doc]), pa.array(np.array(marks, np.int64)[doc]),
             pa.array((found.first - starts[doc]).astype(np.int32)), pa.array(found.count.astype(np.int32))],
            ["key", "content", "id", "mark", "first", "count"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, size = [], 0
            for key, mark, text in zip(batch.column("id").to_pylist(), batch.column("mark").to_pylist(),
                                       batch.column("text")):
                data = text.as_py().encode()
                words = word_fingerprints(data)
                if len(words) < window:
                    continue
                if waiting and size + len(data) > GROUP_BYTES:
                    yield group(*zip(*waiting))
                    waiting, size = [], 0
                waiting.append((key, mark, words))
                size += len(data)
            if waiting:
                yield group(*zip(*waiting))

    return rows.mapInArrow(work, ANCHOR_FIELDS)


def single_windows(texts: DataFrame, window: int) -> DataFrame:
    """(key, print, id, mark, first, times): every window of the wanted stretches of each text."""

    names = ["key", "print", "id", "mark", "first", "times"]

    def windows(key: int, mark: int, text: str, wanted: pa.StructArray) -> tuple[np.ndarray, ...]:
        words = word_fingerprints(text.encode())
        anchor, first, count, times = (np.asarray(wanted.field(name)) for name in ("key", "first", "count", "times"))
        at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        prints = window_fingerprints(words, at, window).view(np.int64)
        return (np.repeat(anchor, count), prints, np.full(len(at), key, np.int64), np.full(len(at), mark, np.int64),
                at.astype(np.int32), np.repeat(times, count))

    def joined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*parts)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for row in range(batch.num_rows):
                key, mark, text = (batch.column(name)[row].as_py() for name in ("id", "mark", "text"))
                parts.append(windows(key, mark, text, batch.column("wanted")[row].values))
                size += len(parts[-1][0])
                if size >= WINDOWS_AT_ONCE:
                    yield joined(parts)
                    parts, size = [], 0
            if parts:
                yield joined(parts)

    return texts.select("id", "mark", "text", "wanted") \
        .mapInArrow(work, "key long, print long, id long, mark long, first int, times long")


def repeated_stretches(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(id, mark, stretches): which windows of each text start elsewhere too.

    Anchors whose key occurs once cannot hang on a repeated window and go first. Of the others,
    stretches whose whole content (a second fingerprint, over all words of all their windows)
    occurs twice are repeated windows throughout. What is left is looked at window by window:
    one stretch of each content, for the keys that have contents occurring once.
    """
    rows = docs.select(*keyed(docs, id_col, text_col))
    every = stored(anchors(rows, window), "anchors")
    # Written, so that the join shuffles both sides by itself and may split a hot key's rows.
    shared = stored(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared-keys")
    suspects = stored(every.join(shared, "key"), "shared-anchors")
    dropped(every, shared)

    contents = stored(suspects.groupBy("key", "content").agg(
        F.count("*").alias("times"), F.min(F.struct("id", "mark", "first", "count")).alias("one")), "contents")
    twice = contents.where("times > 1").select("key", "content")
    whole = suspects.join(twice, ["key", "content"], "left_semi").select("id", "mark", "first", "count")

    unsettled = stored(contents.where("times = 1").select("key").distinct(), "unsettled-keys")
    wanted = contents.join(unsettled, "key", "left_semi") \
        .select("one.id", "one.mark", F.struct("key", "one.first", "one.count", "times").alias("stretch")) \
        .groupBy("id", "mark").agg(F.collect_list("stretch").alias("wanted"))
    windows = stored(single_windows(rows.join(wanted, ["id", "mark"]), window), "windows")
    common = stored(windows.groupBy("key", "print").agg(F.sum("times").alias("times")).where("times > 1")
                    .select("key", "print"), "repeated-windows")
    parts = windows.where("times = 1").join(common, ["key", "print"], "left_semi") \
        .select("id", "mark", "first", F.lit(1).alias("count"))

    stretch = F.col("first").cast("long") * STRETCH + F.col("count")
    # A set: rows that are equal throughout name the same stretches.
    found = stored(whole.unionByName(parts).groupBy("id", "mark").agg(F.collect_set(stretch).alias("stretches")),
                   "stretches")
    dropped(suspects, contents, unsettled, windows, common)
    return found


def cut(text: str | None, stretches: np.ndarray | None, window: int) -> tuple[str, int, int]:
    """(kept words joined by a space, number of words, number of removed words)."""
    words = (text or "").encode().split()
    if stretches is None or not len(stretches):
        return b" ".join(words).decode(), len(words), 0
    found = np.asarray(stretches, np.int64)
    first, count = found // STRETCH, found % STRETCH
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + count + window - 1, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept]).decode(), len(words), len(words) - len(kept)


def with_cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """(row, cut): every row of ``docs`` as a struct, with kept, n_words and n_removed of its text.

    A word is removed if a window of ``window`` consecutive words that covers it also starts
    anywhere else, in the same document or another; windows are judged on the input. Null and
    empty texts have no words. Rows repeated under one id are documents of their own, so that
    equal texts remove each other. An empty table gives an empty result; columns besides id
    and text only pass through.
    """
    found = repeated_stretches(docs, id_col, text_col, window)

    @F.pandas_udf("kept string, n_words long, n_removed long")
    def cut_text(texts: pd.Series, stretches: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(t, s, window) for t, s in zip(texts, stretches)],
                            columns=["kept", "n_words", "n_removed"])

    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    joined = docs.select(row, *keyed(docs, id_col, text_col)).join(found, ["id", "mark"], "left")
    return joined.select("row", cut_text("text", "stretches").alias("cut"))


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """(``id_col``, n_words, n_removed, kept): see ``with_cut_texts``."""
    narrow = docs.select(F.col(id_col), F.col(text_col))
    return with_cut_texts(narrow, id_col, text_col, window) \
        .select(F.col("row").getField(id_col).alias(id_col), "cut.n_words", "cut.n_removed", "cut.kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts; texts without any stay as they are.

    ``length_col``, where it is there, follows the new texts.
    """
    found = with_cut_texts(docs, id_col, text_col, window)
    changed = F.col("cut.n_removed") > 0
    columns = {name: F.col("row").getField(name) for name in docs.columns}
    columns[text_col] = F.when(changed, F.col("cut.kept")).otherwise(columns[text_col])
    if length_col in columns:
        kind = docs.schema[length_col].dataType
        columns[length_col] = F.when(changed, F.length("cut.kept").cast(kind)).otherwise(columns[length_col])
    return found.select(*[column.alias(name) for name, column in columns.items()])

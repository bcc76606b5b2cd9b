"""Periodic runs in word sequences, by maximal pairs over the tree of LCP intervals."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.storage import small_batches

WORD = re.compile("[^\x20\x09-\x0D]+")
LEAST_LENGTH = 24
LEAST_EXPONENT = 3
ROWS_OUT = 256

RUN = "start long, length long, period long"


def words_of(key: object, text: str | None) -> list[str]:
    return WORD.findall(text or "")


def least_shared(least_length: int, least_exponent: int) -> int:
    """Fewest words that two suffixes share if they begin one period apart in a run."""
    return min(max(least_length - period, (least_exponent - 1) * period)
               for period in range(1, max(2, least_length + 1)))


def numbered(words: Sequence[str]) -> np.ndarray:
    names: dict[str, int] = {}
    return np.fromiter((names.setdefault(word, len(names)) for word in words), np.int64, len(words))


def repeated_suffixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``least`` words stand elsewhere too, sorted by suffix, and what neighbours share.

    Ranks double the words they look at each round; only suffixes that still tie are sorted
    again, so a text without long repeats is left after a few rounds. The k-th ranks tell
    whether 2**k words agree, from which the shared lengths follow without a scan.
    """
    size = len(ids)
    starts = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    ranks = [np.append(starts[ids], -1)]
    tied = np.flatnonzero(np.diff(starts)[ids] > 1)
    suffixes, step = tied, 1
    while len(tied):
        if step <= least:
            suffixes = tied
        first, second = ranks[-1][tied], ranks[-1][tied + step]
        order = np.lexsort((second, first))
        tied, first, second = tied[order], first[order], second[order]
        group = np.concatenate([[True], first[1:] != first[:-1]])
        part = group | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(tied))
        begins = np.maximum.accumulate(np.where(part, at, 0))
        rank = ranks[-1].copy()
        rank[tied] = first + begins - np.maximum.accumulate(np.where(group, at, 0))
        ranks.append(rank)
        ends = np.append(part[1:], True)
        tied = np.sort(tied[~(part & ends)])
        step *= 2
    if step <= least or not len(suffixes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    suffixes = suffixes[np.argsort(ranks[-1][suffixes])]
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    shared = np.zeros(len(left), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        agree = np.flatnonzero(ranks[level][left] == ranks[level][right])
        for places in (left, right, shared):
            places[agree] += 1 << level
    return suffixes, np.concatenate([[0], shared])


def runs_of(ids: np.ndarray, least_length: int = LEAST_LENGTH,
            least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    Two places form a maximal pair if the words that follow agree as far as an LCP interval
    is deep, the places lie in different children of the interval (no longer agreement) and in
    different classes of the word to their left. If they are q apart and share at
    least (least_exponent - 1) * q words, the stretch from the first place to the end of the
    second one's agreement has period q and no neighbour extends it: it is a run.

    Each interval keeps its places in text order and the class of each. The start of a run and
    the place one smallest period later have no other place of their interval between them, as that
    would give the stretch a smaller period. So of a place only the nearest
    of the other child need be compared. A multiple of the smallest period may
    come up too; the smallest of a stretch counts.
    """
    least = least_shared(least_length, least_exponent)
    suffixes, shared = repeated_suffixes(ids, least)
    left_class = np.concatenate([[-1], ids]).tolist()
    found: dict[tuple[int, int], int] = {}

    def pair(first: int, second: int, depth: int) -> None:
        period = second - first
        if (least_exponent - 1) * period <= depth and depth + period >= least_length \
                and left_class[first] != left_class[second]:
            stretch = (first, second + depth)
            found[stretch] = min(period, found.get(stretch, period))

    def joined(one: list[int], other: list[int], depth: int) -> list[int]:
        """The places of two children as one list, after the pairs between them."""
        few, many = (one, other) if len(one) < len(other) else (other, one)
        places = [bisect_left(many, place) for place in few]
        for place, at in zip(few, places):
            if at:
                pair(many[at - 1], place, depth)
            if at < len(many):
                pair(place, many[at], depth)
        if len(few) * 16 > len(many):
            many.extend(few)
            many.sort()
        else:
            for place, at in zip(reversed(few), reversed(places)):
                many.insert(at, place)
        return many

    open_intervals: list[tuple[int, list[int]]] = []
    child: list[int] = []
    for place, depth in zip([*suffixes.tolist(), -1], [*shared.tolist(), 0]):
        while open_intervals and open_intervals[-1][0] > depth:
            deeper, places = open_intervals.pop()
            child = joined(places, child, deeper)
        if depth >= least:
            if open_intervals and open_intervals[-1][0] == depth:
                child = joined(open_intervals.pop()[1], child, depth)
            open_intervals.append((depth, child))
        child = [place]
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(words: Sequence[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words outside of all runs and in the first period of one, unless another run drops them."""
    if not runs:
        return list(words)
    covered = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        covered[start + period] += 1
        covered[start + length] -= 1
    drop = np.cumsum(covered)[:-1] > 0
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT,
                  words: Callable[[object, str | None], list[str]] = words_of) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, runs, collapsed.

    ``runs`` holds (start, length, period) of every stretch of at least ``least_length`` words
    and ``least_exponent`` smallest periods that no neighbouring word extends, by start, then
    period; ``collapsed`` is the text with each run cut to its first period, words joined by
    one space. ``words`` splits a text, given its id. Null and empty texts have no runs and an
    empty collapsed text. Whole texts are searched, in time that grows with their length and the
    logarithm of their longest repeat. Repeated rows and null ids keep a row each, an empty
    table gives an empty result, other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(offset, ROWS_OUT)
                runs, kept = [], []
                for key, text in zip(part.column("key").to_pylist(), part.column("text")):
                    own = words(key, text.as_py())
                    found = runs_of(numbered(own), least_length, least_exponent)
                    runs.append([dict(zip(("start", "length", "period"), run)) for run in found])
                    kept.append(" ".join(collapsed(own, found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(runs, run_type), pa.array(kept, pa.string())],
                    ["key", "runs", "collapsed"])

    schema = T.StructType([T.StructField("key", kind),
                           T.StructField("runs", T.ArrayType(T.StructType.fromDDL(RUN))),
                           T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(work, schema).withColumnRenamed("key", id_col)


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length/period, of equal ones the first; null if there is none."""
    column = F.col(runs)

    def better(best: Column, run: Column) -> Column:
        stronger = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | stronger, run).otherwise(best)

    return F.aggregate(column, F.get(column, F.lit(0)), better)


def run_lines(runs: str = "runs") -> Column:
    """Every run as a line of start, length and period."""
    lines = F.transform(runs, lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    return F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")

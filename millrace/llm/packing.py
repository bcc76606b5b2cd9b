"""Best-fit packing of token sequences by exact complements."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder
from millrace.llm.storage import shuffle_partitions, stored

CAPACITY = 4096
END_ID = 1

Pattern = tuple[int, ...]


class Complements:
    """Finds one, two or three available lengths whose sum is a gap.

    Availability only falls, so a gap without an answer never gets one again.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts = Counter({length: n for length, n in counts.items() if n > 0})
        self.there = np.zeros(capacity + 1, bool)
        self.there[list(self.counts)] = True
        self.hopeless: set[tuple[int, int]] = set()

    def take(self, pattern: Pattern, times: int) -> None:
        for length, each in Counter(pattern).items():
            self.counts[length] -= each * times
            self.there[length] = self.counts[length] > 0

    def times(self, pattern: Pattern) -> int:
        return min(self.counts[length] // each for length, each in Counter(pattern).items())

    def find(self, first: int, gap: int, size: int) -> Pattern | None:
        """``first`` and ``size`` more lengths that fill ``gap``; None if there are none."""
        if size == 1:
            return self._usable((first, gap)) if self.there[gap] else None
        if (gap, size) in self.hopeless:
            return None
        found = self._pair((first,), gap) if size == 2 else self._triple(first, gap)
        if found is None:
            self.hopeless.add((gap, size))
        return found

    def _usable(self, pattern: Pattern) -> Pattern | None:
        return pattern if self.times(pattern) > 0 else None

    def _pair(self, before: Pattern, gap: int) -> Pattern | None:
        half = gap // 2
        low = np.flatnonzero(self.there[1:half + 1] & self.there[gap - half:gap][::-1]) + 1
        for a in low[::-1].tolist():
            if self.times((*before, gap - a, a)) > 0:
                return (*before, gap - a, a)
        return None

    def _triple(self, first: int, gap: int) -> Pattern | None:
        for a in np.flatnonzero(self.there[:gap - 1])[::-1].tolist():
            if 3 * a < gap:
                return None
            if (found := self._pair((first, a), gap - a)) is not None:
                return found
        return None


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """(lengths of a sequence, how many such sequences), using every available length up.

    Filling gaps with up to three lengths may spend short pieces that other gaps need more, so
    plans with fillings of up to three, two and one lengths, and of none, are made; the first
    with the fewest sequences counts.
    """
    plans = [complement_plan(counts, capacity, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def complement_plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[Pattern, int]]:
    """From the longest length down, gaps are filled exactly by one to ``most`` other lengths as long as
    the counts allow it; what is left is packed by best fit decreasing."""
    index = Complements(counts, capacity)
    plan: list[tuple[Pattern, int]] = []
    for length in sorted(index.counts, reverse=True):
        if length == capacity:
            plan.append(((length,), index.counts[length]))
            index.take((length,), index.counts[length])
        for size in range(1, most + 1):
            while index.counts[length] > 0 and length < capacity:
                found = index.find(length, capacity - length, size)
                if found is None:
                    break
                times = index.times(found)
                plan.append((found, times))
                index.take(found, times)
    return plan + best_fit({length: n for length, n in index.counts.items() if n > 0}, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing over lengths with counts, alike sequences handled together."""
    open_by_gap: dict[int, list[tuple[Pattern, int]]] = {}
    gaps: list[int] = []

    def put(pattern: Pattern, times: int) -> None:
        gap = capacity - sum(pattern)
        if times > 0:
            if gap not in open_by_gap:
                open_by_gap[gap] = []
                insort(gaps, gap)
            open_by_gap[gap].append((pattern, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            place = bisect_left(gaps, length)
            if place == len(gaps):
                each = capacity // length
                put((length,) * each, left // each)
                put((length,) * (left % each), 1 if left % each else 0)
                break
            gap = gaps[place]
            pattern, times = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap], gaps[place]
            each = gap // length
            if left >= each:
                used = min(times, left // each)
                put(pattern + (length,) * each, used)
                left -= used * each
            else:
                used = 1
                put(pattern + (length,) * left, 1)
                left = 0
            put(pattern, times - used)
    return [entry for group in open_by_gap.values() for entry in group]


def slots(plan: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """For each length, columns (first rank, first sequence, pieces a sequence, offset), ranks ascending."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length, each in Counter(pattern).items():
            rows.setdefault(length, []).append((ranks[length], sequence, each, offset))
            ranks[length] += each * times
            offset += each * length
        sequence += times
    return {length: np.array(found, np.int64).T for length, found in rows.items()}


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each text's ids and the end id, cut at the capacity."""
    kind = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                data = coder.id_bytes(text.as_py()) + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part))
                                + ((np.frombuffer(part, "<u4").astype(np.int32),) if keep_ids else ()))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*rows)) or [[]] * (6 if keep_ids else 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names[:len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, kind)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every piece with its place: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    Only the count of every length (at most ``capacity`` numbers) meets on the driver, which
    plans how many sequences of which lengths to make. Pieces of a length are numbered by salt
    and find their slot by that number, so no length gathers in a task however common it is.
    Null and empty texts are one piece with the end id alone; rows repeated under one id are
    packed as rows of their own; an empty table gives an empty result; other columns are not
    read.
    """
    pieces = stored(token_pieces(docs, path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    salt = F.pmod(F.xxhash64("id", "piece", "start"), F.lit(shuffle_partitions(docs.sparkSession))).cast("int")
    salted = pieces.withColumn("salt", salt)
    sizes = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    counts = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(packing_plan(counts, capacity))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    starts = sizes.select("length", "salt", before.alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    ranked = salted.withColumn("at", F.row_number().over(order) - 1).join(starts, ["length", "salt"]) \
        .withColumn("at", F.col("at") + F.col("before")).drop("salt", "before")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "at"))
            sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                first, base, each, place = places[length]
                slot = np.searchsorted(first, ranks[rows], "right") - 1
                inside = ranks[rows] - first[slot]
                sequence[rows] = base[slot] + inside // each[slot]
                offset[rows] = place[slot] + length * (inside % each[slot])
            yield batch.drop_columns(["at"]).append_column("sequence_id", pa.array(sequence)) \
                .append_column("offset", pa.array(offset))

    kept = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    kind = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    found = ranked.select(*kept, "at").mapInArrow(work, kind + ", sequence_id long, offset long")
    return found.withColumnRenamed("id", id_col)

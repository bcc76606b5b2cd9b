"""Near-duplicates by SimHash: pigeonhole blocks propose pairs, the Hamming distance decides."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.storage import chosen_rows, stored

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 7
SEED = 42
TILE = 512
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text; zero if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = words[start:min(start + SHINGLES_AT_ONCE, total) + shingle - 1]
        if len(words) < shingle:
            joined = [b" ".join(words)]
        else:
            joined = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in joined], np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, mark, fp): a hash of every row's text, and the fingerprint of the whole text as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(found.view(np.int64))],
                                             ["id", "mark", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    return rows.mapInArrow(work, "id long, mark long, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Every union of ``blocks - max_bits`` of the blocks that 64 bits are cut into.

    Two fingerprints that differ in ``max_bits`` bits or fewer agree on at least
    ``blocks - max_bits`` blocks, hence on all bits of one of these unions.
    """
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def close_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that keep all links connected.

    All pairs that share a block union are compared, and within each compared set a spanning
    forest of the links is returned instead of the links. A union shared by more than
    ``tile`` fingerprints is cut into tiles, every two of which meet in a task of their own.
    """
    masks = [mask - (1 << 64) if mask >> 63 else mask for mask in block_masks(blocks, max_bits)]
    unions = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask))) for i, mask in enumerate(masks)])
    keyed = prints.select("fp", F.explode(unions).alias("union"))
    # Written, so that the join shuffles both sides by itself and may split a hot union's rows.
    shared = stored(keyed.groupBy("union").agg(F.count("*").alias("n")).where("n > 1")
                    .select("union", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "shared-unions")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                        lambda t: F.struct(F.least(t, F.col("own")).alias("x"), F.greatest(t, F.col("own")).alias("y")))
    met = keyed.join(shared, "union").withColumn("own", own).select("union", F.explode(pairs).alias("pair"), "fp") \
        .select("union", "pair.x", "pair.y", "fp")
    met = met.repartition("union", "x", "y").sortWithinPartitions("union", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((4, 0), np.int64)
        for batch in batches:
            rows = np.stack([np.asarray(c).astype(np.int64) for c in batch.columns])
            rows = np.concatenate([kept, rows], axis=1)
            change = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
            last = change[-1] if len(change) else 0
            yield edge_batch(rows[3, :last].view(np.uint64), np.concatenate([[0], change])[:-1 if len(change) else 0],
                             max_bits)
            kept = rows[:, last:]
        yield edge_batch(kept[3].copy().view(np.uint64), np.zeros(min(1, kept.shape[1]), np.int64), max_bits)

    return met.mapInArrow(work, "a long, b long").distinct()


def edge_batch(prints: np.ndarray, starts: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Spanning edges of the groups that begin at ``starts``."""
    ends = np.append(starts[1:], len(prints))
    edges = []
    two = starts[ends - starts == 2]
    near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= max_bits
    edges.append((prints[two][near], prints[two + 1][near]))
    for start, end in zip(starts.tolist(), ends.tolist()):
        if end - start > 2:
            edges.append(spanning_edges(prints[start:end], max_bits))
    a = np.concatenate([x for x, _ in edges]).view(np.int64)
    b = np.concatenate([y for _, y in edges]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def spanning_edges(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """From each fingerprint of a group to the first one of its connected part."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= max_bits
    label = np.arange(len(prints))
    while True:
        least = np.where(near, label[None, :], len(prints)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(prints))
    return prints[moved], prints[label[moved]]


def linked_prints(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(fp, component): the component of every distinct fingerprint of ``prints`` (id, fp)."""
    distinct = stored(prints.select("fp").distinct(), "distinct-prints")
    stars = connected_components(close_links(distinct, max_bits, blocks))
    return distinct.join(stars.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("component", "fp").alias("component"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most ``max_bits`` bits. Null
    and word-free texts have fingerprint zero, which is linked like any other. Rows repeated
    under one id keep a row each; null ids reach the smallest id of their component and are
    never it, unless there is no other (then null). An empty table gives an empty result;
    other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    placed = linked_prints(prints, max_bits, blocks)
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    # Written, so that the join shuffles both sides by itself and may split a hot component's fingerprints.
    placed = stored(placed, "placed-prints")
    roots = stored(least.join(placed, "fp").groupBy("component").agg(F.min("least").alias("component_id")), "roots")
    named = placed.join(roots, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col),
                                           F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                        max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The row with the smallest id of every component, with the columns of ``docs``.

    A row without an id stays only if its component has no other; of rows repeated under the
    smallest id one stays.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    placed = linked_prints(prints, max_bits, blocks)
    least = prints.groupBy("fp").agg(F.min(F.struct(F.isnull("id"), "id", "mark")).alias("least"))
    kept = least.join(placed, "fp").groupBy("component").agg(F.min("least").alias("least"))
    every = prints.select(F.col("id").alias("k0"), F.col("mark").alias("k1"))
    chosen = stored(kept.select(F.col("least.id").alias("k0"), F.col("least.mark").alias("k1")), "simhash-kept")
    keys = [F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))]
    return chosen_rows(docs, keys, every, chosen)

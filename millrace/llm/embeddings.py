"""Near-duplicate vectors by cosine, found by a dual traversal of cover trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.covertree import (MATRIX_ROWS, Links, Tree, build, distances, dual_traversal,
                                    roots)
from millrace.llm.storage import dropped, small_batches, stored

LEAST_COSINE = 0.95
TILE = 8192
MAX_CELLS = 4096
SAMPLE_PER_CELL = 8
# Distances come from rounded cosines: a bound is let pass by this much, links are decided by the cosine itself.
SLACK = 1e-6
# Of rows without a vector.
NO_CELL = -1
# Of trees that a task holds while it meets others, and tasks for every core, so that none waits long for the last.
BYTES_HELD = 64 * 1024 * 1024
TASKS_PER_CORE = 16


def numbered(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, name, vector): one row per row, numbered by ``id``; ``name`` is the row's own id, which others may share.

    Floats stay floats, as they take half the room, and are made doubles with the unit vectors.
    """
    kind = vectors.select(F.col(vector_col).alias("vector")).schema["vector"].dataType.simpleString()
    return vectors.select(F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("long").alias("name"),
                          F.col(vector_col).cast(kind if kind == "array<float>" else "array<double>").alias("vector"))


def units_of(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, zeros where there is none to link, and which rows have one. Shorter vectors end in zeros."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    values = column.flatten()
    filled = np.arange(width) < lengths[:, None]
    padded = np.zeros((len(column), width))
    padded[filled] = np.asarray(pc.fill_null(values, float("nan")))
    scale = np.abs(padded).max(axis=1, initial=0.0)
    # The largest of a row is NaN or infinite if any of it is.
    valid = np.isfinite(scale) & (scale > 0)
    padded[~valid], scale[~valid] = 0.0, 1.0
    padded /= scale[:, None]
    padded[valid] /= np.sqrt(np.einsum("ij,ij->i", padded[valid], padded[valid]))[:, None]
    return padded, valid


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Points each as far as possible from those before it, so that any beginning is a net."""
    chosen = [0]
    nearest = distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        far = int(nearest.argmax())
        if nearest[far] <= SLACK:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, distances(points, points[far:far + 1])[:, 0])
    return points[chosen]


def sampled(rows: DataFrame, width: int, share: float) -> np.ndarray:
    """About a ``share`` of the unit vectors, of a bounded number; one at least, of zeros if there is none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, valid = units_of(batch.column("vector"), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(valid)), pa.array([unit.tobytes() for unit in units[valid]], pa.binary())],
                ["id", "unit"])

    def units(some: DataFrame) -> DataFrame:
        return some.select("id", "vector").mapInArrow(work, "id long, unit binary")

    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    found = units(rows.where(chance <= share)).orderBy("id").limit(2 * SAMPLE_PER_CELL * MAX_CELLS).collect() \
        or units(rows).limit(1).collect()
    return np.stack([np.frombuffer(row["unit"], float) for row in found]) if found else np.zeros((1, width))


def nearest(units: np.ndarray, valid: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of every vector and the distance to it; ``NO_CELL`` and zero without a vector."""
    cell, far = np.full(len(units), NO_CELL, np.int32), np.zeros(len(units))
    for start in range(0, len(units), MATRIX_ROWS):
        rows = start + np.flatnonzero(valid[start:start + MATRIX_ROWS])
        apart = distances(units[rows], pivots)
        cell[rows] = apart.argmin(axis=1)
        far[rows] = apart[np.arange(len(rows)), cell[rows]]
    return cell, far


def cell_sizes(rows: DataFrame, width: int, pivots: np.ndarray) -> dict[int, int]:
    """How many vectors every cell has; rows without one count for ``NO_CELL``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(pivots) + 1, np.int64)
        for batch in batches:
            cell, _ = nearest(*units_of(batch.column("vector"), width), pivots)
            sizes += np.bincount(cell - NO_CELL, minlength=len(sizes))
        cells = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array((cells + NO_CELL).astype(np.int32)), pa.array(sizes[cells])], ["cell", "n"])

    found = rows.select("vector").mapInArrow(work, "cell int, n long")
    return {row["cell"]: row["n"] for row in found.groupBy("cell").agg(F.sum("n").alias("n")).collect()}


def placed_vectors(rows: DataFrame, width: int, pivots: np.ndarray, tiles: dict[int, int]) -> DataFrame:
    """(cell, tile, far, id, name, vector): the cell of every row, dealt by its number to the cell's ``tiles``, numbered over all cells."""
    counts = np.ones(len(pivots) + 1, np.int64)
    counts[np.array(list(tiles), np.int64) - NO_CELL] = list(tiles.values())
    firsts = np.cumsum(counts) - counts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = nearest(*units_of(batch.column("vector"), width), pivots)
            mixed = (np.asarray(batch.column("id")).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            tile = firsts[cell - NO_CELL] + mixed.astype(np.int64) % counts[cell - NO_CELL]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(tile.astype(np.int32)), pa.array(far), batch.column("id"), batch.column("name"),
                 batch.column("vector")], ["cell", "tile", "far", "id", "name", "vector"])

    kind = rows.schema["vector"].dataType.simpleString()
    placed = rows.mapInArrow(work, f"cell int, tile int, far double, id long, name long, vector {kind}")
    return placed.repartitionById(int(counts.sum()), "tile")


def trees(tiles: DataFrame, width: int, pivots: np.ndarray) -> DataFrame:
    """(cell, tile, pivot, radius, ids, names, points, levels): the cover tree of each tile, a partition of ``tiles``, as one row.

    The radius covers the tile around its cell's pivot. Rows without a vector have rows of their own, without a tree.
    """

    def listed(values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def tree_row(part: pa.RecordBatch) -> pa.RecordBatch:
        cell, tile = part.column("cell")[0].as_py(), part.column("tile")[0].as_py()
        first = np.argsort(np.asarray(part.column("id")))
        levels: list[np.ndarray] = []
        if cell == NO_CELL:
            order, points, pivot = first, np.zeros(0), np.zeros(0)
        else:
            units, _ = units_of(part.column("vector"), width)
            tree, inner = build(units[first])
            order, points, levels, pivot = first[inner], tree.points, tree.starts, pivots[cell]
        place = pa.array(order)
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int32()), pa.array([tile], pa.int32()), listed(pa.array(pivot)),
             pa.array([pc.max(part.column("far")).as_py()]), listed(part.column("id").take(place)),
             listed(part.column("name").take(place)), pa.array([points.tobytes()]),
             pa.array([[level.tolist() for level in levels]], pa.list_(pa.list_(pa.int32())))],
            ["cell", "tile", "pivot", "radius", "ids", "names", "points", "levels"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if parts:
            yield tree_row(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])

    return tiles.mapInArrow(work, "cell int, tile int, pivot array<double>, radius double, ids array<long>, names array<long>, "
                                  "points binary, levels array<array<int>>")


def tile_pairs(grown: DataFrame, parts: int, reach: float) -> DataFrame:
    """Pairs of trees whose tiles come near enough by their pivots and radii, each pair once, columns ending in _a and _b.

    The join reads the stored trees once more for each of ``parts`` partitions of them, and neither shuffles nor writes
    them: a shuffle would hold every tree once for each tree that it meets.
    """
    a, b = (grown.coalesce(parts).where(F.col("cell") != NO_CELL)
            .select(*[F.col(name).alias(f"{name}_{side}") for name in grown.columns if name != "names"]) for side in "ab")
    cosine = F.aggregate(F.zip_with("pivot_a", "pivot_b", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    apart = F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * cosine))
    near = apart <= F.col("radius_a") + F.col("radius_b") + F.lit(reach)
    return a.join(b.hint("shuffle_replicate_nl"), (F.col("tile_a") <= F.col("tile_b")) & near)


def links_of_pairs(pairs: DataFrame, least_cosine: float, reach: float) -> DataFrame:
    """(id, n_links, other): of each vector its links within a pair of tiles, and a vector it is connected with."""

    def side(batch: pa.RecordBatch, row: int, name: str) -> tuple[np.ndarray, Tree]:
        ids = np.asarray(batch.column(f"ids_{name}")[row].values)
        points = np.frombuffer(batch.column(f"points_{name}")[row].as_buffer(), float).reshape(len(ids), -1)
        return ids, Tree(points, [np.asarray(level.values) for level in batch.column(f"levels_{name}")[row]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                (ids_a, tree_a), (ids_b, tree_b) = (side(batch, row, name) for name in "ab")
                same = batch.column("tile_a")[row] == batch.column("tile_b")[row]
                links = Links(len(ids_a), len(ids_b), least_cosine, same)
                dual_traversal(tree_a, tree_b, links, reach)
                shift = 0 if same else len(ids_a)
                ids = ids_a if same else np.concatenate([ids_a, ids_b])
                edges = np.concatenate([e + np.array([[0], [shift]]) for e in links.edges], axis=1) \
                    if links.edges else np.zeros((2, 0), np.int64)
                count = links.count_a if same else np.concatenate([links.count_a, links.count_b])
                linked = np.flatnonzero(count)
                root = roots(len(ids), edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[linked]), pa.array(count[linked]), pa.array(ids[root[linked]])],
                    ["id", "n_links", "other"])

    columns = [f"{name}_{side}" for side in "ab" for name in ("tile", "ids", "points", "levels")]
    return pairs.select(*columns).mapInArrow(work, "id long, n_links long, other long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           least_cosine: float = LEAST_COSINE, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, n_links, component_id, kept.

    Vectors link where their cosine, in double precision, is at least ``least_cosine``.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows
    repeated under one id are vectors of their own, which link like others. component_id is the smallest id of the
    component, null ids aside (null if it has no other); an empty table gives an empty result; other columns are not read.

    The tree's upper level are cells around pivots, a net of a bounded sample (at most
    ``SAMPLE_PER_CELL`` * ``MAX_CELLS`` vectors), so pivots are small enough to go to every task. Cells are cut into
    tiles of about ``tile`` vectors, each with a cover tree of its own; tile pairs are cut by the tiles' covering
    radii, node pairs by the nodes'. The vectors are shuffled and stored once, as trees, which is all that the disk
    holds of them. No pair of vectors is returned: a task counts links and names one connected vector for each.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = numbered(vectors, id_col, vector_col)
    width, size = rows.agg(F.greatest(F.max(F.size("vector")), F.lit(0)), F.count("vector")).first()
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * least_cosine))) + SLACK
    wanted = max(1, min(MAX_CELLS, -(-size // tile)))
    share = min(1.0, SAMPLE_PER_CELL * wanted / max(1, size) + 64 / max(1, size))
    pivots = farthest_first(sampled(rows, width, share), wanted)

    # The input is read again rather than kept as unit vectors, which would take more room than it does.
    tiles = {cell: -(-n // tile) for cell, n in cell_sizes(rows, width, pivots).items()}
    grown = stored(trees(placed_vectors(rows, width, pivots, tiles), width, pivots), "cover-trees")
    held = -(-size * (8 * width + 16) // BYTES_HELD)
    parts = max(1, held, math.isqrt(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    found = stored(links_of_pairs(tile_pairs(grown, parts, reach), least_cosine, reach), "vector-links")

    counted = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    stars = connected_components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = grown.select(F.inline(F.arrays_zip("ids", "names")).alias("id", "name"))
    placed = stored(named.join(counted, "id", "left")
                    .join(stars.withColumnRenamed("node", "id"), "id", "left")
                    .select("name", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                            F.coalesce("component", "id").alias("component")), "vector-components")
    dropped(grown, found)
    least = stored(placed.groupBy("component").agg(F.min("name").alias("component_id")), "component-names")
    return placed.join(least, "component").select(F.col("name").alias(id_col), "n_links", "component_id",
                                                  F.col("name").eqNullSafe(F.col("component_id")).alias("kept"))

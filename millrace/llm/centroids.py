"""Centroid clustering in whole numbers, with centroids filtered by n-simplex projection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import small_batches, stored

WIDTH = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
PIVOTS = 8
# Squared distances must fit a long: 64 differences of at most 2**28 do.
LARGEST = 1 << 27
SEED = "1:"
# A pivot counts if it lies this far from the span of those before it, as a share of the largest distance.
LEAST_HEIGHT = 0.1
# Apex coordinates are rounded; bounds give way by this share of the squares involved, times how much farther
# away than the pivots are from each other a point lies.
SLACK = 1e-6


class Simplex:
    """Base simplex of some pivots, and the apex coordinates of points above it.

    With n pivots a point's distances to them give n coordinates: its projection
    into the pivots' span, and its height above it.
    """

    def __init__(self, points: np.ndarray, count: int = PIVOTS):
        """Picks up to ``count`` pivots of the points, each one far from the span of those before it."""
        self.pivots = points[:1].astype(float)
        self.corners = np.zeros((len(self.pivots), 0))
        self.widest = np.sqrt(squares(points.astype(float), points.astype(float)).max(initial=0.0))
        while 0 < len(self.pivots) < count:
            apexes = self.apexes(points)
            farthest = int(apexes[:, -1].argmax())
            if apexes[farthest, -1] <= LEAST_HEIGHT * self.widest:
                break
            self.corners = np.vstack([np.pad(self.corners, ((0, 0), (0, 1))), apexes[farthest]])
            self.pivots = np.vstack([self.pivots, points[farthest].astype(float)])

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """Coordinates of every point from its distances to the pivots."""
        if not len(self.pivots):
            return np.zeros((len(points), 1))
        distances = squares(points.astype(float), self.pivots)
        base = self.corners[1:]
        lengths = (base ** 2).sum(axis=1)
        inside = np.zeros((len(points), len(base)))
        for axis in range(len(base)):
            known = inside[:, :axis] @ base[axis, :axis]
            inside[:, axis] = ((distances[:, 0] - distances[:, axis + 1] + lengths[axis]) / 2 - known) / base[axis, axis]
        height = np.sqrt(np.maximum(distances[:, 0] - (inside ** 2).sum(axis=1), 0))
        return np.hstack([inside, height[:, None]])

    def room(self, apexes: np.ndarray) -> np.ndarray:
        """How far rounding may be off in squared distances from points with these apexes."""
        size = (apexes ** 2).sum(axis=1)
        return SLACK * (1 + size) * np.maximum(1, np.sqrt(size) / max(self.widest, 1.0))


def squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all rows, one right row at a time."""
    found = np.empty((len(left), len(right)))
    for column, row in enumerate(right):
        found[:, column] = ((left - row) ** 2).sum(axis=1)
    return found


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of points that have these apexes, squared.

    Both heights point to the same side in the nearest case and to opposite sides in the farthest.
    """
    flat = squares(apexes[:, :-1], others[:, :-1])
    mine, theirs = apexes[:, -1:], others[:, -1]
    return flat + (mine - theirs) ** 2, flat + (mine + theirs) ** 2


def nearest(simplex: Simplex, vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            others: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact comparisons made); ties go to the smaller number.

    A centroid whose least distance exceeds another's greatest is out; the others are compared in whole numbers.
    """
    low, high = bounds(apexes, others)
    room = simplex.room(apexes)[:, None] + simplex.room(others)
    open_pairs = low - room <= (high + room).min(axis=1)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    chosen = np.zeros(len(vectors), np.int64)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_pairs[:, number])
        exact = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        closer = exact < best[rows]
        best[rows[closer]], chosen[rows[closer]] = exact[closer], number
    return chosen, best, int(open_pairs.sum())


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """(id, vector) of the vectors to cluster, components floor(scale * x).

    Components whose whole number would pass ``LARGEST`` either way are held there, since squared distances of
    larger ones do not fit a long.
    """
    limit = F.lit(float(LARGEST))
    values = F.col(vector_col).cast("array<double>")

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x * F.lit(float(scale)), limit), -limit))

    return vectors.select(F.col(id_col).alias("id"), values.alias("vector")) \
        .where((F.size("vector") == width) & F.forall("vector", finite)) \
        .select("id", F.transform("vector", whole).alias("vector"))


def first_centroids(rows: DataFrame, count: int, width: int, seed: str) -> np.ndarray:
    """The ``count`` vectors whose ids hash smallest; null ids hash as empty, equal hashes go by the vector."""
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    chosen = rows.select(order.alias("order"), "vector").orderBy("order", "vector").limit(count).collect()
    return np.array([row["vector"] for row in chosen], np.int64).reshape(len(chosen), width)


def block(column: pa.Array, kind: type) -> np.ndarray:
    """The rows of a column of equally long lists."""
    values = np.asarray(column.flatten(), kind)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def moved(rows: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids as the floored means of the vectors nearest to them; those without vectors stay.

    A task sends one sum per centroid and component; only the centroids come to the driver.
    """
    others = simplex.apexes(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(centroids.shape, object)
        counts = np.zeros(len(centroids), np.int64)
        for batch in batches:
            vectors = block(batch.column("vector"), np.int64)
            chosen, _, _ = nearest(simplex, vectors, block(batch.column("apex"), float), centroids, others)
            for number in np.unique(chosen):
                mine = vectors[chosen == number]
                sums[number] += mine.sum(axis=0)
                counts[number] += len(mine)
        used = np.flatnonzero(counts)
        width = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))),
             pa.array(np.repeat(counts[used], width)), pa.array([str(x) for n in used for x in sums[n]], pa.string())],
            ["cluster", "axis", "n", "total"])

    parts = rows.select("vector", "apex").mapInArrow(work, "cluster long, axis long, n long, total string")
    totals = parts.groupBy("cluster", "axis").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = centroids.copy()
    for row in totals.collect():
        found[row["cluster"], row["axis"]] = int(row["total"]) // row["n"]
    return found


def assigned(rows: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    others = simplex.apexes(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, best, _ = nearest(simplex, block(batch.column("vector"), np.int64),
                                      block(batch.column("apex"), float), centroids, others)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(chosen.astype(np.int32)), pa.array(best)],
                                             ["id", "cluster", "distance"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vector", "apex").mapInArrow(work, f"id {kind}, cluster int, distance long")


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH,
                      clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
                      seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(id_col, cluster, distance) per vector, and the final centroids as whole numbers.

    Vectors with exactly ``width`` components, none null or non-finite, count; others have no row. The first
    ``clusters`` vectors by SHA-256 of ``seed`` and id are the first centroids, fewer if there are fewer vectors.
    Each round assigns all vectors to the nearest centroid (squared distance, ties to the smaller number) and moves
    each centroid to the floor of its vectors' mean; then they are assigned once more. Distances to up to ``PIVOTS``
    of the first centroids are turned into apex coordinates once and stored with the vectors; in each round bounds from
    these rule out most centroids, and what is left is compared in whole numbers. Repeated rows count and are returned
    as often as they occur; an empty table gives an empty result and no centroids. Other columns are not read.
    """
    small_batches(vectors.sparkSession)
    whole = whole_vectors(vectors, id_col, vector_col, width, scale)
    centroids = first_centroids(whole, clusters, width, seed)
    simplex = Simplex(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(block(batch.column("vector"), np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(apexes), pa.list_(pa.float64()))],
                                             [*batch.schema.names, "apex"])

    kind = whole.schema["id"].dataType.simpleString()
    rows = stored(whole.mapInArrow(work, f"id {kind}, vector array<long>, apex array<double>"), "simplex")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, simplex, centroids)
    return assigned(rows, simplex, centroids).withColumnRenamed("id", id_col), centroids


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **settings) -> DataFrame:
    """``centroid_clusters`` with cluster_inertia, inertia and centroid_sha256 (of the components joined by commas).

    Sums of squared distances beyond a long are its largest value.
    """
    found, centroids = centroid_clusters(vectors, id_col, vector_col, **settings)
    found = stored(found, "clusters")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    totals = {row["cluster"]: row["total"] for row in found.groupBy("cluster")
              .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def by_cluster(values: dict[int, Column]) -> Column:
        return F.element_at(F.create_map(*[x for key, value in values.items() for x in (F.lit(key), value)]), F.col("cluster"))

    def held(total: int) -> Column:
        return F.least(F.lit(total).cast("decimal(38,0)"), most).cast("long")

    texts = {number: F.sha2(F.lit(",".join(map(str, row.tolist()))), 256) for number, row in enumerate(centroids)}
    nothing = F.lit(None)
    return found.withColumns({
        "cluster_inertia": by_cluster({key: held(int(total)) for key, total in totals.items()}) if totals
        else nothing.cast("long"),
        "inertia": held(sum(map(int, totals.values()))),
        "centroid_sha256": by_cluster(texts) if texts else nothing.cast("string")})

"""Exact k-means rounds over integer vectors; most centroids are ruled out by n-simplex projection.

The distances of pivots p1..pn to each other make a simplex; the distances of a vector to them make it the apex over that simplex,
a point of R^n whose last coordinate is its height. For two vectors, the distance of their apexes is a lower bound of their
distance, and the distance with one height negated an upper bound. The apex of every vector is computed once from its distances to
the pivots and stored with it; centroids get theirs each round. A centroid whose lower bound exceeds the least upper bound is not
compared; all others are, in integers, so bounds (widened by rounding slack) decide what is computed and never what is returned.

In Spark a round is one pass over the stored table: tasks stream Arrow batches, assign, and give one row of partial sums for each
centroid; k rows come to the driver. Sums are kept in two parts of 32 bits, so they are exact for any number of rows. Nothing is dealt
by cluster, so a cluster of a third of all rows is no hot key. Whole inertias come from a sum by cluster, k rows again.

Edge cases: vectors that are null, of another length than ``width``, or hold a null or non-finite component take no part. Where 64 bits do
not hold what is computed from large components, Python integers are used; a squared distance or inertia beyond 64 bits, or a task's sum of
2^84, is an error. Repeated rows count each; of equal hashes (repeated ids) the vector that sorts first starts first, and a null id sorts last.
Fewer rows than ``k`` make as many centroids; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables, sliced

SCALE, WIDTH, K, ROUNDS, SEED, PIVOTS = 64, 64, 16, 3, 1, 12
#: Components of at most this size are subtracted, squared and added up in 64 bits at any usual width (checked).
_SMALL = 1 << 25
_LOW = (1 << 32) - 1
#: A pivot must stand this part of its largest distance above those before it: rounding errors grow with the inverse.
FLAT = 0.1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and v (floor(scale * component), integers held as doubles) of the vectors that take part."""
    value = F.col(vector_col).cast("array<double>")
    usable = (F.size(value) == width) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf")))
    scaled = F.transform(value, lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def _integers(v: np.ndarray | list[list[int]]) -> np.ndarray:
    """Whole numbers as int64 where every sum fits, else as Python integers."""
    if isinstance(v, np.ndarray):
        if not v.size or np.abs(v).max() <= _SMALL:
            return v.astype(np.int64)
        v = [[int(x) for x in row] for row in v.tolist()]
    return np.array(v, np.int64 if max((abs(x) for row in v for x in row), default=0) <= _SMALL else object)


class Simplex:
    """The base simplex over some pivots; pivots that lie (nearly) in the span of those before add nothing and are left out."""

    def __init__(self, pivots: list[list[int]]) -> None:
        self.pivots: list[list[int]] = []
        self.base = np.zeros((0, 0))  # row i: pivot i in the coordinates of those before, its height last
        for p in pivots:
            away = np.array([[_distance(p, q) for q in self.pivots]])
            apex = self.apexes(away)[0] if self.pivots else np.zeros(0)
            largest = max([1.0, *away.ravel()])
            if self.pivots and not apex[-1] >= FLAT * largest:
                continue
            n = len(self.pivots)
            grown = np.zeros((n + 1, n))
            grown[:n, : max(n - 1, 0)] = self.base
            if n:
                grown[n] = apex
            self.base = grown
            self.pivots.append(p)

    def apexes(self, away: np.ndarray) -> np.ndarray:
        """Coordinates (rows of n) of vectors with these distances (rows of n) to the pivots, the height above the base last."""
        n = len(self.pivots)
        out = np.zeros((len(away), n))
        square = away**2
        for i in range(1, n):  # pivot i is base[i] with i coordinates, the last one positive
            b = self.base[i, :i]
            out[:, i - 1] = (square[:, 0] - square[:, i] + (b**2).sum() - 2 * out[:, : i - 1] @ b[:-1]) / (2 * b[-1])
        if n:
            out[:, n - 1] = np.sqrt(np.maximum(square[:, 0] - (out[:, : n - 1] ** 2).sum(axis=1), 0.0))
        return out


def _distance(a: list[int], b: list[int]) -> float:
    return float(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) ** 0.5


def _squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return (d * d).sum(axis=1)


def bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between apexes ``x`` and ``c``, each moved outwards by rounding slack."""
    flat = ((x[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    low = np.sqrt(flat + (x[:, None, -1] - c[None, :, -1]) ** 2)
    high = np.sqrt(flat + (x[:, None, -1] + c[None, :, -1]) ** 2)
    slack = 1e-5 * (np.abs(x).max(axis=1, initial=1.0)[:, None] + np.abs(c).max(axis=1, initial=1.0)[None, :])
    return low - slack, high + slack


def assign(v: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance (integers) of every row of ``v``, and how many distances were computed."""
    low, high = bounds(apexes, tops)
    possible = ~(low > high.min(axis=1)[:, None])  # a bound that overflowed rules nothing out
    best = np.zeros(len(v), object if v.dtype == object or centroids.dtype == object else np.int64)
    cluster, done = np.full(len(v), -1), 0
    for k in range(len(centroids)):  # ascending, so that a tie stays with the smaller number
        rows = np.flatnonzero(possible[:, k])
        if not len(rows):
            continue
        done += len(rows)
        square = _squares(v[rows], centroids[k])
        nearer = (cluster[rows] < 0) | (square < best[rows])
        cluster[rows[nearer]], best[rows[nearer]] = k, square[nearer]
    return cluster, best, done


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """List columns of equal lengths as matrices."""
    out = []
    for name in names:
        column = batch.column(batch.schema.get_field_index(name))
        out.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
    return out


class Clusters:
    """The stored vectors with their apexes, and the current centroids (lists of integers)."""

    def __init__(self, vectors: DataFrame, k: int = K, seed: int = SEED, pivots: int = PIVOTS) -> None:
        self.tables = Tables(vectors.sparkSession, "clusters")
        raw = self.tables.written(vectors, "vectors")
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
        # The next rows in the same order serve as pivots; a bounded number of rows comes to the driver.
        heads = [[int(x) for x in r.v] for r in raw.orderBy(order, "v").limit(k + pivots).select("v").collect()]
        self.centroids = heads[:k]
        self.simplex = Simplex(heads[k:] + heads[:k])
        self.simplex = Simplex(self.simplex.pivots[:pivots])
        self.stored = self.tables.written(self._with_apexes(raw), "apexes")
        self.tables.drop(raw)

    def _with_apexes(self, raw: DataFrame) -> DataFrame:
        simplex = self.simplex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots = [np.array(p, float) for p in simplex.pivots]
            for batch in sliced(batches, 4096):
                if batch.num_rows:
                    (v,) = _columns(batch, "v")
                    away = np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
                    apex = pa.FixedSizeListArray.from_arrays(pa.array(simplex.apexes(away).ravel()), len(pivots)).cast(pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, apex], ["vec_id", "v", "apex"])

        return raw.mapInArrow(run, "vec_id long, v array<double>, apex array<double>")

    def _tops(self) -> np.ndarray:
        away = np.array([[_distance(c, p) for p in self.simplex.pivots] for c in self.centroids])
        return self.simplex.apexes(away)

    def step(self) -> int:
        """One round: every non-empty centroid becomes the floor of its vectors' mean. Returns how many distances were computed."""
        centroids, tops = self.centroids, self._tops()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, width = _integers(centroids), len(centroids[0])
            sums, counts, done = [[0] * width for _ in centroids], np.zeros(len(centroids), np.int64), 0
            for batch in sliced(batches, 4096):
                if not batch.num_rows:
                    continue
                v, apexes = _columns(batch, "v", "apex")
                v = _integers(v)
                cluster, _, n = assign(v, apexes, held, tops)
                done += n
                for k in np.unique(cluster):
                    mine = v[cluster == k]
                    counts[k] += len(mine)
                    sums[k] = [a + int(b) for a, b in zip(sums[k], mine.sum(axis=0), strict=True)]
            for k, total in enumerate(sums):
                if counts[k]:
                    parts = [[s >> 32 for s in total], [s & _LOW for s in total]]
                    if max(map(abs, parts[0])) >= 1 << 52:
                        raise OverflowError("components sum up to 2^84 in one task")
                    yield pa.RecordBatch.from_pylist([{"k": k, "n": int(counts[k]), "high": parts[0], "low": parts[1], "done": done}], shape)
                    done = 0

        shape = pa.schema({"k": pa.int32(), "n": pa.int64(), "high": pa.list_(pa.int64()), "low": pa.list_(pa.int64()), "done": pa.int64()})
        partial = self.stored.mapInArrow(run, "k int, n long, high array<long>, low array<long>, done long")
        width = len(centroids[0])
        sums = [F.sum(F.get(part, i)).alias(f"{part}{i}") for part in ("high", "low") for i in range(width)]
        computed = 0
        for r in partial.groupBy("k").agg(F.sum("n").alias("n"), F.sum("done").alias("done"), *sums).collect():  # k rows at most
            self.centroids[r.k] = [((r[f"high{i}"] << 32) + r[f"low{i}"]) // r.n for i in range(width)]
            computed += r.done
        return computed

    def assigned(self) -> DataFrame:
        """vec_id, cluster and distance (squared) of every vector."""
        centroids, tops = self.centroids, self._tops()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _integers(centroids)
            for batch in sliced(batches, 4096):
                if batch.num_rows:
                    v, apexes = _columns(batch, "v", "apex")
                    cluster, square, _ = assign(_integers(v), apexes, held, tops)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(square.tolist(), pa.int64())], ["vec_id", "cluster", "distance"])

        return self.stored.mapInArrow(run, "vec_id long, cluster int, distance long")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every row of ``vectors`` (from :func:`quantised`)."""
    spark, made = vectors.sparkSession, Clusters(vectors, k, seed, pivots)
    if not made.centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        made.step()
    rows = made.tables.written(made.assigned(), "assigned")
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # k rows at most
    inertia = sum(sums.values())
    if inertia >= 1 << 63:
        raise OverflowError("the inertia exceeds 64 bits")
    facts = spark.createDataFrame([(c, t, inertia, digest(made.centroids[c])) for c, t in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

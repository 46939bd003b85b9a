"""Exact top-k inner-product search with best-first search in M-trees.

Inner product becomes a metric by one more component: with M at least every norm of a tree, ``x' = (x, sqrt(M^2 - |x|^2))`` and
``q' = (q, 0)`` give ``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``, so the nearest points have the largest products. An M-tree node is a page
of entries under a routing point, with a covering radius and every entry's distance to it. A search keeps a heap of nodes by
their least possible distance and leaves out, by the stored distances and the triangle inequality alone, whatever cannot reach
the k-th best. Scores are integer products, so bounds only decide what is computed and never what is returned.

In Spark the index is a forest: vectors go to the nearest of a bounded sample of pivots, and those of a cell of more than twice
``TREE_ROWS`` rows to the nearest of a sample of its own pivots. What is still larger holds (nearly) equal vectors and is split by
a hash, so a vector that a third of all rows share fills many trees instead of one task. Every tree is one row.

Queries search their own tree first. The k-th score found there prunes whole cells (a bounded table of pivots and covering
radii) and then single trees (their root and covering radius) by ``q.x <= q.c + |q| r`` before any vector or tree is sent
anywhere; queries meet the trees that are left in blocks of ``BLOCK``. Best lists are merged by query.

The driver gets counts, about twice as many vectors as there are pivots, radii, and the roots of trees up to ``ROOT_BYTES``. No join is
left to Spark's choice where it knows files only: those of queries, floors and trees are a small part of their size, and it would
broadcast every query once for each cell it may reach.

Edge cases: vectors that are null or hold a null or a non-finite component take no part; an empty one scores 0 with all. Vectors
of different lengths compare as if padded with zeros. Components may be as large as a double: products that doubles do not hold
exactly are formed from Python integers. A score among the best that no 64-bit integer holds, or a component that ``scale``
makes infinite, is an error. Rows with the query's vec_id are its own and never its candidates; if they hold several vectors, the
smallest (in array order) is the query. Other repeated rows are candidates each. A null vec_id takes no part. Ties go to the
smaller vec_id. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables

SCALE, TOP, QUERY_EVERY = 64, 20, 20
#: Most pivots of the table or of a cell (one for TREE_ROWS rows up to this number), rows of a tree, of a page, entries of an inner
#: node, queries of a block, and rows of a cell that are dealt out to its pivots in one task.
PIVOTS, TREE_ROWS, PAGE, FANOUT, BLOCK, DEAL = 1024, 4096, 512, 16, 512, 100_000
#: Most bytes of the trees' roots that are broadcast.
ROOT_BYTES = 4 << 20


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and v (array of floor(scale * component), integers held as doubles) of the vectors that take part."""
    value = F.col(vector_col).cast("array<double>")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def floor(x: Column) -> Column:
        y = x * scale
        held = F.when(F.abs(y) == float("inf"), F.raise_error(F.lit(f"a component is too large for scale {scale}")).cast("double")).otherwise(y)
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(held)  # beyond it every double is an integer

    rows = vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).where(usable)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(value, floor).alias("v"))


def _matrix(rows: list, width: int = 1) -> np.ndarray:
    """Vectors padded with zeros to one width, at least ``width``; integers held as doubles."""
    width = max([width, *(len(r) for r in rows)])
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, max(0, width - x.shape[1]))))


def _exact(a: float, b: float, width: int) -> bool:
    """Whether every product of vectors with components up to a and b is exact in doubles."""
    return a * b * max(width, 1) < 2**53


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of integers of any size."""
    whole = [int(c) for c in q.tolist()]
    return np.array([sum(int(c) * d for c, d in zip(r, whole, strict=True)) for r in x.tolist()], object)


class MTree:
    """A bulk-loaded M-tree over integer vectors; nodes are pages of row numbers or of child nodes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.x, self.computed = ids, vectors, 0  # computed: products formed by searches so far
        self.largest = float(np.abs(vectors).max(initial=0))
        with np.errstate(over="ignore", invalid="ignore"):
            norms = (vectors**2).sum(axis=1)
            self.most = float(norms.max(initial=0.0))
            self.lift = np.sqrt(np.maximum(self.most - norms, 0.0))
            self.nodes: list[tuple] = []  # (is leaf, entries, distance of entries to the routing point, routing row, covering radius)
            self.bounded = bool(np.isfinite(4 * self.most))  # else distances overflow and searches read every row
            self.root = self._build(np.arange(len(ids)), int(np.argmax(norms)) if len(ids) else -1) if self.bounded else -1
        self._lay_out()

    def _distance(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((self.x[rows] - self.x[to]) ** 2).sum(axis=1) + (self.lift[rows] - self.lift[to]) ** 2)

    def _lay_out(self) -> None:
        """Put the rows of a page next to each other, so that a visit reads one slice."""
        if not self.nodes or not len(self.ids):
            return
        order = np.concatenate([n[1] for n in self.nodes if n[0]])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.x, self.lift = self.ids[order], self.x[order], self.lift[order]
        self.nodes = [(leaf, place[entries] if leaf else entries, away, int(place[routing]), radius) for leaf, entries, away, routing, radius in self.nodes]
        self.below = [None if n[0] else (np.array([self.nodes[c][3] for c in n[1]]), np.array([self.nodes[c][4] for c in n[1]])) for n in self.nodes]

    def _build(self, rows: np.ndarray, routing: int) -> int:
        away = self._distance(rows, routing) if len(rows) else np.empty(0)
        if len(rows) <= PAGE:  # a page: entries in order of their distance
            order = np.argsort(away, kind="stable")
            self.nodes.append((True, rows[order], away[order], routing, float(away.max(initial=0.0))))
            return len(self.nodes) - 1
        fan = min(FANOUT, -(-len(rows) // PAGE) + 1)
        seeds = rows[np.unique(np.linspace(0, len(rows) - 1, fan).astype(int))]
        near = np.stack([self._distance(rows, s) for s in seeds])
        owner = near.argmin(axis=0)
        parts = [rows[owner == k] for k in range(len(seeds))]
        if max(map(len, parts)) == len(rows):  # equal points: pages by number
            parts, seeds = np.array_split(rows, min(FANOUT, -(-len(rows) // PAGE))), rows
        children = [self._build(p, int(s)) for p, s in zip(parts, seeds, strict=False) if len(p)]
        routes = np.array([self.nodes[c][3] for c in children])
        self.nodes.append((False, np.array(children), self._distance(routes, routing), routing, float(away.max())))
        return len(self.nodes) - 1

    def ball(self) -> tuple[np.ndarray, float]:
        """The root's routing point and a radius (without the lifted component) that covers every vector."""
        centre = self.x[self.nodes[self.root][3]] if self.nodes else np.zeros(self.x.shape[1])
        with np.errstate(over="ignore"):
            return centre, float(np.sqrt(((self.x - centre) ** 2).sum(axis=1)).max(initial=0.0))

    def search(self, query_id: int, q: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """The best (score, vec_id) pairs, at most k, of score ``least`` or more."""
        if not len(self.ids):
            return []
        exact = _exact(self.largest, float(np.abs(q).max(initial=0)), len(q))
        with np.errstate(over="ignore"):
            base = float(q @ q) + self.most
        slack = 1e-9 * (base + 1.0)
        rounding = 1e-7 if exact else 1e-7 + 1e-6 * np.sqrt(base)  # of distances
        bound, best = least, []  # best: a heap of (score, -vec_id)

        def radius() -> float:
            """No point beyond this distance can be among the best; the slack covers rounding."""
            return np.inf if bound is None else np.sqrt(max(base - 2 * float(bound), 0.0) + slack) + rounding

        def to(rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base - 2 * (self.x[rows] @ q), 0.0))

        def take(lo: int, hi: int) -> None:
            """Score the rows of a page from lo to hi."""
            nonlocal bound, reach
            self.computed += hi - lo
            scores, ids = self.x[lo:hi] @ q if exact else _products(self.x[lo:hi], q), self.ids[lo:hi]
            good = ids != query_id
            if bound is not None:
                good &= (scores >= bound).astype(bool)
            good = np.flatnonzero(good)
            if exact and len(good) > k:  # of a page at most k count, and ties at the last of them
                last = len(good) - k
                good = good[scores[good] >= np.partition(scores[good], last)[last]]
            for score, ident in zip(scores[good].tolist(), ids[good].tolist(), strict=True):
                item = (int(score), -ident)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                bound = best[0][0] if bound is None else max(bound, best[0][0])
                reach = radius()

        reach = radius()
        if not (self.bounded and np.isfinite(4 * base)):
            take(0, len(self.ids))
            return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))
        start = float(to(np.array([self.nodes[self.root][3]]))[0])
        heap = [(max(0.0, start - self.nodes[self.root][4]), self.root, start)]
        while heap:
            nearest, at, apart = heapq.heappop(heap)
            if nearest > reach:
                break
            leaf, entries, away, _, _ = self.nodes[at]
            if leaf:
                lo, hi = np.searchsorted(away, [apart - reach - rounding, apart + reach + rounding]).tolist()
                if hi > lo:
                    take(int(entries[0]) + lo, int(entries[0]) + hi)
                continue
            routes, radii = self.below[at]
            open_ = np.flatnonzero(np.abs(apart - away) - radii <= reach + rounding)  # no distance computed for the others
            for c, d, r in zip(entries[open_].tolist(), to(routes[open_]).tolist(), radii[open_].tolist(), strict=True):
                if d - r <= reach:
                    heapq.heappush(heap, (max(0.0, d - r), c, d))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of its nearest pivot, and how far it is."""
    width = max(x.shape[1], pivots.shape[1])
    x, p = _widened(x, width), _widened(pivots, width)
    with np.errstate(over="ignore", invalid="ignore"):
        owner = ((p**2).sum(axis=1)[None, :] - 2 * (x @ p.T)).argmin(axis=1)
        return owner, np.sqrt(((x - p[owner]) ** 2).sum(axis=1))


def _split_cells(placed: DataFrame, large: DataFrame, tree_rows: int) -> DataFrame:
    """The rows of the cells in ``large`` (cell, count) with sub, the number of the nearest of the cell's own pivots.

    A cell's rows are dealt out in parts of about ``DEAL``, each of which meets the cell's pivots once.
    """
    wanted = F.least(F.ceil(F.col("count") / tree_rows), F.lit(PIVOTS))
    share = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) / (1 << 30) < wanted / F.col("count")
    rows = placed.join(large, "cell")
    pivots = rows.where(share).select(F.col("cell").alias("p_cell"), F.col("v").alias("p_v"), F.explode(F.sequence(F.lit(0), F.floor(F.col("count") / DEAL).cast("int"))).alias("p_part"))
    dealt = rows.select("cell", "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.floor(F.col("count") / DEAL) + 1).cast("int").alias("part"))

    def assign(mine: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame({"cell": [], "vec_id": [], "v": [], "sub": []})
        sub = np.zeros(len(mine), np.int32)
        if len(own):
            table = np.unique(_matrix(list(own.p_v)), axis=0)
            for lo in range(0, len(mine), 4096):
                sub[lo : lo + 4096] = _nearest(_matrix(list(mine.v.iloc[lo : lo + 4096])), table)[0]
        return mine[["cell", "vec_id", "v"]].assign(sub=sub)

    return dealt.groupBy("cell", "part").cogroup(pivots.groupBy("p_cell", "p_part")).applyInPandas(assign, "cell int, vec_id long, v array<double>, sub int")


def _pivots(rows: DataFrame, tree_rows: int) -> list[list[float]]:
    """One vector for ``tree_rows`` rows, ``PIVOTS`` at most: those of the ids with the least hashes.

    A bound on the hash that about twice as many ids meet comes first, so that the driver gets that many rows from all partitions together.
    """
    count = rows.count()
    if not count:
        return []
    wanted, order = min(PIVOTS, -(-count // tree_rows)), F.xxhash64("vec_id")
    below = min((1 << 63) - 1, (1 << 64) * (2 * wanted + 64) // count - (1 << 63))
    some = rows.where(order <= F.lit(below)).groupBy("vec_id").agg(F.min("v").alias("v")).select(order.alias("hash"), "vec_id", "v").collect()
    if not some:  # few ids, repeated often
        some = rows.agg(F.min(F.struct(order.alias("hash"), "vec_id", "v")).alias("least")).select("least.*").collect()
    return [r.v for r in sorted(some, key=lambda r: (r.hash, r.vec_id))[:wanted]]


def _cells(rows: DataFrame, tree_rows: int, tables: Tables) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The rows with cell (nearest pivot) and tree, and the pivots and covering radii of the cells."""
    pivots = _pivots(rows, tree_rows)
    table = _matrix(pivots)

    @F.pandas_udf("struct<cell int, away double>")
    def nearest(v: pd.Series) -> pd.DataFrame:
        owner, away = _nearest(_matrix(list(v)), table)
        return pd.DataFrame({"cell": owner.astype(np.int32), "away": away})

    found = rows.withColumn("near", nearest("v")) if pivots else rows.withColumn("near", F.struct(F.lit(0).alias("cell"), F.lit(0.0).alias("away")))
    placed = tables.written(found.select("vec_id", "v", "near.*"), "placed")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("count"), F.max("away").alias("radius"))
    radii = np.zeros(len(table))
    for r in sizes.collect():  # at most PIVOTS rows
        radii[r.cell] = np.inf if r.radius is None or np.isnan(r.radius) else r.radius
    large = sizes.where(F.col("count") > 2 * tree_rows).select("cell", "count")
    split = _split_cells(placed, F.broadcast(large), tree_rows)
    whole = placed.join(F.broadcast(large), "cell", "left_anti").select("cell", "vec_id", "v", F.lit(0).alias("sub"))
    cells = tables.written(split.unionByName(whole), "cells")
    parts = tables.written(cells.groupBy("cell", "sub").agg(F.ceil(F.count("*") / (2 * tree_rows)).alias("parts")), "parts")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    number = F.shiftleft(F.col("cell").cast("long"), 44) + F.shiftleft(F.col("sub").cast("long"), 32) + part
    return cells.join(parts, ["cell", "sub"]).select("vec_id", "v", "cell", number.alias("tree")), table, radii


@dataclass
class Forest:
    """Vectors with their cell and tree (vec_id, v, cell, tree), the trees, one pickled tree a row (tree, cell, root, radius, index),
    and the pivot and covering radius of each cell."""

    placed: DataFrame
    trees: DataFrame
    pivots: np.ndarray
    radii: np.ndarray
    tables: Tables


def build(rows: DataFrame, tree_rows: int = TREE_ROWS) -> Forest:
    """Index all quantised vectors (vec_id, v)."""
    tables, passing = Tables(rows.sparkSession, "m-trees"), Tables(rows.sparkSession, "m-tree-cells")
    placed, pivots, radii = _cells(passing.written(rows, "vectors"), tree_rows, passing)
    placed = tables.written(placed, "forest")
    passing.clear()

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        tree = MTree(pdf.vec_id.to_numpy(np.int64), _matrix(list(pdf.v)))
        root, radius = tree.ball()
        tree.x = tree.x.astype(np.int32) if tree.largest < 1 << 31 else tree.x
        return pd.DataFrame({"tree": [pdf.tree.iloc[0]], "cell": [pdf.cell.iloc[0]], "root": [root.tolist()], "radius": [radius], "index": [pickle.dumps(tree)]})

    trees = placed.groupBy("tree").applyInPandas(plant, "tree long, cell int, root array<double>, radius double, index binary")
    return Forest(placed, tables.written(trees, "trees"), pivots, radii, tables)


def _grown(blob: bytes) -> MTree:
    tree = pickle.loads(blob)  # noqa: S301 - written by plant() above
    tree.x = tree.x.astype(np.float64)
    return tree


def _fitted(v, tree: MTree) -> np.ndarray:
    """The query at the tree's width; what lies beyond meets zeros only."""
    q = np.zeros(tree.x.shape[1])
    q[: len(v)] = v[: len(q)]
    return q


def _may_reach(q: np.ndarray, centres: np.ndarray, radii: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a vector within ``radii`` of ``centres`` can score ``least`` (nan: anything) with ``q``; all broadcast against each other.

    The triangle inequality bounds the product by ``q.c + |q| r``; the slack covers rounding.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.sqrt((q**2).sum(axis=-1))
        most = (q * centres).sum(axis=-1) + size * radii
        slack = 1e-9 * (size * (np.sqrt((centres**2).sum(axis=-1)) + radii) + 1)
        return ~(most + slack < least)  # nan and overflow rule nothing out


def searched(forest: Forest, queries: DataFrame, floors: DataFrame) -> DataFrame:
    """query_id, v, least and tree of every (query, tree) pair that bounds do not rule out, the query's own tree left out.

    ``queries`` has query_id, v and tree; ``floors`` has query_id and least (k-th score in the query's own tree, or null).
    """
    pivots, radii = forest.pivots, forest.radii

    @F.pandas_udf("array<int>")
    def cells(v: pd.Series, least: pd.Series) -> pd.Series:
        out = []
        low = least.to_numpy(np.float64)
        for lo in range(0, len(v), 16):
            q = _matrix(list(v.iloc[lo : lo + 16]))
            width = max(q.shape[1], pivots.shape[1])
            good = _may_reach(_widened(q, width)[:, None, :], _widened(pivots, width)[None], radii[None], low[lo : lo + 16, None])
            out += [np.flatnonzero(g).astype(np.int32) for g in good]
        return pd.Series(out, index=v.index)

    @F.pandas_udf("boolean")
    def reaches(v: pd.Series, root: pd.Series, radius: pd.Series, least: pd.Series) -> pd.Series:
        q, c = _matrix(list(v)), _matrix(list(root))
        width = max(q.shape[1], c.shape[1])
        return pd.Series(_may_reach(_widened(q, width), _widened(c, width), radius.to_numpy(np.float64), least.to_numpy(np.float64)), index=v.index)

    asked = queries.join(floors.hint("merge"), "query_id", "left").select("query_id", "v", "least", F.col("tree").alias("home"))
    asked = asked.withColumn("cell", F.explode(cells("v", "least")))
    numbers = forest.trees.agg(F.sum(F.size("root") + 4)).first()[0] or 0
    roots = forest.trees.select("cell", "tree", "root", "radius").hint("broadcast" if 8 * numbers <= ROOT_BYTES else "merge")
    met = asked.join(roots, "cell").where("tree <> home")
    return met.where(reaches("v", "root", "radius", "least")).select("query_id", "v", "least", "tree")


_HIT = "query_id long, vec_id long, score long"
_LONG = 1 << 63


def top_k(forest: Forest, is_query: Column, k: int = TOP) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of every query id among the rows that ``is_query`` picks."""
    picked = forest.placed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("v", "tree")).alias("own"))
    queries = forest.tables.written(picked.select("query_id", "own.v", "own.tree"), "queries")

    def visit(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(trees) and len(asked):
            tree = _grown(trees["index"].iloc[0])
            least = asked["least"] if "least" in asked else pd.Series(None, asked.index, dtype=object)
            for ident, v, low in zip(asked.query_id, asked.v, least, strict=True):
                rows += [(ident, i, s) for s, i in tree.search(ident, _fitted(v, tree), k, None if pd.isna(low) else int(low))]
        if any(not -_LONG <= s < _LONG for _, _, s in rows):
            raise ValueError("a score among the best does not fit 64 bits")
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    home = forest.trees.select("tree", "index").groupBy("tree").cogroup(queries.groupBy("tree")).applyInPandas(visit, _HIT)
    home = forest.tables.written(home, "home")
    floors = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("low")).alias("least"))
    n_blocks = max(1, -(-queries.count() // BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")
    asked = forest.tables.written(searched(forest, queries, floors).withColumn("block", block), "asked")
    met = asked.select(F.col("tree").alias("at"), F.col("block").alias("of")).distinct()
    copies = met.join(forest.trees.select(F.col("tree").alias("at"), "index").hint("merge"), "at")
    away = copies.groupBy("at", "of").cogroup(asked.groupBy("tree", "block")).applyInPandas(visit, _HIT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = home.unionByName(away).withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

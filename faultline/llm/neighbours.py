"""Approximate largest inner products by collision-counting hashing.

Vectors are scaled by the largest norm and lifted to the unit sphere, so that a larger inner
product with a query is a smaller distance.  Every hash is one random projection; a block of
vectors keeps an array of each.  A query opens a window around its own value in
every array and widens all windows step by step (virtual rehashing); it starts two steps below the
width at which the query before it ended.  A vector that falls into the
windows of enough arrays is verified by its exact inner product.  Widening stops when a vector as
near as the worst of the best ``k`` verified ones would have been found with probability ``sure``,
or when everything is verified; nothing is capped.

Collisions are counted by comparing bytes, the projections in steps of ``STEP``; the projections
themselves decide about vectors for which the outermost steps of the windows matter.  Vectors without structure put half of a block into the last window, and looking the
windows up in sorted arrays costs more than reading the block.

Every vector is dealt to one block of about ``block`` vectors and indexed there once.  The queries
go to all blocks: a task holds one block, and the queries stream past it.  The best ``k`` of all
blocks are merged.

Defined cases: null, empty and zero vectors and vectors with a null or non-finite component take no
part; vectors meet only vectors of their own length; equal rows count once; candidates with the
query's id are left out; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import in_pandas

PROJECTIONS = 64
THRESHOLD = 40
SURE = 0.97
WIDEN = 1.3
FIRST_WINDOW = 0.15
BLOCK = 16384
SEED = 5
# The width of a byte's step; projections beyond 128 steps to either side count as the outermost.
STEP = 1 / 32


def needed_share(projections: int, threshold: int, sure: float) -> float:
    """The chance per array with which ``threshold`` of ``projections`` collide with chance ``sure``."""
    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        passed = sum(math.comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(threshold, projections + 1))
        low, high = (p, high) if passed < sure else (low, p)
    return high


class CollisionIndex:
    """Projections of one block of vectors, and their steps in one byte each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, projections: int, seed: int):
        self.ids, self.vectors = ids, vectors
        scaled = vectors / largest
        lift = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1)))
        self.axes = np.random.default_rng(seed).standard_normal((projections, vectors.shape[1] + 1))
        values = self.axes[:, :-1] @ scaled.T + np.outer(self.axes[:, -1], lift)
        self.steps = self._steps(values).astype(np.uint8)
        self.values = np.ascontiguousarray(values.T)
        self.largest = largest
        self.first = FIRST_WINDOW

    @staticmethod
    def _steps(values: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(values / STEP), -128, 127).astype(np.int64) + 128

    @staticmethod
    def _counted(inside: np.ndarray) -> np.ndarray:
        if len(inside) > 255:
            return inside.sum(axis=0)
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def _colliding(self, centre: np.ndarray, half: float, threshold: int, seen: np.ndarray) -> np.ndarray:
        """Places of the vectors not ``seen`` that lie within ``half`` of the centre in ``threshold`` arrays."""
        low, high = self._steps(centre - half), self._steps(centre + half)
        # Below a window, the difference of the bytes wraps around and is too large as well.
        first, span = low.astype(np.uint8)[:, None], (high - low).astype(np.uint8)[:, None]
        above = self.steps - first
        may = np.flatnonzero((self._counted(above <= span) >= threshold) & ~seen)
        if not len(may):
            return may
        # Only the outermost steps of a window need the projections themselves.
        sure = self._counted((above > 0) & (above < span))[may] >= threshold
        edge = may[~sure]
        exact = self.values[edge]
        found = ((exact >= centre - half) & (exact <= centre + half)).sum(axis=1) >= threshold
        return np.sort(np.concatenate((may[sure], edge[found])))

    def _best(self, query: np.ndarray, rows: np.ndarray, k: int, norm: float) -> np.ndarray:
        """The given rows but those whose inner products are below the ``k`` largest beyond doubt.

        Matrix products round in another order than sums of products, by less than ``slack``.
        """
        if len(rows) <= 4 * k:
            return rows
        many = 4 * len(rows) > len(self.ids)
        products = (self.vectors @ query)[rows] if many else self.vectors[rows] @ query
        slack = 4 * len(query) * np.finfo(float).eps * self.largest * norm
        return rows[~(products < np.partition(products, len(rows) - k)[len(rows) - k] - slack)]

    def search(self, query: np.ndarray, own: int, k: int, threshold: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the best ``k`` found, best first, ties to the smaller id."""
        top = float(np.abs(query).max())
        unit = query / top
        length = math.sqrt(float((unit**2).sum()))
        centre = self.axes[:, :-1] @ (unit / length)
        seen = self.ids == own
        rows, scores = np.empty(0, np.int64), np.empty(0)
        half = self.first
        while True:
            new = self._colliding(centre, half, threshold, seen)
            if len(new):
                seen[new] = True
                new = self._best(query, new, k, top * length)
                rows = np.concatenate((rows, new))
                scores = np.concatenate((scores, (self.vectors[new] * query).sum(1)))
                best = np.lexsort((self.ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            if seen.all():
                break
            if len(rows) == k:
                cosine = scores[-1] / top / length / self.largest
                if half >= reach * math.sqrt(max(0.0, 2.0 - 2.0 * cosine)):
                    break
            half *= WIDEN
        self.first = max(FIRST_WINDOW, half / WIDEN**2)
        return self.ids[rows], scores


def _matrix(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return frame["vec_id"].to_numpy(dtype=np.int64), np.array(frame["vector"].tolist(), dtype=np.float64)


def _distinct(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of the parts, in the order of their first place."""
    ids, vectors = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    if len(np.unique(ids)) < len(ids):
        bits = np.column_stack((ids.view(np.float64), vectors)).view(np.uint64)
        places = np.sort(np.unique(bits, axis=0, return_index=True)[1])
        ids, vectors = ids[places], vectors[places]
    return ids, vectors


def _tasks(
    frames: Iterator[pd.DataFrame], k: int, projections: int, threshold: int, sure: float, seed: int, block: int
) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block, vectors before queries; equal rows stand together."""
    reach = NormalDist().inv_cdf((1 + needed_share(projections, threshold, sure)) / 2)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    index, current, last = None, None, None
    for frame in frames:
        for key, part in frame.groupby(["dims", "block"], sort=False):
            if key != current:
                held, index, current, last = [], None, key, None
            data, asked = part[~part["is_query"]], part[part["is_query"]]
            if len(data):
                held.append(_matrix(data))
                # Equal rows may be many; they are held once.
                if len(held) > 1 and sum(len(ids) for ids, _ in held) > 2 * block:
                    held = [_distinct(held)]
            if not len(asked):
                continue
            if held:
                index = CollisionIndex(*_distinct(held), float(part["largest"].iloc[0]), projections, seed)
                held = []
            out = []
            for own, query in zip(*_matrix(asked)):
                row = (int(own), query.tobytes())
                if index is not None and row != last:
                    found, scores = index.search(query, int(own), k, threshold, reach)
                    out.append(pd.DataFrame({"query_id": int(own), "vec_id": found, "score": scores}))
                last = row
            if out:
                yield pd.concat(out)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, projections: int = PROJECTIONS, threshold: int = THRESHOLD,
    sure: float = SURE, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """Per query row and rank: query_id, rank (from 1), vec_id, score."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("is_query")).filter(
        F.col("vec_id").isNotNull() & _usable(F.col("embedding"))
    )
    # Scaled by its largest component, no vector's norm vanishes.
    top = F.array_max(F.transform("vector", F.abs))
    rows = rows.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"), F.coalesce("is_query", F.lit(False)).alias("is_query")
    ).withColumn("top", top).filter("top > 0")
    squares = F.aggregate(F.transform("vector", lambda x: x / F.col("top")), F.lit(0.0), lambda a, x: a + x * x)
    count, largest = rows.agg(F.count(F.lit(1)), F.max(F.col("top") * F.sqrt(squares))).first()
    blocks = max(1, -(-count // block))
    placed = rows.select(
        "vec_id", "vector", F.size("vector").alias("dims"), F.lit(largest or 1.0).alias("largest"), "is_query"
    )
    data = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))
    asked = placed.filter("is_query").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dims", "block"]
    tasks = data.withColumn("is_query", F.lit(False)).unionByName(asked)
    tasks = tasks.repartition(*keys).sortWithinPartitions(*keys, "is_query", "vec_id", "vector")
    found = in_pandas(
        tasks, lambda frames: _tasks(frames, k, projections, threshold, sure, seed, block),
        "query_id long, vec_id long, score double",
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

"""Recall of the nearest-vector search at its default stop rule, over one and over several blocks."""

from __future__ import annotations

import math
import os
from statistics import NormalDist

import numpy as np
import pytest

from faultline.llm import neighbours
from tests.oracle_check import DATA

TABLE = f"{DATA}/sf0.1/embeddings.parquet"
pytestmark = pytest.mark.skipif(not os.path.exists(TABLE), reason="test tables not present")


@pytest.mark.parametrize("blocks", [1, 4])
def test_recall_with_the_default_stop_rule(blocks):
    pq = pytest.importorskip("pyarrow.parquet")
    frame = pq.read_table(TABLE, columns=["vec_id", "embedding"]).to_pandas().drop_duplicates("vec_id").sort_values("vec_id")
    ids, vectors = frame["vec_id"].to_numpy(dtype=np.int64), np.array(frame["embedding"].tolist(), dtype=float)
    usable = np.isfinite(vectors).all(1) & ((vectors**2).sum(1) > 0)
    ids, vectors = ids[usable], vectors[usable]
    reach = NormalDist().inv_cdf(
        (1 + neighbours.needed_share(neighbours.PROJECTIONS, neighbours.THRESHOLD, neighbours.SURE)) / 2
    )
    largest = math.sqrt((vectors**2).sum(1).max())
    parts = [
        neighbours.CollisionIndex(ids[b::blocks], vectors[b::blocks], largest, neighbours.PROJECTIONS, neighbours.SEED)
        for b in range(blocks)
    ]
    recalls = []
    for at in np.random.default_rng(1).choice(len(ids), 60, replace=False):
        own, query = ids[at], vectors[at]
        found = [pair for part in parts for pair in zip(*part.search(query, own, 20, neighbours.THRESHOLD, reach))]
        best = {i for i, _ in sorted(found, key=lambda pair: (-pair[1], pair[0]))[:20]}
        scores = vectors @ query
        scores[at] = -np.inf
        recalls.append(len(best & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert min(recalls) >= 0.95 and np.mean(recalls) >= 0.995


def test_bytes_find_what_the_projections_find():
    """Collisions by bytes are those by projections, and no product among the best is lost."""
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((3000, 12)) * rng.choice([0.01, 1.0, 40.0], (3000, 1))
    index = neighbours.CollisionIndex(np.arange(3000), vectors, math.sqrt((vectors**2).sum(1).max()), 64, 5)
    seen = np.arange(3000) % 7 == 0
    for query in vectors[:40]:
        centre = index.axes[:, :-1] @ (query / np.linalg.norm(query))
        for half in (0.0, 0.01, 0.05, 0.4, 1.6, 9.0):
            counts = (np.abs(index.values - centre) <= half).sum(1)
            for threshold in (1, 20, 40):
                assert index._colliding(centre, half, threshold, seen).tolist() == np.flatnonzero((counts >= threshold) & ~seen).tolist()
        rows = rng.permutation(3000)[: rng.integers(1, 3000)]
        best = rows[np.argsort(-(vectors[rows] * query).sum(1))[:20]]
        assert set(best) <= set(index._best(query, rows, 20, np.linalg.norm(query)))

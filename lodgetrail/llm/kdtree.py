"""Exact search for the highest inner products, by one KD-tree per shard.

Shards are even slices by a hash of the id. Each builds a tree by median splits
with tight boxes; a query visits its nodes best first, by the largest inner
product that a box allows, and stops when no box can hold more than the k-th
score so far. A first shard searched alone gives every query such a score to
start with in all the others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm import tables, vectors

SHARD = 8192
LEAF = 256
QUERIES = 512
SCALE = 64
#: Whole numbers up to here are exact as doubles, and so are sums whose parts add up to no more.
EXACT = float(1 << 53)
#: A first shard of up to this many bytes goes to every executor.
BROADCAST_SHARD = 64 << 20
_FOUND = "query_id long, vec_id long, score long"


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row order, node ranges (first, last, left child or -1), and box corners ``low``, ``high`` of each node.

    A node is split at the median of its widest dimension; its children are
    neighbours in the list. Points all alike stay one leaf, however many.
    """
    order, nodes, low, high = np.arange(len(points)), [], [], []

    def add(first: int, last: int) -> int:
        part = points[order[first:last]]
        nodes.append([first, last, -1])
        low.append(part.min(0))
        high.append(part.max(0))
        return len(nodes) - 1

    waiting = [add(0, len(points))]
    while waiting:
        node = waiting.pop()
        first, last, _ = nodes[node]
        widths = high[node] - low[node]
        if last - first <= leaf or widths.max() == 0:
            continue
        part = order[first:last]
        middle = len(part) // 2
        order[first:last] = part[np.argpartition(points[part, widths.argmax()], middle)]
        left = add(first, first + middle)
        right = add(first + middle, last)
        nodes[node][2] = left
        waiting += [left, right]
    return order, np.array(nodes, "i4"), np.array(low), np.array(high)


def search(
    query: np.ndarray, query_id: int, points: np.ndarray, ids: np.ndarray, nodes: np.ndarray, bounds: np.ndarray, k: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best but the query's own id, of those that reach ``least``.

    ``bounds`` holds the largest product each node allows. Equal bounds are
    followed too, as a tie may go to a smaller id.
    """
    heap = [(-bounds[0], 0)]
    got_ids, got, kth = np.zeros(0, "i8"), np.zeros(0), least
    while heap and -heap[0][0] >= kth:
        _, node = heapq.heappop(heap)
        first, last, left = nodes[node]
        if left >= 0:
            for child in (left, left + 1):
                if bounds[child] >= kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        scores = points[first:last] @ query
        near = (scores >= kth) & (ids[first:last] != query_id)
        got = np.concatenate([got, scores[near]])
        got_ids = np.concatenate([got_ids, ids[first:last][near]])
        if len(got) >= k:
            chosen = vectors.top(got, got_ids, k)
            got, got_ids = got[chosen], got_ids[chosen]
            kth = max(kth, got[-1])
    return got_ids, got


def search_wide(
    query: np.ndarray, query_id: int, points: np.ndarray, ids: np.ndarray, nodes: np.ndarray, bounds: np.ndarray, k: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """As ``search``, for products that doubles do not hold: scores are Python's whole numbers.

    ``bounds`` and ``least`` are doubles, so both are moved by more than what
    rounding can have cost them, and only decide what is looked at.
    """
    whole = [int(x) for x in query]
    slack = 1e-12 * float(np.abs(points).max(0) @ np.abs(query)) + 1
    heap, got, kth = [(-bounds[0] - slack, 0)], [], least - slack
    while heap and -heap[0][0] >= kth:
        _, node = heapq.heappop(heap)
        first, last, left = nodes[node]
        if left >= 0:
            for child in (left, left + 1):
                heapq.heappush(heap, (-bounds[child] - slack, child))
            continue
        for at in range(first, last):
            if ids[at] != query_id:
                got.append((-sum(a * int(b) for a, b in zip(whole, points[at])), int(ids[at])))
        got = heapq.nsmallest(k, got)
        if len(got) >= k:
            kth = max(kth, -got[-1][0])
    # A score beyond a long fails here rather than come out wrong.
    return np.array([i for _, i in got], "i8"), np.array([-s for s, _ in got], "i8")


def _packed_shards(rows: DataFrame, shards: int, leaf: int) -> DataFrame:
    """One row per shard: its tree, its points in the tree's order, and their ids."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        points = vectors.matrix(pdf["vec"])
        order, nodes, low, high = build(points, leaf)
        parts = {"ids": pdf["id"].to_numpy("i8")[order], "points": points[order], "nodes": nodes, "low": low, "high": high}
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "dim": [points.shape[1]]} | {n: [a.tobytes()] for n, a in parts.items()})

    schema = "shard int, dim int, ids binary, points binary, nodes binary, low binary, high binary"
    return rows.withColumn("shard", vectors.dealt("id", shards)).groupBy("shard").applyInPandas(pack, schema)


def _packed_queries(queries: DataFrame, parts: int) -> DataFrame:
    """One row per block of queries, ``on`` shard 0; ``least`` is the score each must reach."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {"query_ids": pdf["id"].to_numpy("i8"), "queries": vectors.matrix(pdf["vec"]), "least": pdf["least"].to_numpy("f8")}
        return pd.DataFrame({"on": [0]} | {n: [a.tobytes()] for n, a in parts.items()})

    dealt = queries.withColumn("block", vectors.dealt("id", parts))
    return dealt.groupBy("block").applyInPandas(pack, "on int, query_ids binary, queries binary, least binary")


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, dim = np.frombuffer(row.ids, "i8"), row.dim
                points, low, high = (np.frombuffer(x).reshape(-1, dim) for x in (row.points, row.low, row.high))
                nodes = np.frombuffer(row.nodes, "i4").reshape(-1, 3)
                queries, query_ids = np.frombuffer(row.queries).reshape(-1, dim), np.frombuffer(row.query_ids, "i8")
                allowed = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
                # What the parts of any product with a query add up to at most.
                most = np.abs(queries) @ np.maximum(np.abs(low[0]), np.abs(high[0]))
                found = [
                    (i, *(search if most_of < EXACT else search_wide)(q, i, points, ids, nodes, bounds, k, least))
                    for q, i, bounds, most_of, least in zip(queries, query_ids.tolist(), allowed, most, np.frombuffer(row.least))
                ]
                yield pd.DataFrame({
                    "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
                    "vec_id": np.concatenate([f[1] for f in found]),
                    "score": np.concatenate([f[2].astype("i8") for f in found]),
                })

    return pairs.mapInPandas(run, _FOUND)


def exact_top_k(
    rows: DataFrame, is_query, k: int, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding",
    shard: int = SHARD, leaf: int = LEAF, block: int = QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` largest integer inner products.

    Components x count as floor(scale * x). Queries are the rows for whose id
    ``is_query(id)`` holds, candidates all rows but the query's own; fewer than
    ``k`` candidates are all returned, none give no rows. ``vectors.usable``
    says which rows take part. Scores are exact: queries whose products with a
    shard may pass 2^53 are scored there in whole numbers of any size, which is
    slow; a score beyond a long fails.

    Every query meets every shard: blocks of queries against all rows. A shard
    holds about ``shard`` rows however common a vector or an id pattern is.
    """
    whole = vectors.usable(rows, key, vector)
    # Beyond 2^53 doubles are whole, and may be too large for a long.
    floored = F.transform("vec", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale))
    whole = whole.withColumn("vec", floored)
    whole = tables.stored(whole, "search-rows")
    candidates = tables.stored(vectors.fewest(whole, k + 1), "search-candidates")
    shards = vectors.blocks(candidates.count(), shard)
    trees = tables.stored(_packed_shards(candidates, shards, leaf), "search-trees")
    queries = whole.where(is_query(F.col("id")))
    parts = vectors.blocks(queries.count(), block)

    # Each block of queries is a task of its own, to which the first shard comes.
    first = _packed_queries(queries.withColumn("least", F.lit(float("-inf"))), parts).repartition(parts)
    start = trees.where(F.col("shard") == 0)
    size = start.agg(F.max(F.octet_length("points"))).first()[0] or 0
    start = F.broadcast(start) if size <= BROADCAST_SHARD else start
    pilot = tables.stored(_searched(first.join(start, F.col("on") == F.col("shard")), k), "search-pilot")
    kth = pilot.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    known = queries.join(kth, queries["id"] == kth["query_id"], "left").select(
        "id", "vec", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("least")
    )
    if shards == 1:
        return vectors.best(pilot, k)
    others = _packed_queries(known, parts).withColumn("on", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
    rest = _searched(others.join(trees, F.col("on") == F.col("shard")), k)
    return vectors.best(pilot.unionByName(rest), k)

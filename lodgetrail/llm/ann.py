"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and every row is filed under a leaf. A
query walks the tree best bin first, through a priority queue on the distance
to the nodes' centres, and reads a number of leaves. That number is widened,
on a sample of queries with known answers, until recall reaches its target.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm import tables, vectors

#: Vectors the tree is fitted on at most, chosen by a hash of their ids.
SAMPLE = 16_384
#: Queries whose true neighbours are found to calibrate the leaf visits.
CALIBRATION = 256
BRANCH = 8
LEAF = 64
#: Recall to reach on the calibration queries; what is promised is 0.9.
RECALL = 0.95
#: Rows of a leaf, and queries, in one block of work.
CHUNK = 4096
QUERIES = 1024


@dataclass
class Tree:
    centres: np.ndarray  # unit vectors, one per node
    children: list[list[int]]  # empty at leaves
    leaf_number: np.ndarray  # -1 inside

    @property
    def leaves(self) -> int:
        return int((self.leaf_number >= 0).sum())


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 3) -> Tree:
    """Hierarchical k-means on directions. Nodes that cannot be split, as all are alike, stay leaves."""
    rng = np.random.default_rng(seed)
    x = _unit(sample)
    tree = Tree(np.zeros((0, x.shape[1])), [[]], np.zeros(0, "i4"))
    centres, waiting = [x.mean(0)], [(0, np.arange(len(x)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf:
            continue
        points = x[rows]
        means = points[rng.choice(len(rows), branch, replace=False)]
        for _ in range(8):
            own = (points @ means.T).argmax(1)
            sums = np.zeros_like(means)
            np.add.at(sums, own, points)
            filled = np.bincount(own, minlength=branch) > 0
            lengths = np.linalg.norm(sums, axis=1)
            good = filled & (lengths > 0)
            means[good] = sums[good] / lengths[good, None]
        own = (points @ means.T).argmax(1)
        used = np.unique(own)
        if len(used) < 2:
            continue
        for group in used:
            centres.append(means[group])
            tree.children.append([])
            tree.children[node].append(len(centres) - 1)
            waiting.append((len(centres) - 1, rows[own == group]))
    tree.centres = np.array(centres)
    ends = np.array([not c for c in tree.children])
    tree.leaf_number = np.where(ends, np.cumsum(ends) - 1, -1)
    return tree


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: down the tree, at every node to the nearest child."""
    at = np.zeros(len(x), "i8")
    x = _unit(x)
    moving = np.arange(len(x))
    while True:
        moving = moving[[bool(tree.children[n]) for n in at[moving]]]
        if not len(moving):
            return tree.leaf_number[at]
        for node in np.unique(at[moving]):
            rows = moving[at[moving] == node]
            children = np.array(tree.children[node])
            at[rows] = children[(x[rows] @ tree.centres[children].T).argmax(1)]


def visits(tree: Tree, x: np.ndarray, wide: int, held: np.ndarray, least: int) -> list[list[int]]:
    """The first ``wide`` leaves of each row's traversal, best bin first, and more until they hold ``least`` rows."""
    out = []
    for own in _unit(x) @ tree.centres.T:
        heap, found, rows = [(0.0, 0)], [], 0
        while heap and (len(found) < wide or rows < least):
            _, node = heapq.heappop(heap)
            children = tree.children[node]
            if not children:
                found.append(int(tree.leaf_number[node]))
                rows += held[found[-1]]
            for child in children:
                heapq.heappush(heap, (-own[child], child))
        out.append(found)
    return out


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of every query with every row, to within some last bits: those depend on the shapes multiplied."""
    return (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1))


def pair_cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one query with every row, each pair summed by itself: the same pair has the same score wherever it is."""
    # Sums along the last axis of whole rows depend on the row alone.
    x = np.ascontiguousarray(x)
    norms = np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(1))
    return (x * q).sum(1) / norms


def _best_rows(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` best rows: all that the product cannot tell from the ``k``-th are scored again pair by pair."""
    queries, places, found = [], [], []
    slack = 8 * (x.shape[1] + 8) * np.finfo("f8").eps
    for i, own, mine in zip(q_ids.tolist(), cosines(q, x), q):
        near = np.flatnonzero(ids != i)
        if len(near) > k:
            edge = np.partition(own[near], len(near) - k)[len(near) - k]
            near = near[own[near] >= edge - slack]
        scores = pair_cosines(mine, x[near])
        chosen = vectors.top(scores, ids[near], k)
        queries.append(np.full(len(chosen), i))
        places.append(near[chosen])
        found.append(scores[chosen])
    place = np.concatenate(places)
    return pd.DataFrame({"query_id": np.concatenate(queries), "vec_id": ids[place], "score": np.concatenate(found), "place": place})


def calibrate(filed: DataFrame, queries: pd.DataFrame, tree: Tree, k: int, recall: float) -> tuple[int, float]:
    """Leaves to visit, and the recall then reached on these queries, whose true neighbours are found among all rows."""
    spark = filed.sparkSession
    q, q_ids = vectors.matrix(queries["vec"]), queries["id"].to_numpy("i8")
    sent = spark.sparkContext.broadcast((q, q_ids))

    def scan(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, own_ids = sent.value
        for frame in frames:
            if len(frame):
                ids = frame["id"].to_numpy("i8")
                near = _best_rows(own, own_ids, vectors.matrix(frame["vec"]), ids, k)
                near["leaf"] = frame["leaf"].to_numpy("i4")[near.pop("place")]
                yield near[["query_id", "vec_id", "score", "leaf"]]

    found = filed.select("id", "vec", "leaf").mapInPandas(scan, "query_id long, vec_id long, score double, leaf int")
    nearest = vectors.best(found, k, "leaf")
    truth = nearest.select("query_id", "leaf").toPandas()  # k rows per calibration query
    if not len(truth):
        return 1, 1.0
    order = visits(tree, q, tree.leaves, np.zeros(tree.leaves), 0)
    place = {(i, leaf): n for i, own in zip(q_ids.tolist(), order) for n, leaf in enumerate(own)}
    needed = np.array([place[i, leaf] for i, leaf in truth.itertuples(index=False)]) + 1
    wide = 1
    while (needed <= wide).mean() < recall and wide < tree.leaves:
        wide += 1
    return wide, float((needed <= wide).mean())


def _filed(rows: DataFrame, tree: Tree) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vec in batches:
            yield pd.Series(assign(sent.value, vectors.matrix(vec)) if len(vec) else [], dtype="int32")

    return rows.withColumn("leaf", leaf("vec"))


def _packed(rows: DataFrame, keys: list[str], ids: str, points: str) -> DataFrame:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        points_ = vectors.matrix(pdf["vec"])
        row = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(row | {"dim": [points_.shape[1]], ids: [pdf["id"].to_numpy("i8").tobytes()], points: [points_.tobytes()]})

    kinds = ", ".join(f"{k} int" for k in keys)
    return rows.groupBy(*keys).applyInPandas(pack, f"{kinds}, dim int, {ids} binary, {points} binary")


def nearest(
    rows: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL,
    sample: int = SAMPLE, leaf: int = LEAF,
) -> tuple[DataFrame, dict]:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (cosine) of each query's ``k`` nearest found, and the calibration.

    Queries are the rows for whose id ``is_query(id)`` holds, candidates all
    rows but the query's own. Beside what ``vectors.usable`` leaves out, zero
    vectors take no part. Visits go on until ``k`` candidates are seen, so only a table
    with fewer returns fewer.

    Leaves are searched in blocks of ``CHUNK`` rows, so a crowded one is many
    pieces of work; equal vectors count ``k + 1`` times at most.
    """
    spark = rows.sparkSession
    whole = vectors.usable(rows, key, vector).where(F.exists("vec", lambda x: x != 0))
    whole = tables.stored(whole, "ann-rows")
    candidates = vectors.fewest(whole, k + 1)
    fitted = whole.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toPandas()
    tree = fit(vectors.matrix(fitted["vec"]), leaf=leaf) if len(fitted) else Tree(np.zeros((1, 1)), [[]], np.zeros(1, "i4"))
    filed = tables.stored(_filed(candidates, tree), "ann-filed")
    queries = whole.where(is_query(F.col("id")))
    known = queries.orderBy(F.xxhash64("id", F.lit("calibration")), "id").limit(CALIBRATION).toPandas()
    wide, reached = calibrate(filed, known, tree, k, recall) if len(known) else (1, 1.0)
    figures = {"leaves": tree.leaves, "visited": wide, "calibrated_recall": reached}

    sizes = filed.groupBy("leaf").agg(F.count("*").alias("held"))
    held = np.zeros(tree.leaves, "i8")  # the fitted tree bounds the number of leaves
    for row in sizes.collect():
        held[row["leaf"]] = row["held"]
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / CHUNK)).cast("int")
    stock = _packed(filed.join(F.broadcast(sizes), "leaf").withColumn("chunk", chunk), ["leaf", "chunk"], "ids", "points")
    sent = spark.sparkContext.broadcast((tree, held))

    @F.pandas_udf("array<int>")
    def visited(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vec in batches:
            yield pd.Series(visits(sent.value[0], vectors.matrix(vec), wide, sent.value[1], k + 1) if len(vec) else [], dtype=object)

    parts = vectors.blocks(queries.count(), QUERIES)
    asked = queries.withColumn("visits", visited("vec")).select("id", "vec", F.explode("visits").alias("leaf"))
    asked = _packed(asked.withColumn("block", vectors.dealt("id", parts)), ["leaf", "block"], "query_ids", "queries").drop("dim")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                points = np.frombuffer(row.points).reshape(-1, row.dim)
                q = np.frombuffer(row.queries).reshape(-1, row.dim)
                ids, q_ids = np.frombuffer(row.ids, "i8"), np.frombuffer(row.query_ids, "i8")
                yield _best_rows(q, q_ids, points, ids, k).drop(columns="place")

    found = asked.join(stock, "leaf").mapInPandas(run, "query_id long, vec_id long, score double")
    return vectors.best(found, k), figures

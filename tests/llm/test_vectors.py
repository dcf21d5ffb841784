"""Vector searches against trying every row."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import top_products

from lodgetrail.llm import ann, kdtree, vectors

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"
HARD = [
    (None, [1.0, 0.0, 0.0]),
    (900, None),
    (901, [1.0, None, 0.0]),
    (902, [float("nan"), 0.0, 0.0]),
    (903, [float("inf"), 0.0, 0.0]),
    (904, [0.0, 0.0, 0.0]),
    (905, [1.0, 2.0]),
    (906, []),
]


def made(spark, n: int, dim: int = 3, seed: int = 1, extra=()):
    """Every third vector is the same one; ids count from 0; hard rows besides."""
    rng = np.random.default_rng(seed)
    points = rng.normal(0, 1, (n, dim)).astype("f4")
    points[::3] = points[0]
    rows = [(i, p.tolist(), "x", "y") for i, p in enumerate(points)] + [(i, v, "x", "y") for i, v in extra]
    return spark.createDataFrame(rows, SCHEMA).repartition(5), points


@pytest.mark.parametrize("shard,leaf,block", [(10_000, 16, 512), (60, 8, 7), (25, 1, 3)])
def test_exact_search_is_exact(spark, shard, leaf, block):
    rows, points = made(spark, 300, extra=HARD)
    found = kdtree.exact_top_k(rows, lambda i: i % 20 == 0, 20, shard=shard, leaf=leaf, block=block).collect()
    # The zero vector takes part here; it is no query.
    whole = np.vstack([np.floor(64 * points.astype("f8")), np.zeros((1, 3))])
    ids = [*range(300), 904]
    assert {tuple(r) for r in found} == top_products(ids, whole, [i for i in ids if i % 20 == 0], 20)


def test_exact_search_with_few_or_no_candidates(spark):
    rows = spark.createDataFrame([(0, [1.0, -1.0], "", ""), (5, [2.0, 0.5], "", ""), (5, [2.0, 0.5], "", "")], SCHEMA)
    found = kdtree.exact_top_k(rows, lambda i: i % 20 == 0, 20).collect()
    assert [tuple(r) for r in found] == [(0, 1, 5, 64 * 128 - 64 * 32)]
    alone = spark.createDataFrame([(0, [1.0], "", "")], SCHEMA)
    assert kdtree.exact_top_k(alone, lambda i: i % 20 == 0, 20).count() == 0
    assert kdtree.exact_top_k(spark.createDataFrame([], SCHEMA), lambda i: i % 20 == 0, 20).count() == 0


def test_tree_boxes_are_tight_and_leaves_whole():
    points = np.random.default_rng(3).integers(-5, 5, (500, 4)).astype("f8")
    order, nodes, low, high = kdtree.build(points, 16)
    assert sorted(order) == list(range(500))
    leaves = [tuple(n[:2]) for n in nodes if n[2] < 0]
    assert sorted(leaves)[0][0] == 0 and sum(b - a for a, b in leaves) == 500
    for (first, last, _), a, b in zip(nodes, low, high):
        assert (points[order[first:last]].min(0) == a).all() and (points[order[first:last]].max(0) == b).all()
    same = kdtree.build(np.ones((100, 2)), 16)[1]
    assert len(same) == 1


def nearest_by_all(ids: list[int], points: np.ndarray, queries: list[int], k: int) -> dict[int, list[int]]:
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    out = {}
    for q in queries:
        scores = unit @ unit[ids.index(q)]
        out[q] = [i for _, i in sorted((-round(s, 12), i) for s, i in zip(scores, ids) if i != q)[:k]]
    return out


def test_tree_search_reaches_its_recall(spark):
    rows, points = made(spark, 3000, dim=8, extra=[(i, v) for i, v in HARD if v is None or len(v) != 8])
    found, figures = ann.nearest(rows, lambda i: i % 50 == 0, 5, sample=1000, leaf=16)
    got = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    truth = nearest_by_all(list(range(3000)), points.astype("f8"), list(range(0, 3000, 50)), 5)
    assert got.keys() == truth.keys() and all(len(g) == 5 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & set(t)) / 5 for q, t in truth.items()]) >= 0.9
    assert figures["visited"] < figures["leaves"] and figures["calibrated_recall"] >= 0.95
    for q, own in got.items():
        for i, score in own:
            a, b = points[q].astype("f8"), points[i].astype("f8")
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_tree_search_of_little(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA), lambda i: i % 50 == 0, 5)[0].count() == 0
    rows = spark.createDataFrame([(i, v, "", "") for i, v in HARD if v is None or len(v) != 3], SCHEMA)
    assert ann.nearest(rows, lambda i: i % 50 == 0, 5)[0].count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (1, [0.0, 1.0], "", ""), (2, [2.0, 0.1], "", ""), (4, [0.0, 0.0], "", "")], SCHEMA)
    assert [(r["rank"], r["vec_id"]) for r in ann.nearest(few, lambda i: i % 50 == 0, 5)[0].orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_a_pair_has_one_score_in_every_block():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 48))
    x[1::4] = x[0]
    ids = rng.permutation(60)
    whole = ann._best_rows(x[:20], ids[:20], x, ids, 59).set_index(["query_id", "vec_id"])["score"]
    for size in (1, 3, 7, 37):
        for a in range(0, 60, size):
            part = ann._best_rows(x[3:4], ids[3:4], x[a : a + size], ids[a : a + size], 59)
            assert all(whole[q, i] == s for q, i, s in part[["query_id", "vec_id", "score"]].itertuples(index=False))
    # Of equal rows the smaller ids come first.
    twins = sorted(ids[i] for i in (0, *range(1, 60, 4)) if i != 1)
    assert ann._best_rows(x[1:2], ids[1:2], x, ids, 5)["vec_id"].tolist() == twins[:5]


def test_tied_and_repeated_rows_rank_by_id(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(400, 16))
    points[::3] = points[0]
    points[1::5] = points[1]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] * 2
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7), lambda i: i % 50 == 0, 5, leaf=16)[0]
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 400, 50))
    for q, own in got.items():
        assert own == sorted(own, key=lambda r: (-r[1], r[0])) and len({i for i, _ in own}) == 5
        twins = [i for i in range(400) if i != q and (points[i] == points[q]).all()]
        if len(twins) >= 5:
            assert [i for i, _ in own] == twins[:5]


def test_equal_vectors_count_a_few_times(spark):
    rows, _ = made(spark, 300)
    kept = vectors.fewest(vectors.usable(rows, "vec_id", "embedding"), 6).collect()
    counts = Counter(tuple(r["vec"]) for r in kept)
    assert max(counts.values()) == 6 and len(kept) == 200 + 6
    assert sorted(r["id"] for r in kept if counts[tuple(r["vec"])] == 6) == [0, 3, 6, 9, 12, 15]


@pytest.mark.parametrize("size", [1e6, 3e7])
@pytest.mark.parametrize("broadcast", [0, 64 << 20])
def test_products_beyond_doubles_are_exact(spark, monkeypatch, size, broadcast):
    monkeypatch.setattr(kdtree, "BROADCAST_SHARD", broadcast)
    rng = np.random.default_rng(8)
    # Near each other, so that doubles round many of the products alike.
    vectors_ = np.concatenate([size + rng.random((150, 2)) * 2, rng.normal(size=(50, 2))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors_)], "vec_id long, embedding array<double>")
    whole = [[int(x) for x in np.floor(v * 64)] for v in vectors_]
    expected = set()
    for q in range(0, 200, 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)
        expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:20], 1)}
    found = kdtree.exact_top_k(rows, lambda i: i % 20 == 0, 20, shard=40, leaf=8, block=3).collect()
    assert {tuple(r) for r in found} == expected

"""Operator 4 against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from packhorse.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, rank int"


def best(rows, k, asked):
    """Per query all scores in order; rows are told apart by their place."""
    usable = [
        (i, key, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (key, v, _) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for i, key, v in usable:
        if key is not None and asked(key):
            scores = sorted(
                ((-sum(a * b for a, b in zip(v, w, strict=True)), other is None, other or 0) for j, other, w in usable if j != i and len(w) == len(v))
            )
            found += [(key, n + 1, None if null else other, -score) for n, (score, null, other) in enumerate(scores[:k])]
    return sorted(found, key=str)


def searched(spark, rows, settings, every=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = cover_tree.search(df, F.col("vec_id") % every == 0, settings)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("kind", ["noise", "clusters", "copies", "norms"])
def test_equals_all_products(spark, kind):
    draw = np.random.default_rng(len(kind))
    points = draw.normal(size=(400, 6))
    if kind == "clusters":
        points = 5 * draw.normal(size=(8, 6))[draw.integers(0, 8, 400)] + 0.1 * points
    if kind == "copies":
        points[100:300] = points[0]
    if kind == "norms":
        points *= draw.lognormal(0, 2, size=(400, 1))
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    settings = cover_tree.Settings(sample=64, leaf_rows=40, block=32, query_block=8)
    assert searched(spark, rows, settings) == best(rows, 5, lambda key: key % 3 == 0)


def test_odd_vectors(spark):
    """Nulls, non-finite components, other lengths, repeated rows and keys, too few candidates, no rows."""
    rows = [
        (0, [1.0, 0.5], 0), (0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (None, [1.0, 0.5], 0), (None, [2.0, 0.0], 0), (3, None, 0), (6, [], 0),
        (9, [float("nan"), 1.0], 0), (12, [float("inf"), 1.0], 0), (15, [1.0, None], 0), (18, [1.0, 2.0, 3.0], 0), (21, [-0.001, 0.0], 0),
    ]
    settings = cover_tree.Settings(sample=2, leaf_rows=2, block=2, query_block=1)
    assert searched(spark, rows, settings) == best(rows, 5, lambda key: key % 3 == 0)
    assert searched(spark, rows[:0], settings) == []
    large = [(i, [1e6 * (i + 1), -3e6], 0) for i in range(9)]
    assert searched(spark, large, settings) == best(large, 5, lambda key: key % 3 == 0)


def test_the_tree_covers_its_points():
    draw = np.random.default_rng(2)
    points = draw.normal(size=(500, 4))
    tree = cover_tree.fit(points, 40)
    reached, todo = [], [0]
    while todo:
        node = todo.pop()
        reached.append(node)
        todo += tree.children[node]
    assert sorted(reached) == list(range(len(tree.centres))) and len(reached) == 40
    leaf = np.linalg.norm(points[:, None] - tree.centres[None], axis=2).argmin(axis=1)
    own = np.array([np.linalg.norm(points[leaf == i] - tree.centres[i], axis=1).max(initial=-np.inf) for i in range(40)])
    radius = cover_tree.Covers.of(tree, own).radius
    assert all(np.linalg.norm(points - tree.centres[0], axis=1) <= radius[0] + 1e-9)
    assert len(cover_tree.fit(np.ones((9, 3)), 5).centres) == 1


def test_far_pairs_are_pruned():
    """Queries that already have better results than a far cluster can give never meet it."""
    points = np.array([[10.0, 0], [9, 1], [-10, 0], [-9, 1], [0, 10], [0, -10]])
    tree = cover_tree.fit(points, 6)
    radius = np.full(len(tree.centres), 0.5)
    products = tree.centres @ tree.centres.T
    worst = products.max(axis=1)
    pairs = set(cover_tree.surviving(tree, radius, worst, radius))
    assert {(i, int(products[i].argmax())) for i in range(len(worst))} <= pairs < {(i, j) for i in range(6) for j in range(6)}
    for i, j in {(i, j) for i in range(6) for j in range(6)} - pairs:
        reach = products[i, j] + 0.5 * (np.linalg.norm(tree.centres[i]) + np.linalg.norm(tree.centres[j])) + 0.25
        assert reach < worst[i]


def kept_share(points, leaves, every=50, k=5):
    """The share of pairs of a query and a row that the traversal keeps, with every query's exact worst score."""
    tree = cover_tree.fit(points, leaves)
    size = len(tree.centres)
    square = (points**2).sum(axis=1)[:, None] + (tree.centres**2).sum(axis=1)[None] - 2 * points @ tree.centres.T
    leaf, asks = square.argmin(axis=1), np.arange(0, len(points), every)
    scores = points[asks] @ points.T
    scores[np.arange(len(asks)), asks] = -np.inf
    worst = np.sort(scores, axis=1)[:, -k]
    far = np.linalg.norm(points - tree.centres[leaf], axis=1)

    def per_leaf(values, rows, how, missing):
        out = np.full(size, missing)
        how.at(out, leaf[rows], values)
        return out

    rows = np.arange(len(points))
    pairs = cover_tree.surviving(
        tree, per_leaf(far[asks], asks, np.maximum, -np.inf), per_leaf(worst, asks, np.minimum, np.inf), per_leaf(far, rows, np.maximum, -np.inf)
    )
    queries, candidates = np.bincount(leaf[asks], minlength=size), np.bincount(leaf, minlength=size)
    return sum(queries[a] * candidates[b] for a, b in pairs) / (len(asks) * len(points))


def test_what_the_traversal_prunes(spark):
    """Most pairs where vectors lie in clusters; next to none of the given ones, which are spread evenly over a sphere."""
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(40, 16))
    clusters = np.floor(256 * (centres / np.linalg.norm(centres, axis=1)[:, None])[draw.integers(0, 40, 2000)] + 2 * draw.normal(size=(2000, 16)))
    assert kept_share(clusters, 64) < 0.25
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    given = np.floor(256 * np.array([row.embedding for row in rows], float))
    shares = {leaves: kept_share(given, leaves) for leaves in (64, 256, 1000)}
    assert shares[64] > 0.99 and shares[256] > 0.99 and 0.5 < shares[1000] <= 1

"""Grown trees against a plain search, with whole and cut tables, and the passes that a forest takes."""

from __future__ import annotations

import random

import numpy as np
import pytest

from paneloom.operators import growth as G
from paneloom.operators import models as M
from paneloom.store import materialise


def plain(x, y, w, sizes, depth, least=1):
    """The prediction of each row by the best split of every node, searched one by one; ties go to the first."""
    mean = (w * y).sum() / w.sum()
    if depth:
        best = None
        for j, b in enumerate(sizes):
            for cut in range(b - 1 if j < len(sizes) - 1 else b):
                right = x[j] > cut if j < len(sizes) - 1 else x[j] == cut
                sides = [(w[s].sum(), (w[s] * y[s]).sum()) for s in (right, ~right)]
                if min(n for n, _ in sides) >= least:
                    score = sum(s * s / n for n, s in sides)
                    if best is None or score > best[0] + 1e-9:
                        best = (score, right)
        if best and best[0] > (w * y).sum() ** 2 / w.sum() + 1e-9:
            out, right = np.empty(len(y)), best[1]
            for side in (right, ~right):
                out[side] = plain(x[:, side], y[side], w[side], sizes, depth - 1, least)
            return out
    return np.full(len(y), mean)


def rows_of(seed, n=400):
    rng = np.random.default_rng(seed)
    sizes = [7, 1, 12, 4]
    x = np.stack([rng.integers(0, b, n) for b in sizes]).astype(np.uint8)
    y = x[0] * 0.3 + (x[2] > 5) * x[3] + rng.normal(size=n)
    return x, y - y.mean(), rng.poisson(1.0, n).astype(np.uint8), sizes


def values(tree, x, p):
    node = np.zeros(x.shape[1], int)
    while (tree["left"][node] >= 0).any():
        f = tree["feature"][node]
        v = x[np.maximum(f, 0), np.arange(x.shape[1])]
        right = np.where(f < p, v > tree["cut"][node], v == tree["cut"][node])
        node = np.where(tree["left"][node] >= 0, tree["left"][node] + right, node)
    return (tree["s"] / tree["n"])[node]


@pytest.mark.parametrize("least", [1, 9])
@pytest.mark.parametrize("cells, chunk", [(G.CELLS, G.CHUNK), (20, 64)])
def test_a_tree_is_the_one_found_by_plain_search(monkeypatch, cells, chunk, least):
    """Also where the tables of a level are too large to be held and nodes are taken a few at a time."""
    monkeypatch.setattr(G, "CELLS", cells)
    monkeypatch.setattr(G, "CHUNK", chunk)
    for seed in range(4):
        x, y, w, sizes = rows_of(seed)
        tree = G.grow(x, y, w, sizes, G.Rules(1, 5, 32, 1, 1.0, True, least, 0.0))
        own = w > 0
        assert values(tree, x, 3)[own] == pytest.approx(plain(x[:, own], y[own], w[own].astype(float), sizes, 5, least), abs=1e-9)
        leaf = tree["left"] < 0
        assert tree["n"][leaf].sum() == w.sum() and tree["n"].min() >= least


def test_a_pure_node_and_an_empty_bag_are_leaves():
    x, y, w, sizes = rows_of(1)
    rules = G.Rules(1, 5, 32, 1, 1.0, True, 1, 0.0)
    assert len(G.grow(x, np.full(len(y), 3.7), w, sizes, rules)["n"]) == 1
    assert len(G.grow(x, y, np.zeros_like(w), sizes, rules)["n"]) == 1


def test_thresholds_are_midpoints_by_equal_shares():
    assert G.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert G.thresholds(np.array([5.0, 5.0]), 32).tolist() == []
    cuts = G.thresholds(np.arange(1000.0), 4)
    assert cuts.tolist() == [249.5, 499.5, 749.5]
    heavy = np.concatenate([np.zeros(900), np.arange(1.0, 101.0)])  # one value holds most rows
    assert len(set(G.thresholds(heavy, 10))) == len(G.thresholds(heavy, 10)) > 0


def test_bags_are_draws_with_replacement():
    rules = G.Rules(2, 5, 32, 42, 1.0, True, 1, 0.0)
    a, b = G.bag(rules, 0, 300_000), G.bag(rules, 1, 300_000)
    shares = np.bincount(a, minlength=4)[:4] / len(a)
    assert shares == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.004)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01 and abs(np.corrcoef(a[1:], a[:-1])[0, 1]) < 0.01
    assert (G.bag(rules, 0, 1000) == a[:1000]).all()


def test_more_trees_take_no_more_passes(spark):
    """The jobs of a fit do not follow the number of trees, their depth or the buffer."""
    rng = random.Random(3)
    rows = [(i, 2000 + i % 7, f"g{i % 3}", rng.random(), rng.random(), rng.random()) for i in range(600)]
    train = materialise(spark.createDataFrame(rows, "entity int, period int, grp string, x double, z double, y double"), "rows")
    jobs = []
    for trees, depth in ((2, 3), (40, 9)):
        spark.sparkContext.setJobGroup(f"fit-{trees}", "a fit")
        model = M.fit(M.forest("y", trees, depth, buffer_mb=1), train, ["x", "z"])
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{trees}")))
        assert model.pipeline.stages[-1].getNumTrees == trees
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 2


def test_rows_are_scored_without_mllibs_model_in_the_driver(spark):
    """By a walk of the stored nodes, equal to MLlib's transform; a row without a feature is an error as there."""
    rng = random.Random(5)
    rows = [(i, 2000 + i % 7, f"g{i % 3}", rng.random(), rng.random(), rng.random()) for i in range(300)]
    train = materialise(spark.createDataFrame(rows, "entity int, period int, grp string, x double, z double, y double"), "rows")
    model = M.fit(M.forest("y", 12, 6), train, ["x", "z"])
    at = lambda df: {r.entity: r.prediction for r in df.collect()}
    found, long = at(M.predict(model, train)), at(M.predictions_long({"forest": model}, train))
    assert "pipeline" not in vars(model)
    assert found == pytest.approx(at(model.transform(train)), abs=1e-12) and found == long
    with pytest.raises(Exception, match="null or NaN"):
        M.predict(model, train.selectExpr("entity", "period", "grp", "x", "cast(null as double) as z")).collect()

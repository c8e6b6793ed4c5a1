"""Leaf-wise boosting against a plain NumPy version, tree by tree, and its stopping rule."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.operators import boosting as B

NAMES = ["a", "b", "c", "d"]


def data(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    margin = x[:, 0] * 2 - (x[:, 1] > 0.3) * 3 + x[:, 2] * x[:, 3] + rng.normal(size=n)
    return x, (margin > 0).astype(float), rng.random(n) < 0.25


def frame(spark, x, y, held):
    rows = [(*map(float, r), float(t), bool(h), float(1.0 + t)) for r, t, h in zip(x, y, held, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, held boolean, w double")


def plain_tree(x, g, h, cuts, leaves, depth, rate, min_rows, penalty):
    """A list of (path, value) leaves; a path is the (feature, bin, side) of every split above."""

    def best(own):
        found = None
        term = lambda a, b: (a / B.UNIT) ** 2 / (b / B.UNIT + penalty)
        gs, hs = g[own].sum(), h[own].sum()
        for f, cut in enumerate(cuts):
            for b, at in enumerate(cut):
                left = own[x[own, f] <= at]
                if len(left) < min_rows or len(own) - len(left) < min_rows:
                    continue
                gl, hl = g[left].sum(), h[left].sum()
                if hl <= 0 or hs - hl <= 0:
                    continue
                gain = term(gl, hl) + term(gs - gl, hs - hl) - term(gs, hs)
                if gain > 1e-9 and (found is None or gain > found[0]):
                    found = (gain, f, b)
        return found

    open_leaves, done, number = [], [], 0

    def add(path, own):
        nonlocal number
        found = best(own) if len(path) < depth else None
        heapq.heappush(open_leaves, (-found[0], number, path, own, found)) if found else done.append((path, own))
        number += 1

    add((), np.arange(len(x)))
    while open_leaves and len(open_leaves) + len(done) < leaves:
        _, _, path, own, (_, f, b) = heapq.heappop(open_leaves)
        side = x[own, f] <= cuts[f][b]
        add((*path, (f, b, 0)), own[side])
        add((*path, (f, b, 1)), own[~side])
    done += [(path, own) for _, _, path, own, _ in open_leaves]
    value = lambda own: float(-(g[own].sum() / B.UNIT) / (h[own].sum() / B.UNIT + penalty)) * rate
    return {path: (value(own), own) for path, own in done}


def paths(tree, node=0, path=()):
    if tree.feature[node] < 0:
        return {path: tree.value[node]}
    step = (int(tree.feature[node]), int(tree.cut[node]))
    return paths(tree, tree.left[node], (*path, (*step, 0))) | paths(tree, tree.right[node], (*path, (*step, 1)))


@pytest.mark.parametrize("few", [0, 8])
def test_equals_a_plain_version_tree_by_tree(spark, monkeypatch, few):
    monkeypatch.setattr(B, "REWRITE", 3)
    monkeypatch.setattr(B, "FEW", few)
    x, y, held = data(2000, 3)
    df = frame(spark, x, y, held).repartition(3)
    setting = dict(depth=5, leaves=12, rate=0.2, min_rows=15, penalty=1e-3)
    model = B.fit(df, NAMES, "y", "w", "held", trees=8, patience=50, **setting)
    cuts = B.cut_points(df.where("NOT held"), NAMES)
    base, w = ~held, 1.0 + y
    score = np.full(len(x), math.log((w * y)[base].sum() / (w * (1 - y))[base].sum()))
    losses = []
    for tree in model.trees:
        p = 1 / (1 + np.exp(-score))
        losses.append((np.logaddexp(0, score) - y * score)[held].mean())
        g, h = np.rint(w * (p - y) * B.UNIT), np.rint(w * p * (1 - p) * B.UNIT)
        expected = plain_tree(x[base], g[base], h[base], cuts, **setting)
        assert {k: pytest.approx(v[0], abs=1e-9) for k, v in expected.items()} == paths(tree)
        assert len(expected) <= 12
        score = score + tree.value[tree.places(list(x.T), tree.at)]
    assert len(model.trees) == 8 and model.losses[:8] == pytest.approx(losses, abs=1e-6)
    found = df.select(*NAMES, model.probability().alias("p")).collect()
    of = {tuple(r[:4]): r["p"] for r in found}
    assert all(of[tuple(r)] == pytest.approx(1 / (1 + math.exp(-s)), abs=1e-9) for r, s in zip(x.tolist(), score, strict=True))


def test_stops_when_held_out_rows_no_longer_improve(spark):
    rng = np.random.default_rng(1)
    x, _, held = data(400, 2)
    model = B.fit(frame(spark, x, rng.integers(0, 2, 400).astype(float), held), NAMES, "y", None, "held", trees=60, rate=0.5, patience=4, min_rows=5)
    assert len(model.losses) < 40 and len(model.trees) == int(np.argmin(model.losses))
    assert len(model.losses) - 1 - len(model.trees) == 4


def test_partitions_do_not_matter_and_odd_tables(spark):
    x, y, held = data(300, 5)
    df = frame(spark, x, y, held)
    one, two = (B.fit(df.repartition(n), NAMES, "y", "w", "held", trees=3, min_rows=5) for n in (1, 7))
    assert [paths(t) for t in one.trees] == [paths(t) for t in two.trees]
    odd = spark.createDataFrame([(None, float("nan"), 1.0, 0.0)], "a double, b double, c double, d double")
    p = odd.select(one.probability()).first()[0]
    assert p == odd.na.fill(0.0).withColumn("b", F.lit(0.0)).select(one.probability()).first()[0] and 0 < p < 1
    assert B.fit(df.limit(0), NAMES, "y").trees == [] and B.fit(df.where("y = 1"), NAMES, "y").probability() is not None
    assert df.limit(1).select(B.fit(df.where("y = 1"), NAMES, "y").probability()).first()[0] == 1.0


def test_the_last_leaves_take_no_pass(spark, monkeypatch):
    """Their sums stand in their parents': a tree of depth 2 is two passes over the rows."""
    rows = spark.range(400).selectExpr("cast(id % 20 as double) AS a", "cast(id % 7 as double) AS b", "cast(id % 20 > 11 and id % 7 > 2 as int) AS y")
    passes = []
    plain = B.histograms
    monkeypatch.setattr(B, "histograms", lambda *a, **k: passes.append(1) or plain(*a, **k))
    model = B.fit(rows, ["a", "b"], "y", trees=3, depth=2, leaves=4)
    assert len(model.trees) == 3 and len(passes) == 6


def test_a_small_table_takes_no_passes_and_large_ones_never_walk_a_finished_tree_again(spark, monkeypatch):
    """The same model by one task, by passes over a cached RDD and by passes over a table, with a rewrite between."""
    x, y, held = data(900, 7)
    df = frame(spark, x, y, held).repartition(5)
    monkeypatch.setattr(B, "REWRITE", 4)
    passes, plain = [], B.histograms
    monkeypatch.setattr(B, "histograms", lambda blocks, recent, *a: passes.append((type(blocks).__name__, len(recent))) or plain(blocks, recent, *a))
    made = []
    for cells, few in ((1 << 24, 8), (0, 3), (0, 0)):
        monkeypatch.setattr(B, "TASK_CELLS", cells)
        monkeypatch.setattr(B, "FEW", few)
        made.append((B.fit(df, NAMES, "y", "w", "held", trees=10, min_rows=5, rate=0.3), passes[:]))
        passes.clear()
    (one, none), (two, cached), (three, table) = made
    assert [paths(t) for t in one.trees] == [paths(t) for t in two.trees] == [paths(t) for t in three.trees] and len(one.trees) > 4
    assert one.losses == two.losses == three.losses and one.start == two.start
    assert none == [] and len(cached) == len(table) > 10
    assert {n for _, n in cached} == {0} and {kind for kind, _ in cached}.isdisjoint({kind for kind, _ in table})
    assert {n for _, n in table} == {0, 1, 2, 3}


def test_held_out_rows_alone_stop_a_table_trained_by_one_task(spark):
    rng = np.random.default_rng(4)
    x, _, held = data(400, 9)
    y = rng.integers(0, 2, 400).astype(float)
    some, none = (B.fit(frame(spark, x, y, h), NAMES, "y", None, "held", trees=30, rate=0.5, patience=4, min_rows=5) for h in (held, held & False))
    assert len(some.losses) - 1 - len(some.trees) == 4 and len(some.losses) < 30
    assert none.losses == [] and len(none.trees) == 30

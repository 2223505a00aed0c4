"""Second-order boosted trees against a plain numpy version (M5)."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lendlens.ml import evaluate as EV
from lendlens.ml.boost import BoostedTrees, BoostParams, _blocks, _histograms, fit_boosted
from lendlens.ml.trees import SCALE, Tree, feature_cuts, uniform


def plain_tree(x, y, margin, rows, features, p):
    """Recursive exact second-order tree with pruning; (tree as nested tuples)."""
    prob = 1 / (1 + np.exp(-margin))
    w = np.where(y > 0, p.scale_pos_weight, 1.0)
    g, h = (prob - y) * w, prob * (1 - prob) * w

    def part(a, b):
        return a * a / (b + p.reg_lambda)

    def grow(rows, depth):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        if depth < p.max_depth:
            for f in features:
                for c in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= c
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    if min(hl, H - hl) < p.min_child_weight:
                        continue
                    gain = part(gl, hl) + part(G - gl, H - hl) - part(G, H)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, c)
        value = -G / (H + p.reg_lambda) * p.learning_rate
        if best is None:
            return ("leaf", value)
        gain, f, c = best
        left = x[rows, f] <= c
        a, b = grow(rows[left], depth + 1), grow(rows[~left], depth + 1)
        if gain < p.gamma and a[0] == b[0] == "leaf":
            return ("leaf", value)
        return (f, a, b, c)

    return grow(np.flatnonzero(rows), 0)


def value(node, row):
    while node[0] != "leaf":
        f, a, b, c = node
        node = a if row[f] <= c else b
    return node[1]


def data(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 20, n), rng.integers(0, 3, n), rng.integers(0, 2, n), rng.normal(size=n).round(1)], axis=1).astype(float)
    y = (x[:, 0] + 4 * x[:, 2] + 3 * rng.normal(size=n) > 11).astype(float)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(r.tolist(), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(parts)


def splits(tree, node=0):
    if tree.feature[node] < 0:
        return ("leaf",)
    return (int(tree.feature[node]), splits(tree, tree.left[node]), splits(tree, tree.right[node]), float(tree.threshold[node]))


def shape(node):
    return ("leaf",) if node[0] == "leaf" else (int(node[0]), shape(node[1]), shape(node[2]), float(node[3]))


@pytest.mark.parametrize("over", [{}, {"gamma": 6.0}, {"min_child_weight": 25.0}, {"scale_pos_weight": 0.3, "reg_lambda": 4.0}, {"max_depth": 1}])
def test_trees_equal_brute_force(spark, over):
    p = BoostParams(**{"rounds": 3, "max_depth": 3, "subsample": 1.0, "column_sample": 1.0, "min_child_weight": 2.0, "refresh": 2, **over})
    x, y = data()
    model = fit_boosted(frame(spark, x, y), "x", "y", 4, p)
    assert len(model.trees) == 3
    margin = np.full(len(x), model.base)
    for t in model.trees:
        want = plain_tree(x, y, margin, np.ones(len(x), bool), range(4), p)
        assert splits(t) == shape(want)
        np.testing.assert_allclose(t.value[t.leaves(x)], [value(want, r) for r in x], atol=1e-5)
        margin = margin + t.value[t.leaves(x)]
    np.testing.assert_allclose(model.margins(x), margin)


def test_sampling_is_honoured(spark):
    """Rows per tree by a hash of the row id, features per tree by the seed;
    the same trees from other partitionings of the same written order."""
    u = uniform(np.arange(100_000), 7)
    assert abs((u < 0.8).mean() - 0.8) < 0.01 and abs(np.corrcoef(u, uniform(np.arange(100_000), 8))[0, 1]) < 0.02
    x, y = data()
    p = BoostParams(rounds=12, max_depth=2, column_sample=0.5, subsample=0.5, min_child_weight=1.0)
    model = fit_boosted(frame(spark, x, y), "x", "y", 4, p)
    assert all(len(set(t.feature[t.feature >= 0].tolist())) <= 2 for t in model.trees)
    assert len({tuple(sorted(set(t.feature[t.feature >= 0].tolist()))) for t in model.trees}) > 1
    assert model.importances().sum() == pytest.approx(1.0)


def test_not_below_first_order_boosting(spark):
    x, y = data(4000, 3)
    df = frame(spark, x, y).withColumn("features", array_to_vector("x"))
    train, test = df.filter(F.xxhash64("x", "y") % 4 != 0), df.filter(F.xxhash64("x", "y") % 4 == 0)
    ours = fit_boosted(train, "x", "y", 4, BoostParams(rounds=20, max_depth=4, learning_rate=0.1, min_child_weight=5.0))
    theirs = GBTClassifier(labelCol="y", maxIter=20, maxDepth=4, stepSize=0.1, seed=1).fit(train)

    def auc(scored):
        return EV.auc_from_roc(EV.roc_curve(scored, "y", "p")).first()["auc"]
    mine = auc(test.select("y", ours.probability(F.col("x")).alias("p")))
    from pyspark.ml.functions import vector_to_array
    assert mine > 0.85 and mine >= auc(theirs.transform(test).select("y", vector_to_array("probability")[1].alias("p"))) - 0.003


def test_saved_and_loaded(spark, tmp_path):
    x, y = data(200)
    model = fit_boosted(frame(spark, x, y), "x", "y", 4, BoostParams(rounds=2, max_depth=2, min_child_weight=1.0))
    model.save(spark, str(tmp_path / "m"))
    back = BoostedTrees.load(spark, str(tmp_path / "m"))
    assert (back.margins(x) == model.margins(x)).all() and (back.importances() == model.importances()).all()


@pytest.mark.parametrize("rows", [[], [([1.0, 2.0], 1.0)], [([1.0, 2.0], 0.0)] * 5])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "x array<double>, y double")
    model = fit_boosted(df, "x", "y", 2, BoostParams(rounds=2))
    assert all(len(t) == 1 for t in model.trees) and np.isfinite(model.margins(np.ones((1, 2)))).all()


def test_leaves_of_a_tree():
    t = Tree.root()
    a, b = t.split(0, 1, 0.5)
    c, d = t.split(b, 0, 2.0)
    assert t.leaves(np.array([[0, 0.5], [2, 1], [3, 1]])).tolist() == [a, c, d] and t.depth() == 2


def test_rows_move_in_blocks_and_sums_a_row_per_node_and_feature(spark):
    """Neither the pass over the training rows nor its shuffle handles single
    rows or bins; features of two bins, added up by pattern, have the sums of
    the others."""
    x, y = data(3000)
    x = np.concatenate([x, x[:, [2, 2]], 1 - x[:, [2]]], axis=1)
    source = frame(spark, x, y).select("x", F.col("y").alias("label"))
    cuts = feature_cuts(source, "x", 7)
    table = _blocks(source, cuts, 0.25)
    assert table.count() <= 3
    root, two = Tree.root(), [f for f, c in enumerate(cuts) if len(c) < 2]
    assert two == [2, 4, 5, 6]
    rows = _histograms(table, [], root, [0], [0, 1, 2, 4, 6], 7, BoostParams(subsample=1.0), 1, two).collect()
    assert len(rows) <= 3 * 5
    prob = 1 / (1 + np.exp(-0.25))
    for f in (0, 1, 2, 4, 6):
        g = sum(np.frombuffer(r["s0"], np.int64) for r in rows if r["feature"] == f) / SCALE
        want = [(prob - y)[np.searchsorted(cuts[f], x[:, f], "left") == b].sum() for b in range(len(cuts[f]) + 1)]
        np.testing.assert_allclose(g[:len(want)], want, atol=1e-5)
        assert not g[len(want):].any()


def test_routes_of_a_tree_are_its_leaves():
    t = Tree.root()
    a, b = t.split(0, 1, 0.5)
    t.split(b, 0, 2.0)
    x = np.array([[0, 0.5], [2, 1], [3, 1], [1, np.nan]])
    for own in (x, np.asfortranarray(x), x[:0]):
        assert t.router()(own).tolist() == t.leaves(own).tolist()
    assert Tree.root().router()(x).tolist() == [0] * 4


def test_the_same_trees_in_a_task_and_on_the_cluster(spark):
    x, y = data(3000, 6)
    x = np.concatenate([x, x[:, [2, 2]], 1 - x[:, [2]], (x[:, [3]] > 0.3)], axis=1)
    df = frame(spark, x, y, 4)
    p = {"rounds": 13, "max_depth": 5, "min_child_weight": 2.0, "refresh": 4}
    once, spread = (fit_boosted(df, "x", "y", 8, BoostParams(**p, local_bytes=most)) for most in (1 << 30, 0))
    for a, b in zip(once.trees, spread.trees, strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "threshold", "left", "right", "value"))
    assert once.gains == spread.gains and max(t.depth() for t in once.trees) == 5


def test_registered_boosting_fits_all_rounds(spark, monkeypatch):
    """The registered queries fit the operator's rounds."""
    from lendlens.ml import train
    from lendlens.plans import catalog

    from .conftest import SF_SMALL
    asked = []
    monkeypatch.setattr(train, "fit_boosted", lambda *a: asked.append(a[4].rounds) or BoostedTrees(a[4], 0.0, [], a[3]))
    monkeypatch.setattr(catalog, "_MODELS", {})
    catalog.QUERIES["train_gbt"](spark, SF_SMALL).collect()
    assert asked == [train.TREES["gbt"][0]] == [500]

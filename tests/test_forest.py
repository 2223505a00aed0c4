"""Forests of unlimited depth (M4)."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lendlens.ml import evaluate as EV
from lendlens.ml.forest import Forest, ForestParams, bootstrap, fit_forest, grow_local

from .test_boost import data, frame


def plain(x, y, w, min_leaf):
    """Recursive exact Gini tree over all features; nested tuples."""
    def share(rows):
        a, b = (w[rows] * (1 - y[rows])).sum(), (w[rows] * y[rows]).sum()
        return a, b

    def grow(rows):
        a, b = share(rows)
        best = None
        if a > 0 and b > 0 and len(rows) >= 2 * min_leaf:
            for f in range(x.shape[1]):
                for c in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= c
                    if min(left.sum(), len(rows) - left.sum()) < min_leaf:
                        continue
                    la, lb = share(rows[left])
                    score = (la * la + lb * lb) / (la + lb) + ((a - la) ** 2 + (b - lb) ** 2) / (a + b - la - lb)
                    if best is None or score > best[0] + 1e-9:
                        best = (score, f, c, left)
        if best is None:
            return b / (a + b)
        return (best[1], best[2], grow(rows[best[3]]), grow(rows[~best[3]]))

    return grow(np.arange(len(x)))


def value(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


@pytest.mark.parametrize("min_leaf", [1, 4, 30])
def test_local_trees_equal_brute_force(min_leaf):
    x, y = data(250, 5)
    w = np.random.default_rng(2).integers(1, 4, len(x)).astype(float)
    tree, gains = grow_local(x, y, w, min_leaf, None, 4, np.random.default_rng(0))
    want = plain(x, y, w, min_leaf)
    np.testing.assert_allclose(tree.value[tree.leaves(x)], [value(want, r) for r in x])
    assert np.bincount(tree.leaves(x)).max() >= min_leaf and (gains >= -1e-9).all()
    sizes = np.bincount(tree.leaves(x), minlength=len(tree))[tree.feature < 0]
    assert sizes.min() >= min_leaf


def staircase(blocks=64, size=8):
    """Blocks of alternating labels along one feature: the best split always
    peels a block off an end, so the tree is about as deep as there are blocks."""
    x = np.stack([np.arange(blocks * size), np.zeros(blocks * size)], axis=1).astype(float)
    return x, (np.arange(blocks * size) // size % 2).astype(float)


def test_deeper_than_any_limit():
    x, y = staircase()
    tree, _ = grow_local(x, y, np.ones(len(x)), 4, None, 1, np.random.default_rng(0))
    assert tree.depth() >= 40 and (tree.value[tree.leaves(x)] == y).all()
    assert grow_local(x, y, np.ones(len(x)), 4, 5, 1, np.random.default_rng(0))[0].depth() == 5


def test_bootstrap_is_poisson():
    times = bootstrap(np.arange(200_000), 3, 42)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and (times == bootstrap(np.arange(200_000), 3, 42)).all()


def test_upper_nodes_on_the_cluster(spark):
    """With few rows a task, upper nodes are split by histograms and the rest in
    tasks; rows of the sample get the shares of the tree grown at once."""
    x, y = data(900, 7)
    df = frame(spark, x, y, 1)
    split = fit_forest(df, "x", "y", 4, ForestParams(trees=2, features_per_node=4, local_rows=60, min_leaf=3, batch=1))
    whole = fit_forest(df, "x", "y", 4, ForestParams(trees=2, features_per_node=4, min_leaf=3))
    assert len(split.tops[0]) > 10 and len(whole.tops[0]) == 1 and split.subtrees.count() > 10
    assert split.subtrees.agg(F.max(F.size("feature"))).first()[0] <= 2 * 60
    got, want = ({tuple(r["x"]): r["p"] for r in m.transform(df, "x").collect()} for m in (split, whole))
    differ = [k for k in got if abs(got[k] - want[k]) > 1e-6]
    assert len(differ) < 0.25 * len(got)  # rows outside a sample may fall on the other side of a gap
    one = ForestParams(trees=1, features_per_node=4, local_rows=60, min_leaf=3)
    a = fit_forest(df, "x", "y", 4, one)
    b = fit_forest(df, "x", "y", 4, ForestParams(trees=1, features_per_node=4, min_leaf=3))
    inside = bootstrap(np.arange(len(x)), 0, 42) > 0  # one partition: ids in order
    order = [tuple(r["x"]) for r in df.collect()]
    pa_, pb = ({tuple(r["x"]): r["p"] for r in m.transform(df, "x").collect()} for m in (a, b))
    assert all(pa_[k] == pytest.approx(pb[k], abs=1e-5) for k, own in zip(order, inside) if own)


def test_scored_in_passes(spark, tmp_path):
    x, y = data(500, 9)
    df = frame(spark, x, y)
    model = fit_forest(df, "x", "y", 4, ForestParams(trees=12, local_rows=100))
    assert model.groups(2000) > 3
    once = sorted(tuple(r) for r in model.transform(df, "x").select("x", "p").collect())
    many = sorted(tuple(r) for r in model.transform(df, "x", group_bytes=2000).select("x", "p").collect())
    assert [k for k, _ in once] == [k for k, _ in many]
    np.testing.assert_allclose([p for _, p in once], [p for _, p in many])
    model.save(spark, str(tmp_path / "f"))
    back = Forest.load(spark, str(tmp_path / "f"))
    np.testing.assert_allclose([p for _, p in once], [p for _, p in sorted(tuple(r) for r in back.transform(df, "x").select("x", "p").collect())])
    assert model.importances().sum() == pytest.approx(1.0) and model.importances().argmax() == 0


def test_not_below_limited_depth(spark):
    x, y = data(3000, 3)
    df = frame(spark, x, y).withColumn("features", array_to_vector("x"))
    train, test = df.filter(F.xxhash64("x", "y") % 4 != 0), df.filter(F.xxhash64("x", "y") % 4 == 0)
    ours = fit_forest(train, "x", "y", 4, ForestParams(trees=30, min_leaf=8)).transform(test, "x")
    theirs = RandomForestClassifier(labelCol="y", numTrees=30, maxDepth=10, minInstancesPerNode=8, seed=1).fit(train).transform(test)

    def auc(scored):
        return EV.auc_from_roc(EV.roc_curve(scored, "y", "p")).first()["auc"]
    assert auc(ours) >= auc(theirs.select("y", vector_to_array("probability")[1].alias("p"))) - 0.01


@pytest.mark.parametrize("rows", [[], [([1.0, 2.0], 1.0)], [([1.0, 2.0], 0.0)] * 9 + [([1.0, 2.0], 1.0)] * 9])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "x array<double>, y double")
    for local in (1, 100):
        model = fit_forest(df, "x", "y", 2, ForestParams(trees=3, local_rows=local))
        got = [r["p"] for r in model.transform(df, "x").collect()]
        assert len(got) == len(rows) and all(0 <= p <= 1 for p in got)


def test_rows_move_packed_and_exact(spark):
    from lendlens.ml.forest import _packed, _unpacked, row_type
    x = np.array([[0.0, -1.0, 70_000.0, 0.1, 2.0**40], [1.0, 300.0, -5.0, 7.0, 1.0]])
    df = spark.createDataFrame([(i, float(i), r.tolist()) for i, r in enumerate(x)], "id long, label double, x array<double>")
    kind = row_type(df, 5)
    assert [kind[f"f{i}"].str for i in range(5)] == ["|i1", "<i2", "<i4", "<f8", "<f8"]
    whole = _packed(np.array([7, 3]), np.array([1.0, 0.0]), x, kind)
    ids, y, columns = _unpacked([whole[:1].tobytes(), whole[1:].tobytes()], kind)
    assert ids.tolist() == [3, 7] and y.tolist() == [0.0, 1.0] and (np.stack(columns, axis=1) == x[::-1]).all()


def test_features_with_more_values_than_a_node_has_rows():
    """Nodes whose rows are counted by rank and nodes whose rows are sorted."""
    from lendlens.ml.forest import grow_ranked, ranked
    rng = np.random.default_rng(4)
    x = np.stack([rng.permutation(3000) / 7, rng.integers(0, 3, 3000), rng.integers(-5, 900, 3000)], axis=1)
    y = (x[:, 0] % 40 + x[:, 1] * 9 + rng.integers(0, 9, 3000) > 30).astype(float)
    w = rng.integers(1, 3, 3000).astype(float)
    tree, _ = grow_ranked(*ranked([x[:, 0], x[:, 1].astype(np.int8), x[:, 2].astype(np.int16)]), y, w, 4, None, 3, np.random.default_rng(0))
    want = plain(x, y, w, 4)
    np.testing.assert_allclose(tree.value[tree.leaves(x)], [value(want, r) for r in x])


@pytest.mark.parametrize("tries", [None, 2])
def test_the_same_forest_whatever_fits_a_task(spark, tmp_path, tries):
    """Upper nodes split over the cluster are those that a task would make, on
    all values of features with more values than bins, and count in importances."""
    rng = np.random.default_rng(11)
    n = 1500
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n), rng.normal(size=n).round(2) * 7, rng.integers(0, 900, n), rng.integers(0, 2, n)], axis=1)
    y = (x[:, 0] + x[:, 1] + (x[:, 3] % 50 > 20) + rng.normal(size=n) > 1.5).astype(float)
    df = frame(spark, x, y, 1)
    once, split = (fit_forest(df, "x", "y", 5, ForestParams(trees=3, features_per_node=tries, local_rows=rows)) for rows in (10**6, 150))
    assert len(split.tops[0]) > 8 and len(once.tops[0]) == 1
    got, want = ({tuple(r["x"]): r["p"] for r in m.transform(df, "x").collect()} for m in (split, once))
    assert got == want
    np.testing.assert_allclose(split.importances(), once.importances(), rtol=1e-9)
    split.save(spark, str(tmp_path / "f"))
    np.testing.assert_allclose(Forest.load(spark, str(tmp_path / "f")).importances(), once.importances(), rtol=1e-9)


def test_a_feature_of_more_ranks_than_two_bytes_hold():
    from lendlens.ml.forest import grow_ranked, ranked
    n = 70_000
    x = np.stack([np.arange(n) + 0.5, np.arange(n) % 2], axis=1)
    y = (x[:, 0] > 66_000).astype(float)
    tree, gains = grow_ranked(*ranked([x[:, 0], x[:, 1]]), y, np.ones(n), 4, None, 2, np.random.default_rng(0))
    assert len(tree) == 3 and tree.feature[0] == 0 and tree.threshold[0] == 66_000 and gains[1] == 0

"""Random forests of unlimited depth (M4).

The reference grows 400 trees until leaves are pure or hold ``min_leaf`` rows.
Nodes near the root are split over the cluster: one pass a level counts rows by
(tree, node, feature, bin), a second one counts single values inside the bins
that may hold a better boundary than the best between bins. Once the rows of a node are at most ``local_rows``, they move to
one task, which grows the rest of the subtree to the end on exact values, all
nodes of a depth at once. So depth is bounded by nothing but the data, and a
task's memory by ``local_rows``. A table that is small from the start skips
the first phase; its trees are dealt out, several to a task. Both phases count
in whole numbers, cut between values and draw features by the way from the
root to the node, so the trees are the same however large ``local_rows`` is.

Bootstrap weights are Poisson(1) numbers from a hash of row id and tree (the
limit of drawing n rows with replacement), so every task and every repeated
task sees the same sample. Class weights are balanced, each node tries
``sqrt(features)`` random features and goes on to others only while none of
them splits, a leaf holds the weighted share of ones, and a probability is the
mean over trees.

The subtrees are a table, since a forest of unlimited depth grows with its
training rows. Scoring broadcasts at most ``GROUP_BYTES`` of them at a time:
each pass adds the shares that its subtrees give to the rows that reach them,
and further passes read the written sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendlens.ml.trees import MAX_BINS, Tree, feature_cuts, matrix, mixed, uniform
from lendlens.session import discard, materialize

#: Bytes of subtrees that one scoring pass broadcasts (28 bytes a node).
GROUP_BYTES = 128 * 1024 * 1024
NODE_BYTES = 28
#: Open nodes whose histograms one pass builds.
SLOTS = 512
#: Bytes of packed rows that a task holds before it hands them on.
BLOCK_BYTES = 64 * 1024 * 1024
SUBTREES = ("tree int, node int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
            "value array<double>, gains array<double>")


@dataclass
class ForestParams:
    trees: int = 400
    min_leaf: int = 4
    max_depth: int | None = None
    features_per_node: int | None = None  # None: the square root of their number
    local_rows: int = 400_000
    batch: int = 64                       # trees whose upper nodes grow together
    seed: int = 42


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def bootstrap(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the sample of ``tree``."""
    return np.searchsorted(_POISSON, uniform(ids, seed * 1_000_003 + tree), "right")


def root_key(seed: int, tree: int) -> np.uint64:
    """The key of the root of a tree: what its nodes draw by."""
    return mixed(np.array([(seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % (1 << 64)], np.uint64))[0]


def child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right child of each node, by turns. A key depends
    on nothing but the way from the root."""
    return mixed(keys[:, None] + np.array([1, 2], np.uint64)).reshape(-1)


def node_features(keys: np.ndarray, width: int, tries: int, tried: int = 0) -> np.ndarray:
    """The features that nodes try after their first ``tried``, in ascending
    order: nodes by features."""
    h = mixed(keys[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if tried:
        order = np.argsort(h, axis=1)[:, tried : tried + tries]
    else:
        order = np.argpartition(h, tries - 1, axis=1)[:, :tries] if tries < width else np.tile(np.arange(width), (len(keys), 1))
    return np.sort(order, axis=1)


def split_scores(l0: np.ndarray, l1: np.ndarray, t0: np.ndarray, t1: np.ndarray, classes: tuple[float, float]) -> np.ndarray:
    """The score of boundaries (more is purer) from whole numbers: how often
    rows of each class count to the left, and in the node."""
    a, b, c, d = l0 * classes[0], l1 * classes[1], (t0 - l0) * classes[0], (t1 - l1) * classes[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        return (b * b + a * a) / (a + b) + (d * d + c * c) / (c + d)


#: Scores that differ by less than this share are ties.
TIE = 1e-12


def middles(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Thresholds between the largest value to the left and the smallest to the right."""
    middle = low / 2 + high / 2
    return np.where((low <= middle) & (middle < high), middle, low)


def ranked(columns: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct values of each column in order, and rows by columns the
    rank of each value. Whole numbers of a narrow range are not sorted."""
    values, ranks = [], np.empty((len(columns[0]) if columns else 0, len(columns)), np.int32)
    for f, c in enumerate(columns):
        low, high = (float(c.min()), float(c.max())) if len(c) else (0.0, math.inf)
        if high - low <= 4 * len(c) + 1024 and (c.dtype.kind == "i" or (c == np.rint(c)).all()):
            place = (c - np.array(low, c.dtype)).astype(np.int64) if c.dtype.kind == "f" else c.astype(np.int64) - int(low)
            seen = np.bincount(place) > 0
            values.append(np.flatnonzero(seen) + low)
            ranks[:, f] = (np.cumsum(seen) - 1)[place]
        else:
            v, ranks[:, f] = np.unique(c, return_inverse=True)
            values.append(v.astype(float))
    return values, ranks


def grow_local(x: np.ndarray, y: np.ndarray, weight: np.ndarray, min_leaf: int, max_depth: int | None, tries: int,
               rng: np.random.Generator) -> tuple[Tree, np.ndarray]:
    """``grow_ranked`` on rows by features."""
    return grow_ranked(*ranked([x[:, f] for f in range(x.shape[1])]), y, weight, min_leaf, max_depth, tries, rng)


class _Rows:
    """Rows in the order of their nodes: ranks by feature in two bytes (those
    of features with more ranks apart), and counts of rows and of how often rows
    of each class count, packed where their bits fit a double."""

    def __init__(self, ranks: np.ndarray, count: np.ndarray, times: np.ndarray, ones: np.ndarray):
        self.ranks = ranks.astype(np.uint16)
        self.tall = {f: np.ascontiguousarray(ranks[:, f]) for f in np.flatnonzero(count > 1 << 16).tolist()}
        self.shift, zeros = int(times.sum()).bit_length() + 1, times - ones
        one, at = np.ones(len(times), np.int64), self.shift
        if 3 * at <= 52:
            sums = [one + (zeros << at) + (ones << 2 * at)]
        elif 2 * at <= 52:
            sums = [one + (zeros << at), ones]
        else:
            sums = [one, zeros, ones]
        self.sums = [c.astype(float) for c in sums]
        # class and times, in the low bits of what is sorted
        self.load = 2 * times + (ones > 0)
        self.load_bits = int(times.max(initial=0)).bit_length() + 1

    def __len__(self) -> int:
        return len(self.load)

    def take(self, at: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        out.shift, out.load_bits = self.shift, self.load_bits
        out.ranks, out.load, out.sums = self.ranks.take(at, axis=0), self.load.take(at), [c.take(at) for c in self.sums]
        out.tall = {f: c.take(at) for f, c in self.tall.items()}
        return out

    def rank(self, feature: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The rank of each row in the feature of its node (of ``n`` rows)."""
        of_row = np.repeat(feature, n)
        out = self.ranks.reshape(-1).take(np.arange(len(of_row)) * self.ranks.shape[1] + of_row).astype(np.int64)
        for f, c in self.tall.items():
            if (feature == f).any():
                own = np.flatnonzero(of_row == f)
                out[own] = c.take(own)
        return out

    def split(self, sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Times of zeros, times of ones, rows."""
        sums, mask = [s.astype(np.int64) for s in sums], (1 << self.shift) - 1
        if len(sums) == 1:
            return sums[0] >> self.shift & mask, sums[0] >> 2 * self.shift, sums[0] & mask
        if len(sums) == 2:
            return sums[0] >> self.shift, sums[1], sums[0] & mask
        return sums[1], sums[2], sums[0]


def grow_ranked(values: list[np.ndarray], ranks: np.ndarray, y: np.ndarray, weight: np.ndarray, min_leaf: int, max_depth: int | None,
                tries: int, rng: np.random.Generator | np.uint64, classes: tuple[float, float] = (1.0, 1.0)) -> tuple[Tree, np.ndarray]:
    """A tree grown to the end, and the impurity decrease by feature.

    ``weight`` says how often a row counts (a whole number), ``classes`` what
    a row of each class weighs, ``rng`` the key of the root. All open nodes of
    a depth are split together: for each of the features that nodes try, rows
    are added up by (node, value) as whole numbers, running sums give the score
    of every boundary, the best of each node is kept (ties: the lowest feature,
    the lowest value)."""
    key = rng if isinstance(rng, np.uint64) else np.uint64(rng.integers(1 << 63))
    width = ranks.shape[1]
    count = np.array([len(v) for v in values], np.int64)
    start_of = np.cumsum(count) - count
    flat = np.concatenate(values) if values else np.zeros(0)
    times = weight.astype(np.int64)
    rows = _Rows(ranks, count, times, np.where(y > 0, times, 0))
    n = np.array([len(rows)])
    feature, threshold, left, right, value = (np.array([v], k) for v, k in ((-1, np.int32), (0, float), (-1, np.int32), (-1, np.int32), (0, float)))
    gains, numbers, keys, depth = np.zeros(width), np.zeros(1, np.int64), np.array([key], np.uint64), 0
    while len(numbers):
        # no node is empty
        t0, t1, n = rows.split([np.add.reduceat(c, np.cumsum(n) - n) if len(rows) else np.zeros(1) for c in rows.sums])
        a, b = t0 * classes[0], t1 * classes[1]
        value[numbers] = np.divide(b, a + b, out=np.zeros(len(numbers)), where=a + b > 0)
        open_ = (t0 > 0) & (t1 > 0) & (n >= 2 * min_leaf)
        if max_depth is not None and depth >= max_depth:
            open_[:] = False
        if not open_.all():  # the rows of nodes that stay leaves are done with
            rows = rows.take(np.flatnonzero(np.repeat(open_, n)))
            numbers, keys, t0, t1, n, a, b = (c[open_] for c in (numbers, keys, t0, t1, n, a, b))
        m = len(numbers)
        at, cut, best = np.full(m, -1), np.zeros(m, np.int64), np.full(m, -np.inf)
        todo, own, done = np.arange(m), rows, 0
        while len(todo) and done < width:
            tried = node_features(keys[todo], width, tries, done)
            done += tries
            found = _best_cuts(tried, own, count, n[todo], t0[todo], t1[todo], min_leaf, classes)
            k = np.flatnonzero(found[0] >= 0)
            at[todo[k]], cut[todo[k]], best[todo[k]] = (c[k] for c in found)
            if len(k) < len(todo) and done < width:  # others for the nodes that none of these splits
                none = found[0] < 0
                own, todo = own.take(np.flatnonzero(np.repeat(none, n[todo]))), todo[none]
            else:
                break
        split = at >= 0
        if not split.all():
            rows = rows.take(np.flatnonzero(np.repeat(split, n)))
            numbers, keys, at, cut, best, a, b, n = (c[split] for c in (numbers, keys, at, cut, best, a, b, n))
        m = len(numbers)
        if not m:
            break
        rank = rows.rank(at, n)
        go_right = rank > np.repeat(cut, n)
        np.add.at(gains, at, best - (b * b + a * a) / (a + b))
        kids = len(feature) + np.arange(2 * m)
        feature[numbers], left[numbers], right[numbers] = at, kids[::2], kids[1::2]
        # the next larger value inside the node decides the threshold
        first = np.cumsum(n) - n
        above = np.minimum.reduceat(np.where(go_right, rank, np.iinfo(np.int64).max), first)
        threshold[numbers] = middles(flat[start_of[at] + cut], flat[start_of[at] + above])
        feature, left, right = (np.append(c, np.full(2 * m, -1, np.int32)) for c in (feature, left, right))
        threshold, value = (np.append(c, np.zeros(2 * m)) for c in (threshold, value))
        # rows to the left before those to the right, node by node
        lefts = n - np.add.reduceat(go_right.astype(np.int64), first)
        place = np.empty(len(rows), np.int64)
        sides = np.stack([lefts, n - lefts], axis=1).reshape(-1)
        to_right = np.repeat(np.tile([False, True], m), sides)
        place[~to_right], place[to_right] = np.flatnonzero(~go_right), np.flatnonzero(go_right)
        rows, n = rows.take(place), sides
        numbers, keys, depth = kids, child_keys(keys), depth + 1
    return Tree(feature, threshold, left, right, value), gains


def _best_cuts(tried: np.ndarray, rows: _Rows, count: np.ndarray, n: np.ndarray, t0: np.ndarray, t1: np.ndarray, min_leaf: int,
               classes: tuple[float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: none), rank and score of the best boundary of each node
    (of ``n`` rows) among its ``tried`` features. Where a feature has far more
    ranks than a node has rows, they are sorted, elsewhere counted in place."""
    m, t = tried.shape
    parts, rank_bits = [], int(count.max(initial=1)).bit_length()
    for j in range(t):
        sizes = count[tried[:, j]]
        wide = sizes > 2 * n + 64
        rank = rows.rank(tried[:, j], n)
        narrow, apart = None, None
        if wide.any():
            mask = np.repeat(wide, n)
            narrow, apart = np.flatnonzero(~mask), np.flatnonzero(mask)
        if narrow is None or len(narrow):
            sizes = np.where(wide, 0, sizes)
            start, total = np.cumsum(sizes) - sizes, int(sizes.sum())
            key, sums = np.repeat(start, n) + rank, rows.sums
            if narrow is not None:
                key, sums = key.take(narrow), [c.take(narrow) for c in sums]
            sums = [np.bincount(key, c, total) for c in sums]
            cell = np.flatnonzero(sums[0])
            group = np.repeat(np.arange(m), sizes).take(cell)
            parts.append((group + m * j, cell - start.take(group), *rows.split([s.take(cell) for s in sums])))
        if apart is not None and len(apart):
            key = np.sort((np.repeat(np.arange(m)[wide], n[wide]) << rank_bits | rank.take(apart)) << rows.load_bits | rows.load.take(apart))
            which, load = key >> rows.load_bits, key & ((1 << rows.load_bits) - 1)
            first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            times, one = load >> 1, load & 1
            sums = [np.add.reduceat(c, first) for c in (times * (1 - one), times * one)]
            which = which[first]
            parts.append(((which >> rank_bits) + m * j, which & ((1 << rank_bits) - 1), *sums, np.diff(np.append(first, len(key)))))
    group, rank, l0, l1, ln = (np.concatenate(c) for c in zip(*parts, strict=True))
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes, owner = np.diff(np.append(first, len(group))), group[first]
    node = owner % m
    l0, l1, ln = (c - np.repeat(c[first] - own[first], sizes) for c, own in zip(map(np.cumsum, (l0, l1, ln)), (l0, l1, ln), strict=True))
    ok = (ln >= min_leaf) & (np.repeat(n[node], sizes) - ln >= max(min_leaf, 1))
    score = np.where(ok, split_scores(l0, l1, np.repeat(t0[node], sizes), np.repeat(t1[node], sizes), classes), -np.inf)
    top, where = np.full((m, t), -np.inf), np.zeros((m, t), np.int64)
    top[node, owner // m] = np.maximum.reduceat(score, first)
    where[node, owner // m] = np.arange(len(first))
    choice = (top >= top.max(axis=1, keepdims=True) * (1 - TIE)).argmax(axis=1)
    best, where = top[np.arange(m), choice], where[np.arange(m), choice]
    # the first boundary of the chosen feature that has its best score
    wanted = np.full(len(first), np.inf)
    wanted[where] = best * (1 - TIE)
    hit = np.flatnonzero(score >= np.repeat(wanted, sizes))
    hit = hit[ok[hit]]
    segment = np.searchsorted(first, hit, "right") - 1
    owners, place = np.unique(segment, return_index=True)
    cut = np.zeros(len(first), np.int64)
    cut[owners] = rank[hit[place]]
    return np.where(np.isfinite(best), tried[np.arange(m), choice], -1), cut[where], best


@dataclass
class Forest:
    params: ForestParams
    tops: list[Tree]          # of each tree; a leaf of value NaN leads to a subtree
    subtrees: DataFrame       # columns of SUBTREES
    n_features: int
    gains: list[np.ndarray] = field(default_factory=list)  # of the upper nodes of each tree, by feature

    def groups(self, group_bytes: int = GROUP_BYTES) -> int:
        nodes = self.subtrees.agg(F.sum(F.size("feature").cast("long"))).first()[0] or 0
        return max(1, math.ceil(nodes * NODE_BYTES / group_bytes))

    def transform(self, df: DataFrame, features: str, out: str = "p", group_bytes: int = GROUP_BYTES) -> DataFrame:
        """``df`` with the mean share of ones over the trees in ``out``."""
        parts = self.groups(group_bytes)
        width, tops, trees = self.n_features, self.tops, self.params.trees
        sc = df.sparkSession.sparkContext
        done = df.withColumn(out, F.lit(0.0))
        for k in range(parts):
            chosen = self.subtrees.drop("gains")
            if parts > 1:
                chosen = chosen.filter(F.pmod(F.xxhash64("tree", "node"), F.lit(parts)) == k)
            rows = _trees_of(chosen.toArrow())
            share = _shares(sc.broadcast(rows), tops, width, trees, k == 0)  # about group_bytes
            done = done.withColumn(out, F.col(out) + share(F.col(features)))
            if parts > 1:
                done = materialize(done, "scores")
        return done

    def importances(self) -> np.ndarray:
        """Mean over trees of each feature's share of the impurity decrease."""
        upper = [(t, f, float(g[f])) for t, g in enumerate(self.gains) for f in np.flatnonzero(g).tolist()]
        per_node = self.subtrees.select("tree", F.posexplode("gains").alias("f", "g")).union(
            self.subtrees.sparkSession.createDataFrame(upper, "tree int, f int, g double"))
        per_tree = per_node.groupBy("tree", "f").agg(F.sum("g").alias("g"))
        share = F.col("g") / F.sum("g").over(Window.partitionBy("tree"))
        rows = per_tree.select("f", F.when(F.col("g") > 0, share).otherwise(0.0).alias("s")).groupBy("f").agg(F.avg("s").alias("s")).collect()
        out = np.zeros(self.n_features)
        for r in rows:
            out[r["f"]] = r["s"] or 0.0
        return out / out.sum() if out.sum() else out

    def save(self, spark: SparkSession, path: str) -> None:
        import json
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        tops = [[t.feature.tolist(), t.threshold.tolist(), t.left.tolist(), t.right.tolist(),
                 [None if math.isnan(v) else v for v in t.value.tolist()]] for t in self.tops]
        meta = {"params": asdict(self.params), "n_features": self.n_features, "gains": [g.tolist() for g in self.gains]}
        spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(tops)], "tree int, top string").write.mode(
            "overwrite").json(f"{path}/tops")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        import json
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        tops = []
        for r in sorted(spark.read.json(f"{path}/tops").collect(), key=lambda r: r["tree"]):
            f, c, a, b, v = json.loads(r["top"])
            tops.append(Tree(np.array(f, np.int32), np.array(c, float), np.array(a, np.int32), np.array(b, np.int32),
                             np.array([math.nan if x is None else x for x in v], float)))
        return Forest(ForestParams(**meta["params"]), tops, spark.read.schema(SUBTREES).parquet(f"{path}/subtrees"), meta["n_features"],
                      [np.array(g) for g in meta["gains"]])


def _trees_of(t: pa.Table) -> list[tuple[int, int, Tree]]:
    """(tree, node, subtree) of the rows of a table of subtrees."""
    cols = [[c.values.to_numpy() for c in t[name]] for name in ("feature", "threshold", "left", "right", "value")]
    return [(tree, node, Tree(*own)) for tree, node, *own in zip(t["tree"].to_pylist(), t["node"].to_pylist(), *cols, strict=True)]


def _shares(held, tops: list[Tree], width: int, trees: int, with_tops: bool):
    """What the broadcast subtrees (and the leaves of ``tops``) add to the mean
    over ``trees`` trees of each row."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of: dict[int, list] = {}
        for tree, node, subtree in held.value:
            of.setdefault(tree, []).append((node, subtree))
        for column in batches:
            x = matrix(column, width)
            total = np.zeros(len(x))
            for tree, top in enumerate(tops):
                own = of.get(tree, [])
                if len(top) == 1 and len(own) == 1:
                    total += own[0][1].value[own[0][1].leaves(x)]
                    continue
                leaf = top.leaves(x)
                if with_tops:
                    total += np.nan_to_num(top.value[leaf])
                by = np.argsort(leaf, kind="stable")
                ordered = leaf[by]
                for node, subtree in own:
                    at = by[np.searchsorted(ordered, node) : np.searchsorted(ordered, node, "right")]
                    if len(at):
                        total[at] += subtree.value[subtree.leaves(x[at])]
            yield pa.array(total / trees)

    return F.arrow_udf(run, "double")


def _subtree_row(tree: int, node: int, grown: Tree, gains: np.ndarray) -> tuple:
    return (tree, node, grown.feature, grown.threshold, grown.left, grown.right, grown.value, gains)


def _subtree_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
             pa.list_(pa.float64()), pa.list_(pa.float64())]
    names = [c.split()[0] for c in SUBTREES.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def row_type(table: DataFrame, width: int) -> np.dtype:
    """The bytes of a row that moves: id, label, and each feature in the
    narrowest type that holds all its values exactly. One pass; a few numbers
    per feature and task are collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, whole = np.full(width, np.inf), np.full(width, -np.inf), np.ones(width, bool)
        for batch in batches:
            x = matrix(batch.column(0), width)
            if len(x):
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
                whole &= (x == np.rint(x)).all(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high), pa.array(whole)],
                                         names=["f", "low", "high", "whole"])

    made = table.select("x").mapInArrow(run, "f bigint, low double, high double, whole boolean").groupBy("f").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("whole").alias("whole")).collect()
    kinds = ["<f8"] * width
    for r in made:
        fits = [k for k in ("<i1", "<i2", "<i4") if np.iinfo(k).min <= r["low"] and r["high"] <= np.iinfo(k).max]
        if r["whole"] and fits:
            kinds[r["f"]] = fits[0]
    return np.dtype([("id", "<i8"), ("label", "<i1"), *[(f"f{i}", k) for i, k in enumerate(kinds)]])


def _packed(ids: np.ndarray, y: np.ndarray, x: np.ndarray, kind: np.dtype) -> np.ndarray:
    out = np.empty(len(ids), kind)
    out["id"], out["label"] = ids, y
    for i in range(x.shape[1]):
        out[f"f{i}"] = x[:, i]
    return out


def _unpacked(blocks: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ids, labels and features of packed rows, in the same order in every run."""
    rows = np.frombuffer(b"".join(blocks), kind)
    rows = rows[np.argsort(rows["id"], kind="stable")]
    return rows["id"], rows["label"].astype(float), [np.ascontiguousarray(rows[f"f{i}"]) for i in range(len(kind) - 2)]


def fit_forest(train: DataFrame, features: str, label: str, n_features: int, params: ForestParams | None = None) -> Forest:
    """Fit on an array column of features and a 0/1 label."""
    p = params or ForestParams()
    tries = p.features_per_node or max(1, int(math.sqrt(n_features)))
    table = materialize(train.select(F.monotonically_increasing_id().alias("id"), F.col(label).cast("double").alias("label"),
                                     F.col(features).alias("x")), "forest")
    counts = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    classes = tuple(n / (len(counts) * counts[k]) if counts.get(k) else 1.0 for k in (0.0, 1.0))
    gains: list[np.ndarray] = []
    if n <= p.local_rows:
        subtrees = _whole_trees(table, n_features, tries, classes, p)
        tops = [Tree.root(math.nan) for _ in range(p.trees)]
        if not n:
            tops = [Tree.root(0.0) for _ in range(p.trees)]
        subtrees = materialize(subtrees, "subtrees")
    else:
        kind, tops, parts = row_type(table, n_features), [], []
        blocks = materialize(_blocks(table, kind, feature_cuts(table, "x", n_features)), "forest-blocks")
        mixed_bins = _mixed_bins(blocks, kind)
        for first in range(0, p.trees, p.batch):
            numbers = list(range(first, min(first + p.batch, p.trees)))
            grown, own, keys = _tops(blocks, mixed_bins, numbers, kind, tries, classes, p)
            parts.append(materialize(_lower_trees(blocks, kind, numbers, grown, keys, tries, classes, p), "subtrees"))
            tops += grown
            gains += own
        subtrees = parts[0]
        for part in parts[1:]:
            subtrees = subtrees.union(part)
        discard(blocks)
    discard(table)
    return Forest(p, tops, subtrees, n_features, gains)


def _whole_trees(table: DataFrame, width: int, tries: int, classes: tuple[float, float], p: ForestParams) -> DataFrame:
    """Every tree from its root, several trees to a task."""
    units = max(1, min(p.trees, 2 * table.sparkSession.sparkContext.defaultParallelism))
    kind = row_type(table, width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _packed(batch.column("id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("x"), width), kind)
            yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary())], names=["rows"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # all rows of the table, at most ``local_rows``
        if not held:
            return
        t = pa.Table.from_batches(held)
        unit = t["unit"][0].as_py()
        ids, y, x = _unpacked(t["rows"].to_pylist(), kind)
        values, ranks = ranked(x)
        for tree in range(unit, p.trees, units):
            times = bootstrap(ids, tree, p.seed)
            own = times > 0
            if own.any():
                grown = grow_ranked(values, ranks[own], y[own], times[own], p.min_leaf, p.max_depth, tries, root_key(p.seed, tree), classes)
            else:  # a sample without rows has a leaf of nothing
                grown = Tree.root(0.0), np.zeros(width)
            yield from _subtree_table([_subtree_row(tree, 0, *grown)]).to_batches()

    # a partition for each unit, so that no task gets two while others get none
    blocks = table.select("id", "label", "x").mapInArrow(pack, "rows binary")
    dealt = blocks.withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(units - 1))))
    return dealt.repartitionById(units, F.col("unit")).mapInArrow(grow, SUBTREES)


def _blocks(table: DataFrame, kind: np.dtype, cuts: list[np.ndarray]) -> DataFrame:
    """Packed rows and their bins (a byte per row, feature by feature), many
    rows to a row."""
    width = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            rows = _packed(batch.column("id").to_numpy(), batch.column("label").to_numpy(), x, kind)
            bins = np.zeros((width, len(x)), np.uint8)
            for f, c in enumerate(cuts):
                bins[f] = np.searchsorted(c, x[:, f], "left")
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (rows, bins)], names=["rows", "bins"])

    return table.select("id", "label", "x").mapInArrow(run, "rows binary, bins binary")


def _mixed_bins(blocks: DataFrame, kind: np.dtype) -> np.ndarray:
    """Features by bins: whether a bin holds more than one value. One pass; a
    row per task and feature is collected."""
    width = len(kind) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((width, MAX_BINS), np.inf), np.full((width, MAX_BINS), -np.inf)
        for rows, bins in _unblocked(batches, kind):
            for f in range(width):
                np.minimum.at(low[f], bins[f], rows[f"f{f}"])
                np.maximum.at(high[f], bins[f], rows[f"f{f}"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([v.tobytes() for v in low], pa.binary()),
                                          pa.array([v.tobytes() for v in high], pa.binary())], names=["f", "low", "high"])

    low, high = np.full((width, MAX_BINS), np.inf), np.full((width, MAX_BINS), -np.inf)
    for r in blocks.select("rows", "bins").mapInArrow(run, "f bigint, low binary, high binary").collect():
        low[r["f"]] = np.minimum(low[r["f"]], np.frombuffer(r["low"]))
        high[r["f"]] = np.maximum(high[r["f"]], np.frombuffer(r["high"]))
    return low < high


def _unblocked(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows, and bins (features by rows), of every block."""
    for batch in batches:
        for rows, bins in zip(batch.column("rows"), batch.column("bins"), strict=True):
            rows = np.frombuffer(rows.as_buffer(), kind)
            yield rows, np.frombuffer(bins.as_buffer(), np.uint8).reshape(-1, len(rows))


def _reached(rows: np.ndarray, asked: list[tuple[int, int]], trees: dict[int, Tree], seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Tree by tree: rows in its sample that reach an asked node, the number
    of this node in ``asked``, and how often each row counts as a zero and as a one."""
    x = np.stack([rows[c].astype(float) for c in rows.dtype.names[2:]], axis=1)
    places: dict[int, list[int]] = {}
    for k, (tree, _) in enumerate(asked):
        places.setdefault(tree, []).append(k)
    for tree, own in places.items():
        slot_of = np.full(len(trees[tree]), -1)
        slot_of[[asked[k][1] for k in own]] = own
        times = bootstrap(rows["id"], tree, seed)
        at = np.flatnonzero(times)
        slot = slot_of[trees[tree].leaves(x[at])]
        at, slot = at[slot >= 0], slot[slot >= 0]
        ones = np.where(rows["label"][at] > 0, times[at], 0)
        yield at, slot, times[at] - ones, ones


def _histograms(blocks: DataFrame, asked: list[tuple[int, int]], trees: dict[int, Tree], tried: np.ndarray, kind: np.dtype,
                p: ForestParams) -> DataFrame:
    """Per task, asked node and tried feature a row: times of zeros, times of
    ones and rows by bin."""
    t = tried.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(asked) * t * MAX_BINS))
        for rows, bins in _unblocked(batches, kind):
            for at, slot, zeros, ones in _reached(rows, asked, trees, p.seed):
                first, end = int(slot.min(initial=len(asked))), int(slot.max(initial=-1)) + 1
                if end <= first:
                    continue
                for j in range(t):
                    key = ((slot - first) * t + j) * MAX_BINS + bins[tried[slot, j], at]
                    part = slice(first * t * MAX_BINS, end * t * MAX_BINS)
                    for k, v in enumerate((zeros, ones, None)):
                        sums[k, part] += np.bincount(key, v, (end - first) * t * MAX_BINS)
        whole = sums.astype(np.int64).reshape(3, len(asked), t, MAX_BINS)
        slot, j = np.nonzero(whole[2].any(axis=-1))
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(tried[slot, j], pa.int32()),
                                          pa.array([whole[:, a, b].tobytes() for a, b in zip(slot, j, strict=True)], pa.binary())], names=["slot", "feature", "sums"])

    return blocks.mapInArrow(run, "slot int, feature int, sums binary")


#: The values of a bin are looked at one by one unless no boundary between them
#: can be among the best; by this share its bound is held to be inexact.
SLACK = 1e-11
FOUND = "slot int, feature int, t0 bigint, t1 bigint, n bigint, score double, bin int, bins array<int>, bounds array<double>, before array<bigint>"


def _bin_cuts(histograms: DataFrame, mixed_bins: np.ndarray, min_leaf: int, classes: tuple[float, float]) -> list:
    """Per asked node and feature its sums, the best boundary between bins (the
    first of equal ones), and the bins inside of which a better one may lie: a
    score is convex in the sums to the left, so inside a bin it is at most what
    one of the four corners (none or all of the bin's zeros and ones) gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for slot, f, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[slot, f] = sums.get((slot, f), 0) + np.frombuffer(own, np.int64)
        rows = []
        for (slot, f), own in sums.items():
            own = own.reshape(3, MAX_BINS)
            upto = np.cumsum(own, axis=1)
            l0, l1, ln = upto
            t0, t1, n = upto[:, -1]
            ok = (ln >= min_leaf) & (n - ln >= max(min_leaf, 1))
            score = np.where(ok, split_scores(l0, l1, t0, t1, classes), -np.inf)
            best = score.max()
            b = int(np.argmax(ok & (score >= best * (1 - TIE))))
            before = upto - own
            bound = np.full(MAX_BINS, -np.inf)
            for c0, c1 in ((l0, l1), (l0, before[1]), (before[0], l1), (before[0], before[1])):
                bound = np.fmax(bound, split_scores(c0, c1, t0, t1, classes))  # a corner with nothing on one side is no cut
            open_ = np.flatnonzero(mixed_bins[f] & (own[2] > 1) & ((bound >= best * (1 - SLACK)) | ~np.isfinite(bound)))
            rows.append((slot, f, int(t0), int(t1), int(n), float(best), b, open_.tolist(), bound[open_].tolist(), before[:, open_].reshape(-1).tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds, strict=True)], names=names)

    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64())]
    return histograms.repartition("slot", "feature").mapInArrow(run, FOUND).collect()


def _value_cuts(blocks: DataFrame, asked: list[tuple[int, int]], trees: dict[int, Tree], edges: list[tuple[int, int, int]], inside: list[tuple],
                kind: np.dtype, min_leaf: int, classes: tuple[float, float], p: ForestParams) -> list[dict[int, tuple]]:
    """Of each edge (node, feature, bin) the values on both sides; of each
    ``inside`` (node, feature, bin, sums before it, sums of the node) the best
    boundary between its values: (score, value below, value above)."""
    # numbers of the open bins by feature: node by bin
    open_: dict[int, np.ndarray] = {}
    for k, (slot, f, b, *_) in enumerate(inside):
        open_.setdefault(f, np.full((len(asked), MAX_BINS), -1, np.int32))[slot, b] = k
    sides: dict[int, list[tuple[int, int, int]]] = {}
    for k, (slot, f, b) in enumerate(edges):
        sides.setdefault(asked[slot][0], []).append((k, slot, f, b))
    first_edge = len(inside)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bins in _unblocked(batches, kind):
            parts = []
            for at, slot, zeros, ones in _reached(rows, asked, trees, p.seed):
                if not len(at):
                    continue
                for f, numbers in open_.items():
                    own = numbers[slot, bins[f, at]]
                    hit = np.flatnonzero(own >= 0)
                    if len(hit):
                        v, k = rows[f"f{f}"][at[hit]].astype(float), own[hit]
                        by = np.lexsort((v, k))
                        v, k = v[by], k[by]
                        first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (k[1:] != k[:-1])))
                        sums = [np.add.reduceat(c[hit][by], first) for c in (zeros, ones, np.ones(len(at), np.int64))]
                        parts.append((k[first], v[first], *sums))
                for k, own_slot, f, b in sides.get(asked[slot[0]][0], []):
                    own = at[slot == own_slot]
                    v, low = rows[f"f{f}"][own].astype(float), bins[f, own] <= b
                    ends = [(first_edge + 2 * k + side, end) for side, end in ((0, v[low].max(initial=-np.inf)), (1, v[~low].min(initial=np.inf))) if np.isfinite(end)]
                    if ends:
                        parts.append((*map(np.array, zip(*ends, strict=True)), *[np.ones(len(ends), np.int64)] * 3))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(
                    zip(*parts, strict=True), (np.int32, float, np.int64, np.int64, np.int64), strict=True)], names=["k", "v", "t0", "t1", "n"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], []

        def done() -> None:
            k, v = held[0][0][0], np.concatenate([h[1] for h in held])
            if k >= first_edge:
                out.append((int(k), 0.0, float(v[-1] if (k - first_edge) % 2 == 0 else v[0]), 0.0))
                return
            _, _, _, before, whole = inside[k]
            l0, l1, ln = (np.cumsum(np.concatenate([h[2 + i] for h in held])) + before[i] for i in range(3))
            ok = (ln >= min_leaf) & (whole[2] - ln >= max(min_leaf, 1))
            ok[-1] = False  # the boundary to the next bin
            score = np.where(ok, split_scores(l0, l1, *whole[:2], classes), -np.inf)
            if ok.any():
                at = int(np.argmax(ok & (score >= score.max() * (1 - TIE))))
                out.append((int(k), float(score.max()), float(v[at]), float(v[at + 1])))

        for batch in batches:
            k, *cols = (c.to_numpy() for c in batch.columns)
            ends = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)] if len(k) else []
            for a, b in pairwise(ends):
                if held and held[0][0][0] != k[a]:
                    done()
                    held = []
                held.append((k[a:b], *(c[a:b] for c in cols)))
        if held:
            done()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*out) if out else [()] * 4, (pa.int32(), pa.float64(), pa.float64(), pa.float64()), strict=True)], names=["k", "score", "low", "high"])

    values = blocks.mapInArrow(find, "k int, v double, t0 bigint, t1 bigint, n bigint").groupBy("k", "v").agg(
        *[F.sum(c).alias(c) for c in ("t0", "t1", "n")])
    rows = values.repartition("k").sortWithinPartitions("k", "v").mapInArrow(best, "k int, score double, low double, high double").collect()
    found = {r["k"]: (r["score"], r["low"], r["high"]) for r in rows}
    return [{k: (found[first_edge + 2 * k][1], found[first_edge + 2 * k + 1][1]) for k in range(len(edges))},
            {k: found[k] for k in range(len(inside)) if k in found}]


def _tops(blocks: DataFrame, mixed_bins: np.ndarray, numbers: list[int], kind: np.dtype, tries: int, classes: tuple[float, float],
          p: ForestParams) -> tuple[list[Tree], list[np.ndarray], dict[tuple[int, int], np.uint64]]:
    """The upper nodes of the trees, their impurity decrease by feature, and the
    keys of nodes. Leaves either hold a share (pure, or nothing splits them) or
    NaN: at most ``local_rows`` rows. Splits are those of ``grow_ranked``: the
    best boundary of all values, found between bins first."""
    width = len(kind) - 2
    trees = {t: Tree.root(math.nan) for t in numbers}
    gains = {t: np.zeros(width) for t in numbers}
    keys = {(t, 0): root_key(p.seed, t) for t in numbers}
    # (tree, node, depth, features tried so far)
    open_nodes = [(t, 0, 0, 0) for t in numbers]
    while open_nodes:
        # nodes that have tried equally many features, so that they try equally many now
        step = open_nodes[0][3]
        now = sorted([o for o in open_nodes if o[3] == step][:SLOTS])
        chosen = set(now)
        open_nodes = [o for o in open_nodes if o not in chosen]
        asked = [(t, node) for t, node, _, _ in now]
        tried = node_features(np.array([keys[k] for k in asked], np.uint64), width, tries, step)
        found: dict[int, list] = {}
        for r in _bin_cuts(_histograms(blocks, asked, trees, tried, kind, p), mixed_bins, p.min_leaf, classes):
            found.setdefault(r["slot"], []).append(r)
        edges, inside, splitting = [], [], {}
        for k, (t, node, depth, _) in enumerate(now):
            own, tree = sorted(found.get(k, []), key=lambda r: r["feature"]), trees[t]
            if not own or own[0]["n"] <= p.local_rows:
                continue  # its rows go to a task
            t0, t1, n = own[0]["t0"], own[0]["t1"], own[0]["n"]
            a, b = t0 * classes[0], t1 * classes[1]
            if not t0 or not t1 or n < 2 * p.min_leaf or (p.max_depth is not None and depth >= p.max_depth):
                tree.value[node] = b / (a + b) if a + b else 0.0
                continue
            splitting[k] = (t0, t1, n)
            most = max(r["score"] for r in own)
            for r in own:
                if math.isfinite(r["score"]) and r["score"] >= most * (1 - TIE):
                    edges.append((k, r["feature"], r["bin"], r["score"]))
                size = len(r["bins"])
                for i, (own_bin, bound) in enumerate(zip(r["bins"], r["bounds"], strict=True)):
                    if bound >= most * (1 - SLACK) or not math.isfinite(bound):
                        inside.append((k, r["feature"], own_bin, tuple(r["before"][i::size]), (t0, t1, n)))
        between, within = _value_cuts(blocks, asked, trees, [e[:3] for e in edges], inside, kind, p.min_leaf, classes, p) if edges or inside else ({}, {})
        # of each node: (score, feature, value below, value above)
        cuts: dict[int, list[tuple]] = {}
        for i, (low, high) in between.items():
            cuts.setdefault(edges[i][0], []).append((edges[i][3], edges[i][1], low, high))
        for i, (score, low, high) in within.items():
            cuts.setdefault(inside[i][0], []).append((score, inside[i][1], low, high))
        for k, (t0, t1, _) in splitting.items():
            t, node, depth, _ = now[k]
            tree, a, b = trees[t], t0 * classes[0], t1 * classes[1]
            if k not in cuts:
                if step + tries < width:
                    open_nodes.append((t, node, depth, step + tries))
                else:  # equal in all values, or nothing leaves enough rows on both sides
                    tree.value[node] = b / (a + b)
                continue
            most = max(c[0] for c in cuts[k])
            f = min(c[1] for c in cuts[k] if c[0] >= most * (1 - TIE))
            best = max(c[0] for c in cuts[k] if c[1] == f)
            _, low, high = min((c[1:] for c in cuts[k] if c[1] == f and c[0] >= best * (1 - TIE)), key=lambda c: c[1])
            gains[t][f] += best - (b * b + a * a) / (a + b)
            kids = tree.split(node, f, float(middles(np.array([low]), np.array([high]))[0]), (math.nan, math.nan))
            for kid, key in zip(kids, child_keys(np.array([keys[t, node]], np.uint64)), strict=True):
                keys[t, kid] = key
                open_nodes.append((t, kid, depth + 1, 0))
    return [trees[t] for t in numbers], [gains[t] for t in numbers], keys


def _lower_trees(blocks: DataFrame, kind: np.dtype, numbers: list[int], tops: list[Tree], keys: dict[tuple[int, int], np.uint64], tries: int,
                 classes: tuple[float, float], p: ForestParams) -> DataFrame:
    """The rows of each open leaf, moved to one task and grown to the end. They
    move in packed blocks of a leaf, not one by one."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[bytes]] = {}
        size = 0
        for rows, _ in _unblocked(batches, kind):
            x = np.stack([rows[c].astype(float) for c in kind.names[2:]], axis=1)
            for tree, top in zip(numbers, tops, strict=True):
                leaf = top.leaves(x)
                own = np.flatnonzero((bootstrap(rows["id"], tree, p.seed) > 0) & np.isnan(top.value[leaf]))
                own = own[np.argsort(leaf[own], kind="stable")]
                at = leaf[own]
                bounds = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)] if len(at) else []
                for a, b in pairwise(bounds):
                    held.setdefault((tree, int(at[a])), []).append(rows[own[a:b]].tobytes())
            size += len(rows) * kind.itemsize * len(numbers)
            if size >= BLOCK_BYTES:
                yield moved(held)
                held, size = {}, 0
        if held:
            yield moved(held)

    def moved(held: dict[tuple[int, int], list[bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.int32()), pa.array([k for _, k in held], pa.int32()),
                                           pa.array([b"".join(v) for v in held.values()], pa.binary())], names=["tree", "node", "rows"])

    def grow(t: pa.Table) -> pa.Table:
        tree, node = t["tree"][0].as_py(), t["node"][0].as_py()
        ids, y, x = _unpacked(t["rows"].to_pylist(), kind)
        above = tops[numbers.index(tree)]
        left = None if p.max_depth is None else max(0, p.max_depth - _depth_of(above, node))
        grown = grow_ranked(*ranked(x), y, bootstrap(ids, tree, p.seed), p.min_leaf, left, tries, keys[tree, node], classes)
        return _subtree_table([_subtree_row(tree, node, *grown)])

    return blocks.mapInArrow(route, "tree int, node int, rows binary").groupBy("tree", "node").applyInArrow(grow, SUBTREES)


def _depth_of(tree: Tree, node: int) -> int:
    depth = 0
    while node:
        node = int(np.flatnonzero((tree.left == node) | (tree.right == node))[0])
        depth += 1
    return depth

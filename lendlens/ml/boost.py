"""Second-order gradient boosting with histogram trees (M5).

Log-loss boosting as the reference's library does it: every tree fits the
gradient ``g`` and hessian ``h`` of the loss at the current margins, a split
gains ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``, a leaf is ``-G/(H+l)`` times
the learning rate, a split needs ``min_child_weight`` of hessian on both
sides, splits that gain less than ``gamma`` are pruned from the leaves up,
rows are sampled per tree and features per tree.

One level of a tree is one pass over the binned table: tasks add up their
rows in numpy histograms over (node, feature, bin), one shuffle deals a row
per task, node and feature to the task that adds them up, running sums over
the bins give every split's gain, and the best split per node and feature
reaches the driver. Features of two bins (one-hot slots) are added up eight at
a time, by the pattern of their bits.
Margins are written again every ``refresh`` trees; the trees since then are
evaluated in the pass. Every row's gradient and hessian are rounded to integers
of 2 ** -30 before they are added up, so lost and repeated tasks or other
partitionings give the same trees. A training table of at most ``local_bytes``
is moved to one task, which makes the same sums and trees without a job a level.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.ml.trees import (MAX_BINS, SCALE, Histogram, Tree, feature_cuts, matrix, uniform)
from lendlens.session import discard, materialize

#: A split must gain more than this at all.
LEAST_GAIN = 1e-6
#: Columns of the training table: a row holds the values of a block of rows.
BLOCK = ["id", "label", "margin", "bins"]
BLOCK_TYPE = ", ".join(f"{c} binary" for c in BLOCK)
#: Most bytes of the bins of a block (of at least 64 rows).
BLOCK_BYTES = 1 << 18


@dataclass
class BoostParams:
    rounds: int = 500
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    column_sample: float = 0.8
    min_child_weight: float = 5.0
    gamma: float = 0.1
    reg_lambda: float = 1.0
    scale_pos_weight: float = 1.0
    max_bins: int = MAX_BINS
    seed: int = 42
    refresh: int = 10
    local_bytes: int = 192 * 1024 * 1024  # of the training table that one task may hold


@dataclass
class BoostedTrees:
    params: BoostParams
    base: float
    trees: list[Tree]
    n_features: int
    gains: list[dict[int, list[float]]] = field(default_factory=list)  # per tree: feature -> gains of its splits

    def margins(self, x: np.ndarray, routes: list | None = None) -> np.ndarray:
        out = np.full(len(x), self.base)
        for route, value in routes or self._routes():
            out += value.take(route(x))
        return out

    def _routes(self) -> list:
        return [(t.router(), t.value) for t in self.trees]

    def probability(self, features: Column) -> Column:
        """P(label = 1) of an array of features. The trees travel with the
        function: at most ``rounds * 2 ** (max_depth + 1)`` nodes."""
        model, width = self, self.n_features

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            routes = model._routes()
            for column in batches:
                yield pa.array(1 / (1 + np.exp(-model.margins(matrix(column, width), routes))))

        return F.arrow_udf(run, "double")(features)

    def transform(self, df: DataFrame, features: str, out: str = "p") -> DataFrame:
        return df.withColumn(out, self.probability(F.col(features)))

    def importances(self) -> np.ndarray:
        """Mean gain of each feature's splits, adding up to 1."""
        total, count = np.zeros(self.n_features), np.zeros(self.n_features)
        for of in self.gains:
            for f, own in of.items():
                total[f] += sum(own)
                count[f] += len(own)
        mean = np.divide(total, count, out=np.zeros_like(total), where=count > 0)
        return mean / mean.sum() if mean.sum() else mean

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(k, n, int(t.feature[n]), float(t.threshold[n]), int(t.left[n]), int(t.right[n]), float(t.value[n]))
                for k, t in enumerate(self.trees) for n in range(len(t))]
        spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double").write.mode(
            "overwrite").parquet(f"{path}/trees")
        meta = {"params": asdict(self.params), "base": self.base, "n_features": self.n_features, "n_trees": len(self.trees),
                "gains": [{str(f): g for f, g in of.items()} for of in self.gains]}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        own: dict[int, list] = {k: [] for k in range(meta["n_trees"])}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():  # rounds x 2^(depth+1) rows at most
            own[r["tree"]].append(r)
        trees = [Tree(*[np.array([r[c] for r in rows], kind) for c, kind in (
            ("feature", np.int32), ("threshold", float), ("left", np.int32), ("right", np.int32), ("value", float))])
            for rows in own.values()]
        gains = [{int(f): g for f, g in of.items()} for of in meta["gains"]]
        return BoostedTrees(BoostParams(**meta["params"]), meta["base"], trees, meta["n_features"], gains)


def gradients(y: np.ndarray, margin: np.ndarray, pos_weight: float) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y > 0, pos_weight, 1.0)
    return (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w


def whole_gradients(y: np.ndarray, margin: np.ndarray, pos_weight: float) -> list[np.ndarray]:
    """Gradients and hessians in units of 1 / ``SCALE``: whole numbers, whose
    sums do not depend on their order."""
    return [np.rint(v * SCALE) for v in gradients(y, margin, pos_weight)]


def packed(ids: np.ndarray, y: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    """Rows as one row, a feature's bins side by side."""
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (ids, y, margin, bins.T)], names=BLOCK)


def unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels, margins and bins (rows by features) of every block."""
    for batch in batches:
        for raw in zip(*(batch.column(c) for c in BLOCK), strict=True):
            ids, y, margin, bins = (np.frombuffer(v.as_buffer(), kind) for v, kind in zip(raw, (np.int64, float, float, np.uint8), strict=True))
            yield ids, y, margin, bins.reshape(width, len(ids)).T


def _blocks(source: DataFrame, cuts: Sequence[np.ndarray], base: float) -> DataFrame:
    """Rows of ``x`` and ``label`` in blocks, with ids, margins and bins: Spark
    hands a block to Python at the price of a row."""
    width = len(cuts)
    most = max(64, min(8192, BLOCK_BYTES // max(width, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            x, y = matrix(batch.column("x"), width), batch.column("label").to_numpy()
            bins = np.zeros((width, len(x)), np.uint8)
            for f, c in enumerate(cuts):
                bins[f] = np.searchsorted(c, x[:, f], "left")
            for k in range(0, len(x), most):
                own = y[k : k + most]
                yield packed(first + np.arange(len(own)), own, np.full(len(own), base), bins[:, k : k + most].T)
                first += len(own)

    return source.select("x", "label").mapInArrow(run, BLOCK_TYPE)


def _histograms(table: DataFrame, pending: list[Tree], tree: Tree, open_nodes: list[int], features: list[int], width: int,
                p: BoostParams, row_seed: int, two: Sequence[int] = ()) -> DataFrame:
    """Sums of g and h of the sampled rows: a row per task, open node and
    feature, with the sums of the bins as integers. ``two``: features of at
    most two bins, which are added up eight at a time, by the pattern of their
    bits."""
    pairs = [f for f in features if f in set(two)]
    single = [f for f in features if f not in set(two)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_node = np.full(len(tree), -1)
        of_node[open_nodes] = np.arange(len(open_nodes))
        leaf, before = tree.router(), [(t.router(), t.value) for t in pending]
        columns = len(single) + -(-len(pairs) // 8)
        sums = Histogram(len(open_nodes), columns, 2)
        for ids, y, margin, bins in unpacked(batches, width):
            at = np.flatnonzero(uniform(ids, row_seed) < p.subsample)
            bins = bins.T.take(at, axis=1).T
            slot = of_node[leaf(bins)]
            if (slot < 0).any():
                own = np.flatnonzero(slot >= 0)
                at, bins, slot = at[own], bins.T.take(own, axis=1).T, slot[own]
            y, margin = y[at], margin[at]
            for route, value in before:
                margin = margin + value.take(route(bins))
            own = np.concatenate([bins.T[single], np.packbits(bins.T[pairs], axis=0)])
            sums.add(slot, own.T, range(columns), whole_gradients(y, margin, p.scale_pos_weight))
        # nodes by features by bins
        whole = sums.sums.reshape(2, columns, len(open_nodes), MAX_BINS)
        parts = [*zip(single, whole.swapaxes(0, 1), strict=False), *zip(pairs, _pairs_of(whole[:, len(single):], len(pairs)).swapaxes(0, 1), strict=True)]
        rows = [(slot, f, *(s[slot].astype(np.int64).tobytes() for s in own))
                for f, own in parts for slot in range(len(open_nodes)) if own[:, slot].any()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 4, kinds, strict=True)], names=names)

    names, kinds = ["slot", "feature", "s0", "s1"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return table.select(*BLOCK).mapInArrow(run, "slot int, feature int, s0 binary, s1 binary")


def _pairs_of(patterns: np.ndarray, count: int) -> np.ndarray:
    """Sums by (sum, feature of two bins, node, bin) from those by the pattern
    of eight such features."""
    out = np.zeros((2, count, patterns.shape[2], 2))
    for k in range(count):
        one = np.arange(MAX_BINS) >> (7 - k % 8) & 1 == 1
        pattern = patterns[:, k // 8]
        out[:, k, :, 0], out[:, k, :, 1] = pattern[..., ~one].sum(-1), pattern[..., one].sum(-1)
    return out


def split_gains(sums: np.ndarray, p: BoostParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of g and h up to each bin (the last axis), and the gain of a split
    there (-inf: none), from sums in units of 1 / ``SCALE``."""
    part = lambda a, b: a * a / (b + p.reg_lambda)
    gl, hl = np.cumsum(sums, axis=-1) / SCALE
    g, h = gl[..., -1:], hl[..., -1:]
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = part(gl, hl) + part(g - gl, h - hl) - part(g, h)
        return gl, hl, np.where((hl >= p.min_child_weight) & (h - hl >= p.min_child_weight) & (gain > LEAST_GAIN), gain, -np.inf)


def best_splits(histograms: DataFrame, p: BoostParams) -> list:
    """Per open node its sums, and the best split if there is one. Ties go to
    the lowest feature, then the lowest bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for slot, f, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.stack([np.frombuffer(s, np.int64) for s in own])
                sums[slot, f] = sums[slot, f] + own if (slot, f) in sums else own
        rows = []
        for (slot, f), own in sums.items():
            gl, hl, gain = split_gains(own, p)
            b = int(np.argmax(gain))
            found = gain[b] > -np.inf
            rows.append((slot, f, gl[-1], hl[-1], *((gain[b], b, gl[b], hl[b]) if found else (None,) * 4)))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 8, kinds, strict=True)], names=names)

    names, kinds = ["slot", "feature", "g", "h", "gain", "b", "gl", "hl"], [pa.int32()] * 2 + [pa.float64()] * 3 + [pa.int32()] + [pa.float64()] * 2
    # one row per node and feature comes back, from the partitions that add up
    own = histograms.repartition("slot", "feature").mapInArrow(
        run, "slot int, feature int, g double, h double, gain double, b int, gl double, hl double").collect()
    out: dict[int, dict] = {}
    for r in sorted(own, key=lambda r: (r["slot"], r["feature"])):
        node = out.setdefault(r["slot"], {"slot": r["slot"], "sums": {"g": r["g"], "h": r["h"]}, "best": None})
        if r["gain"] is not None and (node["best"] is None or r["gain"] > node["best"]["gain"]):
            node["best"] = {"gain": r["gain"], "f": r["feature"], "b": r["b"], "gl": r["gl"], "hl": r["hl"]}
    return list(out.values())


def grow(level: Callable[[Tree, list[int]], list], p: BoostParams) -> tuple[Tree, dict[int, list[float]]]:
    """One tree on bins, its leaf values times the learning rate, and the
    gains of the splits that stay. ``level`` gives the sums and the best split
    of the open nodes of a tree."""
    tree, open_nodes, depth = Tree.root(), [0], 0
    sums: dict[int, tuple[float, float]] = {}
    gain: dict[int, float] = {}
    while open_nodes and depth < p.max_depth:
        found = level(tree, open_nodes)
        following = []
        for r in sorted(found, key=lambda r: r["slot"]):
            node, best = open_nodes[r["slot"]], r["best"]
            g, h = r["sums"]["g"], r["sums"]["h"]
            sums[node] = (g, h)
            if best is not None:
                kids = tree.split(node, best["f"], best["b"])
                gain[node] = best["gain"]
                sums[kids[0]], sums[kids[1]] = (best["gl"], best["hl"]), (g - best["gl"], h - best["hl"])
                following += kids
        open_nodes, depth = following, depth + 1
    for node in reversed(range(len(tree))):  # children come after their parents
        if tree.feature[node] >= 0 and gain[node] < p.gamma and tree.feature[tree.left[node]] < 0 and tree.feature[tree.right[node]] < 0:
            tree.feature[node] = -1
    for node, (g, h) in sums.items():
        tree.value[node] = -g / (h + p.reg_lambda) * p.learning_rate
    kept: dict[int, list[float]] = {}
    reached = [0]
    for node in reached:
        if tree.feature[node] >= 0:
            kept.setdefault(int(tree.feature[node]), []).append(gain[node])
            reached += [int(tree.left[node]), int(tree.right[node])]
    return tree, kept


def with_cuts(tree: Tree, cuts: list[np.ndarray]) -> Tree:
    """The tree on values: bin b's upper end is cut b."""
    values = [cuts[f][int(b)] if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.threshold, strict=True)]
    return Tree(tree.feature, np.array(values, float), tree.left, tree.right, tree.value)


def fit_boosted(train: DataFrame, features: str, label: str, n_features: int, params: BoostParams | None = None) -> BoostedTrees:
    """Fit on an array column of features and a 0/1 label. The base margin is
    the log odds of the weighted share of ones."""
    p = params or BoostParams()
    if not 2 <= p.max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must lie between 2 and {MAX_BINS}")
    source = train.select(F.col(features).alias("x"), F.col(label).cast("double").alias("label"))
    cuts = feature_cuts(source, "x", n_features, p.max_bins)
    counts = source.agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).first()
    ones, n = float(counts["ones"] or 0), int(counts["n"])
    weight = ones * p.scale_pos_weight / max(ones * p.scale_pos_weight + n - ones, 1e-12)
    base = math.log(min(max(weight, 1e-9), 1 - 1e-9) / (1 - min(max(weight, 1e-9), 1 - 1e-9)))
    table = materialize(_blocks(source, cuts, base), "boost")
    two = [f for f, c in enumerate(cuts) if len(c) < 2]
    if n * (n_features + 24) <= p.local_bytes:
        grown, gains = _grown_in_a_task(table, n_features, p, two)
    else:
        grown, gains = _grown_on_the_cluster(table, n_features, p, two)
    return BoostedTrees(p, base, [with_cuts(t, cuts) for t in grown], n_features, gains)


def _draws(width: int, p: BoostParams) -> Iterator[tuple[list[int], int]]:
    """Of each tree its features and the seed of its rows."""
    rng = np.random.default_rng(p.seed)
    for k in range(p.rounds):
        yield sorted(rng.choice(width, max(1, int(p.column_sample * width)), replace=False).tolist()), p.seed * 1_000_003 + k


def _grown_on_the_cluster(table: DataFrame, width: int, p: BoostParams, two: Sequence[int]) -> tuple[list[Tree], list[dict[int, list[float]]]]:
    """Trees and their gains, a job a level."""
    grown: list[Tree] = []
    gains: list[dict[int, list[float]]] = []
    pending: list[Tree] = []
    for chosen, seed in _draws(width, p):
        def level(tree: Tree, open_nodes: list[int]) -> list:
            return best_splits(_histograms(table, pending, tree, open_nodes, chosen, width, p, seed, two), p)  # noqa: B023

        tree, kept = grow(level, p)
        grown.append(tree)
        gains.append(kept)
        pending.append(tree)
        if len(pending) == p.refresh and len(grown) < p.rounds:
            table, old = materialize(_advanced(table, pending, width), "boost"), table
            discard(old)
            pending = []
    discard(table)
    return grown, gains


def _grown_in_a_task(table: DataFrame, width: int, p: BoostParams, two: Sequence[int]) -> tuple[list[Tree], list[dict[int, list[float]]]]:
    """The same, by the task that holds all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = list(unpacked(batches, width))
        ids, y, margin = (np.concatenate([b[i] for b in blocks]) if blocks else np.zeros(0) for i in range(3))
        bins = np.concatenate([b[3].T for b in blocks], axis=1) if blocks else np.zeros((width, 0), np.uint8)
        del blocks
        for k, (chosen, seed) in enumerate(_draws(width, p)):
            tree, kept = grow(_levels(ids, y, margin, bins, chosen, p, seed, two), p)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *[pa.array([c], pa.list_(t)) for c, t in zip(
                (tree.feature, tree.threshold, tree.left, tree.right, tree.value), kinds, strict=True)], pa.array([json.dumps(kept)])], names=names)
            margin = margin + tree.value.take(tree.router()(bins.T))

    names, kinds = ["k", "feature", "threshold", "left", "right", "value", "gains"], [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
    made = table.select(*BLOCK).repartition(1).mapInArrow(
        run, "k int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, gains string")
    rows = sorted(made.collect(), key=lambda r: r["k"])  # rounds x 2^(depth+1) nodes at most
    discard(table)
    trees = [Tree(np.array(r["feature"], np.int32), np.array(r["threshold"], float), np.array(r["left"], np.int32), np.array(r["right"], np.int32),
                  np.array(r["value"], float)) for r in rows]
    return trees, [{int(f): g for f, g in json.loads(r["gains"]).items()} for r in rows]


def _levels(ids: np.ndarray, y: np.ndarray, margin: np.ndarray, bins: np.ndarray, features: list[int], p: BoostParams, row_seed: int,
            two: Sequence[int]) -> Callable[[Tree, list[int]], list]:
    """``best_splits`` of one level after the other on held rows (``bins`` is
    features by rows). Of two siblings the smaller one is added up, the other is
    what is left of their parent."""
    pairs = [f for f in features if f in set(two)]
    single = [f for f in features if f not in set(two)]
    at = np.flatnonzero(uniform(ids, row_seed) < p.subsample)
    values = whole_gradients(y[at], margin[at], p.scale_pos_weight)
    bins = bins.take(at, axis=1)
    own = np.concatenate([bins[single], np.packbits(bins[pairs], axis=0)])
    slot = np.zeros(len(at), np.int64)  # of each row's node among the open ones, -1 in a leaf
    before: tuple = ()

    def level(tree: Tree, open_nodes: list[int]) -> list:
        nonlocal slot, before
        if before:  # a step down
            nodes, old = before
            feature, cut = tree.feature[nodes], tree.threshold[nodes]
            place = {node: k for k, node in enumerate(open_nodes)}
            to = np.array([[place.get(int(kid), -1) for kid in (tree.left[node], tree.right[node])] for node in nodes] + [[-1, -1]]).reshape(-1)
            of = np.append(np.maximum(feature, 0), 0).take(slot)
            right = bins.reshape(-1).take(of * len(at) + np.arange(len(at))) > np.append(cut, 0).take(slot)
            slot = to.take(2 * np.where(slot < 0, len(nodes), slot) + right)
        size = np.bincount(slot + 1, minlength=len(open_nodes) + 1)[1:]
        small = np.ones(len(open_nodes), bool)
        if before:
            for a in range(0, len(open_nodes), 2):  # siblings are neighbours
                small[a + int(size[a] <= size[a + 1])] = False
        number = np.append(np.where(small, np.cumsum(small) - 1, -1), -1).take(slot)
        part = Histogram(int(small.sum()), len(own), 2)
        rows = np.flatnonzero(number >= 0)
        if len(rows) < len(slot):
            part.add(number.take(rows), own.take(rows, axis=1).T, range(len(own)), [v.take(rows) for v in values])
        else:
            part.add(number, own.T, range(len(own)), values)
        whole = np.zeros((2, len(own), len(open_nodes), MAX_BINS))
        whole[:, :, small] = part.sums.reshape(2, len(own), -1, MAX_BINS)
        if before:
            for a in range(0, len(open_nodes), 2):
                parent = int(np.flatnonzero(tree.left[nodes] == open_nodes[a])[0])
                left_out = a + int(not small[a + 1])
                whole[:, :, left_out] = old[:, :, parent] - whole[:, :, a + int(small[a + 1])]
        before = np.array(open_nodes), whole
        out: list[dict] = [{"slot": k, "sums": None, "best": None} for k in range(len(open_nodes))]
        choices: dict[int, list[tuple]] = {}
        for some, sums in ((single, whole[:, : len(single)]), (pairs, _pairs_of(whole[:, len(single) :], len(pairs)))):
            if not some:
                continue
            gl, hl, gain = split_gains(sums, p)
            b = np.argmax(gain, axis=-1)
            for k in range(len(open_nodes)):
                out[k]["sums"] = out[k]["sums"] or {"g": float(gl[0, k, -1]), "h": float(hl[0, k, -1])}
                most = gain[np.arange(len(some)), k, b[:, k]]
                best = int(np.argmax(most))
                if most[best] > -np.inf:
                    c = b[best, k]
                    choices.setdefault(k, []).append((-float(most[best]), some[best], {
                        "gain": float(most[best]), "f": some[best], "b": int(c), "gl": float(gl[best, k, c]), "hl": float(hl[best, k, c])}))
        for k, found in choices.items():  # ties: the lowest feature
            out[k]["best"] = min(found, key=lambda c: c[:2])[2]
        return [r for r in out if size[r["slot"]]]

    return level


def _advanced(table: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The table with the margins after ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = [(t.router(), t.value) for t in trees]
        for ids, y, margin, bins in unpacked(batches, width):
            for route, value in routes:
                margin = margin + value.take(route(bins))
            yield packed(ids, y, margin, bins)

    return table.select(*BLOCK).mapInArrow(run, BLOCK_TYPE)

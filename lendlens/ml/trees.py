"""Decision trees as flat arrays, shared by the boosted trees (M5) and the
forest (M4): routing of row blocks, feature cuts from mergeable quantile
summaries, and binned training tables.

A row goes left where ``x[feature] <= threshold``. Training tables hold one
byte per feature (the number of cuts below the value), so a histogram over
(node, feature, bin) is exact in the binned values, and a level of a tree
costs one pass and one small shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins per feature: a bin number is one byte.
MAX_BINS = 256
#: Gradients are rounded to integers of 2 ** -30, so that their sums do not
#: depend on the order in which rows and tasks are added up: doubles hold those
#: of 4 million rows of a task exactly.
SCALE = float(1 << 30)


@dataclass
class Tree:
    """Nodes by number, the root first; ``feature`` -1 marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @staticmethod
    def root(value: float = 0.0) -> Tree:
        return Tree(np.array([-1], np.int32), np.zeros(1), np.full(1, -1, np.int32), np.full(1, -1, np.int32), np.array([float(value)]))

    def __len__(self) -> int:
        return len(self.feature)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x`` (rows by features)."""
        out = np.zeros(len(x), np.int64)
        if self.feature[0] < 0 or not len(x):
            return out
        values, width = np.ascontiguousarray(x).reshape(-1), x.shape[1]
        # of a node: where it leads left, then right
        to = np.stack([self.left, self.right], axis=1).astype(np.int64).reshape(-1)
        moving, at = np.arange(len(x)), out.copy()
        own = self.feature.take(at)
        while len(moving):
            right = ~(values.take(moving * width + own) <= self.threshold.take(at))
            at = to.take(2 * at + right)
            own = self.feature.take(at)
            inner = own >= 0
            if not inner.all():
                ended = ~inner
                out[moving[ended]] = at[ended]
                moving, at, own = moving[inner], at[inner], own[inner]
        return out

    def router(self) -> Callable[[np.ndarray], np.ndarray]:
        """``leaves`` of a tree of few levels, prepared once for many blocks:
        all rows take as many steps as the tree has levels, and a leaf leads
        to itself."""
        inner, own = self.feature >= 0, np.arange(len(self))
        feature = np.where(inner, self.feature, 0).astype(np.intp)
        # of a node: where it leads left, then right
        to = np.stack([np.where(inner, self.left, own), np.where(inner, self.right, own)], axis=1).astype(np.intp).reshape(-1)
        threshold, steps = self.threshold, self.depth()

        def leaves(x: np.ndarray) -> np.ndarray:
            node = np.zeros(len(x), np.intp)
            if not steps:
                return node
            if x.flags.c_contiguous:
                values, row, at = x.reshape(-1), np.arange(len(x)) * x.shape[1], feature
            else:  # a feature's values lie side by side
                values, row, at = np.ascontiguousarray(x.T).reshape(-1), np.arange(len(x)), feature * len(x)
            for _ in range(steps):
                right = ~(values.take(row + at.take(node)) <= threshold.take(node))
                node = to.take(2 * node + right)
            return node

        return leaves

    def split(self, node: int, feature: int, threshold: float, values: tuple[float, float] = (0.0, 0.0)) -> tuple[int, int]:
        """Make ``node`` an inner node with two new leaves."""
        a = len(self.feature)
        self.feature = np.append(self.feature, np.array([-1, -1], np.int32))
        self.threshold = np.append(self.threshold, [0.0, 0.0])
        self.left = np.append(self.left, np.array([-1, -1], np.int32))
        self.right = np.append(self.right, np.array([-1, -1], np.int32))
        self.value = np.append(self.value, values)
        self.feature[node], self.threshold[node], self.left[node], self.right[node] = feature, threshold, a, a + 1
        return a, a + 1

    def depth(self) -> int:
        depth = np.zeros(len(self), np.int64)
        for k in range(len(self)):  # children have higher numbers
            if self.feature[k] >= 0:
                depth[[self.left[k], self.right[k]]] = depth[k] + 1
        return int(depth.max())


def mixed(h: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per row id and seed; the same in every task."""
    h = mixed(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xBF58476D1CE4E5B9 % (1 << 64)))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def feature_cuts(df: DataFrame, col: str, n_features: int, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature of an array column: its quantiles, from
    one aggregate of mergeable summaries. A feature with fewer than
    ``max_bins`` frequent values is cut at these. The largest value is no cut."""
    shares = [k / max_bins for k in range(1, max_bins)]
    made = df.agg(*[F.percentile_approx(F.col(col)[i], shares, 50 * max_bins).alias(f"c{i}") for i in range(n_features)],
                  *[F.max(F.col(col)[i]).alias(f"m{i}") for i in range(n_features)]).first()
    out = []
    for i in range(n_features):
        cuts = np.unique(np.array(made[f"c{i}"] or [], float))
        out.append(cuts[cuts < made[f"m{i}"]] if len(cuts) else cuts)
    return out


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows by features of an array<double> column without nulls."""
    flat = column.flatten() if hasattr(column, "flatten") else column
    return np.asarray(flat.to_numpy(zero_copy_only=False), kind).reshape(len(column), width)


def dense(vector: Column) -> Column:
    """An ML vector as an array without NaN (a missing number is 0)."""
    from pyspark.ml.functions import vector_to_array
    return F.transform(vector_to_array(vector), lambda v: F.when(F.isnan(v), 0.0).otherwise(v))


class Histogram:
    """Sums of a task over (slot, feature, bin)."""

    def __init__(self, slots: int, width: int, sums: int):
        self.sums = np.zeros((sums, width, slots * MAX_BINS))

    def add(self, slot: np.ndarray, bins: np.ndarray, features: Sequence[int], values: Sequence[np.ndarray]) -> None:
        """Add rows."""
        for f in features:
            key = slot * MAX_BINS + bins[:, f]
            for k, v in enumerate(values):
                self.sums[k, f] += np.bincount(key, v, self.sums.shape[2])

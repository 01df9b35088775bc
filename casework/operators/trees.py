"""Populations of classification trees grown level by level in shared scans of binned features.

All trees of a population (settings of a search, folds, members of a forest) are grown together. A scan routes
each block's rows down every unfinished tree and adds up the class weights per (open node, feature, bin)
in tasks; the driver reads the best split of every open node from its histogram. The number of open nodes
of a scan is bounded, so memory does not grow with depth; more nodes take more scans. A forest's
bootstrap weights follow from the block and the tree, so a repeated task draws the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.operators import blocks as B
from casework.operators.boosting import BINS
from casework.operators.logistic import rates

#: Histogram cells that one scan may add up (16 MB of doubles).
CELLS = 2_000_000


@dataclass(frozen=True)
class Setting:
    """Growth rules; ``min_decrease`` is the impurity decrease weighted by the node's share of all rows."""

    criterion: str = "gini"
    max_depth: int = 10
    min_split: int = 2
    min_leaf: int = 1
    min_decrease: float = 0.0

    @property
    def name(self) -> str:
        return f"{self.criterion} depth={self.max_depth} split={self.min_split} leaf={self.min_leaf} decrease={self.min_decrease:g}"


# The search grid.
GRID = [
    Setting(c, d, s, n, g / 1000)
    for c, d, s, n, g in product(("gini", "entropy"), (10, 20), range(5, 10), range(2, 10), range(1, 5))
]


@dataclass
class Tree:
    """Nodes by number: split feature (-1 for a leaf), last bin and threshold on the left, children, probability of class 1."""

    setting: Setting
    fold: int = -9
    seed: int | None = None
    per_node: int | None = None
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    child: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    value: list[float] = field(default_factory=lambda: [0.0])
    decrease: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def nodes(self, x: np.ndarray, bins: bool = True) -> np.ndarray:
        """Leaf, or open node, of every row of bin numbers (or of values)."""
        feature, child = np.array(self.feature), np.array(self.child)
        cut = np.array(self.cut) if bins else np.array(self.threshold)
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            f = feature[at]
            at = np.where(f < 0, at, child[at, (x[rows, np.maximum(f, 0)] > cut[at]).astype(int)])
        return at


def _weights(x: np.ndarray, f: np.ndarray, tree: Tree) -> np.ndarray:
    inside = (f != tree.fold).astype(float)
    if tree.seed is None:
        return inside
    return inside * np.random.default_rng([tree.seed, zlib.crc32(x.tobytes())]).poisson(1.0, len(x))


def _impurity(a: np.ndarray, b: np.ndarray, criterion: str) -> np.ndarray:
    """Impurity of class weights ``a`` and ``b``."""
    total = np.maximum(a + b, 1e-300)
    p, q = a / total, b / total
    if criterion == "gini":
        return 1 - p * p - q * q
    return -(p * np.log2(np.maximum(p, 1e-300)) + q * np.log2(np.maximum(q, 1e-300)))


def _split(h: np.ndarray, whole: float, cuts: Sequence[np.ndarray], s: Setting, able: np.ndarray) -> tuple[int, int, float] | None:
    """Feature, last bin on the left and weighted decrease of the best allowed split; ties to the first by feature and threshold."""
    n0, n1 = h[0].sum(0)
    n, best = n0 + n1, None
    own = float(_impurity(n0, n1, s.criterion))
    if n < max(s.min_split, 2 * s.min_leaf) or own <= 1e-12:
        return None
    for j in np.flatnonzero(able):
        left = h[j].cumsum(0)[: len(cuts[j])]
        right = h[j].sum(0) - left
        nl, nr = left.sum(1), right.sum(1)
        fits = (nl >= s.min_leaf) & (nr >= s.min_leaf) & (nl > 0) & (nr > 0)
        if not fits.any():
            continue
        after = (nl * _impurity(left[:, 0], left[:, 1], s.criterion) + nr * _impurity(right[:, 0], right[:, 1], s.criterion)) / n
        gain = np.where(fits, n / whole * (own - after), -np.inf)
        at = int(np.flatnonzero(gain >= gain.max() - 1e-12)[0])
        if gain[at] >= max(s.min_decrease, 1e-12) and (best is None or gain[at] > best[2] + 1e-12):
            best = (int(j), at, float(gain[at]))
    return best


def grow(binned: DataFrame, cuts: Sequence[np.ndarray], trees: Sequence[Tree], bins: int = BINS) -> list[Tree]:
    """Grow ``trees`` (roots only) over binned blocks."""
    d, whole = len(cuts), {}
    waiting = [(t, 0, 0) for t in range(len(trees))]
    slots = max(1, CELLS // (d * bins * 2))
    while waiting:
        now, waiting = waiting[:slots], waiting[slots:]
        place: dict[int, dict[int, int]] = {}
        for i, (t, node, _) in enumerate(now):
            place.setdefault(t, {})[node] = i
        open_ = {t: trees[t] for t in place}

        def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
            out = np.zeros((len(now), d, bins * 2))
            label = (y > 0.5).astype(np.int64)
            for t, tree in open_.items():
                order = list(place[t].items())
                slot = np.full(len(tree.feature), -1)
                slot[[n for n, _ in order]] = np.arange(len(order))
                mine = slot[tree.nodes(x)]
                weight = _weights(x, f, tree)
                rows = np.flatnonzero((mine >= 0) & (weight > 0))
                if len(rows):
                    base, w = mine[rows] * bins * 2 + label[rows], weight[rows]
                    for j in range(d):
                        got = np.bincount(base + 2 * x[rows, j].astype(np.int64), w, len(order) * bins * 2)
                        out[[i for _, i in order], j] += got.reshape(len(order), bins * 2)
            return out.ravel()

        hist = B.summed(binned, fn, len(now) * d * bins * 2, "u1").reshape(len(now), d, bins, 2)
        for (t, node, depth), h in zip(now, hist):
            tree = trees[t]
            total = float(h[0].sum())
            whole.setdefault(t, total)
            tree.value[node] = float(h[0][:, 1].sum() / total) if total else 0.0
            if depth >= tree.setting.max_depth:
                continue
            able = np.ones(d, dtype=bool)
            if tree.per_node is not None and tree.per_node < d:
                able[:] = False
                able[np.random.default_rng([tree.seed or 0, node, 1]).choice(d, tree.per_node, replace=False)] = True
            found = _split(h, max(whole[t], 1e-300), cuts, tree.setting, able)
            if found is None:
                continue
            j, at, gain = found
            first = len(tree.feature)
            tree.feature[node], tree.cut[node], tree.threshold[node], tree.child[node], tree.decrease[node] = j, at, float(cuts[j][at]), (first, first + 1), gain
            for kid in (first, first + 1):
                tree.feature.append(-1)
                tree.cut.append(0)
                tree.threshold.append(0.0)
                tree.child.append((kid, kid))
                tree.value.append(0.0)
                tree.decrease.append(0.0)
                waiting.append((t, kid, depth + 1))
            tree.depth = max(tree.depth, depth + 1)
    return list(trees)


def forest(count: int, setting: Setting, d: int, seed: int = 42, fold: int = -9) -> list[Tree]:
    """Roots of a forest: bootstrapped trees that look at about the square root of the features at each node."""
    return [Tree(setting, fold, seed * 100_003 + i, max(1, round(d**0.5))) for i in range(count)]


def importances(trees: Sequence[Tree], d: int) -> np.ndarray:
    """Mean over trees of each feature's share of the impurity decrease."""
    out = np.zeros(d)
    for tree in trees:
        own = np.zeros(d)
        for f, gain in zip(tree.feature, tree.decrease):
            if f >= 0:
                own[f] += gain
        out += own / own.sum() if own.sum() else own
    return out / out.sum() if out.sum() else out


def probability(features: Column, trees: Sequence[Tree]) -> Column:
    """Mean probability of class 1 over trees, for an array column."""

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="float64")
        x = np.stack(rows.to_numpy())
        return pd.Series(sum(np.array(t.value)[t.nodes(x, bins=False)] for t in trees) / len(trees))

    return score(features)


def counts(binned: DataFrame, trees: Sequence[Tree]) -> np.ndarray:
    """Per tree: true and false positives, false and true negatives on the fold it left out."""

    def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        yes, out = y > 0.5, []
        for t in trees:
            here = f == t.fold
            says = np.array(t.value)[t.nodes(x[here])] > 0.5
            out.append([(says & yes[here]).sum(), (says & ~yes[here]).sum(), (~says & yes[here]).sum(), (~says & ~yes[here]).sum()])
        return np.array(out, dtype=float).ravel()

    return B.summed(binned, fn, 4 * len(trees), "u1").reshape(-1, 4)


def search(binned: DataFrame, cuts: Sequence[np.ndarray], settings: Sequence[Setting], folds: int = 5, metric: str = "accuracy") -> tuple[DataFrame, list[Tree], int]:
    """Cross-validated search: table ``(setting, mean, std, best)``, the tree of each setting on all rows, and the best setting's number."""
    trees = grow(binned, cuts, [Tree(s, f) for s in settings for f in (-9, *range(folds))])
    values = rates(counts(binned, trees))[metric].reshape(len(settings), folds + 1)[:, 1:]
    best = int(values.mean(1).argmax())
    rows = [(s.name, float(v.mean()), float(v.std()), i == best) for i, (s, v) in enumerate(zip(settings, values))]
    table = binned.sparkSession.createDataFrame(rows, "setting string, mean double, std double, best boolean")
    return table, trees[:: folds + 1], best

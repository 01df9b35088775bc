"""Populations of logistic models: all settings and folds trained in one scan per step.

A model is a (setting, held-out fold) pair. One scan of the training blocks adds up the loss, gradient
and curvature of every pair at its current coefficients; the driver takes a proximal Newton step per
pair (coordinate descent on features × features numbers), halving steps that did not lower the
objective. Twenty settings in five folds therefore cost as many scans as their slowest model, not
a job series each.

The objective is the summed log-loss plus ``(1 / C)`` times the penalty, the intercept is free, and the
features are used unscaled: they are centred and scaled inside for conditioning only, with the penalty
of each coefficient scaled to match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.operators import blocks as B

#: Features a population may have; its curvature is a square of them per model.
MAX_FEATURES = 256


@dataclass(frozen=True)
class Setting:
    """Penalty ``None``, ``l1``, ``l2`` or ``elasticnet`` with strength ``1 / C``."""

    penalty: str | None = "l2"
    C: float = 1.0
    l1_ratio: float = 0.0

    @property
    def name(self) -> str:
        if self.penalty is None:
            return "none"
        return f"{self.penalty} C={self.C:g}" + (f" l1_ratio={self.l1_ratio:g}" if self.penalty == "elasticnet" else "")

    def strengths(self) -> tuple[float, float]:
        """Weights of the absolute and of the squared penalty."""
        if self.penalty is None:
            return 0.0, 0.0
        mix = {"l1": 1.0, "l2": 0.0, "elasticnet": self.l1_ratio}[self.penalty]
        return mix / self.C, (1 - mix) / self.C


# The search grid.
GRID = [
    Setting(None),
    *[Setting(p, c, r) for c in (0.01, 0.1, 1.0, 10.0) for p, r in (("l2", 0.0), ("l1", 0.0), ("elasticnet", 0.25), ("elasticnet", 0.5), ("elasticnet", 0.75))],
]


@dataclass
class Fitted:
    """Models of a population; ``coefficients`` are in the features' own units, the intercept last."""

    settings: list[Setting]
    folds: np.ndarray
    coefficients: np.ndarray
    residual: np.ndarray
    rows: np.ndarray
    scans: int

    def model(self, setting: int, fold: int = -1) -> np.ndarray:
        return self.coefficients[(np.asarray(self.owner) == setting) & (self.folds == fold)][0]

    owner: np.ndarray | None = None


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -500, 500)))


def _statistics(blocks: DataFrame, w: np.ndarray, fold: np.ndarray, mean: np.ndarray, spread: np.ndarray):
    """Loss, gradient, curvature and rows of every model."""
    models, m = w.shape

    def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        a = np.concatenate([(x - mean) / spread, np.ones((len(y), 1))], axis=1)
        margin = a @ w.T
        inside = f[:, None] != fold[None, :]
        p = _sigmoid(margin)
        loss = (inside * (np.logaddexp(0, margin) - y[:, None] * margin)).sum(0)
        gradient = (inside * (p - y[:, None])).T @ a
        products = (a[:, :, None] * a[:, None, :]).reshape(len(y), m * m)
        curvature = (inside * p * (1 - p)).T @ products
        return np.concatenate([loss, gradient.ravel(), curvature.ravel(), inside.sum(0)])

    got = B.summed(blocks, fn, models * (1 + m + m * m + 1))
    loss, rest = got[:models], got[models:]
    gradient, rest = rest[: models * m].reshape(models, m), rest[models * m :]
    return loss, gradient, rest[: models * m * m].reshape(models, m, m), rest[models * m * m :]


def _step(w: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, l1: np.ndarray, l2: np.ndarray, sweeps: int = 1000) -> np.ndarray:
    """Minimum of the penalised quadratic model of every row, by coordinate descent over all rows at once."""
    u, diagonal = w.copy(), np.einsum("pjj->pj", curvature)
    floor = 1e-10 * np.maximum(diagonal.max(1, keepdims=True), 1e-12)
    for _ in range(sweeps):
        most = 0.0
        for j in range(w.shape[1]):
            h = diagonal[:, j] + floor[:, 0]
            slope = gradient[:, j] + np.einsum("pk,pk->p", curvature[:, j], u - w)
            pull = h * u[:, j] - slope
            new = np.sign(pull) * np.maximum(np.abs(pull) - l1[:, j], 0) / (h + l2[:, j])
            most = max(most, float(np.abs(new - u[:, j]).max()))
            u[:, j] = new
        if most < 1e-12:
            break
    return u


def _residual(w: np.ndarray, gradient: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Largest violation of the score equations of every model."""
    slope = gradient + l2 * w
    return np.where(w != 0, np.abs(slope + l1 * np.sign(w)), np.maximum(np.abs(slope) - l1, 0)).max(1)


def fit(blocks: DataFrame, settings: Sequence[Setting], folds: int = 0, scans: int = 60, tolerance: float = 1e-7) -> Fitted:
    """One model per setting on all rows and, with ``folds``, one per setting and fold left out."""
    d = B.width(blocks)
    if not d:
        raise ValueError("no rows to train on")
    if d > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    pairs = [(s, f) for s in range(len(settings)) for f in (-1, *range(folds))]
    owner, fold = np.array([s for s, _ in pairs]), np.array([f for _, f in pairs])
    # A model on all rows leaves out a fold that does not exist.
    left = np.where(fold < 0, -9, fold)
    n, mean, spread = B.moments(blocks, d)
    strengths = np.array([settings[s].strengths() for s in owner])
    free = np.zeros((len(pairs), 1))
    l1 = np.concatenate([strengths[:, :1] / spread, free], axis=1)
    l2 = np.concatenate([strengths[:, 1:] / spread**2, free], axis=1)
    penalty = lambda v: (l1 * np.abs(v) + 0.5 * l2 * v * v).sum(1)
    w = np.zeros((len(pairs), d + 1))
    loss, gradient, curvature, rows = _statistics(blocks, w, left, mean, spread)
    value, used = loss + penalty(w), 1
    residual = _residual(w, gradient, l1, l2)
    trial = _step(w, gradient, curvature, l1, l2)
    while used < scans and (residual > tolerance * n).any():
        loss, g, c, _ = _statistics(blocks, trial, left, mean, spread)
        used += 1
        new = loss + penalty(trial)
        better = new <= value + 1e-12 * np.abs(value)
        w = np.where(better[:, None], trial, w)
        value = np.where(better, new, value)
        gradient, curvature = np.where(better[:, None], g, gradient), np.where(better[:, None, None], c, curvature)
        residual = _residual(w, gradient, l1, l2)
        trial = np.where(better[:, None], _step(w, gradient, curvature, l1, l2), (w + trial) / 2)
    slopes = w[:, :d] / spread
    coefficients = np.concatenate([slopes, (w[:, d] - slopes @ mean)[:, None]], axis=1)
    return Fitted(list(settings), fold, coefficients, residual / n, rows, used, owner)


def held_out_counts(blocks: DataFrame, fitted: Fitted) -> np.ndarray:
    """Per model with a fold: true and false positives, false and true negatives on that fold, from one scan."""
    w, fold = fitted.coefficients, fitted.folds

    def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        says = x @ w[:, :-1].T + w[:, -1] > 0
        here, yes = f[:, None] == fold[None, :], (y > 0.5)[:, None]
        here &= (fold >= 0)[None, :]
        return np.concatenate([(here & a & b).sum(0) for a, b in ((says, yes), (says, ~yes), (~says, yes), (~says, ~yes))]).astype(float)

    return B.summed(blocks, fn, 4 * len(fold)).reshape(4, -1).T


def rates(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Accuracy, precision and recall of rows of (tp, fp, fn, tn); 0 where undefined."""
    tp, fp, fn, tn = counts.T
    ratio = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    return {"accuracy": ratio(tp + tn, tp + fp + fn + tn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}


def search(blocks: DataFrame, settings: Sequence[Setting] = tuple(GRID), folds: int = 5, metric: str = "accuracy") -> tuple[DataFrame, Fitted, int]:
    """Cross-validated search: table ``(setting, mean, std, best)``, the population, and the best setting's number.

    The table has the population deviation over folds; of equally good settings the first is best.
    """
    fitted = fit(blocks, settings, folds)
    values = rates(held_out_counts(blocks, fitted))[metric]
    per = [values[(fitted.owner == s) & (fitted.folds >= 0)] for s in range(len(settings))]
    best = int(np.argmax([v.mean() for v in per]))
    rows = [(s.name, float(v.mean()), float(v.std()), i == best) for i, (s, v) in enumerate(zip(settings, per))]
    return blocks.sparkSession.createDataFrame(rows, "setting string, mean double, std double, best boolean"), fitted, best


def margin(features: Column, model: np.ndarray) -> Column:
    """Log-odds of an array column under one model, as a column expression."""
    weights = F.array(*[F.lit(float(v)) for v in model[:-1]])
    return F.aggregate(F.zip_with(features, weights, lambda a, b: a * b), F.lit(float(model[-1])), lambda s, v: s + v)


def score_equations(df: DataFrame, features: str, label: Column, models: Sequence[np.ndarray], settings: Sequence[Setting], fold: Column | None = None, folds: Sequence[int] = ()) -> DataFrame:
    """Check of fitted models by plain column sums: ``(model, rows, residual)``.

    ``residual`` is the largest violation of a model's optimality conditions, each divided by the rows and
    the root mean square of its feature. It does not use the training code. Model ``i`` leaves out ``folds[i]``.
    """
    d = len(models[0]) - 1
    x = F.col(features)
    sums = []
    for i, w in enumerate(models):
        inside = F.lit(True) if not folds or folds[i] < 0 else fold != F.lit(int(folds[i]))
        miss = F.when(inside, 1 / (1 + F.exp(-margin(x, w))) - label.cast("double")).otherwise(0.0)
        sums.append(F.count_if(inside).alias(f"n_{i}"))
        sums += [F.sum(miss * (F.get(x, F.lit(j)) if j < d else F.lit(1.0))).alias(f"g_{i}_{j}") for j in range(d + 1)]
    sums += [F.sqrt(F.avg(F.get(x, F.lit(j)) ** 2)).alias(f"s_{j}") for j in range(d)]
    row = df.agg(*sums).first()
    out = []
    for i, (w, s) in enumerate(zip(models, settings)):
        l1, l2 = s.strengths()
        worst = abs(row[f"g_{i}_{d}"])
        for j in range(d):
            slope = row[f"g_{i}_{j}"] + l2 * w[j]
            off = abs(slope + l1 * np.sign(w[j])) if w[j] else max(abs(slope) - l1, 0.0)
            worst = max(worst, off / max(row[f"s_{j}"], 1e-12))
        out.append((i, int(row[f"n_{i}"]), float(worst / max(row[f"n_{i}"], 1))))
    return df.sparkSession.createDataFrame(out, "model long, rows long, residual double")

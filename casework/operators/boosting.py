"""Boosted stumps from histograms: one scan of binned features per round, for all folds at once.

Features are cut once at quantiles and stored as small numbers. A stump is a condition on one bin
number, so everything a row has to know about all stumps so far is one table entry per feature:
the weights of a row are the sum of ``features`` look-ups, however many rounds went before. A
round adds up the weight of every (feature, bin, class) in tasks; from that histogram the driver reads the best split
by Gini impurity, its leaf votes and its weighted error, without a second scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.operators import blocks as B
from casework.session import materialise

#: Bins of a feature; bin numbers are stored in one byte.
BINS = 64

Stump = tuple[int, float, float, float, float]


def cut_points(df: DataFrame, features: str = "features", bins: int = BINS, accuracy: int = 10_000) -> list[np.ndarray]:
    """Thresholds per feature: its distinct approximate quantiles, at most ``bins - 1``."""
    x = _array(df, features)
    first = df.select(F.size(x).alias("d")).where("d > 0").limit(1).collect()
    if not first:
        return []
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.get(x, F.lit(j)), shares, accuracy).alias(f"q{j}") for j in range(first[0].d)]).first()
    return [np.unique(np.asarray(q or [0.0], dtype=np.float64)) for q in row]


def _array(df: DataFrame, features: str) -> Column:
    return vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features).cast("array<double>")


def binned(blocks: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Blocks with bin numbers instead of values: a value is in bin ``i`` when ``i`` thresholds lie below it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out = []
            for x, y in zip(B.buffers(batch.column(0)), B.buffers(batch.column(1))):
                m = np.frombuffer(x, dtype="<f8").reshape(y.size // 8, -1)
                out.append(np.stack([np.searchsorted(c, m[:, j]) for j, c in enumerate(cuts)], axis=1).astype("u1").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1), batch.column(2)], names=["x", "y", "f"])

    with B.few_at_a_time(blocks.sparkSession):
        return materialise(blocks.mapInArrow(run, "x binary, y binary, f binary"), "binned-blocks")


def _histograms(blocks: DataFrame, no: np.ndarray, yes: np.ndarray, shift: np.ndarray, left: np.ndarray, bins: int) -> np.ndarray:
    """Weight per (model, feature, bin, class); ``no`` and ``yes`` hold the weight of votes for each class by (model, feature, bin)."""
    models, d = no.shape[:2]
    # By bin and class: a row's weight grows with every vote for the other class.
    votes = np.stack([yes, no], axis=-1).reshape(models, d, 2 * bins)

    def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        label = y > 0.5
        cells = [2 * x[:, j].astype(np.int64) + label for j in range(d)]
        out = np.zeros((models, d, 2 * bins))
        for m in range(models):
            weight = np.exp(sum(votes[m, j].take(c) for j, c in enumerate(cells)) - shift[m]) * (f != left[m])
            for j, c in enumerate(cells):
                out[m, j] = np.bincount(c, weight, 2 * bins)
        return out.ravel()

    return B.summed(blocks, fn, models * d * bins * 2, "u1").reshape(models, d, bins, 2)


def best_stump(weight: np.ndarray, cuts: Sequence[np.ndarray]) -> tuple[int, int, int, int, float] | None:
    """Feature, last bin on the left, votes of both sides and weighted error of the purest split; ``None`` without one.

    Of equally pure splits the first by feature and threshold is taken.
    """
    best, found = np.inf, None
    for j, c in enumerate(cuts):
        left = weight[j].cumsum(0)[: len(c)]
        right = weight[j].sum(0) - left
        a, b = left.sum(1), right.sum(1)
        able = (a > 1e-12) & (b > 1e-12)
        if not able.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = np.where(able, a - (left**2).sum(1) / a + b - (right**2).sum(1) / b, np.inf)
        at = int(impurity.argmin())
        if impurity[at] < best - 1e-12 * abs(impurity[at]):
            best = impurity[at]
            votes = int(left[at, 1] > left[at, 0]), int(right[at, 1] > right[at, 0])
            error = (left[at, 1 - votes[0]] + right[at, 1 - votes[1]]) / (a[at] + b[at])
            found = (j, at, *votes, float(error))
    return found


def fit(df: DataFrame, rounds: int = 50, rate: float = 1.0, features: str = "features", label: str = "label", fold: Column | None = None, folds: int = 0, bins: int = BINS) -> list[list[Stump]]:
    """Boosted stumps ``(feature, threshold, left, right, alpha)`` of the whole table and of each fold left out.

    Rounds end early when a stump is no better than chance, or perfect.
    """
    cuts = cut_points(df, features, bins)
    if not cuts:
        return [[] for _ in range(folds + 1)]
    data = binned(B.pack(df, features, F.col(label), fold), cuts)
    left = np.array([-9, *range(folds)])
    models, d = len(left), len(cuts)
    no, yes = np.zeros((models, d, bins)), np.zeros((models, d, bins))
    shift, going = np.zeros(models), np.ones(models, dtype=bool)
    stumps: list[list[Stump]] = [[] for _ in range(models)]
    for _ in range(rounds):
        weight = _histograms(data, no, yes, shift, left, bins)
        for m in np.flatnonzero(going):
            found = best_stump(weight[m], cuts)
            if found is None or found[4] >= 0.5:
                going[m] = False
                continue
            j, at, a, b, error = found
            alpha = rate * float(np.log((1 - max(error, 1e-10)) / max(error, 1e-10)))
            stumps[m].append((j, float(cuts[j][at]), float(a), float(b), alpha))
            for side, vote in ((slice(0, at + 1), a), (slice(at + 1, None), b)):
                (yes if vote else no)[m, j, side] += alpha
            shift[m] += np.log(max(weight[m, 0].sum(), 1e-300))  # keeps weights near a sum of one
            going[m] = error > 1e-10
        if not going.any():
            break
    return stumps


def score(x: Column, stumps: Sequence[Stump]) -> Column:
    """Weighted vote: positive for class 1. Stumps with the same condition become one term."""
    merged: dict[tuple[int, float], list[float]] = {}
    for j, t, a, b, alpha in stumps:
        sides = merged.setdefault((j, t), [0.0, 0.0])
        sides[0] += alpha * (2 * a - 1)
        sides[1] += alpha * (2 * b - 1)
    terms = [F.when(F.get(x, F.lit(j)) <= t, F.lit(a)).otherwise(F.lit(b)) for (j, t), (a, b) in merged.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def predict(df: DataFrame, stumps: Sequence[Stump], features: str = "features") -> DataFrame:
    """``prediction`` of the weighted vote."""
    return df.withColumn("prediction", (score(_array(df, features), stumps) > 0).cast("double"))

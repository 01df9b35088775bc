"""Populations of small sigmoid networks: all layouts, learning rates and folds trained in the same scans.

Networks of the same depth are one batch of matrices, padded to the widest; what leaves units beyond a network's width
is masked, so they never act nor learn. A scan of the training blocks adds up the gradient of every network
in tasks, and the driver takes one Nesterov step per network. The full gradient is used, so the result
does not depend on how rows are spread. Features are centred and scaled inside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import product

import numpy as np
from pyspark.sql import DataFrame

from casework.operators import blocks as B
from casework.operators.logistic import rates

#: Networks and rows worked on at a time within a task; their activations stay in a core's cache.
CHUNK, ROWS = 12, 1024
MOMENTUM = 0.9
#: Spacing (2^-FINE) and range of the table of hyperbolic tangents, and the number whose sum with another has that spacing.
FINE, REACH = 13, 20
ROUND = 1.5 * 2 ** (52 - FINE)
FIRST = int(np.float64(ROUND).view(np.int64)) - (REACH << FINE)


@dataclass(frozen=True)
class Net:
    """Widths of the hidden layers and the learning rate."""

    hidden: tuple[int, ...]
    rate: float

    @property
    def name(self) -> str:
        return f"hidden={'x'.join(map(str, self.hidden))} rate={self.rate:g}"


# The search grid.
RATES = (0.1, 0.2, 0.3, 0.4)
WIDTHS = range(5, 10)
GRID = [Net(h, r) for r in RATES for n in (1, 2, 3) for h in product(WIDTHS, repeat=n)]


@cache
def _nodes() -> np.ndarray:
    """Hyperbolic tangents of the multiples of ``2^-FINE`` from ``-REACH`` to ``REACH``; at its ends they are -1 and 1."""
    return np.tanh(np.arange(-REACH << FINE, (REACH << FINE) + 1) / (1 << FINE))


class _Space(dict):
    """Work arrays by name, kept from call to call: fresh ones would cost a page fault for every 512 numbers."""

    def get(self, name: str, shape: tuple[int, ...], kind: type = np.float64) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, kind)
        return self[name][:size].reshape(shape)


def _tanh(u: np.ndarray, out: np.ndarray, short: bool, space: _Space) -> None:
    """Hyperbolic tangent of ``u`` (overwritten; ``short``: within ``REACH``) to 1e-13, from that of the next node and an addition theorem.

    Adding ``ROUND`` rounds to a node and leaves its number in the lowest bits.
    """
    if not short:
        np.clip(u, -REACH, REACH, out=u)
    q, t, number = space.get("q", u.shape), space.get("t", u.shape), space.get("number", u.shape, np.int64)
    np.add(u, ROUND, out=q)
    np.subtract(q.view(np.int64), FIRST, out=number)
    q -= ROUND
    u -= q
    _nodes().take(number, mode="wrap" if short else "clip", out=t)  # "wrap" is quicker, but walks to numbers far outside
    np.multiply(t, u, out=q)
    q += 1
    t += u
    np.divide(t, q, out=out)


def _log_likelihood(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per network (rows of ``p``): sum of the log-likelihoods of labels ``y``."""
    if not ((y == 0) | (y == 1)).all():
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return (y * np.log(p) + (1 - y) * np.log(1 - p)).sum(1)
    p = p + (y - 1)
    np.abs(p, out=p)
    np.maximum(p, 1e-12, out=p)
    np.minimum(p, 1 - 1e-12, out=p)
    rest, ends = len(y), 0.0
    for _ in range(4):  # sixteen factors of 1e-12 are still a normal number
        if rest % 2:
            ends = ends + np.log(p[:, rest - 1])
        rest //= 2
        p = p[:, :rest] * p[:, rest : 2 * rest]
    return np.log(p).sum(1) + ends


def _stretches(live: np.ndarray) -> Iterator[slice]:
    """Slices of about equal size, ``CHUNK`` at most, over the true values."""
    ends = np.flatnonzero(np.diff(live, prepend=False, append=False))
    for a, b in zip(ends[::2].tolist(), ends[1::2].tolist()):
        cuts = np.linspace(a, b, -(-(b - a) // CHUNK) + 1).astype(int).tolist()
        yield from map(slice, cuts[:-1], cuts[1:])


class _Group:
    """Networks of one depth: weights ``(network, in, out)`` and biases per layer, masks of real units, and the fold each leaves out."""

    def __init__(self, members: Sequence[tuple[int, Net, int]], d: int, seed: int):
        self.members = list(members)
        depth, wide = len(members[0][1].hidden), max(max(n.hidden) for _, n, _ in members)
        sizes = [d, *[wide] * depth, 1]
        self.shapes = [(len(members), a, b) for a, b in zip(sizes, sizes[1:])]
        self.masks = np.array([[np.arange(wide) < w for w in n.hidden] for _, n, _ in members], dtype=float)
        self.left = np.array([-9 if f < 0 else f for _, _, f in members])
        self.rate = np.array([n.rate for _, n, _ in members])
        self.w, self.b = [], []
        for layer, (count, a, b) in enumerate(self.shapes):
            weight = np.zeros((count, a, b))
            for i, (number, net, _) in enumerate(members):
                fan = [d, *net.hidden, 1]
                limit = np.sqrt(2 / (fan[layer] + fan[layer + 1]))
                # The same start for all folds of a setting.
                rng = np.random.default_rng([seed, number, layer])
                weight[i, : fan[layer], : fan[layer + 1]] = rng.uniform(-limit, limit, (fan[layer], fan[layer + 1]))
            self.w.append(weight)
            self.b.append(np.zeros((count, 1, b)))
        self.moved = [np.zeros_like(v) for v in (*self.w, *self.b)]

    @property
    def size(self) -> int:
        return sum(v.size for v in (*self.w, *self.b)) + 2 * len(self.members)

    def forward(self, x: np.ndarray, at: slice, joined: Sequence[np.ndarray], short: Sequence[bool], space: _Space) -> list[np.ndarray]:
        """Signed activations ``(network, unit, row)`` of every layer for rows ``x`` (with a last column of ones).

        A unit's activation ``a`` is stored as ``2 a - 1``, the hyperbolic tangent of half its input. Hidden layers
        end with a unit that is always one, so that ``joined`` weights hold the biases. ``short`` is from :meth:`short`.
        """
        acts, rows = [], len(x)
        for layer, weights in enumerate(joined):
            own, last = weights[at], layer + 1 == len(joined)
            count, units = own.shape[:2]
            u = space.get("u", (count, units, rows))
            if layer:
                np.matmul(own, acts[-1], out=u)
            else:
                np.matmul(own.reshape(-1, x.shape[1]), x.T, out=u.reshape(-1, rows))
            full = space.get(f"act{layer}", (count, units + (not last), rows))
            _tanh(u, full[:, :units], short[layer], space)
            full[:, units:] = 1
            acts.append(full)
        return acts

    def short(self, x: np.ndarray, joined: Sequence[np.ndarray]) -> list[bool]:
        """By layer: whether no unit's input can pass ``REACH``."""
        return [bool(np.abs(w).sum(2).max(initial=0) * (1 if layer else np.abs(x).max(initial=0)) < REACH) for layer, w in enumerate(joined)]

    def joined(self) -> list[np.ndarray]:
        """Weights of signed activations with their biases as a last input: ``(network, out, in + 1)`` per layer, for half of a unit's input."""
        out = []
        for layer, (w, b) in enumerate(zip(self.w, self.b)):
            if layer:
                w = w * self.masks[:, layer - 1, :, None]
            w, b = (w / 4, b / 2 + w.sum(1, keepdims=True) / 4) if layer else (w / 2, b / 2)
            out.append(np.ascontiguousarray(np.concatenate([w, b], axis=1).transpose(0, 2, 1)))
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray, f: np.ndarray, space: _Space | None = None) -> np.ndarray:
        """Summed gradients of all weights and biases, then loss and rows of every network.

        Rows are taken fold by fold, so a network does no work for the fold it leaves out.
        """
        space = _Space() if space is None else space
        joined, ones = self.joined(), np.column_stack([x, np.ones(len(x))])
        short, sums = self.short(ones, joined), [np.zeros_like(v) for v in joined]
        loss, rows = np.zeros(len(self.members)), np.zeros(len(self.members))
        away = np.where(np.isin(f, self.left), f, -1)  # rows of folds that no network leaves out are alike
        order = np.argsort(away, kind="stable")
        folds, begin = np.unique(away[order], return_index=True)
        for fold, own in zip(folds, np.split(order, begin[1:])):
            live = self.left != fold
            rows[live] += len(own)
            parts = list(_stretches(live))
            for first in range(0, len(own), ROWS):
                part = own[first : first + ROWS]
                z, target = ones[part], y[part]
                out = space.get("out", (len(live), len(part)))
                for at in parts:
                    acts = self.forward(z, at, joined, short, space)
                    np.add(acts[-1][:, 0], 1, out=out[at])
                    out[at] /= 2
                    delta = (out[at] - target)[:, None, :]
                    for layer in range(len(self.w) - 1, 0, -1):
                        below, back = acts[layer - 1], joined[layer][at, :, :-1].transpose(0, 2, 1)
                        sums[layer][at] += delta @ below.transpose(0, 2, 1)
                        slope, below = space.get("t", (len(back), below.shape[1] - 1, len(z))), below[:, :-1]
                        np.multiply(below, below, out=slope)
                        np.subtract(1, slope, out=slope)
                        down = space.get(f"delta{layer % 2}", slope.shape)
                        (np.matmul if back.shape[2] > 1 else np.multiply)(back, delta, out=down)
                        down *= slope
                        delta = down
                    sums[0][at] += (delta.reshape(-1, len(z)) @ z).reshape(sums[0][at].shape)
                loss[live] -= _log_likelihood(out[live], target)
        gw, gb = [], []
        for layer, v in enumerate(sums):
            w, b = v[:, :, :-1].transpose(0, 2, 1), v[:, :, -1]
            if layer:  # an activation is half of one plus its signed form; that of a masked unit is zero
                w = (w + b[:, None, :]) / 2 * self.masks[:, layer - 1, :, None]
            gw.append(w)
            gb.append(b)
        return np.concatenate([v.ravel() for v in (*gw, *gb, loss, rows)])

    def step(self, summed: np.ndarray) -> np.ndarray:
        """Take one step from summed gradients; mean loss before it."""
        count = len(self.members)
        rows = np.maximum(summed[-count:], 1)
        scale, at = (self.rate / rows)[:, None, None], 0
        for i, v in enumerate((*self.w, *self.b)):
            pull = scale * summed[at : at + v.size].reshape(v.shape)
            at += v.size
            self.moved[i] = MOMENTUM * self.moved[i] - pull
            v += MOMENTUM * self.moved[i] - pull
        return summed[-2 * count : -count] / rows


@dataclass
class Fitted:
    """Networks of a population, their folds (-1: trained on all rows), and the mean loss of each over the steps."""

    nets: list[Net]
    groups: list[_Group]
    mean: np.ndarray
    spread: np.ndarray
    losses: np.ndarray
    owner: np.ndarray
    folds: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 by row and network."""
        z = np.column_stack([(x - self.mean) / self.spread, np.ones(len(x))])
        out, at, space = np.empty((len(x), len(self.folds))), 0, _Space()
        for g in self.groups:
            joined = g.joined()
            short = g.short(z, joined)
            for part in _stretches(np.ones(len(g.members), dtype=bool)):
                for first in range(0, len(x), ROWS):
                    says = g.forward(z[first : first + ROWS], part, joined, short, space)[-1][:, 0].T
                    out[first : first + ROWS, at + part.start : at + part.stop] = (says + 1) / 2
            at += len(g.members)
        return out


def fit(blocks: DataFrame, nets: Sequence[Net], folds: int = 0, steps: int = 200, seed: int = 1) -> Fitted:
    """Train every network on all rows and, with ``folds``, with each fold left out."""
    d = B.width(blocks)
    if not d:
        raise ValueError("no rows to train on")
    _, mean, spread = B.moments(blocks, d)
    # Fold by fold, so that the networks that learn from a row lie side by side.
    members = [(i, n, f) for f in (-1, *range(folds)) for i, n in enumerate(nets)]
    groups = [_Group([m for m in members if len(m[1].hidden) == depth], d, seed) for depth in sorted({len(n.hidden) for n in nets})]
    sizes, losses, space = [g.size for g in groups], [], _Space()
    for _ in range(steps):

        def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
            z = (x - mean) / spread
            return np.concatenate([g.gradient(z, y, f, space) for g in groups])

        parts = np.split(B.summed(blocks, fn, sum(sizes)), np.cumsum(sizes)[:-1])
        losses.append(np.concatenate([g.step(p) for g, p in zip(groups, parts)]))
    order = [m for g in groups for m in g.members]
    return Fitted(list(nets), groups, mean, spread, np.array(losses), np.array([i for i, _, _ in order]), np.array([f for _, _, f in order]))


def counts(blocks: DataFrame, fitted: Fitted) -> np.ndarray:
    """Per network: true and false positives, false and true negatives, on the fold it left out or on all rows."""
    folds = fitted.folds

    def fn(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        says, yes = fitted.probabilities(x) > 0.5, (y > 0.5)[:, None]
        here = (folds < 0)[None, :] | (f[:, None] == folds[None, :])
        return np.concatenate([(here & a & b).sum(0) for a, b in ((says, yes), (says, ~yes), (~says, yes), (~says, ~yes))]).astype(float)

    return B.summed(blocks, fn, 4 * len(folds)).reshape(4, -1).T


def search(blocks: DataFrame, nets: Sequence[Net] = tuple(GRID), folds: int = 5, steps: int = 200, metric: str = "accuracy") -> tuple[DataFrame, Fitted, int]:
    """Cross-validated search: table ``(setting, mean, std, best)``, the population, and the number of the best network's setting."""
    fitted = fit(blocks, nets, folds, steps)
    values = rates(counts(blocks, fitted))[metric]
    per = [values[(fitted.owner == i) & (fitted.folds >= 0)] for i in range(len(nets))]
    best = int(np.argmax([v.mean() for v in per]))
    rows = [(n.name, float(v.mean()), float(v.std()), i == best) for i, (n, v) in enumerate(zip(nets, per))]
    return blocks.sparkSession.createDataFrame(rows, "setting string, mean double, std double, best boolean"), fitted, best

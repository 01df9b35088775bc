"""Populations of models trained in shared scans, against single models and plain loops."""

import sys
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from casework.operators import blocks, boosting, clustering, logistic, models, networks, trees


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(900):
        x = rng.normal(size=3) * [1, 300, 0.02] + [0, 5000, 1]
        p = 1 / (1 + np.exp(-(1.2 * x[0] + (x[1] - 5000) / 250)))
        rows.append((i, x.tolist(), float(rng.random() < p), i % 5))
    return spark.createDataFrame(rows, "id long, x array<double>, label double, fold int").repartition(5).cache()


@pytest.fixture(scope="module")
def packed(noisy):
    return blocks.pack(noisy, "x", F.col("label"), F.col("fold"))


def test_all_settings_and_folds_solve_their_equations(noisy, packed):
    fitted = logistic.fit(packed, logistic.GRID, folds=5)
    assert len(logistic.GRID) == 21 and len(fitted.coefficients) == 21 * 6
    assert fitted.residual.max() < 1e-6 and fitted.scans < 40
    assert set(fitted.rows.astype(int)) == {900, 720}
    some = [m for m in range(len(fitted.folds)) if m % 5 == 0]
    check = logistic.score_equations(
        noisy, "x", F.col("label"), [fitted.coefficients[m] for m in some], [fitted.settings[fitted.owner[m]] for m in some], F.col("fold"), [int(fitted.folds[m]) for m in some]
    ).collect()
    assert max(r.residual for r in check) < 1e-5 and [r.rows for r in check] == [int(fitted.rows[m]) for m in some]


def test_wrong_coefficients_do_not_pass(noisy, packed):
    fitted = logistic.fit(packed, [logistic.Setting("l2")])
    off = fitted.coefficients[0] * 1.01
    assert logistic.score_equations(noisy, "x", F.col("label"), [off], [logistic.Setting("l2")]).first().residual > 5e-4  # fifty times what a solved model may have


@pytest.mark.parametrize("setting", [logistic.Setting(None), logistic.Setting("l2", 0.1), logistic.Setting("l1", 0.1), logistic.Setting("elasticnet", 0.01, 0.5)])
def test_equal_to_single_models(noisy, packed, setting):
    own = logistic.fit(packed, [setting]).coefficients[0]
    l1, l2 = setting.strengths()
    lr = LogisticRegression(regParam=(l1 + l2) / 900, elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0, maxIter=2000, tol=1e-12, standardization=False)
    other = lr.fit(noisy.select(array_to_vector("x").alias("features"), "label"))
    assert own[:3] == pytest.approx(other.coefficients.toArray(), rel=0.02, abs=2e-4)


def test_search_counts_equal_predictions(noisy, packed):
    table, fitted, best = logistic.search(packed, logistic.GRID[:4], folds=5)
    rows = table.collect()
    assert [r.best for r in rows].index(True) == best
    score = F.coalesce(*[F.when(F.col("fold") == f, logistic.margin(F.col("x"), fitted.model(2, f))) for f in range(5)])
    rates = {r.metric: r for r in models.fold_rates(noisy.withColumn("prediction", (score > 0).cast("int"))).collect()}
    assert rows[2].mean == pytest.approx(rates["accuracy"].mean) and rows[2].std == pytest.approx(rates["accuracy"]["std"])


def test_separable_and_constant_features_end(spark):
    rows = [([float(i), 1.0], float(i > 4), -1) for i in range(10)]
    data = blocks.pack(spark.createDataFrame(rows, "x array<double>, label double, fold int"), "x", F.col("label"))
    fitted = logistic.fit(data, [logistic.Setting("l2"), logistic.Setting(None)])
    assert fitted.residual[0] < 1e-6 and np.isfinite(fitted.coefficients).all()


def test_rows_with_holes_are_left_out(spark):
    rows = [([1.0, 2.0], 1.0), ([None, 2.0], 1.0), ([float("nan"), 2.0], 0.0), ([1.0, float("inf")], 0.0), (None, 1.0), ([3.0, 4.0], None), ([5.0, 6.0], 0.0)]
    data = blocks.pack(spark.createDataFrame(rows, "x array<double>, label double"), "x", F.col("label"))
    assert blocks.moments(data, 2)[0] == 2
    with pytest.raises(ValueError, match="no rows"):
        logistic.fit(data.limit(0), [logistic.Setting()])


def plain_boosting(x, y, rounds, rate):
    """Stumps over all values as thresholds, weights kept per row."""
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for j in range(x.shape[1]):
            for t in np.unique(x[:, j])[:-1]:
                side = x[:, j] <= t
                total, votes, wrong = 0.0, [], 0.0
                for part in (side, ~side):
                    a, b = w[part & (y == 0)].sum(), w[part & (y == 1)].sum()
                    total += (a + b) - (a * a + b * b) / (a + b)
                    votes.append(float(b > a))
                    wrong += min(a, b)
                if best is None or total < best[0] - 1e-12:
                    best = (total, j, t, *votes, wrong / w.sum(), side)
        _, j, t, left, right, error, side = best
        if error >= 0.5:
            break
        alpha = rate * np.log((1 - error) / error)
        out.append((j, float(t), left, right, alpha))
        w = w * np.exp(alpha * (np.where(side, left, right) != y))
    return out


def test_boosting_equals_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + rng.normal(0, 4, 400) > 17).astype(float)
    fold = np.arange(400) % 3
    df = spark.createDataFrame([(a.tolist(), float(b), int(f)) for a, b, f in zip(x, y, fold)], "x array<double>, label double, fold int").repartition(4)
    got = boosting.fit(df, rounds=15, rate=0.5, features="x", fold=F.col("fold"), folds=3)
    for k, stumps in enumerate(got):
        part = np.ones(400, dtype=bool) if k == 0 else fold != k - 1
        want = plain_boosting(x[part], y[part], 15, 0.5)
        assert len(stumps) == len(want)
        for a, b in zip(stumps, want):
            assert a == pytest.approx(b)
    score = sum(a * (2 * np.where(x[:, j] <= t, l, r) - 1) for j, t, l, r, a in got[0])
    hits = boosting.predict(df, got[0], "x").where("prediction = label").count()
    assert hits == ((score > 0) == y).sum() > 300


def test_boosting_ends_when_perfect_or_hopeless(spark):
    perfect = spark.createDataFrame([([float(i)], float(i > 5)) for i in range(10)], "x array<double>, label double")
    assert [s[:4] for s in boosting.fit(perfect, 20, features="x")[0]] == [(0, 5.0, 0.0, 1.0)]
    same = spark.createDataFrame([([1.0], float(i % 2)) for i in range(10)], "x array<double>, label double")
    assert boosting.fit(same, 20, features="x") == [[]] and boosting.fit(same.limit(0), features="x") == [[]]


def test_starts_settle_on_means_and_cost_falls(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (4, 0), (0, 4), (4, 4))])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3)
    found = clustering.kmeans_starts(df, range(1, 6), starts=10, features="x", tolerance=0.0)
    costs = [found[k].cost for k in range(1, 6)]
    assert costs == sorted(costs, reverse=True)
    assert costs[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert sorted(found[4].sizes) == [60] * 4
    for k, c in found.items():
        own = ((x[:, None] - c.centres[None]) ** 2).sum(2).argmin(1)
        assert np.bincount(own, minlength=k).tolist() == c.sizes.tolist()
        assert all(c.centres[j] == pytest.approx(x[own == j].mean(0)) for j in range(k))
    one = clustering.kmeans(df, 4, "x")[0].groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in one) == [60] * 4


def test_more_centres_than_values(spark):
    df = spark.createDataFrame([([1.0],)] * 5 + [([2.0],)] * 3, "x array<double>")
    found = clustering.kmeans_starts(df, [3], features="x")[3]
    assert found.cost == 0 and found.sizes.sum() == 8


def test_worst_pairs_in_slices(monkeypatch):
    rng = np.random.default_rng(1)
    c, s = rng.normal(size=(23, 4)), rng.random(23)
    gap = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
    np.fill_diagonal(gap, np.inf)
    want = ((s[:, None] + s[None]) / gap).max(1).mean()
    for cells in (10, 100, 10**6):
        monkeypatch.setattr(clustering, "PAIR_CELLS", cells)
        assert clustering._worst_pairs(c, s) == pytest.approx(want)


def test_network_gradients_equal_differences():
    rng = np.random.default_rng(4)
    x, y, f = rng.normal(size=(40, 3)), (rng.random(40) > 0.5).astype(float), np.arange(40) % 2
    for hidden in ((2,), (3, 2), (2, 3, 2)):
        group = networks._Group([(0, networks.Net(hidden, 0.1), -1), (1, networks.Net(tuple(w + 1 for w in hidden), 0.1), 1)], 3, 7)
        n = sum(v.size for v in (*group.w, *group.b))
        got, at = group.gradient(x, y, f)[:n], 0
        for v in (*group.w, *group.b):
            flat = v.reshape(-1)
            for i in rng.integers(0, flat.size, 6):
                ends = []
                for move in (1e-5, -1e-5):
                    flat[i] += move
                    ends.append(group.gradient(x, y, f)[n : n + 2].sum())
                    flat[i] -= move
                assert got[at + i] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-5)
            at += v.size


def test_networks_learn_what_a_line_cannot(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (600, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    data = blocks.pack(spark.createDataFrame([(a.tolist(), float(b), i % 3) for i, (a, b) in enumerate(zip(x, y))], "x array<double>, label double, fold int").repartition(4), "x", F.col("label"), F.col("fold"))
    nets = [networks.Net((5,), 0.4), networks.Net((9,), 0.4), networks.Net((9, 5), 0.01)]
    table, fitted, best = networks.search(data, nets, folds=3, steps=150)
    rows = table.collect()
    assert rows[best].mean > 0.85 and best != 2 and (fitted.losses[-1] < fitted.losses[0]).all()
    hits = networks.counts(data, fitted)
    assert hits.sum(1).tolist() == [600.0 if f < 0 else 200.0 for f in fitted.folds]
    own = (fitted.probabilities(x) > 0.5) == (y[:, None] > 0.5)
    assert hits[:, [0, 3]].sum(1).tolist() == [int(own[:, i].sum() if f < 0 else own[np.arange(600) % 3 == f, i].sum()) for i, f in enumerate(fitted.folds)]
    assert len(networks.GRID) == 4 * (5 + 25 + 125)


def plain_tree(x, y, s, whole=None, depth=0):
    """Nested (feature, threshold, left, right), or the probability of class 1."""
    whole = len(y) if whole is None else whole

    def impurity(v):
        p = v.mean()
        if s.criterion == "gini":
            return 1 - p * p - (1 - p) ** 2
        return -sum(q * np.log2(q) for q in (p, 1 - p) if q > 0)

    best = None
    if depth < s.max_depth and len(y) >= max(s.min_split, 2 * s.min_leaf) and 0 < y.mean() < 1:
        for j in range(x.shape[1]):
            for t in np.unique(x[:, j])[:-1]:
                side = x[:, j] <= t
                if min(side.sum(), (~side).sum()) < s.min_leaf:
                    continue
                gain = (len(y) * impurity(y) - side.sum() * impurity(y[side]) - (~side).sum() * impurity(y[~side])) / whole
                if gain >= max(s.min_decrease, 1e-12) and (best is None or gain > best[0] + 1e-12):
                    best = (gain, j, t, side)
    if best is None:
        return float(y.mean())
    _, j, t, side = best
    return (j, float(t), plain_tree(x[side], y[side], s, whole, depth + 1), plain_tree(x[~side], y[~side], s, whole, depth + 1))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    a, b = tree.child[node]
    return (tree.feature[node], tree.threshold[node], nested(tree, a), nested(tree, b))


@pytest.fixture(scope="module")
def coarse(spark):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 9, (500, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2) ^ (rng.random(500) < 0.1)).astype(float)
    fold = np.arange(500) % 4
    df = spark.createDataFrame([(a.tolist(), float(b), int(f)) for a, b, f in zip(x, y, fold)], "x array<double>, label double, fold int").repartition(3).cache()
    cuts = boosting.cut_points(df, "x")
    return x, y, fold, df, cuts, boosting.binned(blocks.pack(df, "x", F.col("label"), F.col("fold")), cuts)


def same_tree(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    return a == pytest.approx(b) if not isinstance(a, tuple) else a[:2] == b[:2] and same_tree(a[2], b[2]) and same_tree(a[3], b[3])


@pytest.mark.parametrize("cells", [2_000_000, 1000])
def test_trees_equal_plain_recursion(coarse, monkeypatch, cells):
    x, y, fold, _, cuts, data = coarse
    monkeypatch.setattr(trees, "CELLS", cells)
    settings = [trees.Setting("gini", 6), trees.Setting("entropy", 3, min_leaf=7), trees.Setting("gini", 20, 9, 4, 0.002), trees.Setting("entropy", 0)]
    settings = settings if cells > 1000 else settings[1:]
    for tree in trees.grow(data, cuts, [trees.Tree(s, f) for s in settings for f in (-9, 2)]):
        part = fold != tree.fold
        assert same_tree(nested(tree), plain_tree(x[part], y[part], tree.setting))


def test_tree_search_and_forest(spark, coarse):
    x, y, fold, df, cuts, data = coarse
    settings = [trees.Setting("gini", 1), trees.Setting("gini", 6, min_leaf=5)]
    table, full, best = trees.search(data, cuts, settings, folds=4)
    rows = table.collect()
    assert best == 1 and rows[1].best and rows[1].mean > 0.8 > rows[0].mean and len(trees.GRID) == 640
    score = df.select((trees.probability(F.col("x"), [full[1]]) > 0.5).alias("p"), "label").where("p = (label = 1)").count()
    assert score == int(((np.array(full[1].value)[full[1].nodes(x, bins=False)] > 0.5) == y).sum())
    grown = trees.grow(data, cuts, trees.forest(12, trees.Setting("gini", 6), 3))
    again = trees.grow(data, cuts, trees.forest(12, trees.Setting("gini", 6), 3))
    assert [nested(t) for t in grown] == [nested(t) for t in again] and nested(grown[0]) != nested(grown[1])
    shares = trees.importances(grown, 3)
    assert shares.sum() == pytest.approx(1) and shares[2] < min(shares[:2])


def test_gradients_hold_few_activations():
    """A block's activations are worked on in cache-sized parts, not whole."""
    nets = [networks.Net((7, 7, 7), 0.1)] * 24
    group = networks._Group([(i, n, -1) for i, n in enumerate(nets)], 4, 1)
    rng = np.random.default_rng(0)
    x, y, f = rng.normal(size=(4096, 4)), rng.integers(0, 2, 4096).astype(float), np.zeros(4096, dtype="<i4")
    tracemalloc.start()
    group.gradient(x, y, f)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20


def test_tasks_get_few_blocks_at_a_time(spark):
    data = blocks.pack(spark.range(50 * blocks.BLOCK_ROWS, numPartitions=1).selectExpr("array(cast(id as double)) as x"), "x")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def fn(x, y, f):
        return np.array([1.0, sys._getframe(1).f_locals["batch"].num_rows])

    count, sizes = blocks.summed(data, fn, 2)
    assert count == data.count() > 10 * blocks.SENT
    assert sizes <= blocks.SENT * count
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_networks_do_no_work_for_the_fold_they_leave_out(monkeypatch):
    rng = np.random.default_rng(3)
    x, y, f = rng.normal(size=(3000, 4)), rng.integers(0, 2, 3000).astype(float), rng.integers(0, 3, 3000).astype("<i4")
    members = [(i, networks.Net((3, 2), 0.1), fold) for fold in (-1, 0, 1) for i in range(2)]
    seen, forward = [0], networks._Group.forward

    def counted(self, rows, at, *rest):
        seen[0] += len(rows) * len(range(*at.indices(len(members))))
        return forward(self, rows, at, *rest)

    monkeypatch.setattr(networks._Group, "forward", counted)
    got = networks._Group(members, 4, 1).gradient(x, y, f)
    rows = [3000, 3000, *[int((f != k).sum()) for k in (0, 1) for _ in range(2)]]
    assert got[-6:].tolist() == rows and seen[0] == sum(rows)
    single = [networks._Group([m], 4, 1).gradient(x[f != m[2]], y[f != m[2]], f[f != m[2]]) for m in members]
    assert got[-12:-6] == pytest.approx([s[-2] for s in single])


def test_tabled_tangent_and_summed_logarithms():
    rng = np.random.default_rng(5)
    for wide, short in ((1.0, True), (60.0, False)):
        u, out, space = rng.normal(0, wide, (3, 2, 501)), np.empty((3, 2, 501)), networks._Space()
        want = np.tanh(u)
        networks._tanh(u, out, short, space)
        assert np.abs(out - want).max() < 1e-13
    networks._tanh(np.array([[[np.nan, np.inf, -np.inf]]]), out := np.empty((1, 1, 3)), False, networks._Space())
    assert np.isnan(out[0, 0, 0]) and out[0, 0, 1:].tolist() == [1, -1]
    p = np.concatenate([rng.random((4, 37)), np.zeros((4, 40)), np.ones((4, 3))], axis=1)
    for y in (rng.integers(0, 2, 80).astype(float), rng.random(80)):
        q = np.clip(p, 1e-12, 1 - 1e-12)
        assert networks._log_likelihood(p, y) == pytest.approx((y * np.log(q) + (1 - y) * np.log(1 - q)).sum(1), abs=1e-9)


def test_stacking_works_folds_out_once(noisy):
    plans = []

    class Probe(LogisticRegression):
        def fit(self, df, params=None):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return super().fit(df, params)

    data = noisy.select(F.col("id").alias("key"), array_to_vector("x").alias("features"), "label")
    scored = models.fit_stack(data, {"lr": Probe(maxIter=5)}, "key", folds=3)(data)
    assert len(plans) == 4 and not any("md5" in p for p in plans)
    assert scored.where("prediction = label").count() > 600


def test_histograms_look_votes_up_once(monkeypatch):
    """One table entry by bin and class, not one of each class and a choice."""
    rng = np.random.default_rng(6)
    x, y, f = rng.integers(0, 4, (300, 2)).astype("u1"), rng.integers(0, 2, 300).astype(float), rng.integers(0, 3, 300).astype("<i4")
    no, yes, left, shift = rng.random((2, 2, 4)), rng.random((2, 2, 4)), np.array([-9, 1]), np.array([0.5, 0.1])
    want = np.zeros((2, 2, 4, 2))
    for m in range(2):
        for row, label, fold in zip(x, y.astype(int), f):
            if fold != left[m]:
                weight = np.exp(sum((no if label else yes)[m, j, b] for j, b in enumerate(row)) - shift[m])
                for j, b in enumerate(row):
                    want[m, j, b, label] += weight
    monkeypatch.setattr(boosting.B, "summed", lambda blocks, fn, size, kind: fn(x, y, f))
    monkeypatch.setattr(np, "where", None)
    got = boosting._histograms(None, no, yes, shift, left, 4)
    monkeypatch.undo()
    assert got == pytest.approx(want)

"""Feature engineering, models, metrics and clustering."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casework.operators import blocks, boosting, clustering, compare, evaluation, features, logistic, metrics, models, networks, trees
from casework.plans.measures import NUMERIC, SQL_LABELLED, labelled
from casework.plans.registry import query
from casework.plans.relations import SQL_SCORED, scored
from casework.session import materialise
from casework.sources.files import spread


@query(
    "m1_label_encode",
    """SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS o_orderpriority_code, (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::BIGINT AS o_orderstatus_code FROM orders""",
)
def _(t):
    df = features.label_encode(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderpriority", "o_orderstatus"])
    return df.select("o_orderkey", "o_orderpriority_code", "o_orderstatus_code")


SQL_HASH = "('0x' || substring(md5('42:' || {0}::VARCHAR), 1, 8))::BIGINT / 4294967296.0"


@query(
    "m2_standardise",
    f"""WITH p AS (SELECT *, {SQL_HASH.format('o_orderkey')} < 0.3 AS test FROM orders),
s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM p WHERE NOT test)
SELECT o_orderkey, round((o_totalprice - m) / sd, 6) AS o_totalprice, CASE WHEN test THEN 'test' ELSE 'train' END AS part FROM p, s""",
)
def _(t):
    df = features.split(t.orders.select("o_orderkey", "o_totalprice"), 0.3, key="o_orderkey")
    fitted = features.fit_standard(df.where("part = 'train'"), ["o_totalprice"])
    out = features.standardise(df, ["o_totalprice"], fitted)
    return out.withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    "m3_impute",
    f"""WITH {SQL_LABELLED}, holes AS (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE n_chars END AS n_chars, quality, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE lang END AS lang FROM labelled)
SELECT doc_id, coalesce(n_chars, (SELECT quantile_cont(n_chars, 0.5) FROM holes))::DOUBLE AS n_chars, coalesce(quality, (SELECT quantile_cont(quality, 0.5) FROM holes))::DOUBLE AS quality,
  coalesce(lang, (SELECT lang FROM holes WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang FROM holes""",
)
def _(t):
    hole = lambda c: F.when(F.col("doc_id") % 10 != 3, F.col(c)).alias(c)
    df = labelled(t).select("doc_id", hole("n_chars"), "quality", hole("lang"))
    return features.impute(df, numeric=["n_chars", "quality"], categorical=["lang"])


@query(
    "m4_rare_group",
    """WITH s AS (SELECT p_name, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN share > 0.015 THEN p_name ELSE 'other' END AS p_name_grp, p_name AS p_name FROM part JOIN s USING (p_name)""",
)
def _(t):
    return features.rare_group(t.part.select("p_partkey", "p_name"), "p_name", 0.015)


@query(
    "m4_rare_group_default",
    """WITH s AS (SELECT p_name, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN share > 0.01 THEN p_name ELSE 'other' END AS p_name_grp FROM part JOIN s USING (p_name)""",
)
def _(t):
    return features.rare_group(t.part.select("p_partkey", "p_name"), "p_name").drop("p_name")


@query(
    "m5_frequency_encode",
    """WITH s AS (SELECT p_name, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1)
SELECT p_partkey, round(CASE WHEN share > 0.015 THEN share ELSE 0 END, 6)::DOUBLE AS p_name_freq FROM part JOIN s USING (p_name)""",
)
def _(t):
    grouped = features.rare_group(t.part.select("p_partkey", "p_name"), "p_name", 0.015)
    out = features.frequency_encode(grouped, "p_name_grp", of=t.part, of_column="p_name")
    return out.select("p_partkey", F.round("p_name_grp_freq", 6).alias("p_name_freq"))


@query(
    "m6_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"(o_orderpriority = '{p}')::BIGINT AS p_{p[0]}" for p in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    + " FROM orders",
)
def _(t):
    out = features.one_hot(t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("p")), "p")
    return out.drop("p")


@query("m7_split", f"SELECT doc_id, CASE WHEN {SQL_HASH.format('doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS part FROM labels")
def _(t):
    return features.split(t.labels.select("doc_id"), 0.2, key="doc_id")


@query(
    "m8_class_weights",
    """SELECT doc_id, quality::BIGINT AS quality, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels""",
)
def _(t):
    out = features.class_weights(t.labels.select("doc_id", "quality"), "quality")
    return out.withColumn("weight", F.round("weight", 6))


def training(t):
    """Line items as labelled rows, written once: the trainers read it many times."""
    keyed = spread(t.lineitem).withColumn("key", F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    data = models.assemble(keyed, NUMERIC, F.col("l_returnflag") == "R", keep=["key", "l_shipdate"])
    return features.split(materialise(data, "training"), 0.3, key="key")


def train_test(t):
    data = training(t)
    return data.where("part = 'train'").drop("part"), data.where("part = 'test'").drop("part")


def scored_rates(predictions, name):
    return metrics.class_metrics(predictions).select(F.lit(name).alias("model"), "*")


#: Folds are dealt by another hash than the split, which has already used the low numbers of its own.
FOLD_SEED = 43

SQL_TRAINING = f"""keyed AS (SELECT *, concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key, l_returnflag = 'R' AS label FROM lineitem),
training AS (SELECT *, floor({SQL_HASH.replace('42:', '43:').format('key')} * 5)::BIGINT AS fold FROM keyed WHERE {SQL_HASH.format('key')} >= 0.3)"""


def folded(t):
    """Training rows with ``x`` (array), ``label`` and ``fold``."""
    train, _ = train_test(t)
    return train.select(vector_to_array("features").alias("x"), "label", "l_shipdate", features.fold("key", 5, FOLD_SEED).alias("fold"))


def packed(df):
    return blocks.pack(df, "x", F.col("label"), F.col("fold"))


@query("m9_fit_logistic")
def _(t):
    train, test = train_test(t)
    settings = [logistic.Setting(None), logistic.Setting("l1"), logistic.Setting("l2"), logistic.Setting("elasticnet", 1.0, 0.5)]
    fitted = logistic.fit(blocks.pack(train, "features", F.col("label")), settings)
    scored = test.select(vector_to_array("features").alias("x"), "label")
    parts = [
        scored_rates(scored.select("label", (logistic.margin(F.col("x"), w) > 0).cast("double").alias("prediction")), s.name)
        for s, w in zip(settings, fitted.coefficients)
    ]
    return compare.union_runs(*parts)


def sql_values(names):
    return ", ".join(f"('{n}')" for n in names)


@query(
    "m9_score_equations",
    f"""WITH {SQL_TRAINING} SELECT setting, (SELECT count(*) FROM training) AS rows, true AS solved FROM (VALUES {sql_values([s.name for s in logistic.GRID])}) v(setting)""",
)
def _(t):
    """Every model of the search grid meets its optimality conditions, recomputed by column sums."""
    train = folded(t)
    fitted = logistic.fit(packed(train), logistic.GRID)
    check = logistic.score_equations(train, "x", F.col("label"), fitted.coefficients, logistic.GRID)
    names = t.spark.createDataFrame([(i, s.name) for i, s in enumerate(logistic.GRID)], "model long, setting string")
    return check.join(names, "model").select("setting", "rows", (F.col("residual") < 1e-5).alias("solved"))


@query("m10_logit_summary")
def _(t):
    return models.logit_summary(train_test(t)[0], NUMERIC)


@query("m10_logit_equations", f"WITH {SQL_TRAINING} SELECT count(*) AS rows, {len(NUMERIC) + 1}::BIGINT AS terms, true AS solved FROM training")
def _(t):
    """The unpenalised coefficients solve the score equations, recomputed by column sums."""
    train, _ = train_test(t)
    summary = {r.term: r.coefficient for r in models.logit_summary(train, NUMERIC).collect()}
    check = logistic.score_equations(
        train.select(vector_to_array("features").alias("x"), "label"), "x", F.col("label"), [[summary[c] for c in (*NUMERIC, "intercept")]], [logistic.Setting(None)]
    )
    return check.select("rows", F.lit(len(summary)).cast("long").alias("terms"), (F.col("residual") < 1e-5).alias("solved"))


def binned(df):
    """Thresholds, and blocks of bin numbers."""
    cuts = boosting.cut_points(df, "x")
    return cuts, boosting.binned(packed(df), cuts)


#: Part of ``trees.GRID``.
TREES = [s for s in trees.GRID if s.min_split == 5 and s.min_leaf in (2, 5, 9) and s.min_decrease in (0.001, 0.004)]


@query("m11_fit_tree")
def _(t):
    cuts, data = binned(by_net_price(folded(t)))
    _, grown, best = trees.search(data, cuts, TREES, folds=5)
    test = by_net_price(train_test(t)[1].select(vector_to_array("features").alias("x")))
    return scored_rates(test.select("label", (trees.probability(F.col("x"), [grown[best]]) > 0.5).cast("double").alias("prediction")), "tree")


@query(
    "m11_tree_totals",
    f"""WITH {SQL_TRAINING}, y AS (SELECT l_extendedprice * (1 - l_discount) * (1 + l_tax) > 35000 AS label FROM training)
SELECT setting, (SELECT count(*) FROM y) AS rows, (SELECT count(*) FROM y WHERE label) AS positives FROM (VALUES {sql_values([s.name for s in TREES])}) v(setting)""",
)
def _(t):
    """The probabilities that a tree gives its own training rows add up to their positives."""
    df = by_net_price(folded(t))
    cuts, data = binned(df)
    grown = trees.grow(data, cuts, [trees.Tree(s) for s in TREES])
    sums = df.agg(F.count("*").alias("rows"), *[F.sum(trees.probability(F.col("x"), [g])).alias(f"p{i}") for i, g in enumerate(grown)])
    pairs = F.array(*[F.struct(F.lit(s.name).alias("setting"), F.col("rows"), F.round(f"p{i}", 6).cast("long").alias("positives")) for i, s in enumerate(TREES)])
    return sums.select(F.explode(pairs).alias("r")).select("r.*")


@query("m12_fit_forest")
def _(t):
    cuts, data = binned(by_net_price(folded(t)))
    shares = trees.importances(trees.grow(data, cuts, trees.forest(50, trees.Setting("gini", 7), len(cuts))), len(cuts))
    return t.spark.createDataFrame([(n, float(v)) for n, v in zip(NUMERIC, shares)], "feature string, importance double")


#: Layouts of one to three layers at every learning rate; the whole grid is ``networks.GRID``.
NETS = [networks.Net((w,) * n, r) for r in networks.RATES for n in (1, 2, 3) for w in (7,)]


def by_net_price(df):
    """A curved target: whether the price after discount and tax passes 35,000."""
    x = lambda i: F.get("x", F.lit(i))
    return df.withColumn("label", (x(1) * (1 - x(2)) * (1 + x(3)) > 35_000).cast("double"))


@query("m13_fit_mlp")
def _(t):
    return networks.search(packed(by_net_price(folded(t))), NETS, folds=5, steps=60)[0]


@query(
    "m13_mlp_checks",
    f"""WITH {SQL_TRAINING}, y AS (SELECT l_extendedprice * (1 - l_discount) * (1 + l_tax) > 35000 AS label FROM training)
SELECT count(*) AS rows, {len(NETS)}::BIGINT AS nets, greatest(count(*) FILTER (label), count(*) FILTER (NOT label)) AS majority, true AS beaten, true AS losses_fall FROM y""",
)
def _(t):
    """Rows and majority class of the training part, and whether the best network trained on it does better."""
    data = packed(by_net_price(folded(t)))
    fitted = networks.fit(data, NETS, steps=60)
    hits = networks.counts(data, fitted)
    rows, yes = int(hits[0].sum()), int(hits[0, 0] + hits[0, 2])
    majority, best = max(yes, rows - yes), int((hits[:, 0] + hits[:, 3]).max())
    row = (rows, len(NETS), majority, best > majority, bool((fitted.losses[-1] < fitted.losses[0]).all()))
    return t.spark.createDataFrame([row], "rows long, nets long, majority long, beaten boolean, losses_fall boolean")


@query("m14_fit_gbt")
def _(t):
    train, _ = train_test(t)
    return models.importances(models.fit_gbt(train, rounds=5, depth=4), NUMERIC, t.spark)


@query("m15_fit_stack")
def _(t):
    train, test = train_test(t)
    bases = {
        "lr": LogisticRegression(maxIter=10),
        "dt": DecisionTreeClassifier(maxDepth=4, seed=42),
        "rf": RandomForestClassifier(numTrees=5, maxDepth=4, seed=42),
    }
    return scored_rates(models.fit_stack(train, bases, "key", folds=3, seed=FOLD_SEED)(test), "stack")


def by_season(df):
    """A balanced target gives the stumps something to learn."""
    return df.withColumn("label", (F.month("l_shipdate") <= 6).cast("double"))


@query("m16_fit_adaboost")
def _(t):
    train, test = train_test(t)
    stumps = boosting.fit(by_season(train), rounds=100, rate=0.1)[0]
    return scored_rates(boosting.predict(by_season(test), stumps), "adaboost")


@query(
    "m16_first_stump",
    f"""WITH {SQL_TRAINING}, long AS (
  SELECT unnest([0, 1, 2]) AS feature, unnest([l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE]) AS x, (month(l_shipdate) <= 6)::INT AS y FROM training),
cells AS (SELECT feature, x, count(*) AS n, sum(y) AS p FROM long GROUP BY ALL),
sides AS (SELECT feature, x AS threshold, sum(n) OVER w AS n1, sum(p) OVER w AS p1, sum(n) OVER (PARTITION BY feature) AS n, sum(p) OVER (PARTITION BY feature) AS p FROM cells WINDOW w AS (PARTITION BY feature ORDER BY x)),
pure AS (SELECT *, n1 - (p1 * p1 + (n1 - p1) * (n1 - p1))::DOUBLE / n1 + (n - n1) - ((p - p1) * (p - p1) + (n - n1 - p + p1) * (n - n1 - p + p1))::DOUBLE / (n - n1) AS impurity FROM sides WHERE n1 < n),
best AS (SELECT * FROM pure ORDER BY impurity, feature, threshold LIMIT 1)
SELECT feature::BIGINT AS feature, threshold, (p1 > n1 - p1)::BIGINT AS left_vote, (p - p1 > n - n1 - p + p1)::BIGINT AS right_vote,
  round((least(p1, n1 - p1) + least(p - p1, n - n1 - p + p1)) / n, 9)::DOUBLE AS error FROM best""",
)
def _(t):
    """The first round on features of few values, where every value is a threshold."""
    train = by_season(folded(t)).select("label", F.array(*[F.get("x", F.lit(i)) for i in (0, 2, 3)]).alias("x"))
    j, threshold, left, right, alpha = boosting.fit(train, rounds=1, features="x")[0][0]
    error = F.lit(1.0) / (1 + F.exp(F.lit(alpha)))
    one = t.spark.createDataFrame([(j, threshold, int(left), int(right))], "feature long, threshold double, left_vote long, right_vote long")
    return one.withColumn("error", F.round(error, 9))


@query("m17_rfe")
def _(t):
    return models.rfe(spread(t.lineitem), NUMERIC, F.col("l_returnflag") == "R", numTrees=5, maxDepth=4)


@query("m18_search")
def _(t):
    train, _ = train_test(t)
    full = logistic.search(packed(folded(t)))[0]
    drawn = models.random_search(train, RandomForestClassifier(seed=42), {"numTrees": [3, 5], "maxDepth": [2, 3]}, n=2, folds=3)
    return compare.union_runs(full.withColumn("search", F.lit("grid")), models.search_table(drawn, t.spark).withColumn("search", F.lit("random")))


@query(
    "m18_models",
    f"""WITH {SQL_TRAINING}, f AS (SELECT fold, (SELECT count(*) FROM training) - count(*) AS rows FROM training GROUP BY fold)
SELECT setting, fold, rows, true AS solved FROM f, (VALUES {sql_values([s.name for s in logistic.GRID])}) v(setting)""",
)
def _(t):
    """Rows and optimality of every (setting, fold) model of the search."""
    fitted = logistic.fit(packed(folded(t)), logistic.GRID, folds=5)
    rows = [(logistic.GRID[s].name, int(f), int(n), bool(r < 1e-6)) for s, f, n, r in zip(fitted.owner, fitted.folds, fitted.rows, fitted.residual) if f >= 0]
    return t.spark.createDataFrame(rows, "setting string, fold long, rows long, solved boolean")


def fold_table(t, name, hits):
    """Rates of the models of all folds from their counts: ``(model, metric, mean, std)``."""
    return t.spark.createDataFrame([(name, m, float(v.mean()), float(v.std())) for m, v in logistic.rates(hits).items()], "model string, metric string, mean double, std double")


@query("m19_cross_val")
def _(t):
    df = by_net_price(folded(t))
    data = packed(df)
    linear = logistic.fit(data, [logistic.Setting("l2")], folds=5)
    nets = networks.fit(data, [networks.Net((9,), 0.4)], folds=5, steps=60)
    cuts, binned_data = binned(df)
    grown = trees.grow(binned_data, cuts, [trees.Tree(TREES[0], f) for f in range(5)])
    stumps = boosting.fit(df, 100, 0.1, features="x", fold=F.col("fold"), folds=5)
    score = F.coalesce(*[F.when(F.col("fold") == f, boosting.score(F.col("x"), stumps[f + 1])) for f in range(5)])
    boosted = models.fold_rates(df.withColumn("prediction", (score > 0).cast("int"))).withColumn("model", F.lit("adaboost"))
    return compare.union_runs(
        fold_table(t, "logistic", logistic.held_out_counts(data, linear)[linear.folds >= 0]),
        fold_table(t, "network", networks.counts(data, nets)[nets.folds >= 0]),
        fold_table(t, "tree", trees.counts(binned_data, grown)),
        boosted.select("model", "metric", "mean", "std"),
    )


def ruled(t, threshold):
    return scored(t).select("doc_id", F.col("quality").alias("label"), (F.col("score") > threshold).cast("int").alias("prediction"))


SQL_CLASS = """
cm AS (SELECT quality AS label, (score > {th})::INT AS prediction FROM scored),
cls AS (SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS predicted FROM cm, (VALUES (0), (1)) v(c) GROUP BY c),
pr AS (SELECT c::VARCHAR AS class, support, tp, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM cls),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr),
cmet AS (SELECT class, support, round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall, round(f1, 6)::DOUBLE AS f1 FROM f
UNION ALL SELECT 'macro', sum(support)::BIGINT, round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM f
UNION ALL SELECT 'accuracy', sum(support)::BIGINT, round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6) FROM f)
"""


@query("m20_class_metrics", f"WITH {SQL_SCORED}, {SQL_CLASS.format(th=0.5)} SELECT * FROM cmet")
def _(t):
    return metrics.class_metrics(ruled(t, 0.5))


@query(
    "m20_confusion", f"WITH {SQL_SCORED} SELECT quality::BIGINT AS label, (score > 0.5)::BIGINT AS prediction, count(*) AS n FROM scored GROUP BY ALL"
)
def _(t):
    return metrics.confusion(ruled(t, 0.5))


@query(
    "m21_threshold_sweep",
    f"""WITH {SQL_SCORED}, th AS (SELECT unnest([0.8, 0.5, 0.3]::DOUBLE[]) AS threshold),
c AS (SELECT threshold, count(*) FILTER (score > threshold AND quality = 1) AS tp, count(*) FILTER (score > threshold AND quality = 0) AS fp,
  count(*) FILTER (score <= threshold AND quality = 1) AS fn, count(*) FILTER (score <= threshold AND quality = 0) AS tn FROM scored, th GROUP BY 1)
SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6)::DOUBLE AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6)::DOUBLE AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS f1 FROM c""",
)
def _(t):
    return metrics.threshold_sweep(scored(t).withColumnRenamed("quality", "label"))


SQL_ROC = f"""WITH {SQL_SCORED}, s AS (SELECT score, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS q FROM scored GROUP BY 1),
c AS (SELECT score, p, q, sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp, sum(p) OVER () AS tot_p, sum(q) OVER () AS tot_q FROM s),
roc AS (SELECT score, tp / tot_p AS tpr, fp / tot_q AS fpr, (q / tot_q) * (tp / tot_p + (tp - p) / tot_p) / 2 AS area FROM c)"""


@query("m22_roc_points", f"{SQL_ROC} SELECT round(score, 9) AS score, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM roc")
def _(t):
    points = metrics.roc_points(scored(t).withColumnRenamed("quality", "label"))
    return points.select(F.round("score", 9).alias("score"), F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"))


@query("m22_roc_auc", f"{SQL_ROC} SELECT round(sum(area), 6) AS auc, count(*) AS points FROM roc")
def _(t):
    return metrics.roc_auc(metrics.roc_points(scored(t).withColumnRenamed("quality", "label")))


def _sql_model_rows() -> str:
    parts = []
    for name, th in (("loose", 0.3), ("middle", 0.5), ("strict", 0.7)):
        parts.append(
            f"""SELECT '{name}' AS model, unnest(['precision', 'recall', 'f1']) AS metric, unnest([precision, recall, f1]) AS value
FROM (WITH {SQL_SCORED}, {SQL_CLASS.format(th=th)} SELECT * FROM cmet WHERE class = '1')"""
        )
    return " UNION ALL ".join(parts)


@query(
    "m23_model_table",
    f"""WITH m AS ({_sql_model_rows()}), r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS rank FROM m) SELECT *, rank = 1 AS best FROM r""",
)
def _(t):
    rows = []
    for name, th in (("loose", 0.3), ("middle", 0.5), ("strict", 0.7)):
        one = metrics.class_metrics(ruled(t, th)).where("class = '1'")
        rows.append(one.select(F.lit(name).alias("model"), F.expr("stack(3, 'precision', precision, 'recall', recall, 'f1', f1) as (metric, value)")))
    return evaluation.model_table(compare.union_runs(*rows))


def vectors(t):
    return clustering.as_features(t.embeddings, "embedding")


@query("m24_pca")
def _(t):
    _, model = clustering.pca(vectors(t), k=50)
    explained = model.explainedVariance.toArray()
    return t.spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(explained)], "component long, variance double")


@query("m24_pca_total", "SELECT 64::BIGINT AS components, 1.0::DOUBLE AS total, true AS falling")
def _(t):
    """All components together hold the whole variance, largest first."""
    explained = clustering.pca(vectors(t), k=64)[1].explainedVariance.toArray()
    falling = bool((explained[:-1] >= explained[1:] - 1e-12).all())
    return t.spark.createDataFrame([(len(explained), round(float(explained.sum()), 9), falling)], "components long, total double, falling boolean")


def reduced(t):
    """Embeddings on their first 50 principal components."""
    data, _ = clustering.pca(vectors(t), k=50)
    return data.select(vector_to_array("pca").alias("x"))


@query("m25_kmeans")
def _(t):
    found = clustering.kmeans_starts(reduced(t), [2], starts=10, features="x")[2]
    return t.spark.createDataFrame([(i, int(n)) for i, n in enumerate(found.sizes)], "cluster long, size long")


@query("m26_elbow")
def _(t):
    return clustering.elbow(reduced(t), range(1, 7), features="x", starts=10)


@query("m26_elbow_checks", "SELECT k, (SELECT count(*) FROM embeddings) AS rows, true AS settled, true AS falling FROM range(1, 7) r(k)")
def _(t):
    """Of each k: rows of all clusters, whether centres are the means of their rows, and whether the cost is at most that of k - 1."""
    data = materialise(reduced(t), "reduced")
    found = clustering.kmeans_starts(data, range(1, 7), starts=10, features="x", tolerance=0.0)
    rows = []
    for k, c in found.items():
        means = clustering.group_sums(data.withColumn("cluster", clustering.nearest_centre(F.col("x"), c.centres)), "x", "cluster").collect()
        settled = all(abs(a - b) < 1e-6 for m in means for a, b in zip(m.centre, c.centres[m.label]))
        rows.append((k, sum(m.n for m in means), settled, k == 1 or c.cost <= found[k - 1].cost))
    return t.spark.createDataFrame(rows, "k long, rows long, settled boolean, falling boolean")


@query(
    "m27_silhouette",
    """WITH far AS (
  SELECT a.vec_id, a.label, b.label AS other, sum(2 - 2 * list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) + (list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) - 1) + (list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]) - 1)) AS total, count(*) AS n
  FROM embeddings a CROSS JOIN embeddings b GROUP BY ALL),
own AS (SELECT vec_id, total / nullif(n - 1, 0) AS a FROM far WHERE label = other),
near AS (SELECT vec_id, min(total / n) AS b FROM far WHERE label <> other GROUP BY 1)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM own JOIN near USING (vec_id)""",
)
def _(t):
    data = vectors(t).withColumn("cluster", F.col("label").cast("int"))
    return t.spark.createDataFrame([(round(float(clustering.silhouette(data)), 6),)], "silhouette double")


SQL_LONG = """long AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) r(i)),
cen AS (SELECT label, i, avg(x) AS c, count(*) AS n FROM long GROUP BY ALL),"""


@query(
    "m28_calinski_harabasz",
    f"""WITH {SQL_LONG} tot AS (SELECT i, avg(x) AS m FROM long GROUP BY 1), w AS (SELECT sum((x - c) ** 2) AS w FROM long JOIN cen USING (label, i)),
b AS (SELECT sum(n * (c - m) ** 2) AS b FROM cen JOIN tot USING (i))
SELECT round((b / ((SELECT count(DISTINCT label) FROM embeddings) - 1)) / (w / ((SELECT count(*) FROM embeddings) - (SELECT count(DISTINCT label) FROM embeddings))), 6) AS calinski_harabasz FROM w, b""",
)
def _(t):
    value = float(clustering.calinski_harabasz(t.embeddings, "embedding", "label"))
    return t.spark.createDataFrame([(round(value, 6),)], "calinski_harabasz double")


@query(
    "m29_davies_bouldin",
    f"""WITH {SQL_LONG} d AS (SELECT label, vec_id, sqrt(sum((x - c) ** 2)) AS d FROM long JOIN cen USING (label, i) GROUP BY ALL), s AS (SELECT label, avg(d) AS s FROM d GROUP BY 1),
p AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.c - b.c) ** 2)) AS gap FROM cen a JOIN cen b ON a.i = b.i AND a.label <> b.label GROUP BY ALL)
SELECT round(avg(worst), 6) AS davies_bouldin FROM (SELECT la, max((sa.s + sb.s) / gap) AS worst FROM p JOIN s sa ON sa.label = la JOIN s sb ON sb.label = lb GROUP BY la)""",
)
def _(t):
    value = clustering.davies_bouldin(t.embeddings, "embedding", "label")
    return t.spark.createDataFrame([(round(value, 6),)], "davies_bouldin double")


@query("m29_davies_bouldin_by_k")
def _(t):
    return clustering.davies_bouldin_by_k(reduced(t), ks=range(2, 7), features="x")
